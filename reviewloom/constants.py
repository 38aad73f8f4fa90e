"""Fixed values of the review language, and the defaults of the jobs."""

# The labels that open a part of a review.
LABEL_PLUS = "Достоинства"
LABEL_MINUS = "Недостатки"
LABEL_COMMENT = "Комментарий"
LABEL_WHOLE = "Весь отзыв"

# What stands for a missing part, and for a missing product rating.
MISSING_PART = "Нет"
UNRATED = "Нет оценок"

# The parts of a review in the order in which they make up the whole review.
PARTS = (("text_plus", LABEL_PLUS), ("text_minus", LABEL_MINUS), ("text_comment", LABEL_COMMENT))
CATEGORIES = tuple(label for _, label in PARTS) + (LABEL_WHOLE,)
RATINGS = (1, 2, 3, 4, 5)

# Defaults of the collecting jobs.
MAX_PRODUCTS = 100
MAX_REVIEWS = 100
TOP_REPORT = 10
TOP_CLOUD = 100

# The 32 ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# The Unicode whitespace characters, with the four ASCII separators.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set as a character class that Java and RE2 both read.
WHITESPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# The common Russian stop list (151 words).
RUSSIAN_STOP_WORDS = tuple(
    """
    и в во не что он на я с со как а то все она так его но да ты к у же вы за бы по только ее
    мне было вот от меня еще нет о из ему теперь когда даже ну вдруг ли если уже или ни быть был
    него до вас нибудь опять уж вам ведь там потом себя ничего ей может они тут где есть надо ней
    для мы тебя их чем была сам чтоб без будто чего раз тоже себе под будет ж тогда кто этот того
    потому этого какой совсем ним здесь этом один почти мой тем чтобы нее сейчас были куда зачем
    всех никогда можно при наконец два об другой хоть после над больше тот через эти нас про всего
    них какая много разве три эту моя впрочем хорошо свою этой перед иногда лучше чуть том нельзя
    такой им более всегда конечно всю между
    """.split()
)
