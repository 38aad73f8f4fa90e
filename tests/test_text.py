import random

import pytest
from pyspark.sql import functions as F

from reviewloom.constants import PUNCTUATION, RUSSIAN_STOP_WORDS
from reviewloom.functions import keys
from reviewloom.functions import text as tx

PIECES = [
    "Достоинства:", "Недостатки:", "Комментарий:", "Достоинства", ":", " ", "\n", "\r", "\t", "\x85", "\xa0", "　",
    "​", "\x1c", "\x1f", " ", "хорошо", "Размер, 46!", "Нет", "«кеды»", "A-b", "İ", "е́", "\\", "$1", "…",
]


def random_texts(count, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 12))) for _ in range(count)]


def expected_parts(text):
    """Line-wise reading of the labels, written without regular expressions."""
    text = text or ""

    def behind(label):
        at = text.find(label)
        if at < 0:
            return None
        rest = text[at + len(label):].lstrip()
        return rest.split("\n", 1)[0]

    plus, minus, comment = (behind(f"{name}:") for name in ("Достоинства", "Недостатки", "Комментарий"))
    if comment is None:
        body = text.strip()
        if not body.startswith(("Достоинства:", "Недостатки:")):
            comment = body.split("\n", 1)[0]
    return tuple("Нет" if part is None else part for part in (plus, minus, comment))


def test_split_review_matches_line_reading(spark):
    texts = random_texts(20_000, 1) + ["", None, "Достоинства:", "Комментарий:\n\nда"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select("i", tx.split_review(F.col("t")).alias("p")).select("i", "p.*").collect()
    wrong = [(texts[r[0]], tuple(r[1:])) for r in rows if tuple(r[1:]) != expected_parts(texts[r[0]])]
    assert wrong == []


def test_unreadable_review_misses_every_part(spark):
    row = spark.range(1).select(tx.split_captured_review(F.lit(""), F.lit(True)).alias("p"),
                                tx.split_captured_review(F.lit(""), F.lit(False)).alias("q")).first()
    assert tuple(row.p) == ("Нет", "Нет", "Нет")
    assert tuple(row.q) == ("Нет", "Нет", "")


def test_tokens_match_python(spark):
    texts = random_texts(5_000, 2)
    delete = str.maketrans("", "", PUNCTUATION)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    rows = df.select(
        "i",
        tx.clean_text(F.col("t")).alias("clean"),
        tx.clean_tokens(F.col("t")).alias("fused"),
        tx.tokens(tx.clean_text(F.col("t"))).alias("plain"),
        tx.drop_stop_words(tx.clean_tokens(F.col("t"))).alias("content"),
        tx.inner_bigrams(tx.clean_tokens(F.col("t"))).alias("pairs"),
    ).collect()
    for r in rows:
        clean = texts[r.i].lower().translate(delete)
        words = clean.split()
        assert r.clean == clean
        assert r.fused == words and r.plain == words
        assert r.content == [w for w in words if w.lower() not in RUSSIAN_STOP_WORDS]
        assert r.pairs == [" ".join(p) for p in zip(words, words[1:])]


def test_null_text_stays_null(spark):
    row = spark.range(1).select(tx.clean_text(F.lit(None).cast("string")).alias("c")).first()
    assert row.c is None


def test_keys(spark):
    row = spark.range(1).select(
        keys.article_from_link(F.lit("https://shop.example/catalog/123/detail?x=/catalog/9/")).alias("a"),
        keys.article_or_null(F.lit("https://shop.example/brands")).alias("b"),
        keys.key_from_file_name(F.lit("/x/shoes/778.csv")).alias("c"),
        keys.result_slug(F.lit("https://www.shop.example/a/b?c=1")).alias("d"),
        keys.file_slug(F.lit("https://shop.example/catalog/obuv/kedy-i-mokasiny"), "https://shop.example/catalog/").alias("e"),
        keys.decimal_comma(F.lit("4,7")).alias("f"),
        keys.decimal_comma(F.lit("Нет оценок")).alias("g"),
        keys.cell_title(F.lit("Весь отзыв"), F.lit(3)).alias("h"),
    ).first()
    assert tuple(row) == (123, None, 778, "shop.example_a_b_c=1", "obuvkedy_i_mokasiny", 4.7, None, "Весь отзыв (Оценка 3/5)")


def test_link_without_article_fails(spark):
    with pytest.raises(Exception, match="no product article"):
        spark.range(1).select(keys.article_from_link(F.lit("https://shop.example/"))).collect()
