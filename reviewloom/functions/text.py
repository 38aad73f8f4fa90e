"""Review text as Column -> Column functions; everything stays in built-in expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewloom.constants import (
    LABEL_COMMENT,
    LABEL_MINUS,
    LABEL_PLUS,
    MISSING_PART,
    PUNCTUATION,
    RUSSIAN_STOP_WORDS,
    WHITESPACE,
    WHITESPACE_CLASS,
)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    """Cut Unicode whitespace off both ends."""
    return F.regexp_replace(text, rf"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+\z", "")


def labelled_part(text: Column, label: str) -> Column:
    """What follows the first ``label:`` up to the end of its line; NULL where there is none.

    Whitespace after the colon is skipped, line breaks included, so a label with nothing
    behind it takes the next line.
    """
    value = F.regexp_extract(text, rf"{label}:{WHITESPACE_CLASS}*([^\n]*)", 1)
    return F.when(F.contains(text, F.lit(f"{label}:")), value)


def split_review(
    text: Column,
    plus: str = LABEL_PLUS,
    minus: str = LABEL_MINUS,
    comment: str = LABEL_COMMENT,
    missing: str = MISSING_PART,
) -> Column:
    """Struct ``(text_plus, text_minus, text_comment)`` of a review.

    Without a comment label the first line counts as the comment, unless it opens with one of
    the other two labels.
    """
    text = text_or_empty(text)
    opens_labelled = F.regexp_like(text, F.lit(rf"^{WHITESPACE_CLASS}*(?:{plus}|{minus}):"))
    # The first line of the stripped text, found without copying the text: it ends with its line, or where only whitespace follows.
    first_line = F.when(~opens_labelled, F.regexp_extract(text, rf"^{WHITESPACE_CLASS}*([^\n]*?)(?:{WHITESPACE_CLASS}*\z|\n)", 1))
    return F.struct(
        F.coalesce(labelled_part(text, plus), F.lit(missing)).alias("text_plus"),
        F.coalesce(labelled_part(text, minus), F.lit(missing)).alias("text_minus"),
        F.coalesce(labelled_part(text, comment), first_line, F.lit(missing)).alias("text_comment"),
    )


def split_captured_review(text: Column, unreadable: Column, missing: str = MISSING_PART) -> Column:
    """:func:`split_review`, but an unreadable review has all three parts missing."""
    gone = F.struct(*[F.lit(missing).alias(f"text_{p}") for p in ("plus", "minus", "comment")])
    return F.when(unreadable, gone).otherwise(split_review(text))


def clean_text(text: Column) -> Column:
    """Lower-case and delete ASCII punctuation; NULL stays NULL."""
    return F.translate(F.lower(text), PUNCTUATION, "")


def tokens(text: Column) -> Column:
    """Split at whitespace runs, without empty tokens."""
    spaced = F.translate(text, WHITESPACE, " " * len(WHITESPACE))
    return F.array_remove(F.split(spaced, " "), "")


def clean_tokens(text: Column) -> Column:
    """``tokens(clean_text(text))`` in one pass over the characters."""
    folded = F.translate(F.lower(text), WHITESPACE + PUNCTUATION, " " * len(WHITESPACE))
    return F.array_remove(F.split(folded, " "), "")


def is_content_word(
    word: Column, stop_words: Iterable[str] = RUSSIAN_STOP_WORDS, lowered: bool = False
) -> Column:
    return ~(word if lowered else F.lower(word)).isin(*stop_words)


def drop_stop_words(
    words: Column, stop_words: Iterable[str] = RUSSIAN_STOP_WORDS, lowered: bool = False
) -> Column:
    """Content words of a token array; ``lowered`` says that the tokens are lower-case already."""
    stop = list(stop_words)
    return F.filter(words, lambda word: is_content_word(word, stop, lowered))


def join_tokens(words: Column) -> Column:
    return F.array_join(words, " ")


def inner_bigrams(words: Column) -> Column:
    """Adjacent pairs of one token array."""
    short = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(
        F.slice(words, F.lit(1), short),
        F.slice(words, F.lit(2), short),
        lambda left, right: F.concat_ws(" ", left, right),
    )
