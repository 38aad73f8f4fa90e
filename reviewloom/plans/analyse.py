"""Word and bigram analysis of all catalogues, ratings and parts in one plan each."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.constants import CATEGORIES, RUSSIAN_STOP_WORDS, TOP_CLOUD, TOP_REPORT
from reviewloom.operators import terms
from reviewloom.operators.filters import rated_reviews
from reviewloom.operators.relate import catalog_reviews
from reviewloom.session import stored


#: Counters that the sketches of all cells have together, and the fewest that a cell's sketch is of use with.
COUNTERS, LEAST_BUCKETS = 1 << 22, 1 << 12


class Analysis(NamedTuple):
    """``cloud`` holds the top words and bigrams (``term_kind``) with weights; its head is the report."""

    counts_by_rating: DataFrame
    cloud: DataFrame

    def report(self, k: int = TOP_REPORT) -> DataFrame:
        return report_of(self.cloud, k)


def report_of(cloud: DataFrame, k: int = TOP_REPORT) -> DataFrame:
    """The first ranks of a cloud, so that texts are counted once for both."""
    return cloud.filter(F.col("rank") <= k).drop("weight")


def load_reviews(catalogs: DataFrame, products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews of the given catalogues; ``catalog`` is the catalogue id."""
    return catalog_reviews(catalogs, products, reviews).withColumnRenamed("catalog_id", "catalog")


def word_counts(reviews: DataFrame, stop_words: Iterable[str] = RUSSIAN_STOP_WORDS) -> DataFrame:
    parts = terms.review_parts(rated_reviews(reviews))
    return terms.term_counts(terms.word_rows(parts, stop_words=stop_words))


def stored_tokens(
    parts: DataFrame, cell: Sequence[str] = terms.CELL, stop_words: Iterable[str] = RUSSIAN_STOP_WORDS
) -> DataFrame:
    """The tokens of ``terms.part_tokens``, made once, with their places as small as they can be."""
    return terms.compact_places(stored(terms.part_tokens(parts, cell, stop_words), "tokens"))


def bigram_counts(
    reviews: DataFrame, stop_words: Iterable[str] = RUSSIAN_STOP_WORDS, cross_review: bool = True, first: int | None = None
) -> DataFrame:
    """Counts of bigrams. Building them starts jobs: tokens are stored first.

    With ``first``, bigrams that cannot be among the first so many of their cell in any category are left
    out before they are shuffled, and the others counted as without it.
    """
    tokens = stored_tokens(terms.review_parts(rated_reviews(reviews)), stop_words=stop_words)
    rows = terms.bigram_rows(tokens, cross_review=cross_review)
    return terms.term_counts(rows if first is None else first_rows(tokens, rows, terms.CELL, first))


def one_part_bigram_counts(
    reviews: DataFrame, cell: Sequence[str], text: str, stop_words: Iterable[str] = RUSSIAN_STOP_WORDS, first: int | None = None
) -> DataFrame:
    """The same of reviews that have one text, by ``cell``: ``(cell, term, n, first_place)``."""
    tokens = stored_tokens(terms.review_parts(reviews, cell, [text]), cell, stop_words)
    rows = terms.bigram_rows(tokens, cell)
    return terms.single_counts(rows if first is None else first_rows(tokens, rows, cell, first, ["all"]), cell)


def first_rows(
    tokens: DataFrame, rows: DataFrame, cell: Sequence[str], k: int, categories: Sequence[str] = CATEGORIES
) -> DataFrame:
    """``terms.possible_top_rows`` of ``rows``, which are made from ``tokens`` each time they are read.

    The sketches of all cells have a bounded size together; where cells are too many for that, all rows stay.
    """
    cells = tokens.select(*[c for c in cell if c in tokens.columns]).distinct().count()
    buckets = min(terms.BUCKETS, COUNTERS // max(cells, 1))
    return rows if buckets < LEAST_BUCKETS else terms.possible_top_rows(rows, cell, k, categories, buckets)


def top_bigrams_of_large_cells(
    reviews: DataFrame, stop_words: Iterable[str] = RUSSIAN_STOP_WORDS, k: int = TOP_REPORT, buckets: int = terms.BUCKETS
) -> DataFrame:
    """The first ``k`` bigrams of every cell and category, as from :func:`bigram_counts`, without counting the others.

    Pairs are stored first, and most of them are ruled out by a sketch before they are shuffled.
    """
    tokens = stored_tokens(terms.review_parts(rated_reviews(reviews)), stop_words=stop_words)
    pairs = stored(terms.bigram_rows(tokens), "bigrams")
    return terms.top_terms(terms.term_counts(terms.possible_top_rows(pairs, k=k, buckets=buckets)), k=k)


def analyse(
    reviews: DataFrame, stop_words: Iterable[str] = RUSSIAN_STOP_WORDS, cloud: int = TOP_CLOUD
) -> Analysis:
    """Counts per rating and the clouds of loaded reviews (``load_reviews``).

    Words and bigrams share the tokens, one aggregation and one ranking. Building the result starts
    jobs: the tokens are stored, so that texts are read and tokenised once, and terms that cannot come
    into the cloud are ruled out before they are shuffled.
    """
    tokens = stored_tokens(terms.review_parts(rated_reviews(reviews)), stop_words=stop_words)
    kind_cell = [*terms.CELL, "term_kind"]
    rows = first_rows(tokens, terms.word_and_bigram_rows(tokens), kind_cell, cloud)
    counts = terms.term_counts(rows, kind_cell)
    return Analysis(terms.rating_counts(reviews), terms.cloud_terms(counts, [*kind_cell, "category"], cloud))
