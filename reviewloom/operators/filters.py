"""Row filters and projections of catalogue and review tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.constants import RATINGS, UNRATED
from reviewloom.functions import text as tx

# The columns of the analysis.
ANALYSIS_COLUMNS = (
    "product_article", "rating", "text_plus", "text_comment", "text_all", "review_id", "text_minus",
)


def drop_unrated(products: DataFrame, rating: str = "product_rating", unrated: str = UNRATED) -> DataFrame:
    """Rows whose rating is not the unrated mark; NULL ratings stay."""
    return products.filter(~F.col(rating).eqNullSafe(F.lit(unrated)))


def drop_without_reviews(products: DataFrame, count: str = "count_reviews") -> DataFrame:
    """Rows whose review count is not 0; NULL counts stay."""
    return products.filter(~F.col(count).eqNullSafe(F.lit(0)))


def rated_reviews(reviews: DataFrame, ratings: Sequence[int] = RATINGS) -> DataFrame:
    return reviews.filter(F.col("rating").isin(*ratings))


def union_reviews(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of tables of reviews, by column name; a column that a table lacks is NULL. Repeated rows stay."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def analysis_columns(reviews: DataFrame) -> DataFrame:
    """The seven columns the analysis reads, in their order."""
    return reviews.select(*ANALYSIS_COLUMNS)


def catalog_id_of_link(catalogs: DataFrame, link: str) -> DataFrame:
    """One row: the smallest id stored for the link, NULL when there is none."""
    return catalogs.filter(F.col("catalog_link") == link).agg(F.min("catalog_id").alias("catalog_id"))


def articles_of_catalog(products: DataFrame, catalog_id: int) -> DataFrame:
    return products.filter(F.col("catalog_id") == catalog_id).select("product_article")


def reviews_of_article(reviews: DataFrame, article: int, rating: int | None = None) -> DataFrame:
    found = reviews.filter(F.col("product_article") == article)
    return found if rating is None else found.filter(F.col("rating") == rating)


def value_profile(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column, NULL included, with their row counts."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def with_parts(
    reviews: DataFrame,
    text: str = "review_text",
    names: tuple[str, str, str] = ("review_text_plus", "review_text_minus", "review_text_comment"),
    unreadable: Column | None = None,
) -> DataFrame:
    """Replace the part columns by the parts split off ``text``."""
    source = F.col(text)
    parts = tx.split_review(source) if unreadable is None else tx.split_captured_review(source, unreadable)
    kept = reviews.drop(*names).withColumn("_parts", parts)
    for name, part in zip(names, ("text_plus", "text_minus", "text_comment")):
        kept = kept.withColumn(name, F.col(f"_parts.{part}"))
    return kept.drop("_parts")
