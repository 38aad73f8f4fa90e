"""Cleaning and preprocessing of collected CSV trees, all catalogues in one plan."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from reviewloom.operators.dedup import drop_keys, review_set_groups
from reviewloom.operators.filters import drop_unrated, drop_without_reviews, with_parts
from reviewloom.schemas import PROCESSED_REVIEW_CSV
from reviewloom.sources import csv_tree

RAW_COLUMNS = ("review_rating", "review_text", "review_text_plus", "review_text_minus")


class Cleaned(NamedTuple):
    catalogs: DataFrame
    reviews: DataFrame
    kept_files: DataFrame


def clean_catalogs(catalogs: DataFrame, reviews: DataFrame, files: DataFrame) -> Cleaned:
    """Drop unrated and review-less products and all but the first product of equal review sets.

    Catalogue rows without a review file stay; a repeated catalogue row stays repeated.
    """
    groups = review_set_groups(
        files, reviews, ["catalog"], "product_article", "file_name", "review_pos", RAW_COLUMNS
    )
    key = ["catalog", "product_article"]
    dropped = groups.filter("product_article <> kept").select(*key)
    kept = groups.filter("product_article = kept").select(*key)
    rated = drop_without_reviews(drop_unrated(catalogs))
    return Cleaned(drop_keys(rated, dropped, key), reviews.join(kept, key, "left_semi"), kept)


def clean_tree(spark: SparkSession, raw: str, clean: str, ranged: bool = False) -> None:
    """Raw or written tree -> clean tree, with the kept products, also those without rows, in ``kept_files``.

    The clean tree's files hold many products each, so their number does not grow with that of the products.
    ``ranged`` reads large review files by many tasks.
    """
    result = clean_catalogs(*csv_tree.read_tree(spark, raw, ranged))
    csv_tree.write_catalogs(result.catalogs, f"{clean}/catalogs")
    csv_tree.write_shared_reviews(result.reviews, f"{clean}/reviews")
    csv_tree.write_kept_files(result.kept_files, f"{clean}/kept_files")


def preprocess_reviews(reviews: DataFrame) -> DataFrame:
    """Replace the empty part columns of collected reviews by the parts of their text."""
    return with_parts(reviews)


def preprocess_tree(spark: SparkSession, clean: str, processed: str, files_per_catalog: int | None = None) -> None:
    """Written clean tree -> processed tree and one combined table per catalogue."""
    parsed = preprocess_reviews(csv_tree.read_written_reviews(spark, f"{clean}/reviews"))
    columns = ["catalog", "product_article", "review_pos", *PROCESSED_REVIEW_CSV.names]
    csv_tree.write_shared_reviews(parsed.select(*columns), f"{processed}/reviews")
    csv_tree.write_combined(parsed.select(*columns), f"{processed}/all", files_per_catalog)
    csv_tree.write_kept_files(csv_tree.read_kept_files(spark, f"{clean}/kept_files"), f"{processed}/kept_files")
