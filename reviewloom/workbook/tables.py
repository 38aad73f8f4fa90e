"""Views of the given tables in the shape of catalogues, products and reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.constants import LABEL_COMMENT, LABEL_MINUS, LABEL_PLUS, RUSSIAN_STOP_WORDS
from reviewloom.functions import text as tx

# The stop list of the jobs, with frequent short words of the four languages of ``documents``.
STOP_WORDS = RUSSIAN_STOP_WORDS + tuple("the and of to in die der und le de la les el que en".split())


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as reviews with one part: catalogue = language, product = source."""
    return table(spark, folder, "documents").select(
        F.col("lang").alias("catalog"),
        F.substring("source", 4, 10).cast("bigint").alias("product_id"),
        F.col("doc_id").alias("review_id"),
        "text",
    )


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Turns as reviews with one part: catalogue = role, product = conversation."""
    return table(spark, folder, "conversations").select(
        F.col("role").alias("catalog"),
        F.col("conv_id").alias("product_id"),
        F.col("turn").alias("review_id"),
        "text",
    )


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with review labels written into their text, in six forms by ``doc_id``."""
    docs = documents(spark, folder)
    text = F.col("text")
    flat = F.replace(text, F.lit("\n"), F.lit(" "))
    lines = F.split(text, "\n")
    line = lambda i: F.coalesce(F.get(lines, F.lit(i)), F.lit(""))
    plus, minus, comment = (F.lit(f"{label}:") for label in (LABEL_PLUS, LABEL_MINUS, LABEL_COMMENT))
    form = F.pmod("review_id", F.lit(6))
    review = (
        F.when(form == 0, F.concat(plus, F.lit(" "), flat))
        .when(form == 1, F.concat(minus, F.lit(" "), flat))
        .when(form == 2, F.concat(plus, F.lit(" "), line(0), F.lit("\n"), minus, F.lit(" "), line(1), F.lit("\n"), comment, flat))
        .when(form == 3, text)
        .when(form == 4, F.concat(plus, F.lit("\n"), flat, F.lit("\n"), comment))
        .otherwise(F.concat(comment, F.lit("\n  "), flat))
    )
    return docs.withColumn("text", review)


def reviews(spark: SparkSession, folder: str, slices: int | None = None) -> DataFrame:
    """Labelled documents with rating and parts. Rating 1 to 4 from the labels, 5 without a label."""
    return with_parts(whole_reviews(spark, folder, slices))


def with_parts(reviews: DataFrame) -> DataFrame:
    return reviews.select("*", tx.split_review(F.col("text_all")).alias("p")).select(*reviews.columns, "p.*")


def whole_reviews(spark: SparkSession, folder: str, slices: int | None = None) -> DataFrame:
    """The same without the parts; with ``slices``, dealt by review into so many partitions.

    Texts are shuffled once for the labels and the slices: the join takes over the dealing, or, where it
    wants more partitions, deals into these, which are then put together.
    """
    docs = labelled(spark, folder)
    marks = table(spark, folder, "labels").select(F.col("doc_id").alias("review_id"), "quality", "toxic")
    rating = F.coalesce(1 + 2 * F.col("quality") + F.col("toxic"), F.lit(5)).cast("int")
    if slices is not None:
        docs, marks = docs.repartition(slices, "review_id"), marks.repartition(slices, "review_id")
    rated = docs.join(marks, "review_id", "left").select(
        "catalog", "product_id", "review_id", rating.alias("rating"), F.col("text").alias("text_all")
    )
    return rated if slices is None else rated.coalesce(slices)


def document_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as products, their lines as reviews in order."""
    return table(spark, folder, "documents").select(
        F.col("lang").alias("catalog"),
        F.col("doc_id").alias("product_article"),
        F.posexplode(F.split("text", "\n")).alias("review_pos", "line"),
    )


def shop(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nations as catalogues, customers as products, orders as reviews."""
    catalogs = table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("catalog_id"), F.col("n_name").alias("catalog_link")
    )
    products = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("product_id"),
        F.col("c_custkey").alias("product_article"),
        F.col("c_nationkey").cast("bigint").alias("catalog_id"),
        F.col("c_name").alias("name"),
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("review_id"),
        F.col("o_custkey").alias("product_article"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("rating"),
        F.col("o_orderpriority").alias("text_all"),
        F.col("o_orderstatus").alias("text_plus"),
        F.lit(None).cast("string").alias("text_minus"),
        F.col("o_orderpriority").alias("text_comment"),
    )
    return catalogs, products, orders


def part_listings(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Order lines as catalogue listings (catalogue = supplier) and some parts as stored products."""
    listings = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("catalog_id"),
        F.col("l_partkey").alias("product_article"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("position"),
    )
    stored = table(spark, folder, "part").filter("p_size <= 20").select(
        F.col("p_partkey").alias("product_article"), F.pmod("p_partkey", F.lit(100)).alias("catalog_id")
    )
    return listings, stored


LINE_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity"]


def part_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as reviews of parts; the brand is the group of variants."""
    lines = table(spark, folder, "lineitem").select("l_partkey", *LINE_ORDER)
    brands = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return lines.join(brands, "l_partkey")
