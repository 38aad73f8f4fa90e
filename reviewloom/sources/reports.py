"""Report tables: top words, top bigrams and the ``analysis`` rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewloom.functions.keys import cell_title
from reviewloom.session import shuffle_width

# Column names of the report sheets.
TERM_NAME = {"word": "Word", "bigram": "Bigram"}
COUNT_NAME = {"word": "Top 10 Words (Category: {})", "bigram": "Top 10 Bigrams (Category: {})"}


REPORT = "catalog string, rank int, term string, n bigint, term_kind string, rating int, category string"
CLOUD = REPORT.replace("n bigint", "n bigint, weight double")


def write_report(top: DataFrame, path: str) -> None:
    """One folder per kind of term, rating and category; a row holds catalogue, rank, term and count."""
    _write(top, path)


def write_cloud(cloud: DataFrame, path: str) -> None:
    """The same layout with weights."""
    _write(cloud, path)


def _write(top: DataFrame, path: str) -> None:
    """A cell has few rows of a catalogue; the files of a cell follow the shuffle width, for many catalogues."""
    lanes = max(1, shuffle_width(top.sparkSession) // 16)
    (
        top.repartition("term_kind", "rating", "category", F.pmod(F.xxhash64("catalog"), F.lit(lanes)))
        .sortWithinPartitions("term_kind", "rating", "category", "catalog", "rank")
        .write.mode("overwrite")
        .partitionBy("term_kind", "rating", "category")
        .parquet(path)
    )


def read_report(spark: SparkSession, path: str, runs: Sequence[int] | None = None) -> DataFrame:
    """A written report, or the newest of all runs, or of the given ones, below ``path`` (:func:`newest`)."""
    return _read(spark, path, REPORT, runs)


def read_cloud(spark: SparkSession, path: str, runs: Sequence[int] | None = None) -> DataFrame:
    return _read(spark, path, CLOUD, runs)


def _read(spark: SparkSession, path: str, schema: str, runs: Sequence[int] | None) -> DataFrame:
    return newest(spark.read.schema(schema).parquet(path), ["catalog", "rating"], runs)


def newest(rows: DataFrame, cell: Sequence[str], runs: Sequence[int] | None = None) -> DataFrame:
    """Of every cell the rows of the last run that wrote it, without the column ``run``; rows without one stay.

    The runs of a cell are few; only their numbers meet. ``runs`` names the runs that count.
    """
    if "run" not in rows.columns:
        return rows
    if runs is not None:
        rows = rows.filter(F.col("run").isin(*runs) if runs else F.lit(False))
    last = rows.groupBy(*cell).agg(F.max("run").alias("run"))
    return rows.join(last, [*cell, "run"], "left_semi").drop("run")


def sheet(top: DataFrame, catalog: str, rating: int, category: str, kind: str) -> DataFrame:
    """The report sheet of one cell and kind of term: a 0-based index, the term and its count under display names."""
    cell = (F.col("catalog") == catalog) & (F.col("rating") == rating) & (F.col("category") == category)
    return top.filter(cell & (F.col("term_kind") == kind)).select(
        (F.col("rank") - 1).alias("index"),
        F.col("term").alias(TERM_NAME[kind]),
        F.col("n").alias(COUNT_NAME[kind].format(category)),
    )


def titled(top: DataFrame) -> DataFrame:
    """Add the display title of the cell."""
    return top.withColumn("title", cell_title(F.col("category"), F.col("rating")))


def analysis_rows(top: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``(word, frequency, df_index, column)``: rating and category name the cell.

    ``keep`` carries further columns along, to order the rows by.
    """
    return top.select(
        *keep,
        F.col("term").alias("word"),
        F.col("n").cast("double").alias("frequency"),
        F.col("rating").cast("string").alias("df_index"),
        F.col("category").alias("column"),
    )
