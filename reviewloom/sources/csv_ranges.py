"""CSV files with line breaks inside cells, read in byte ranges by many tasks.

Spark's text reader cuts files into ranges and ranges into lines. Whether a line begins inside a quoted
cell follows from the number of quotes before it, odd or even:

1. The quotes of each range are counted, with the records that begin in it if it begins outside a cell
   and if it begins inside one. Only these numbers leave the range; added up along the file they tell
   how each range begins and which record it begins with.
2. Each range puts its lines together to records. A record that goes over the end of its range is put
   together from its pieces, at most two a range. Records are parsed by ``from_csv``.

A quote may stand in quoted cells only, doubled, as the writers of this package and others that follow the
common format write it. A file without a quoted line break reads as the plain reader reads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANGE = ["file_path", "range"]


def read_ranges(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """``file_path, file_name, pos`` (0, 1, … behind the header) and the columns of ``schema`` of all files below ``path``.

    File names are as in a URL, as Spark's metadata gives them. Files without records add no rows; blank
    lines between records are none. The ranges have ``spark.sql.files.maxPartitionBytes`` at most.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    marked = lines.withColumns({"odd": quotes.cast("int"), "blank": F.col("value").isin("", "\r")})
    begins = range_starts(marked)
    placed = marked.join(begins, _RANGE).withColumn("inside", (F.col("begins_inside") + _odd_before()) % 2)
    starts = ((F.col("inside") == 0) & ~F.col("blank")).cast("long")
    here = Window.partitionBy(*_RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = placed.filter((F.col("inside") == 1) | ~F.col("blank")).withColumn("record", F.col("records_before") + F.sum(starts).over(here))
    pieces = numbered.groupBy(*_RANGE, "file_name", "record", "records_before", "records_here", "ends_inside").agg(
        _joined(F.array_sort(F.collect_list(F.struct("at", "value"))))
    )
    # The first and last records of a range may go on in another.
    cut = (F.col("record") == F.col("records_before")) | (F.col("ends_inside") & (F.col("record") == F.col("records_before") + F.col("records_here")))
    keys = ["file_path", "file_name", "record"]
    whole = pieces.filter(~cut).select(*keys, "text")
    parts = pieces.filter(cut).groupBy(*keys).agg(_joined(F.array_sort(F.collect_list(F.struct(F.col("range").alias("at"), F.col("text").alias("value"))))))
    records = whole.unionByName(parts.select(*keys, "text")).filter(F.col("record") > 1)
    text = F.regexp_replace("text", r"\r\z", "")
    cells = F.from_csv(text, schema.simpleString()[len("struct<") : -1].replace(":", " "), {k: v for k, v in options.items() if k != "header"})
    return records.select("file_path", "file_name", (F.col("record") - 2).alias("pos"), cells.alias("c")).select("file_path", "file_name", "pos", "c.*")


def range_starts(marked: DataFrame) -> DataFrame:
    """``file_path, range, begins_inside, records_before, records_here, ends_inside`` of every range with lines.

    Of the lines only the parity of their quotes is looked at; one row a range goes along the file.
    """
    in_range = marked.select(*_RANGE, "at", "odd", "blank").withColumn("before", _odd_before() % 2)
    found = in_range.groupBy(*_RANGE).agg(
        (F.sum("odd") % 2).alias("odd"),
        F.count_if((F.col("before") == 0) & ~F.col("blank")).alias("if_outside"),
        F.count_if((F.col("before") == 1) & ~F.col("blank")).alias("if_inside"),
    )
    along = Window.partitionBy("file_path").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begun = found.withColumn("begins_inside", F.coalesce(F.sum("odd").over(along), F.lit(0)) % 2)
    here = F.when(F.col("begins_inside") == 0, F.col("if_outside")).otherwise(F.col("if_inside"))
    return begun.withColumn("records_here", here).select(
        *_RANGE,
        "begins_inside",
        F.coalesce(F.sum("records_here").over(along), F.lit(0)).alias("records_before"),
        "records_here",
        ((F.col("begins_inside") + F.col("odd")) % 2 == 1).alias("ends_inside"),
    )


def _odd_before() -> Column:
    """Quotes, counted by lines that have an odd number, before a line in its range."""
    before = Window.partitionBy(*_RANGE).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("odd").over(before), F.lit(0))


def _joined(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda p: p.value), "\n").alias("text")
