"""Analysis that grows with its reviews: tokens and sketches are kept, texts are read once.

Four tables below the results folder have a folder ``run=<number>`` for each run:

* ``tokens`` - the content words of the parts that the run read;
* ``counts`` - counts of words and of pairs inside parts by hash bucket (``terms.sketch_counts``), of the
  cells that the run touched, as a whole;
* ``ends``   - first and last words of the parts that the run read, for the pairs across parts and reviews;
* ``marks``  - what each catalogue's analysis has seen: largest review id, number of reviews, and the run
  that it began with.

Reviews are only appended as a rule, with larger ids. New ones are tokenised and their sketch is added to
that of their cells, whose size is bounded whatever the vocabulary is. Pairs across reviews cannot be
added, because a new review comes between two old ones; they are linked anew from the ends of the touched
cells, which are a few words a review. The sketch says which terms can come into a cell's list; these
alone are counted, exactly and with first places, from the kept tokens. Where a review that was counted
is gone, its catalogue begins anew with this run, and so does one whose runs have kept no tokens.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.constants import RATINGS, RUSSIAN_STOP_WORDS, TOP_CLOUD
from reviewloom.operators import terms
from reviewloom.operators.filters import rated_reviews
from reviewloom.plans.analyse import COUNTERS, LEAST_BUCKETS
from reviewloom.session import ROW_GROUP_BYTES, ready_checkpoints, stored
from reviewloom.sources.reports import newest

KIND_CELL = (*terms.CELL, "term_kind")
MARKS = "catalog bigint, first_run int, last_review bigint, n_reviews bigint"


class Growth(NamedTuple):
    """``cells`` (catalog, rating) that changed, and the top terms of these alone, with weights."""

    cells: DataFrame
    cloud: DataFrame


def count_growth(
    loaded: DataFrame,
    catalogs: DataFrame,
    results: str,
    run: int,
    runs: Sequence[int],
    stop_words: Iterable[str] = RUSSIAN_STOP_WORDS,
    cloud: int = TOP_CLOUD,
) -> Growth:
    """Count what is new in the loaded reviews of ``catalogs`` (catalog) and write the state of this run.

    ``runs`` are the finished runs before. Cells of a catalogue that begins with this run all count as
    touched, also those without reviews.
    """
    spark = loaded.sparkSession
    ready_checkpoints(spark)
    old = [r for r in runs if _there(spark, _at(results, "tokens", r))]
    begun = stored(_begin(loaded, catalogs, results, run, old), "begun")
    begun.select("catalog", "first_run", "last_review", "n_reviews").write.mode("overwrite").parquet(_at(results, "marks", run))
    new = loaded.join(begun.select("catalog", "seen"), "catalog").filter(F.col("review_id") > F.col("seen")).drop("seen")
    made = terms.part_tokens(terms.review_parts(rated_reviews(new)), stop_words=stop_words)
    made.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(_at(results, "tokens", run))
    tokens = spark.read.schema(made.schema).parquet(_at(results, "tokens", run))
    every = begun.filter(F.col("first_run") == run).select("catalog", F.explode(F.array(*map(F.lit, RATINGS))).alias("rating"))
    cells = stored(every.unionByName(rated_reviews(new).select(*terms.CELL)).distinct(), "cells")

    terms.part_ends(tokens).write.mode("overwrite").parquet(_at(results, "ends", run))
    fresh = terms.sketch_counts(terms.word_and_bigram_rows(tokens, cross_review=False), KIND_CELL)
    if old:
        kept = _since(spark, results, "counts", old, begun)
        kept = newest(kept.join(cells, list(terms.CELL), "left_semi"), list(terms.CELL))
        fresh = terms.merge_counts(fresh.unionByName(kept.select(*fresh.columns)), KIND_CELL, "_bucket")
    fresh.write.mode("overwrite").parquet(_at(results, "counts", run))

    def touched(name: str) -> DataFrame:
        return _since(spark, results, name, [*old, run], begun).join(cells, list(terms.CELL), "left_semi").drop("run")

    ends = touched("ends").checkpoint()
    ends, tokens = terms.compact_together(ends, F.col("last_pos") + 1, ends, touched("tokens"))
    border = stored(terms.linked_ends(ends).withColumn("term_kind", F.lit("bigram")), "borders")
    rows = terms.word_and_bigram_rows(tokens, cross_review=False).unionByName(border)
    return Growth(cells, terms.cloud_terms(_first_counts(rows, border, cells, _at(results, "counts", run), fresh, cloud), [*KIND_CELL, "category"], cloud))


def _first_counts(rows: DataFrame, border: DataFrame, cells: DataFrame, counts: str, fresh: DataFrame, k: int) -> DataFrame:
    """Counts of the terms that can come into the lists; all of them where cells are too many for sketches."""
    if cells.count() * LEAST_BUCKETS > COUNTERS:
        return terms.term_counts(rows, KIND_CELL)
    inner = rows.sparkSession.read.schema(fresh.schema).parquet(counts)
    sketch = terms.merge_counts(inner.unionByName(terms.sketch_counts(border, KIND_CELL).select(*inner.columns)), KIND_CELL, "_bucket")
    return terms.leading_counts(rows, sketch, KIND_CELL, k)


def _begin(loaded: DataFrame, catalogs: DataFrame, results: str, run: int, runs: Sequence[int]) -> DataFrame:
    """Marks of this run with ``seen``, the id up to which reviews have been counted: ids and numbers alone are read."""
    spark = loaded.sparkSession
    marks = [r for r in runs if _there(spark, _at(results, "marks", r))]
    before = spark.createDataFrame([], MARKS)
    if marks:
        before = newest(spark.read.schema(f"{MARKS}, run int").option("basePath", f"{results}/marks").parquet(*[_at(results, "marks", r) for r in marks]), ["catalog"])
    before = catalogs.join(before, "catalog", "left").select("catalog", "first_run", F.col("last_review").alias("_last"), F.col("n_reviews").alias("_n"))
    placed = loaded.select("catalog", "review_id").join(before.select("catalog", "_last"), "catalog")
    counted = placed.groupBy("catalog").agg(
        F.max("review_id").alias("last_review"), F.count(F.lit(1)).alias("n_reviews"), F.count_if(F.col("review_id") <= F.col("_last")).alias("_still")
    )
    goes_on = F.col("first_run").isNotNull() & (F.coalesce("_still", F.lit(0)) == F.col("_n"))
    return before.join(counted, "catalog", "left").select(
        "catalog",
        F.when(goes_on, F.col("first_run")).otherwise(run).cast("int").alias("first_run"),
        F.coalesce("last_review", F.lit(-1)).cast("bigint").alias("last_review"),
        F.coalesce("n_reviews", F.lit(0)).cast("bigint").alias("n_reviews"),
        F.when(goes_on, F.col("_last")).otherwise(-1).cast("bigint").alias("seen"),
    )


def _since(spark, results: str, name: str, runs: Sequence[int], begun: DataFrame) -> DataFrame:
    """A table's rows of the given runs, as far as they are not older than what their catalogue began with."""
    rows = spark.read.option("basePath", f"{results}/{name}").parquet(*[_at(results, name, r) for r in runs])
    return rows.join(begun.select("catalog", "first_run"), "catalog").filter(F.col("run") >= F.col("first_run")).drop("first_run")


def _at(results: str, name: str, run: int) -> str:
    return f"{results}/{name}/run={run}"


def _there(spark, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
