"""Incremental collecting: captured review files arrive in a folder and are collected into the store.

The stream keeps the products and page positions that it has seen as keyed state, so a batch reads and
writes what it brings, however large the store is. Each batch is a folder of its own, which a replay
writes again, so repeated files and replayed batches add nothing and it does not matter how files are
split into batches. A lost checkpoint loses the state and captures everything once more; :func:`settle`,
which brings products and reviews of the store up to the captured rows, then takes the first capture of
each place. Settling picks, counts and numbers reviews without their texts, which are long; the texts of
the reviews that are written are then fetched from the captured files in one join.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewloom.constants import MAX_REVIEWS
from reviewloom.functions.keys import decimal_comma
from reviewloom.operators.filters import drop_unrated
from reviewloom.plans.collect import collected, with_captured_parts
from reviewloom.schemas import CAPTURED
from reviewloom.session import freed_shuffles, ready_checkpoints, settings, stored
from reviewloom.sources.store import FeedbackStore

_PLACE = ["product_article", "review_pos"]
_CAPTURE = ["reviewed_article", "review_pos", "_row"]
# State on disk, and nothing allocated ahead: stores are many and small, and each would take megabytes.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
_ORDER = ["catalog_id", "position", "product_article"]


def captured_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(CAPTURED).option("maxFilesPerTrigger", files_per_batch).json(folder)


def new_captures(stream: DataFrame) -> DataFrame:
    """Captured rows of rated products, each product and page position once; rows without a product are not kept."""
    return drop_unrated(stream).filter(F.col("product_article").isNotNull()).dropDuplicates(_PLACE)


def first_captures(store: FeedbackStore) -> DataFrame:
    """Captured rows, of each product and page position the one that was captured first.

    One stream captures a place once. Only where the batches come from several checkpoints are captures
    compared, by the time of their file, then by its name and their content.
    """
    columns = CAPTURED.names
    if len(_streams(store)) < 2:
        return store.read_batches("captured")
    timed = store.read_batches("captured", F.struct("_metadata.file_modification_time", "_metadata.file_path").alias("_at"))
    rest = [c for c in columns if c not in _PLACE]
    first = timed.groupBy(*_PLACE).agg(F.min(F.struct("_at", *rest)).alias("_row"))
    return first.select(*[F.col(c) if c in _PLACE else F.col(f"_row.{c}").alias(c) for c in columns])


def _marked_captures(store: FeedbackStore) -> DataFrame:
    """:func:`first_captures` with ``_row``, which tells rows of one place apart and is the same at every reading."""
    row = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_row")
    if len(_streams(store)) < 2:
        return store.read_batches("captured", row)
    return stored(first_captures(store), "first-captures").select("*", row)


def _streams(store: FeedbackStore) -> set[str]:
    """Names of the checkpoints that the captured batches come from."""
    return {b.rpartition("-")[0] for b in store.batches("captured")}


def settle(store: FeedbackStore, max_reviews: int = MAX_REVIEWS) -> None:
    """Bring products and reviews up to the captured rows: at most ``max_reviews`` a product over all
    batches, in page order, with ``count_reviews`` to match.

    New products are appended. Stored products whose reviews are others now get new rows in a new
    version of the two tables; unchanged ones keep theirs, so settling twice adds nothing. Reviews are
    written before products, and reviews without a product are left over from a run that broke off
    and are replaced. Catalogues of changed products are open for analysis again.
    """
    ready_checkpoints(store.spark)
    with freed_shuffles(store.spark):
        _settle(store, _marked_captures(store), max_reviews)


def _settle(store: FeedbackStore, captured: DataFrame, max_reviews: int) -> None:
    per_product = captured.groupBy("product_article").agg(
        F.min(F.struct("catalog_id", "position", "name", "product_rating")).alias("p")
    )
    picks = per_product.select("product_article", "p.catalog_id", "p.position")
    products = per_product.select(
        "product_article", F.col("p.name").alias("name"), decimal_comma(F.col("p.product_rating")).alias("rating")
    )
    readable = captured.filter(F.col("review_pos").isNotNull() & F.col("rating").isNotNull())
    content = F.xxhash64("text_all", "rating", "text_plus", "text_minus", "text_comment")
    known = store.read("products").select("product_article", "count_reviews")
    mark = F.lit(0).cast("bigint") if known.isEmpty() else content  # with no product stored there is nothing to compare: texts need not be read for it
    reviews = with_captured_parts(readable, "text").select("product_article", "variant_group", "review_pos", "rating", "_row", mark.alias("content"))
    found, shown = collected(products, reviews, picks, max_reviews, captured.select("product_article", "variant_group"))

    marks = [F.sum(F.col("content").cast("decimal(38,0)")).alias("mark"), F.count(F.lit(1)).alias("n")]
    kept = store.read("reviews").withColumn("content", content).groupBy("product_article").agg(*marks)
    wanted = shown.groupBy("product_article").agg(*marks)
    before = known.join(kept, "product_article", "left").select("product_article", "count_reviews", F.struct("mark", "n").alias("before"))
    now = found.select("product_article", F.col("count_reviews").alias("count_now")).join(wanted, "product_article", "left")
    compared = now.select("product_article", "count_now", F.struct("mark", "n").alias("now")).join(before, "product_article", "left")
    same = F.col("before").eqNullSafe(F.col("now")) & F.col("count_reviews").eqNullSafe(F.col("count_now"))
    changed = compared.filter(~same).select("product_article").checkpoint()
    if changed.isEmpty():
        return
    store.reopen(picks.join(changed, "product_article", "left_semi").select("catalog_id").distinct())
    texts = captured.select(F.col("product_article").alias("reviewed_article"), "review_pos", "_row", "text")

    def with_texts(numbered: DataFrame) -> DataFrame:
        return with_captured_parts(numbered.join(texts, _CAPTURE), "text")

    for name, rows, id_column, order, finish in (
        ("reviews", shown, "review_id", [*_ORDER, "rank"], with_texts), ("products", found, "product_id", _ORDER, None)
    ):
        new = rows.join(changed, "product_article", "left_semi")
        if store.read(name).join(changed, "product_article", "left_semi").isEmpty():
            store.append_numbered(name, new, id_column, order, finish)
        else:
            store.exchange_numbered(name, changed, "product_article", new, id_column, order, finish)


def start_ingest(store: FeedbackStore, stream: DataFrame, checkpoint: str) -> StreamingQuery:
    """Capture until all files that are there have been read; :func:`settle` afterwards.

    The state is kept by RocksDB, so that it need not fit into memory, and a batch's shuffle files go when it
    is written; the session's settings are put back once the stream has started.
    """
    store.create()
    name = f"{zlib.crc32(checkpoint.rstrip('/').encode()):08x}"
    with settings(store.spark, _STATE), freed_shuffles(store.spark):
        return (
            new_captures(stream).writeStream.foreachBatch(lambda batch, number: store.write_batch("captured", batch, f"{name}-{number:06d}"))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
