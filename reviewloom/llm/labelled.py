"""The labelled rows that classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import held_out, stored


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, text_bytes: int | None = None) -> DataFrame:
    """``text, label`` of at most ``rows`` labelled documents outside the held-out fold.

    The rows with the smallest hashes of their ids are taken, whatever the size of the tables; NULL
    labels and ids are passed over. The chosen ids are a bounded set, which Spark broadcasts below
    its size limit, so texts are not shuffled.

    With ``text_bytes``, an id that several documents hold does not exceed ``rows`` either: documents
    are taken by the hashes of id and text, equal ones once, as far as their whole texts together have
    at most so many bytes; a longer one is passed over.
    """
    named = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    chosen = named.select("doc_id", F.col(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if text_bytes is None:
        return texts.join(chosen, "doc_id").select("text", "label")
    chosen = stored(chosen, "chosen-labels")
    named_texts = texts.withColumns({"_h": F.xxhash64("text"), "_size": F.octet_length("text")})
    keys = ["doc_id", "_h", "_size", "label"]
    sizes = named_texts.select("doc_id", "_h", "_size").join(chosen, "doc_id").filter(F.col("_size") <= text_bytes)
    first = sizes.groupBy(*keys).agg(F.lit(1)).select(*keys).orderBy(F.xxhash64("doc_id"), "doc_id", "_h", "_size", "label").limit(rows)
    taken, room = [], text_bytes
    for r in first.collect():  # at most ``rows`` rows of numbers
        if r["_size"] <= room:
            room -= r["_size"]
            taken.append(tuple(r))
    kept = docs.sparkSession.createDataFrame(taken, sizes.select(*keys).schema)
    # One of equal documents, so that the sum above holds; texts that are not taken are held back before the shuffle.
    one = named_texts.join(F.broadcast(kept), ["doc_id", "_h", "_size"]).groupBy(*keys).agg(F.min("text").alias("text"))
    return one.select("text", "label")
