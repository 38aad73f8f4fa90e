"""Products that carry the identical review set.

Comparing all pairs of products is replaced by one fingerprint per product and one grouping by
fingerprint. The fingerprint is a XOR over row digests, each bound to its position, so it is built
with map-side partial aggregation and a product of any size never sits in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORDS = ("fp0", "fp1", "fp2", "fp3")


def fingerprints(rows: DataFrame, key: Sequence[str], position: str, columns: Sequence[str]) -> DataFrame:
    """``(key, n_rows, fp0 … fp3)``: equal for two keys with the same rows in the same order.

    ``position`` numbers the rows of a key densely from a common start (``dense_positions`` makes
    such numbers); NULL equals NULL. The four words are the four parts of SHA-256 row digests, so they
    hold 256 bits and none follows from another.
    """
    row = F.to_json(F.struct(F.col(position).alias("p"), *columns), {"ignoreNullFields": "false"})
    digest = rows.select(*key, F.sha2(row, 256).alias("_digest"))
    part = [F.conv(F.substring("_digest", 1 + 16 * i, 16), 16, -10).cast("bigint") for i in range(len(_WORDS))]
    words = [F.bit_xor(p).alias(w) for p, w in zip(part, _WORDS)]
    return digest.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"), *words)


def review_set_groups(
    listing: DataFrame,
    rows: DataFrame,
    scope: Sequence[str],
    key: str,
    listed: str,
    position: str,
    columns: Sequence[str],
) -> DataFrame:
    """Every listed key with ``kept`` — the first listed key of its scope with the same review set.

    ``listing`` names the keys (also those without rows: all of them share the empty set) and the
    column ``listed`` that orders them.
    """
    marks = fingerprints(rows, [*scope, key], position, columns)
    empty = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_rows", *_WORDS)]
    marked = listing.join(marks, [*scope, key], "left").select(*scope, key, listed, *empty)
    same_set = [*scope, "n_rows", *_WORDS]
    firsts = marked.groupBy(*same_set).agg(F.min(F.struct(listed, key)).alias("_first"))
    return marked.join(firsts, same_set).select(*scope, key, F.col(f"_first.{key}").alias("kept"))


def drop_keys(df: DataFrame, dropped: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.join(dropped, list(key), "left_anti").select(*df.columns)
