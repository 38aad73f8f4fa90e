"""Order-aware operators that never sort a whole group in one task.

A group (a catalogue, a rating, a product) may hold a third of all rows, so a plain
``Window.partitionBy(group)`` would put a third of the data into one task. The operators here cut
the total order into range slices first and only carry slice borders across.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.session import ready_checkpoints, shuffle_width


# Several slices per shuffle partition even out how many of them meet in one task.
SLICES_PER_TASK = 4


def top_k(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    k: int,
    rank: str = "rank",
    lanes: int = 1,
    lane_key: Sequence[str] = (),
) -> DataFrame:
    """First ``k`` rows of every group, numbered from 1.

    The rank filter sits right above the window, so Spark cuts every group to ``k`` rows before the
    shuffle. With ``lanes`` > 1 a group is first cut to ``k`` rows per lane (a hash of ``lane_key``)
    and then to ``k`` rows; use it on raw rows, where every map task may send ``k`` rows of a hot group.
    """
    if lanes > 1:
        lane = F.pmod(F.xxhash64(*lane_key), F.lit(lanes))
        by_lane = Window.partitionBy(*group, "_lane").orderBy(*order)
        df = (
            df.withColumn("_lane", lane)
            .withColumn("_lane_rank", F.row_number().over(by_lane))
            .filter(F.col("_lane_rank") <= k)
            .drop("_lane", "_lane_rank")
        )
    by_group = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(by_group)).filter(F.col(rank) <= k)


def next_in_order(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    carry: Sequence[str],
    out: str = "next",
    slices: int | None = None,
) -> DataFrame:
    """Add ``out``: a struct of ``carry`` of the following row of the group, NULL on its last row.

    ``order`` must be total inside a group. Rows are range-partitioned on (group, order); inside a
    slice ``lead`` gives the answer for all rows but the last. First and last rows of the slices,
    at most two per slice and group, are then linked by a second window; the other rows stay
    spread over their slices.
    """
    slices = slices or SLICES_PER_TASK * shuffle_width(df.sparkSession)
    carried = F.struct(*carry)
    in_slice = Window.partitionBy("_slice", *group).orderBy(*order)
    across = Window.partitionBy("_lane", *group).orderBy(*order)
    sliced = (
        df.repartitionByRange(slices, *group, *order)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_here", F.lead(carried).over(in_slice))
        .withColumn("_first", F.row_number().over(in_slice) == 1)
    )
    edge = F.col("_first") | F.col("_here").isNull()
    linked = sliced.withColumn("_lane", F.when(edge, F.lit(-1)).otherwise(F.col("_slice"))).withColumn(
        "_there", F.lead(carried).over(across)
    )
    return linked.withColumn(out, F.coalesce("_here", "_there")).drop("_slice", "_here", "_first", "_lane", "_there")


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    start: int | Column = 1,
    slices: int | None = None,
) -> DataFrame:
    """Dense numbers ``start, start + 1, …`` along a total order over all rows.

    The range slices are fixed by a checkpoint, because both the slice sizes and the rows are read
    from them. The broadcast side has one row per slice.
    """
    spark = df.sparkSession
    ready_checkpoints(spark)
    slices = slices or shuffle_width(spark)
    laid = (
        df.repartitionByRange(slices, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_slice", F.shiftright("_at", 33))
        .withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid.groupBy("_slice")
        .agg((F.max("_at") + 1).alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        laid.join(F.broadcast(offsets), "_slice")
        .withColumn(name, (first + F.col("_offset") + F.col("_at")).cast("bigint"))
        .drop("_slice", "_at", "_offset")
    )


def dense_positions(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "pos"
) -> DataFrame:
    """Positions 0, 1, … inside every group, without a window over the group."""
    numbered = number_rows(df, [*group, *order], "_n", start=0)
    firsts = numbered.groupBy(*group).agg(F.min("_n").alias("_n0"))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in group]
    joined = numbered.alias("l").join(firsts.alias("r"), same)
    return joined.select(*[F.col(f"l.{c}") for c in df.columns], (F.col("_n") - F.col("_n0")).alias(name))
