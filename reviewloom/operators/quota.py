"""Choosing new products for catalogues that compete for them.

The result is that of filling one catalogue after the other, smallest first. All catalogues choose at
once, and a product goes to the smallest that wants it; a few rounds settle lists that overlap widely.
What is left then are long chains, in which each catalogue displaces the next. There only catalogues that
can still meet are looked at together: a catalogue is sure of the candidates that no smaller one has
left, and never reaches beyond the place where these alone fill it. Those that share no candidate within
reach are done; the others fall into groups, connected by shared candidates, and each group is settled in
order by one task, or in rounds to the end if it is too large for a task.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.constants import MAX_PRODUCTS
from reviewloom.operators.ordering import top_k
from reviewloom.operators.relate import unseen
from reviewloom.session import stored

#: Candidates within reach of a group that one task settles; larger groups are settled in rounds.
TASK_ROWS = 200_000
#: Rounds for all catalogues before groups are looked for.
ROUNDS = 16


def select_new_products(
    candidates: DataFrame,
    products: DataFrame,
    catalog: str = "catalog_id",
    article: str = "product_article",
    position: str = "position",
    target: int = MAX_PRODUCTS,
    task_rows: int = TASK_ROWS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """First unknown products of every catalogue in listing order, up to what it still lacks.

    ``(catalog, article, position, pick)``; the same products as if the catalogues were filled one
    after the other, smallest first. A link listed twice counts at its first position; equal positions
    are taken by article, and a NULL position comes first. Candidates without a catalogue or an article
    are not taken.
    """
    named = candidates.filter(F.col(catalog).isNotNull() & F.col(article).isNotNull())
    listed = named.groupBy(catalog, article).agg(F.min(position).alias(position))
    done = products.groupBy(catalog).agg(F.count(F.lit(1)).alias("_done"))
    room = F.lit(target) - F.coalesce("_done", F.lit(0))
    free = unseen(listed, products, article).join(done, catalog, "left").withColumn("_room", room).drop("_done")
    columns = [catalog, article, position, "pick"]
    picks, left = _settle_in_rounds(stored(free.filter("_room > 0"), "free"), catalog, article, position, target, rounds)
    if left is None:
        return picks.select(columns)
    reach = stored(_within_reach(left, catalog, article, position, target), "reach")
    shared = reach.groupBy(article).agg(F.min(catalog).alias("_first"), F.max(catalog).alias("_last")).filter("_first <> _last")
    met = reach.join(shared.select(article, "_first"), article).filter(F.col("_first") != F.col(catalog))
    groups = connected(met.select(F.col(catalog).alias("u"), F.col("_first").alias("v")).distinct())
    grouped = reach.join(groups.withColumnRenamed("node", catalog), catalog, "left")
    sizes = grouped.filter(F.col("component").isNotNull()).groupBy("component").agg(F.count(F.lit(1)).alias("_rows"))
    sized = stored(grouped.join(sizes, "component", "left"), "sized")

    alone = sized.filter(F.col("component").isNull())
    picks = _first_free(alone, catalog, article, position, target).select(columns)
    small = sized.filter(F.col("_rows") <= task_rows).select("component", catalog, article, position, "_room")
    schema = reach.select(catalog, article, position, F.lit(0).alias("pick")).schema
    settle = _settle_group(catalog, article, position)
    picks = picks.unionByName(small.groupBy("component").applyInArrow(settle, schema))
    large = sized.filter(F.col("_rows") > task_rows).select(catalog, article, position, "_room")
    if not large.isEmpty():
        picks = picks.unionByName(_settle_in_rounds(large, catalog, article, position, target)[0].select(columns))
    return picks


def connected(links: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) for the nodes of ``links(u, v)``, ``u <> v``.

    Nodes hang their larger neighbours, then their smaller ones, below the least of them, until only
    stars are left; a chain needs rounds with the logarithm of its length. Links and least members are
    stored tables: adaptive skew joins can split a node with very many neighbours, and plans do not grow
    with the rounds, as they do over checkpoints, which keep the constraints of all that came before.
    """
    links = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while not _only_stars(links):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
        larger = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        larger = stored(larger.distinct(), "larger")
        least = stored(larger.groupBy("u").agg(F.min("v").alias("m")), "least")
        smaller = larger.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(smaller.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    members = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _only_stars(links: DataFrame) -> bool:
    """Whether every node hangs below one other at most, and nodes that hang have none below them."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        links.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    )
    roles = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return roles.filter("hangs > 1 OR (hangs = 1 AND holds = 1)").isEmpty()


def _within_reach(free: DataFrame, catalog: str, article: str, position: str, target: int) -> DataFrame:
    """Candidates up to the place where those that no smaller catalogue lists fill a catalogue."""
    first = free.groupBy(article).agg(F.min(catalog).alias("_first"))
    marked = stored(free.join(first, article), "listed")
    sure = marked.filter(F.col("_first") == F.col(catalog))
    full = _first_free(sure, catalog, article, position, target).filter(F.col("pick") == F.col("_room"))
    ends = full.select(catalog, F.struct(position, article).alias("_end"))
    near = F.col("_end").isNull() | (F.struct(position, article) <= F.col("_end"))
    return marked.join(ends, catalog, "left").filter(near).select(catalog, article, position, "_room")


def _first_free(rows: DataFrame, catalog: str, article: str, position: str, target: int) -> DataFrame:
    return top_k(rows, [catalog], [F.asc(position), F.asc(article)], target, "pick").filter("pick <= _room")


def _settle_group(catalog: str, article: str, position: str) -> Callable[[pa.Table], pa.Table]:
    """One group, catalogue after catalogue."""

    def settle(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: (r[catalog], r[position] is not None, r[position], r[article]))
        taken, picks, filled = set(), [], {}
        for row in rows:
            pick = filled.get(row[catalog], 0) + 1
            if pick <= row["_room"] and row[article] not in taken:
                taken.add(row[article])
                filled[row[catalog]] = pick
                picks.append({catalog: row[catalog], article: row[article], position: row[position], "pick": pick})
        types = [(c, group.schema.field(c).type) for c in (catalog, article, position)]
        return pa.Table.from_pylist(picks, pa.schema([*types, ("pick", pa.int32())]))

    return settle


def _settle_in_rounds(
    free: DataFrame, catalog: str, article: str, position: str, target: int, rounds: int | None = None
) -> tuple[DataFrame | None, DataFrame | None]:
    """Picks and None, or, if ``rounds`` did not settle them, the last picks and the candidates still possible.

    All catalogues choose at once; a product chosen by several goes to the smallest of them, which keeps it
    or loses it to a still smaller one only. So products held by a smaller catalogue are struck off for
    good, and the choice is repeated until nobody loses one. A round is stored and holds ``target`` rows
    a catalogue.
    """
    picks, pool, done = None, free, 0
    while rounds is None or done < rounds:
        chosen = _first_free(pool, catalog, article, position, target)
        picks = stored(chosen.withColumn("_holder", F.min(catalog).over(Window.partitionBy(article))), "picks")
        if picks.filter(F.col("_holder") < F.col(catalog)).isEmpty():
            return picks, None
        held = picks.select(article, "_holder").distinct()
        kept = F.coalesce(F.col("_holder"), F.col(catalog)) >= F.col(catalog)
        pool, done = free.join(held, article, "left").filter(kept).drop("_holder"), done + 1
    return picks, pool
