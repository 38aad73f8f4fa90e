"""Joins, counts, keys and integrity checks over catalogues, products and reviews.

Joins carry no hints: a side is broadcast when its size is known to be below
``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides are shuffled and adaptive skew joins
split hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.constants import MAX_PRODUCTS, MAX_REVIEWS
from reviewloom.operators.ordering import number_rows, top_k
from reviewloom.session import ready_checkpoints, shuffle_width


# -- loading ------------------------------------------------------------------------------------

def catalog_reviews(catalogs: DataFrame, products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Reviews of all given catalogues with catalogue id, product order and the analysis columns.

    Products without reviews add no rows. The order of a catalogue is (product_id, review_id).
    """
    owned = products.select("product_article", "product_id", "catalog_id").join(
        catalogs.select("catalog_id"), "catalog_id", "left_semi"
    )
    return reviews.join(owned, "product_article").select(
        "catalog_id", "product_id", "product_article", "rating", "text_plus", "text_comment", "text_all",
        "review_id", "text_minus",
    )


def with_catalog_link(results: DataFrame, catalogs: DataFrame) -> DataFrame:
    """Replace ``catalog_id`` by the link, ``catalog``."""
    links = catalogs.select("catalog_id", F.col("catalog_link").alias("catalog"))
    rest = [c for c in results.columns if c != "catalog_id"]
    return results.join(links, "catalog_id").select("catalog", *rest)


# -- counts -------------------------------------------------------------------------------------

def product_counts(catalogs: DataFrame, products: DataFrame) -> DataFrame:
    """``(catalog_id, n_products)``, 0 for catalogues without products."""
    counted = products.groupBy("catalog_id").agg(F.count(F.lit(1)).alias("n"))
    return catalogs.select("catalog_id").join(counted, "catalog_id", "left").select(
        "catalog_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_products")
    )


def product_count(products: DataFrame, catalog_id: int | None) -> DataFrame:
    """One row with the number of products of a catalogue; 0 for an unknown (NULL) catalogue."""
    own = products.filter(F.col("catalog_id").eqNullSafe(F.lit(catalog_id)))
    return own.agg(F.count(F.lit(1)).alias("n_products"))


def collection_progress(catalogs: DataFrame, products: DataFrame, target: int = MAX_PRODUCTS) -> DataFrame:
    """``(catalog_id, n_done, n_target, complete)``."""
    return product_counts(catalogs, products).select(
        "catalog_id",
        F.col("n_products").alias("n_done"),
        F.lit(target).cast("bigint").alias("n_target"),
        (F.col("n_products") >= target).alias("complete"),
    )


def review_counts(reviews: DataFrame, key: Sequence[str] = ("product_article",), cap: int = MAX_REVIEWS) -> DataFrame:
    """Reviews collected per product: all there are, at most ``cap``."""
    return reviews.groupBy(*key).agg(
        F.least(F.count(F.lit(1)), F.lit(cap)).cast("bigint").alias("count_reviews")
    )


# -- first reviews of a product -----------------------------------------------------------------

def first_reviews(
    reviews: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    n: int = MAX_REVIEWS,
    rank: str = "rank",
) -> DataFrame:
    """First ``n`` reviews of every product in page order. ``order`` must be total inside a product.

    Spark cuts every product to ``n`` rows in each task before the shuffle, as long as ``n`` is small; only
    a list too long for that is cut by lanes, which costs a second shuffle and sort of all rows.
    """
    limit = int(reviews.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    lanes = 1 if n < limit else shuffle_width(reviews.sparkSession)
    return top_k(reviews, key, [F.asc(c) for c in order], n, rank, lanes=lanes, lane_key=order)


def reviews_in_scope(
    reviews: DataFrame,
    article: str,
    variant_group: str,
    order: Sequence[str],
    n: int = MAX_REVIEWS,
    members: DataFrame | None = None,
) -> DataFrame:
    """First ``n`` reviews that a product page would show.

    A product with more than ``n / 3`` reviews of its own shows those; any other, also one without
    any, shows the pooled reviews of its variant group. ``members`` (article, variant_group) names the
    products; left out, those that have reviews. A column ``own_count`` in it says how many a product has
    of its own, captured or not; where that is NULL, the captured ones count. Columns: ``article``, ``scope`` (``own`` or
    ``pooled``), ``rank`` and the review's columns under their names, its article as
    ``reviewed_article``.

    The reviews are read once: each product is cut to ``n`` rows, and these, checkpointed, give the
    counts, the own and the pooled pages, which need no row beyond them. Only ``n`` rows of a group
    meet its small products.
    """
    ready_checkpoints(reviews.sparkSession)
    key = [article, variant_group]
    first = first_reviews(reviews, key, order, n).checkpoint()
    counted = first.groupBy(*key).agg(F.count(F.lit(1)).alias("_own"))
    told = members is not None and "own_count" in members.columns
    if members is None:
        spine = counted
    else:
        spine = members.select(*key, *(["own_count"] if told else [])).distinct().join(counted, key, "left")
    own_count = F.coalesce(*([F.col("own_count")] if told else []), F.col("_own"), F.lit(0))
    scoped = spine.select(*key, F.when(own_count > n / 3, "own").otherwise("pooled").alias("scope"))
    rest = [c for c in reviews.columns if c not in key]
    own = first.join(scoped.filter(F.col("scope") == "own"), key)
    pooled = first_reviews(first.drop("rank"), [variant_group], order, n).withColumnRenamed(article, "reviewed_article")
    shown = pooled.join(scoped.filter(F.col("scope") == "pooled"), variant_group)
    columns = [article, variant_group, "scope", "rank", "reviewed_article", *rest]
    return own.withColumn("reviewed_article", F.col(article)).select(*columns).unionByName(shown.select(*columns))


# -- known products -----------------------------------------------------------------------------

def unseen(candidates: DataFrame, products: DataFrame, key: str = "product_article") -> DataFrame:
    """Candidates whose key is not stored yet."""
    return candidates.join(products.select(key).distinct(), key, "left_anti")


def stored(candidates: DataFrame, products: DataFrame, key: str = "product_article") -> DataFrame:
    return candidates.join(products.select(key).distinct(), key, "left_semi")


# -- keys, flags, integrity ---------------------------------------------------------------------

def with_new_ids(rows: DataFrame, order: Sequence[str], name: str, existing: DataFrame | None = None) -> DataFrame:
    """Number new rows on from the largest stored id, in the given order."""
    largest = 0 if existing is None else (existing.agg(F.max(name)).first()[0] or 0)
    return number_rows(rows, order, name, start=largest + 1)


def set_flag(catalogs: DataFrame, ids: DataFrame, flag: str, value: bool) -> DataFrame:
    """Catalogues with ``flag`` set for the ids in ``ids`` and unchanged for the others."""
    hit = ids.select("catalog_id").distinct().withColumn("_hit", F.lit(True))
    updated = catalogs.join(hit, "catalog_id", "left").withColumn(
        flag, F.when(F.col("_hit"), F.lit(value)).otherwise(F.col(flag))
    )
    return updated.select(*catalogs.columns)


def duplicate_keys(df: DataFrame, key: str, table: str) -> DataFrame:
    found = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _violations(found, table, "unique", key, F.sum("n"))


def missing_values(df: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """NULLs of each column, counted in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    named = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_rows")) for c in columns])
    return counts.select(F.explode(named).alias("c")).select(
        F.lit(table).alias("table_name"), F.lit("not null").alias("rule"), "c.column_name", F.col("c.n_rows").cast("bigint").alias("n_rows")
    )


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_key: str, table: str) -> DataFrame:
    """Rows whose reference has no parent. References are counted first, so a hot one is one row."""
    used = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    keys = parent.select(F.col(parent_key).alias(column)).distinct()
    return _violations(used.join(keys, column, "left_anti"), table, "foreign key", column, F.sum("n"))


def integrity_report(
    tables: Mapping[str, DataFrame],
    unique: Mapping[str, Sequence[str]],
    not_null: Mapping[str, Sequence[str]],
    references: Sequence[tuple[str, str, str, str]] = (),
) -> DataFrame:
    """``(table_name, rule, column_name, n_rows)``, one row per rule, 0 where it holds."""
    checks = [duplicate_keys(tables[t], c, t) for t, columns in unique.items() for c in columns]
    checks += [missing_values(tables[t], columns, t) for t, columns in not_null.items()]
    checks += [orphans(tables[t], c, tables[p], k, t) for t, c, p, k in references]
    report = checks[0]
    for check in checks[1:]:
        report = report.unionByName(check)
    return report


def _violations(found: DataFrame, table: str, rule: str, column: str, count: Column) -> DataFrame:
    return found.agg(F.coalesce(count, F.lit(0)).cast("bigint").alias("n_rows")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), "n_rows"
    )
