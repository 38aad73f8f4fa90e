import random

from pyspark.sql import functions as F

from reviewloom.operators import relate
from reviewloom.operators.filters import rated_reviews, value_profile


def test_reviews_in_scope(spark):
    """Products with more than a third of the cap show their own reviews, the others the pooled ones."""
    rng = random.Random(7)
    rows = []
    for article in range(40):
        group = 0 if article < 25 else rng.randint(1, 4)
        for pos in range(rng.choice([1, 3, 4, 5, 30])):
            rows.append((article, group, pos, f"{article}-{pos}"))
    rng.shuffle(rows)
    cap = 12
    expected = set()
    for article, group in {(r[0], r[1]) for r in rows}:
        own = sorted(r for r in rows if r[0] == article)
        pool = own if len(own) > cap / 3 else sorted((r for r in rows if r[1] == group), key=lambda r: (r[0], r[2]))
        scope = "own" if len(own) > cap / 3 else "pooled"
        expected |= {(article, group, scope, i + 1, r[0], r[2], r[3]) for i, r in enumerate(pool[:cap])}
    df = spark.createDataFrame(rows, "article bigint, grp bigint, pos int, text string").repartition(5)
    df = df.withColumn("shown_article", df.article)
    out = relate.reviews_in_scope(df, "article", "grp", ["shown_article", "pos"], cap).drop("shown_article")
    assert {tuple(r) for r in out.collect()} == expected


def test_products_without_reviews_show_pooled_ones(spark):
    reviews = spark.createDataFrame([(1, 5, 0), (1, 5, 1)], "article bigint, grp bigint, pos int").withColumn("at", F.col("article"))
    members = spark.createDataFrame([(1, 5), (2, 5), (3, 6)], "article bigint, grp bigint")
    out = relate.reviews_in_scope(reviews, "article", "grp", ["at", "pos"], 30, members)
    assert {(r.article, r.scope, r.reviewed_article, r.pos) for r in out.collect()} == {
        (1, "pooled", 1, 0), (1, "pooled", 1, 1), (2, "pooled", 1, 0), (2, "pooled", 1, 1),
    }


def test_counts_progress_and_flags(spark):
    catalogs = spark.createDataFrame([(1, False), (2, True), (3, False)], "catalog_id bigint, collected boolean")
    products = spark.createDataFrame([(1, 10), (1, 11), (2, 12)], "catalog_id bigint, product_article bigint")
    progress = {r.catalog_id: (r.n_done, r.n_target, r.complete) for r in relate.collection_progress(catalogs, products, 2).collect()}
    assert progress == {1: (2, 2, True), 2: (1, 2, False), 3: (0, 2, False)}
    flagged = relate.set_flag(catalogs, catalogs.filter("catalog_id = 3"), "collected", True)
    assert {r.catalog_id: r.collected for r in flagged.collect()} == {1: False, 2: True, 3: True}


def test_new_ids_follow_the_stored_ones(spark):
    stored = spark.createDataFrame([(41,)], "id bigint")
    rows = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    assert {r.name: r.id for r in relate.with_new_ids(rows, ["name"], "id", stored).collect()} == {"a": 42, "b": 43, "c": 44}
    assert {r.id for r in relate.with_new_ids(rows, ["name"], "id", stored.filter("id < 0")).collect()} == {1, 2, 3}


def test_integrity_report(spark):
    products = spark.createDataFrame([(1,), (1,), (2,), (None,)], "product_article bigint")
    reviews = spark.createDataFrame([(1, 1), (2, 9), (3, 9), (4, None)], "review_id bigint, product_article bigint")
    report = relate.integrity_report(
        {"products": products, "reviews": reviews},
        unique={"products": ["product_article"], "reviews": ["review_id"]},
        not_null={"products": ["product_article"]},
        references=[("reviews", "product_article", "products", "product_article")],
    )
    assert {(r.table_name, r.rule): r.n_rows for r in report.collect()} == {
        ("products", "unique"): 2, ("reviews", "unique"): 0, ("products", "not null"): 1, ("reviews", "foreign key"): 2,
    }


def test_filters(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (6,), (None,)], "rating int")
    assert sorted(r.rating for r in rated_reviews(df).collect()) == [1, 5]
    assert {(r.value, r.n) for r in value_profile(df, "rating").collect()} == {(0, 1), (1, 1), (5, 1), (6, 1), (None, 1)}


def test_short_lists_take_one_shuffle(spark):
    """rows are shuffled and sorted once, unless a list is too long to be cut in the tasks; both give the same rows."""
    rows = spark.createDataFrame([(i % 7, i) for i in range(300)] + [(9, i) for i in range(2500)], "a bigint, at bigint").repartition(5)

    def plan(n):
        return relate.first_reviews(rows, ["a"], ["at"], n)._jdf.queryExecution().sparkPlan().toString()

    assert "_lane" not in plan(100) and "WindowGroupLimit" in plan(100) and "_lane" in plan(2000)
    for n in (100, 2000):
        found = sorted((r.a, r["rank"], r.at) for r in relate.first_reviews(rows, ["a"], ["at"], n).collect())
        assert found == [(a, i + 1, x) for a in [*range(7), 9] for i, x in enumerate((range(a, 300, 7) if a < 7 else range(2500))[:n])]
