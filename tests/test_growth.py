"""Analyses of a store that grows against one analysis of all that it holds."""

import random

import pytest
from pyspark.sql import functions as F

from reviewloom.operators import terms
from reviewloom.plans.collect import analyse_catalogs, read_rating_counts
from reviewloom.sources.reports import newest, read_cloud, read_report
from reviewloom.sources.store import FeedbackStore

WORDS = "кеды боты лёгкие удобные не и маломерят цвет подошва хорошо плохо да".split()
REVIEW = "product_article bigint, rating int, text_all string, text_plus string, text_minus string, text_comment string, at int"


def reviews(rng, articles, n, at=0):
    def text():
        return rng.choice([None, "", "Нет", *[" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 7))) for _ in range(5)]])

    return [(rng.choice(articles), rng.choice([1, 2, 5, 5, 0, 9, None]) or 3, "x", text(), text(), text(), at + i) for i in range(n)]


def shop_of(spark, path):
    store = FeedbackStore(spark, str(path))
    store.create()
    store.register_catalogs(spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "catalog_link string, link_order int"))
    return store


def add_products(store, rows):
    frame = store.spark.createDataFrame(rows, "product_article bigint, catalog_id bigint")
    store.append_numbered("products", frame.withColumns({"name": F.lit("p"), "rating": F.lit(4.0), "count_reviews": F.lit(1)}), "product_id", ["product_article"])


def add_reviews(store, rows):
    store.append_numbered("reviews", store.spark.createDataFrame(rows, REVIEW), "review_id", ["at"])


def state(store, results):
    spark = store.spark
    frames = [read_report(spark, f"{results}/report", store.finished_runs()), read_cloud(spark, f"{results}/cloud", store.finished_runs()),
              read_rating_counts(store, results), store.read("analysis"), store.read("catalogs")]
    return [sorted((tuple(r) for r in f.select(*sorted(f.columns)).collect()), key=str) for f in frames]


@pytest.fixture(scope="module")
def grown(spark, tmp_path_factory):
    rng = random.Random(11)
    base = tmp_path_factory.mktemp("growth")
    first, second = reviews(rng, [10, 11, 20], 60), reviews(rng, [10, 12, 21], 25, 100)
    store = shop_of(spark, base / "grown")
    add_products(store, [(10, 1), (11, 1), (20, 2)])
    add_reviews(store, first)
    results = str(base / "results")
    analyse_catalogs(store, results)
    add_products(store, [(12, 1), (21, 2)])
    store.reopen(spark.createDataFrame([(1,), (2,)], "catalog_id bigint"))
    add_reviews(store, second)
    analyse_catalogs(store, results)
    return store, results, base


def once(store, path):
    """One analysis of a copy of the store's rows."""
    copy = shop_of(store.spark, path / "store")
    for name in ("products", "reviews"):
        copy.append(name, store.read(name))
    analyse_catalogs(copy, str(path / "results"))
    return state(copy, str(path / "results"))


def test_growing_equals_one_analysis(grown, tmp_path):
    store, results, _ = grown
    assert state(store, results) == once(store, tmp_path)


def test_only_touched_cells_are_written_again(spark, grown):
    store, results, _ = grown
    runs = store.finished_runs()
    assert len(runs) == 2 and {r.catalog for r in spark.read.parquet(f"{results}/counts/run={runs[1]}").collect()} == {1, 2}
    store.reopen(spark.createDataFrame([(2,)], "catalog_id bigint"))
    add_reviews(store, [(20, 4, "x", "новое слово", None, None, 900)])
    analyse_catalogs(store, results)
    last = store.finished_runs()[-1]
    assert {(r.catalog, r.rating) for r in spark.read.parquet(f"{results}/counts/run={last}").collect()} == {(2, 4)}
    assert spark.read.parquet(f"{results}/ends/run={last}").count() == 1
    assert {(r.catalog, r.rating) for r in spark.read.parquet(f"{results}/report/run={last}").collect()} == {("b", 4)}


def test_replaced_reviews_begin_anew(spark, grown, tmp_path):
    store, results, _ = grown
    gone = spark.createDataFrame([(10,)], "product_article bigint")
    store.reopen(spark.createDataFrame([(1,)], "catalog_id bigint"))
    store.exchange_numbered("reviews", gone, "product_article", spark.createDataFrame(reviews(random.Random(4), [10], 9, 2000), REVIEW), "review_id", ["at"])
    analyse_catalogs(store, results)
    assert state(store, results) == once(store, tmp_path)


def test_newest_rows_of_a_cell(spark):
    rows = spark.createDataFrame([("a", 1, 1, "old"), ("a", 1, 3, "new"), ("a", 2, 1, "only"), ("a", 1, 4, "unfinished")], "catalog string, rating int, run int, term string")
    assert {r.term for r in newest(rows, ["catalog", "rating"], [1, 3]).collect()} == {"new", "only"}
    assert newest(rows.drop("run"), ["catalog"]).count() == 4 and newest(rows, ["catalog"], []).count() == 0


def test_analysis_without_reviews(spark, tmp_path):
    """Catalogues that have nothing yet get their empty grid, and what comes later is counted."""
    store = shop_of(spark, tmp_path / "store")
    results = str(tmp_path / "results")
    analyse_catalogs(store, results)
    assert store.read("analysis").count() == 0 and read_report(spark, f"{results}/report").count() == 3 * 5 * 4 * 2
    add_products(store, [(10, 1)])
    store.reopen(spark.createDataFrame([(1,)], "catalog_id bigint"))
    add_reviews(store, reviews(random.Random(2), [10], 12))
    analyse_catalogs(store, results)
    assert state(store, results) == once(store, tmp_path / "once")


def test_kept_counts_are_bounded(spark, tmp_path):
    """However many words a cell has, a run keeps no more counts of it than there are buckets; ties go by first place."""
    store = shop_of(spark, tmp_path / "store")
    results = str(tmp_path / "results")
    add_products(store, [(10, 1)])
    for at, words in ((1, range(0, 70000)), (2, range(69000, 71000))):
        store.reopen(spark.createDataFrame([(1,)], "catalog_id bigint"))
        add_reviews(store, [(10, 5, "x", " ".join(f"w{i}" for i in words), None, None, at)])
        analyse_catalogs(store, results)
        assert spark.read.parquet(f"{results}/counts/run={store.finished_runs()[-1]}").count() <= 2 * terms.BUCKETS
    top = read_report(spark, f"{results}/report", store.finished_runs()).filter("catalog = 'a' AND rating = 5 AND term_kind = 'bigram'")
    found = {(r.category, r["rank"], r.term, r.n) for r in top.collect() if r.term}
    assert found == {(c, k + 1, f"w{69000 + k} w{69001 + k}", 2) for c in ("Достоинства", "Весь отзыв") for k in range(10)}


def test_runs_without_tokens_begin_anew(spark, tmp_path):
    """Results whose runs have kept counts but no tokens are not continued, but read again."""
    store = shop_of(spark, tmp_path / "store")
    results = str(tmp_path / "results")
    add_products(store, [(10, 1)])
    add_reviews(store, reviews(random.Random(5), [10], 12))
    analyse_catalogs(store, results)
    (tmp_path / "results/tokens").rename(tmp_path / "elsewhere")
    store.reopen(spark.createDataFrame([(1,)], "catalog_id bigint"))
    add_reviews(store, reviews(random.Random(6), [10], 9, 50))
    analyse_catalogs(store, results)
    assert state(store, results) == once(store, tmp_path / "once")


def test_rows_are_finished_after_they_are_numbered(spark, tmp_path):
    """what is derived row by row is neither sampled nor sorted; the stored rows are the same."""
    rows = spark.createDataFrame([(10, 5, f"text {i}", 9 - i) for i in range(9)], "product_article bigint, rating int, text_all string, at int")
    seen = []

    def finish(numbered):
        seen.append(numbered.columns)
        return numbered.withColumns({"text_plus": F.upper("text_all"), "text_minus": F.lit(None), "text_comment": F.lit("c")})

    found = []
    for name, frame, after in (("late", rows, finish), ("early", finish(rows), None)):
        store = shop_of(spark, tmp_path / name)
        store.append_numbered("reviews", frame, "review_id", ["at"], after)
        found.append(sorted(tuple(r) for r in store.read("reviews").select("review_id", "text_all", "text_plus", "text_comment").collect()))
    assert found[0] == found[1] and found[0][0] == (1, "text 8", "TEXT 8", "c")
    assert any({"review_id", "at"} <= {*columns} and "text_plus" not in columns for columns in seen)
