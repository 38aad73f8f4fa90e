"""Golden three-stage tree (raw, clean, processed) in the folder named by REVIEWLOOM_FIXTURES."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from reviewloom.constants import CATEGORIES
from reviewloom.functions import text as tx
from reviewloom.plans.analyse import analyse
from reviewloom.plans.clean import clean_catalogs, clean_tree, preprocess_reviews
from reviewloom.schemas import PROCESSED_REVIEW_CSV
from reviewloom.sources import csv_tree

TREE = os.environ.get("REVIEWLOOM_FIXTURES", "")
pytestmark = pytest.mark.skipif(not os.path.isdir(f"{TREE}/raw"), reason="no fixture tree")


def files(stage):
    return {int(os.path.basename(p)[:-4]) for p in glob.glob(f"{TREE}/{stage}/reviews/*/*.csv")}


@pytest.fixture(scope="module")
def cleaned(spark):
    return clean_catalogs(
        csv_tree.read_catalogs(spark, f"{TREE}/raw/catalogs"),
        csv_tree.read_reviews(spark, f"{TREE}/raw/reviews"),
        csv_tree.list_review_files(spark, f"{TREE}/raw/reviews"),
    )


def test_row_counts(spark):
    assert csv_tree.read_reviews(spark, f"{TREE}/raw/reviews").count() == 2054
    assert csv_tree.read_reviews(spark, f"{TREE}/clean/reviews").count() == 1734
    assert csv_tree.read_catalogs(spark, f"{TREE}/raw/catalogs").count() == 100


def test_kept_products(cleaned):
    assert {r.product_article for r in cleaned.kept_files.collect()} == files("clean")


def test_clean_reviews(spark, cleaned):
    golden = csv_tree.read_reviews(spark, f"{TREE}/clean/reviews")
    assert cleaned.reviews.exceptAll(golden).count() == 0
    assert golden.exceptAll(cleaned.reviews).count() == 0


def test_clean_catalog(spark, cleaned):
    known = files("raw")

    def rows(df):
        return [tuple(r)[2:] for r in df.orderBy("listing").collect() if r.product_article in known]

    assert rows(cleaned.catalogs) == rows(csv_tree.read_catalogs(spark, f"{TREE}/clean/catalogs"))


def test_processed_reviews(spark):
    golden = csv_tree.read_reviews(spark, f"{TREE}/processed/reviews", PROCESSED_REVIEW_CSV)
    keys = golden.select("catalog", "product_article").distinct()
    clean = csv_tree.read_reviews(spark, f"{TREE}/clean/reviews").join(keys, ["catalog", "product_article"], "left_semi")
    comment = F.nullif("review_text_comment", F.lit(""))
    parsed = preprocess_reviews(clean).withColumn("review_text_comment", comment).select(*golden.columns)
    assert golden.count() == 920
    assert parsed.exceptAll(golden).count() == 0 and golden.exceptAll(parsed).count() == 0


def test_top_terms(spark):
    clean = csv_tree.read_reviews(spark, f"{TREE}/clean/reviews")
    loaded = clean.select(
        "catalog",
        F.col("product_article").alias("product_id"),
        F.col("review_pos").alias("review_id"),
        F.col("review_rating").alias("rating"),
        tx.split_review(F.col("review_text")).alias("p"),
    ).select("catalog", "product_id", "review_id", "rating", "p.*")
    result = analyse(loaded)
    plus, minus, whole = CATEGORIES[0], CATEGORIES[1], CATEGORIES[3]

    def top(df, rating, category, n):
        rows = df.filter((F.col("rating") == rating) & (F.col("category") == category)).orderBy("rank").limit(n).collect()
        return [f"{r.term} {r.n}" for r in rows]

    report = result.report().persist()
    words, pairs = report.filter("term_kind = 'word'"), report.filter("term_kind = 'bigram'")
    assert top(words, 5, plus, 5) == ["размер 154", "очень 147", "удобные 129", "кроссовки 105", "хорошие 104"]
    assert top(words, 5, minus, 5) == ["пока 24", "нету 17", "маломерят 16", "размер 14", "недостатков 11"]
    assert top(words, 5, whole, 5) == ["размер 283", "очень 282", "удобные 177", "кроссовки 173", "хорошие 168"]
    assert top(words, 1, whole, 5) == ["очень 24", "подошва 14", "качество 13", "кроссовки 11", "пришли 11"]
    assert top(words, 1, plus, 5) == ["кроссовки 5", "очень 4", "нету 4", "выглядят 3", "красивые 3"]
    assert top(pairs, 5, plus, 3) == ["очень понравились 28", "качество хорошее 22", "очень удобные 17"]
    assert top(pairs, 5, minus, 3) == ["маломерят размер 4", "размер 46 3", "пока пока 3"]
    assert top(pairs, 5, whole, 3) == ["очень понравились 58", "качество хорошее 30", "отличные кроссовки 29"]
    assert top(pairs, 1, minus, 3) == ["неделю носки 3", "сегодня пошел 2", "очень расстроен 2"]
    counts = {r.rating: r.n for r in result.counts_by_rating.collect()}
    assert counts == {5: 1296, 4: 195, 3: 71, 2: 57, 1: 115}


def test_written_clean_tree_lists_every_product(spark, tmp_path):
    clean_tree(spark, TREE + "/raw", str(tmp_path / "clean"))
    _, reviews, kept = csv_tree.read_tree(spark, str(tmp_path / "clean"))
    assert {r.product_article for r in kept.collect()} == files("clean") and len(files("clean")) == 49
    assert reviews.count() == 1734
    assert reviews.filter("product_article = 276942833").isEmpty() and 276942833 in files("clean")
