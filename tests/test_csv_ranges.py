"""CSV read in ranges by many tasks against the reading of whole files."""

import random

import pytest
from pyspark.sql import functions as F

from reviewloom.schemas import RAW_REVIEW_CSV
from reviewloom.sources import csv_tree
from reviewloom.sources.csv_ranges import read_ranges


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.fixture
def tree(tmp_path):
    """Review files with line breaks, quotes and commas in cells, blank lines, Windows line ends, a header alone."""
    rng = random.Random(8)
    bits = ["слово", "a,b", '""', "\n", "\n\n", " ", "конец.", "x" * 30]

    def cell():
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(9)))
        return f'"{text}"' if any(c in text for c in ',"\n') else text

    header = "review_rating,review_text,review_text_plus,review_text_minus"
    for catalog, article, n, end in (("обувь", 1, 400, "\n"), ("обувь", 2, 3, "\n"), ("a b", 3, 150, "\r\n"), ("a b", 4, 0, "\n")):
        folder = tmp_path / "reviews" / catalog
        folder.mkdir(parents=True, exist_ok=True)
        lines = [f"{rng.randrange(1, 6)},{cell()},{cell()},{cell()}" for _ in range(n)]
        if article == 1:
            lines[7:7] = ["", ""]
            lines.append('5,"' + "long\n" * 2000 + '",,')
        (folder / f"{article}.csv").write_text(end.join([header, *lines]) + (end if article != 2 else ""), newline="")
    return str(tmp_path / "reviews")


@pytest.mark.parametrize("size", [97, 1000, 1 << 27])
def test_ranges_equal_whole_files(spark, tree, size):
    whole = rows_of(csv_tree.read_reviews(spark, tree))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        ranged = csv_tree.read_reviews(spark, tree, ranged=True)
        assert rows_of(ranged) == whole and len(whole) == 554
        cut = spark.read.text(f"{tree}/*/").select("_metadata.file_block_start").distinct().count()
        assert (cut > 10) == (size < 1 << 20)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_no_task_gets_a_whole_file(spark, tree):
    """Lines are dealt by range; only one row a range goes by file."""
    plan = read_ranges(spark, f"{tree}/*/", RAW_REVIEW_CSV, csv_tree.READ)._jdf.queryExecution().optimizedPlan().toString()
    by_file = [line for line in plan.splitlines() if "Window" in line and "range" not in line.split("windowspecdefinition")[-1].split("specifiedwindowframe")[0]]
    assert by_file == []
    assert spark.read.text(tree + "/*/").filter(F.col("value") == "nowhere").count() == 0


def test_empty_folder_of_files(spark, tmp_path):
    (tmp_path / "reviews" / "c").mkdir(parents=True)
    (tmp_path / "reviews" / "c" / "1.csv").write_text("")
    assert csv_tree.read_reviews(spark, str(tmp_path / "reviews"), ranged=True).count() == 0
