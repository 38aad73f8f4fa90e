"""Small documents with every awkward case, and tables for the query tests."""

import os

import pytest

TABLES = os.environ.get("REVIEWLOOM_TABLES", "/root/testdata/sf0.001")
#: Names that operators use inside; a table may have them as well.
CLASHES = ("_h", "_key", "_sha", "_bytes", "_owner", "n", "rep", "values", "did", "h", "score", "label", "value", "b")


def make_docs(spark, rows, clashes=True):
    """``rows``: (doc_id, text). Extra columns have clashing names and other types."""
    schema = "doc_id bigint, text string" + "".join(f", {c} string" for c in CLASHES if clashes)
    return spark.createDataFrame([(*r, *(["x"] * len(CLASHES) if clashes else [])) for r in rows], schema).repartition(4)


WORDS = [f"w{i}" for i in range(400)]


def sentence(start, n, step=1):
    return " ".join(WORDS[(start + step * i) % len(WORDS)] for i in range(n))


@pytest.fixture(scope="session")
def awkward():
    """NULLs, empty and very long texts, repeated rows, ties, copies and near copies."""
    base = sentence(0, 120)
    near = base.replace("w7 ", "x7 ").replace("w90 ", "x90 ")
    rows = [
        (1, base), (2, base), (3, near), (4, sentence(1, 120, 7)), (5, None), (6, ""), (7, "   \n "), (8, "one two"),
        (9, "one two"), (9, "one two"), (None, base), (None, None), (10, "ONE two"), (11, "ünï çödé ÉÀ 日本語 🙂 " * 3),
        (12, " ".join(f"{w}{k}" for k in range(60) for w in WORDS)), (13, base + " tail " + sentence(5, 40, 3)),
        (14, "a\tb\r\nc  d\x0b e\x1c f\x85g　h "), (14, "same id, other text"),
    ]
    return rows


@pytest.fixture(scope="session")
def tables():
    if not os.path.isdir(TABLES):
        pytest.skip("no tables")
    return TABLES
