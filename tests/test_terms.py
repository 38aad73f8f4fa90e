import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewloom.constants import CATEGORIES, PUNCTUATION, RUSSIAN_STOP_WORDS
from reviewloom.operators import terms
from reviewloom.plans import analyse as plans
from reviewloom.plans.analyse import analyse, bigram_counts, word_counts

SCHEMA = """catalog string, product_id bigint, review_id bigint, rating int, text_plus string, text_minus string,
            text_comment string"""


def random_reviews(count=600, seed=5):
    rng = random.Random(seed)
    vocabulary = ["кеды", "Размер", "46", "нет", "и", "очень", "носки,", "!", "«да»", "подошва", "а-б"]

    def text():
        if rng.random() < 0.15:
            return None
        return rng.choice([" ", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 1, 2, 5, 9])))

    rows = []
    for i in range(count):
        catalog = "hot" if rng.random() < 0.5 else rng.choice("ab")
        rating = None if rng.random() < 0.05 else rng.randint(0, 6)
        rows.append((catalog, rng.randint(0, 12), i, rating, text(), text(), text()))
    rng.shuffle(rows)
    return rows


def expected_cells(rows, most_common, pairs):
    """Top lists by joining the text of every cell, as plain Python."""
    delete = str.maketrans("", "", PUNCTUATION)
    cells = {}
    for catalog in {r[0] for r in rows}:
        for rating in range(1, 6):
            members = sorted((r for r in rows if r[0] == catalog and r[3] == rating), key=lambda r: (r[1], r[2]))
            texts = [" ".join(r[c] for r in members if r[c] is not None) for c in (4, 5, 6)]
            for category, text in zip(CATEGORIES, [*texts, " ".join(texts)]):
                words = [w for w in text.lower().translate(delete).split() if w not in RUSSIAN_STOP_WORDS]
                found = [" ".join(p) for p in zip(words, words[1:])] if pairs else words
                top = Counter(found).most_common(most_common)
                if top:
                    cells[catalog, rating, category] = top
    return cells


def cells_of(df):
    cells = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        cells.setdefault((r.catalog, r.rating, r.category), []).append((r.term, r.n))
    return cells


@pytest.fixture(scope="module")
def analysis(spark):
    return analyse(spark.createDataFrame(random_reviews(), SCHEMA).repartition(6), cloud=30)


def test_words_match_counter(analysis):
    rows = random_reviews()
    assert cells_of(analysis.report(4).filter("term_kind = 'word'")) == expected_cells(rows, 4, pairs=False)
    assert cells_of(analysis.cloud.filter("term_kind = 'word'")) == expected_cells(rows, 30, pairs=False)


def test_bigrams_match_counter(analysis):
    rows = random_reviews()
    assert cells_of(analysis.report(4).filter("term_kind = 'bigram'")) == expected_cells(rows, 4, pairs=True)
    assert cells_of(analysis.cloud.filter("term_kind = 'bigram'")) == expected_cells(rows, 30, pairs=True)


def test_separate_counts_match_counter(spark):
    rows = random_reviews()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert cells_of(terms.top_terms(word_counts(df), k=5)) == expected_cells(rows, 5, pairs=False)
    assert cells_of(terms.top_terms(bigram_counts(df), k=5)) == expected_cells(rows, 5, pairs=True)


def test_weights(analysis):
    for r in analysis.cloud.filter("rank = 1").collect():
        assert r.weight == 1.0


def test_rating_counts(analysis):
    rows = random_reviews()
    counted = Counter((r[0], r[3]) for r in rows if r[3] in (1, 2, 3, 4, 5))
    found = {(r.catalog, r.rating): r.n for r in analysis.counts_by_rating.collect()}
    assert found == {(c, k): counted[c, k] for c in {r[0] for r in rows} for k in range(1, 6)}


def test_few_and_many_slices_agree(spark):
    parts = terms.review_parts(spark.createDataFrame(random_reviews(), SCHEMA))
    tokens = terms.part_tokens(parts)
    results = [
        {tuple(r) for r in terms.term_counts(terms.bigram_rows(tokens, slices=n)).collect()} for n in (1, 2, 50)
    ]
    assert results[0] == results[1] == results[2]


def test_id_outside_the_place_range_fails(spark):
    rows = [("a", 10**13, 1, 5, "кеды", None, None)]
    parts = terms.review_parts(spark.createDataFrame(rows, SCHEMA))
    with pytest.raises(Exception, match="outside the range"):
        terms.word_rows(parts).collect()


def test_largest_ids_keep_their_order(spark):
    rows = [("a", 10**13 - 1, 10**14 - 1, 5, "два кеды", None, "бот"), ("a", 10**13 - 1, 10**14 - 2, 5, "носки", None, None)]
    top = terms.top_terms(terms.term_counts(terms.word_rows(terms.review_parts(spark.createDataFrame(rows, SCHEMA)))))
    assert [r.term for r in top.filter(F.col("category") == CATEGORIES[3]).orderBy("rank").collect()] == ["носки", "кеды", "бот"]


@pytest.mark.parametrize("buckets", [4, 64, 1 << 16])
def test_sketch_rules_out_only_what_cannot_come_in(spark, buckets):
    """Skewed terms with ties, NULL cells and cells of few terms: the same lists as from all counts."""
    rng = random.Random(7)
    made = []
    for cell, n in (("big", 20_000), ("small", 9), (None, 300)):
        for i in range(n):
            term = f"t{min(int(rng.paretovariate(0.7)), 10_000 + i)}"
            made.append((cell, 5, rng.randrange(3), rng.random() < 0.1, i, term))
    schema = "catalog string, rating int, part int, crosses boolean, place bigint, term string"
    rows = spark.createDataFrame(made, schema).withColumn("place", F.col("place").cast("decimal(38,0)")).repartition(6)
    for k in (1, 3, 10):
        every = terms.top_terms(terms.term_counts(rows), k=k)
        left = terms.possible_top_rows(rows, k=k, buckets=buckets)
        assert sorted(map(str, terms.top_terms(terms.term_counts(left), k=k).collect())) == sorted(map(str, every.collect()))
    if buckets > 1 << 10:
        assert 10 * left.select("catalog", "term").distinct().count() < rows.select("catalog", "term").distinct().count()
    assert terms.possible_top_rows(rows.limit(0), buckets=buckets).count() == 0


@pytest.mark.parametrize("buckets", [1 << 4, 1 << 12])
def test_leading_counts_from_added_sketches(spark, buckets):
    """sketches of two halves, added, lead to the same lists; large cells and NULL ones, flat cells, cells of few terms."""
    rng = random.Random(8)
    made = []
    for cell, n, flat in (("big", 12_000, False), ("flat", 900, True), ("small", 5, False), (None, 200, False)):
        for i in range(n):
            term = f"t{i if flat else min(int(rng.paretovariate(0.7)), 10_000 + i)}"
            made.append((cell, 5, rng.choice(["word", "bigram"]), rng.randrange(3), rng.random() < 0.1, i, term))
    schema = "catalog string, rating int, term_kind string, part int, crosses boolean, place bigint, term string"
    rows = spark.createDataFrame(made, schema).withColumn("place", F.col("place").cast("decimal(38,0)")).repartition(6)
    cell = ["catalog", "rating", "term_kind"]
    halves = [terms.sketch_counts(rows.filter(f"place % 2 = {h}"), cell, buckets=buckets) for h in (0, 1)]
    sketch = terms.merge_counts(halves[0].unionByName(halves[1]), cell, "_bucket")
    assert sketch.count() <= 8 * buckets
    for k in (1, 3, 10):
        every = terms.term_counts(rows, cell)
        some = terms.leading_counts(rows, sketch, cell, k, buckets=buckets)
        tops = [sorted(map(str, terms.top_terms(x, [*cell, "category"], k).collect())) for x in (every, some)]
        assert tops[0] == tops[1]
        assert {tuple(r) for r in some.collect()} <= {tuple(r) for r in every.collect()}
    assert terms.leading_counts(rows.limit(0), sketch.limit(0), cell, buckets=buckets).count() == 0


def test_first_bigrams_are_counted_alone(spark, monkeypatch):
    """F3, F7 to F9, F11 to F13: the same first terms with the same counts, and few of the others; all of them if cells are too many."""
    rng = random.Random(3)
    made = [("c", 1, i, 5, " ".join(f"w{min(int(rng.paretovariate(0.9)), 500 + i)}" for _ in range(20)), None, "да нет") for i in range(400)]
    df = spark.createDataFrame(made, SCHEMA).repartition(4)
    for cross in (True, False):
        every, some = bigram_counts(df, cross_review=cross), bigram_counts(df, cross_review=cross, first=3)
        assert cells_of(terms.top_terms(some, k=3)) == cells_of(terms.top_terms(every, k=3))
        assert 10 * some.count() < every.count()
        assert {tuple(r) for r in some.drop("first_place").collect()} <= {tuple(r) for r in every.drop("first_place").collect()}
    monkeypatch.setattr(plans, "COUNTERS", 1 << 10)
    assert bigram_counts(df, first=3).count() == bigram_counts(df).count()


def test_compact_places_keep_the_order(spark):
    """places of stored tokens are 64-bit numbers; where ids do not fit, they stay decimals."""
    narrow = [("a", p, r, 5, "x y z", None, "u v") for p in (10**12, 10**12 + 3) for r in (10**13, 10**13 + 7)]
    for rows, kind in ((narrow, "bigint"), ([*narrow, ("a", 0, 0, 5, "x y", None, None)], "decimal(38,0)")):
        tokens = plans.stored_tokens(terms.review_parts(spark.createDataFrame(rows, SCHEMA)))
        assert dict(tokens.dtypes)["place"] == kind
        plain = terms.part_tokens(terms.review_parts(spark.createDataFrame(rows, SCHEMA)))
        inner = [[r.term for r in terms.bigram_rows(x).orderBy("place").collect()] for x in (tokens, plain)]
        assert inner[0] == inner[1] and len(inner[0]) > 2 * len(rows)


def test_second_reading_skips_other_cells(spark):
    """only the cells that need a second reading have their words paired in it; the counts are those of all terms."""
    words = [f"w{i}" for i in range(60)]
    made = [("a", 1, 0, 0, words), ("b", 1, 0, 100, ["x", "x"]), (None, 2, 1, 200, ["y", "y", "y"])]
    tokens = spark.createDataFrame(made, "catalog string, rating int, part int, place bigint, words array<string>")
    cell = ["catalog", "rating", "term_kind"]
    rows = terms.word_and_bigram_rows(tokens, cross_review=False)
    assert rows.count() == sum(2 * len(m[4]) - 1 for m in made)
    some = terms.leading_counts(rows, terms.sketch_counts(rows, cell), cell, 1)
    every = terms.term_counts(rows, cell)
    tops = [sorted(map(str, terms.top_terms(x, [*cell, "category"], 1).collect())) for x in (every, some)]
    assert tops[0] == tops[1] and len(tops[0]) == 3 * 2 * 2
    plan = some._jdf.queryExecution().optimizedPlan().toString().splitlines()
    paired = next(i for i, line in enumerate(plan) if "posexplode" in line)
    assert any("Filter" in line and "xxhash64(catalog" in line for line in plan[paired + 1 :])


def test_sketch_keeps_kinds_apart(spark):
    """a word and a bigram of one bucket are two rows of a sketch, under their own kinds."""
    schema = "catalog string, rating int, term_kind string, part int, crosses boolean, place bigint, term string"
    rows = spark.createDataFrame([("a", 1, k, 0, k == "bigram", 0, "x y") for k in ("word", "bigram", "bigram")], schema)
    found = terms.sketch_counts(rows, ["catalog", "rating", "term_kind"], buckets=4).collect()
    assert {(r.term_kind, r.n_all, r.n_0) for r in found} == {("word", 1, 1), ("bigram", 2, 0)} and len({r._bucket for r in found}) == 1
    with pytest.raises(Exception, match="unknown kind"):
        terms.sketch_counts(rows.withColumn("term_kind", F.lit("letter")), ["term_kind"]).collect()


def test_tables_that_are_compacted_together_compare(spark):
    """places of several tables become 64-bit numbers of one order; where ids do not fit, all stay decimals."""
    narrow = [("a", p, r, 5, "x y z", None, "u v") for p in (7, 9) for r in (10**13, 10**13 + 7)]
    for rows, kind in ((narrow, "bigint"), ([*narrow, ("a", 10**12, 0, 5, "x y", None, None)], "decimal(38,0)")):
        tokens = terms.part_tokens(terms.review_parts(spark.createDataFrame(rows, SCHEMA)))
        ends = terms.part_ends(tokens)
        both = terms.compact_together(ends, F.col("last_pos") + 1, ends, tokens.filter("part = 2"))
        assert [dict(b.dtypes)["place"] for b in both] == [kind, kind]
        laid = both[0].select("place", F.lit(0).alias("of"), "first_word").unionByName(both[1].select("place", F.lit(1).alias("of"), F.get("words", F.lit(0)).alias("first_word")))
        found = [(r.of, r.first_word) for r in laid.orderBy("place", "of").collect()]
        firsts = len(rows)
        assert found == [(0, "x")] * firsts + [(0, "u"), (1, "u")] * len(narrow)
