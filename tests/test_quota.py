import random

from pyspark.sql import functions as F

from reviewloom.operators import quota


def expected_picks(candidates, stored, target):
    """Catalogue after catalogue, smallest first."""
    found = set()
    known = {a for _, a in stored}
    for catalog in sorted({c for c, _, _ in candidates}):
        first = {}
        for _, article, position in (c for c in candidates if c[0] == catalog):
            first[article] = min(position, first.get(article, position))
        new = sorted((p, a) for a, p in first.items() if a not in known)
        room = max(target - sum(1 for c, _ in stored if c == catalog), 0)
        found |= {(catalog, a, p, i + 1) for i, (p, a) in enumerate(new[:room])}
        known |= {a for _, a in new[:room]}
    return found


def test_select_new_products(spark):
    rng = random.Random(8)
    candidates = [(rng.choice([1, 1, 1, 2, 3]), rng.randint(0, 60), i) for i in range(400)]
    stored = [(rng.randint(1, 3), a) for a in range(0, 60, 5)]
    cand = spark.createDataFrame(candidates, "catalog_id bigint, product_article bigint, position bigint")
    prod = spark.createDataFrame(stored, "catalog_id bigint, product_article bigint")
    for target, task_rows, rounds in ((9, 10_000, 16), (9, 10_000, 0), (9, 0, 1), (100, 10_000, 0)):
        out = quota.select_new_products(cand, prod, target=target, task_rows=task_rows, rounds=rounds)
        assert {tuple(r) for r in out.collect()} == expected_picks(candidates, stored, target)


def test_a_catalogue_moves_on_to_its_next_candidates(spark):
    candidates = [(1, 10, 0), (1, 11, 1), (2, 10, 0), (2, 11, 1), (2, 12, 2), (2, 13, 3), (3, 12, 0), (3, 13, 1)]
    cand = spark.createDataFrame(candidates, "catalog_id bigint, product_article bigint, position bigint")
    none = spark.createDataFrame([], "catalog_id bigint, product_article bigint")
    picks = quota.select_new_products(cand, none, target=2).collect()
    assert {(r.catalog_id, r.product_article) for r in picks} == {(1, 10), (1, 11), (2, 12), (2, 13)}


def test_many_groups_of_catalogues(spark):
    """Groups below and above the limit of a task, and catalogues that share nothing, next to each other."""
    rng = random.Random(9)
    candidates, at = [], 0
    for group in range(12):
        members = rng.randint(1, 9)
        for _ in range(members * 14):
            candidates.append((group * 10 + rng.randint(0, members - 1), group * 1000 + rng.randint(0, 20), at))
            at += 1
    stored = [(rng.randint(0, 119), rng.randint(0, 11) * 1000 + a) for a in range(15)]
    cand = spark.createDataFrame(candidates, "catalog_id bigint, product_article bigint, position bigint").repartition(5)
    prod = spark.createDataFrame(stored, "catalog_id bigint, product_article bigint")
    for target, rounds in ((1, 0), (4, 1)):
        out = quota.select_new_products(cand, prod, target=target, task_rows=40, rounds=rounds)
        assert {tuple(r) for r in out.collect()} == expected_picks(candidates, stored, target)


def test_a_chain_of_displacements_takes_few_jobs(spark):
    """Each catalogue loses its first candidate to the one before it, which has lost its own."""
    candidates = [(1, 1, 0)] + [(c, a, a) for c in range(2, 1001) for a in (c - 1, c)]
    cand = spark.createDataFrame(candidates, "catalog_id bigint, product_article bigint, position bigint")
    none = spark.createDataFrame([], "catalog_id bigint, product_article bigint")
    context = spark.sparkContext
    context.setJobGroup("chain", "a chain of displacements")
    try:
        picks = quota.select_new_products(cand, none, target=1).collect()
        jobs = len(context.statusTracker().getJobIdsForGroup("chain"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert {(r.catalog_id, r.product_article) for r in picks} == {(c, c) for c in range(1, 1001)}
    assert 0 < jobs < 500


def test_candidates_behind_the_reach_are_left_out(spark):
    """A catalogue filled by candidates of its own never meets another one further down its list."""
    candidates = [(1, 10, 0), (1, 11, 1), (1, 30, 2), (2, 30, 0), (2, 31, 1), (2, 32, 2)]
    cand = spark.createDataFrame(candidates, "catalog_id bigint, product_article bigint, position bigint").withColumn("_room", F.lit(2))
    near = quota._within_reach(cand, "catalog_id", "product_article", "position", 2)
    assert {(r.catalog_id, r.product_article) for r in near.collect()} == {(1, 10), (1, 11), (2, 30), (2, 31), (2, 32)}


def test_candidates_without_key_or_position(spark):
    schema = "catalog_id string, product_article string, position int"
    rows = [("b", "x", None), ("b", "y", 0), ("a", "y", 5), ("a", None, 0), (None, "z", 0), ("a", "x", 5)]
    none = spark.createDataFrame([], "catalog_id string, product_article string")
    out = quota.select_new_products(spark.createDataFrame(rows, schema), none, target=1, rounds=0)
    assert {tuple(r) for r in out.collect()} == {("a", "x", 5, 1), ("b", "y", 0, 1)}
    empty = quota.select_new_products(spark.createDataFrame([], schema), none, target=1)
    assert empty.collect() == [] and empty.columns == ["catalog_id", "product_article", "position", "pick"]


def test_connected(spark):
    rng = random.Random(4)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(n, n + 1) for n in range(400, 450)]
    links = [(u, v) for u, v in links if u != v]
    least = {n: n for link in links for n in link}
    for _ in range(len(links)):
        for u, v in links:
            least[u] = least[v] = min(least[u], least[v])
    out = quota.connected(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    assert {(r.node, r.component) for r in out} == set(least.items()) and len(out) == len(least)
