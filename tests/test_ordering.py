import random

from pyspark.sql import functions as F

from reviewloom.operators.ordering import dense_positions, next_in_order, number_rows, top_k


def skewed_rows(count=4000, seed=3):
    """One group holds more than a third of the rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        group = "hot" if rng.random() < 0.4 else f"g{rng.randint(0, 30)}"
        rows.append((group, rng.randint(0, 5), i, f"v{i}"))
    rng.shuffle(rows)
    return rows


SCHEMA = "g string, a int, b int, v string"


def by_group(rows):
    groups = {}
    for row in sorted(rows):
        groups.setdefault(row[0], []).append(row)
    return groups


def test_next_in_order(spark):
    rows = skewed_rows()
    expected = {}
    for members in by_group(rows).values():
        for row, following in zip(members, [*members[1:], None]):
            expected[row[2]] = following and following[3]
    for slices in (1, 3, 40):
        df = spark.createDataFrame(rows, SCHEMA).repartition(5)
        out = next_in_order(df, ["g"], ["a", "b"], ["v"], "nx", slices)
        assert out.columns == ["g", "a", "b", "v", "nx"]
        assert {r.b: r.nx and r.nx.v for r in out.collect()} == expected


def test_number_rows(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for slices in (1, 7):
        out = number_rows(df, ["g", "a", "b"], "n", start=11, slices=slices).collect()
        assert [r.b for r in sorted(out, key=lambda r: r.n)] == [r[2] for r in sorted(rows)]
        assert sorted(r.n for r in out) == list(range(11, 11 + len(rows)))


def test_dense_positions(spark):
    rows = [*skewed_rows(500), (None, 0, 900, "x"), (None, 0, 901, "y")]
    out = dense_positions(spark.createDataFrame(rows, SCHEMA), ["g"], ["a", "b"]).collect()
    assert len(out) == len(rows)
    found = {r.b: r.pos for r in out}
    for members in by_group([r for r in rows if r[0]]).values():
        assert [found[r[2]] for r in members] == list(range(len(members)))
    assert (found[900], found[901]) == (0, 1)


def test_top_k_with_lanes(spark):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    for lanes in (1, 8):
        out = top_k(df, ["g"], [F.asc("a"), F.asc("b")], 7, lanes=lanes, lane_key=["a", "b"])
        assert out.columns == ["g", "a", "b", "v", "rank"]
        found = {(r.g, r["rank"]): r.b for r in out.collect()}
        expected = {
            (group, i + 1): row[2] for group, members in by_group(rows).items() for i, row in enumerate(members[:7])
        }
        assert found == expected
