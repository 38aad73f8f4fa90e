"""Exact and near duplicates and repeated byte strings against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from reviewloom.llm import components as component_module
from reviewloom.llm import near_dedup, repeated_spans
from reviewloom.llm.components import components
from reviewloom.llm.exact_dedup import PatriciaTrie, drop_copies, op9_exact_dedup, with_owner
from reviewloom.llm.suffixes import common_prefix, deep_shallow_sort
from tests.llm.conftest import make_docs, sentence


# -- exact --------------------------------------------------------------------------------------

@pytest.mark.parametrize("largest", [True, False])
def test_owners(spark, awkward, largest):
    groups = defaultdict(list)
    for doc_id, text in awkward:
        groups[text or ""].append(doc_id)
    pick = max if largest else min
    expected = Counter(
        (i, pick((x for x in ids if x is not None), default=None), len(ids)) for ids in groups.values() for i in ids
    )
    found = with_owner(make_docs(spark, awkward), largest).collect()
    assert Counter((r.doc_id, r._owner, r._n) for r in found) == expected
    kept = drop_copies(make_docs(spark, awkward), largest)
    assert Counter((r.doc_id, r.text or "") for r in kept.collect()) == Counter(
        (pick((x for x in ids if x is not None), default=None), t) for t, ids in groups.items()
    )
    assert kept.columns == make_docs(spark, awkward).columns


def test_exact_dedup_of_nothing(spark):
    empty = make_docs(spark, [])
    assert with_owner(empty).count() == drop_copies(empty).count() == 0


SKEW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def small_limits(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_text_is_dealt_by_id(spark, small_limits):
    """No exchange of whole rows goes by the text alone."""
    docs = make_docs(spark, [(i, "hot text " * 20) for i in range(4000)] + [(i, f"own {i}") for i in range(4000, 5000)])
    kept = drop_copies(docs, largest=True)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {3999, *range(4000, 5000)}
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", kept._jdf.queryExecution().executedPlan().toString())
    assert sum("doc_id" in keys or "_owner" in keys for keys in dealt) >= 2
    assert all("doc_id" in keys or "_owner" in keys or "text" not in keys for keys in dealt)


def test_a_hub_is_split(spark, small_limits, monkeypatch):
    """The joins of a star's round split the hub's partition."""
    plans = []
    stored = component_module.stored

    def watched(df, name):
        df.collect()
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(component_module, "stored", watched)
    star = spark.createDataFrame([(0, i) for i in range(1, 20_000)], "u bigint, v bigint").repartition(8)
    assert {r.component for r in components(star).collect()} == {0}
    assert any(name == "large" and "skew=true" in plan for name, plan in plans)


def test_trie_spills_subtrees():
    rng = random.Random(1)
    keys = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) * rng.randint(1, 3) for _ in range(3000)]
    trie = PatriciaTrie(largest=False, budget=20_000)
    for i, key in enumerate(keys):
        trie.insert(key, hashlib.sha256(key).digest(), i, 1)
        if trie.full():
            trie.spill(b"")
    assert trie.spilled
    expected = {k: (keys.index(k), n) for k, n in Counter(keys).items()}
    assert {k: (owner, n) for k, _, owner, n in trie.records()} == expected


def test_op9(spark, tables):
    rows = op9_exact_dedup(spark, tables).collect()
    assert all(r.kept == (r.doc_id == r.keep_id) for r in rows)


# -- near ---------------------------------------------------------------------------------------

def brute_components(rows, width, percent=80):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        span = min(width, len(words))
        sets.append({tuple(words[i : i + span]) for i in range(len(words) - span + 1)} if words else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0] and a and b
            linked = a and b and 100 * len(a & b) >= percent * len(a | b)
            if None not in (rows[i][0], rows[j][0]) and (linked or same_id):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return Counter((d, len(s), None if d is None else least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def families(rng, n):
    """Near copies of a few texts, at similarities around the threshold, and unrelated texts."""
    rows = []
    for i in range(n):
        words = sentence(rng.choice([0, 0, 100, 200]), rng.choice([30, 30, 60, 200]), rng.choice([1, 1, 3])).split()
        for _ in range(rng.choice([0, 1, 1, 2, 3, 8])):
            words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("width", [4, 5])
def test_near_components(spark, awkward, width):
    rows = awkward + [(100 + i, t) for i, t in families(random.Random(width), 150)]
    found = near_dedup.near_components(make_docs(spark, rows), width).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows, width)


@pytest.mark.parametrize("paired,block", [(2, 1 << 20), (2, 2000)])
def test_long_lists_and_blocks(spark, monkeypatch, paired, block):
    """Lists that make no pairs, and clusters dealt out in blocks, give the same components."""
    monkeypatch.setattr(near_dedup, "PAIRED", paired)
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", block)
    rows = families(random.Random(9), 120)
    found = near_dedup.near_components(make_docs(spark, rows), 4).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute_components(rows, 4)


def test_one_near_copy_stays(spark, awkward):
    docs = make_docs(spark, awkward)
    kept = near_dedup.drop_near_copies(docs, 5)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and ids[2] == ids[3] == 0 and ids[None] == 2 and ids[8] == 1 and ids[9] == 0 and ids[5] == 1
    assert near_dedup.near_components(make_docs(spark, [])).count() == 0
    assert near_dedup.near_components(make_docs(spark, [(1, None), (2, "")])).count() == 2


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 90), (90, 100), (7, 7), (200, 100)]
    found = components(spark.createDataFrame(chain, "u bigint, v bigint"))
    assert {(r.node, r.component) for r in found.collect()} == {(i, 0) for i in range(61)} | {(90, 90), (100, 90), (200, 90)}


# -- repeated byte strings ----------------------------------------------------------------------

def brute_repeats(rows, length=200):
    raws = [(t or "").encode() for _, t in rows]
    times = Counter(raw[i : i + length] for raw in raws for i in range(len(raw) - length + 1))
    out = Counter()
    for (doc_id, _), raw in zip(rows, raws):
        spans = []
        for i in range(len(raw) - length + 1):
            if times[raw[i : i + length]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + length
                else:
                    spans.append([i, i + length])
        at, kept = 0, []
        for a, b in spans:
            kept.append(raw[at:a])
            at = b
        kept = b"".join([*kept, raw[at:]])
        out[doc_id, len(raw), len(raw) - len(kept), len(spans), kept] += 1
    return out


def spliced(rng, n):
    passages = [sentence(k, rng.randint(30, 90), rng.choice([1, 7, 11])) for k in range(0, 90, 15)]
    rows = []
    for i in range(n):
        parts = [f"u{rng.randrange(10**9)}" * rng.randint(1, 30) if rng.random() < 0.5 else rng.choice(passages) for _ in range(rng.randint(1, 6))]
        text = " ".join(parts)
        cut = rng.randrange(len(text) + 1)
        rows.append((i, text[cut:] if rng.random() < 0.4 else text))
    return rows + [(n, "ab" * 300), (n + 1, "é" * 150), (n + 2, "x" * 199), (n + 3, "x" * 200), (n + 4, "y" * 201)]


@pytest.mark.parametrize("group,pairwise,chunk", [(4096, 16, 1 << 19), (2, 16, 1 << 19), (4096, 1, 1 << 19), (4096, 16, 256)])
def test_repeated_spans(spark, awkward, monkeypatch, group, pairwise, chunk):
    for name, value in (("GROUP", group), ("PAIRWISE", pairwise), ("CHUNK", chunk)):
        monkeypatch.setattr(repeated_spans, name, value)
    rows = awkward + [(1000 + i, t) for i, t in spliced(random.Random(group + chunk), 80)]
    found = repeated_spans.without_repeats(make_docs(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == brute_repeats(rows)


def test_a_common_gram_meets_in_no_task(spark, monkeypatch):
    """A line in many documents, each time in other surroundings: grams are not put into windows."""
    line = "the same line of more than sixty-four bytes in every document, " + sentence(0, 40)
    rows = [(i, f"{'a%d ' % i * 50}{line}{' b%d' % i * 50}") for i in range(60)]
    found = repeated_spans.without_repeats(make_docs(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found) == brute_repeats(rows)
    monkeypatch.setattr(repeated_spans, "stored", lambda df, name: df)
    plan = repeated_spans._marks(make_docs(spark, rows))._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [gram" in plan and "Window" not in plan


def test_repeats_of_nothing(spark):
    assert repeated_spans.without_repeats(make_docs(spark, [])).count() == 0
    (row,) = repeated_spans.without_repeats(make_docs(spark, [(1, None)])).collect()
    assert (row.n_bytes, row.n_removed, bytes(row.kept)) == (0, 0, b"")


def test_op3(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    expected = {(d, n, r, s, hashlib.sha256(k).hexdigest()) for d, n, r, s, k in brute_repeats([tuple(x) for x in docs])}
    assert {tuple(r) for r in repeated_spans.op3_repeated_spans(spark, tables).collect()} == expected


def test_deep_shallow_sort():
    rng = random.Random(3)
    for _ in range(300):
        base = bytes(rng.choice(b"ab") for _ in range(60))
        texts = [base[: rng.randint(0, 60)] + bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 40))]
        order, shared = deep_shallow_sort(texts)
        assert [texts[i] for i in order] == sorted(texts)
        assert shared == [common_prefix(texts[order[k - 1]], texts[order[k]]) if k else 0 for k in range(len(order))]
