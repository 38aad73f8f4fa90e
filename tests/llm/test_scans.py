"""Secrets, decontamination, classifiers and the pipeline against brute force or held-out labels."""

import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from reviewloom.llm import decontaminate, quality, secrets, toxicity
from reviewloom.llm.labelled import labelled_sample
from reviewloom.llm.queries import QUERIES, SQL
from tests.llm.conftest import make_docs, sentence
from tests.llm.test_dedup import brute_components
from tests.oracle_check import compare, oracle_connection

# -- secrets ------------------------------------------------------------------------------------

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)


def with_checksum(prefix, payload):
    value, digits = zlib.crc32(payload.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = secrets.BASE62.decode()[digit] + digits
    return f"{prefix}_{payload}{digits}"


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(found)


SECRETS = [
    "password=hunter22 Passwd: 'abc' SECRET = \"a.b-c_d\" token:::x api-key=nothing1 APIKEY=abcdef api_key : q1w2e3",
    "tokentoken=abcdef password=password=abcdef secret==12345x ſecret=abcdef toKen=abcdef", "AKIA" + "A1" * 8, "AKIA" + "A" * 15,
    "xAKIAKIA" + "B" * 16 + "ü", "ü" * 5 + "0123456789abcdef01234567 0123456789ABCDEF01234567 " + "a" * 23, "日 password=日本abcdef token=abcdef日",
    "password=" + "a1" * 100_000,
]


def test_base_spans(spark, awkward):
    rows = awkward + [(100 + i, t) for i, t in enumerate(SECRETS)]
    found = secrets.find_secrets(make_docs(spark, rows)).collect()
    got = Counter((r.doc_id, tuple((s.start, secrets.KINDS.index(s.kind), s.end) for s in r.secrets)) for r in found)
    assert got == Counter((i, tuple(base_spans(t or ""))) for i, t in rows)
    assert secrets.find_secrets(make_docs(spark, [])).count() == 0


def test_many_hits_in_a_long_text():
    """The time grows with the length: a text eight times as long takes nowhere near 64 times as long."""
    took = []
    for n in (10_000, 80_000):
        text = "日本 password=abcdef é token: q1w2e3r4 " * n
        started = time.perf_counter()
        spans = secrets.SecretScanner().scan(text)
        took.append(time.perf_counter() - started)
        assert len(spans) == 2 * n and [text[a:b] for a, _, b in (spans[0], spans[-1])] == ["password=abcdef", "token: q1w2e3r4"]
    assert took[1] < 24 * took[0]


def test_checksums_decide():
    good = with_checksum("ghp", "a1B2c3D4e5" * 3)
    bad = good[:-1] + ("A" if good[-1] != "A" else "B")
    npm = with_checksum("npm", "Z9y8X7w6V5" * 3)
    spans = secrets.SecretScanner().scan(f"é {good} {bad} {npm} {good}x")
    assert [(secrets.KINDS[k], a) for a, k, _ in spans] == [("github", 2), ("npm", 2 + 2 * 41)]


# -- decontamination ----------------------------------------------------------------------------

def words_of(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text) if w]


def brute_hits(text, items):
    own, hit, named = words_of(text), set(), set()
    for item_id, item in items:
        words = words_of(item)
        n = min(10, len(words))
        windows = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
        for i in range(len(own) - n + 1) if windows else ():
            if tuple(own[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                named.add(item_id)
    return len(own), len(hit), named


BENCH = [
    (1, sentence(0, 25)), (2, "Only, four SHORT words"), (3, "word"), (4, None), (5, "..."), (6, sentence(200, 12, 3)), (None, sentence(300, 11)),
    (1, sentence(0, 25)), (7, "Éa b c d e f g h i j k"), (8, "a a a a a a a a a a a"),
]
DIRTY = [
    (50, "x " + sentence(3, 10).upper() + " y"), (51, sentence(3, 9)), (52, "only four; short WORDS!"), (53, "a word"), (54, sentence(200, 12, 3)),
    (55, "éa b c d e f g h i j k"), (56, "Éa B C D E F G H I J K"), (57, "a " * 30), (58, sentence(0, 12) + " gap " + sentence(11, 14)),
    (59, " ".join([sentence(0, 25)] * 3)), (60, sentence(300, 11)), (61, "," + sentence(300, 11)),
]


def test_contamination(spark, awkward):
    rows = awkward + DIRTY
    bench = spark.createDataFrame([(*b, 1) for b in BENCH], "item_id bigint, text string, words int")
    found = decontaminate.contamination(make_docs(spark, rows), bench).collect()
    expected = Counter()
    for doc_id, text in rows:
        n, hit, named = brute_hits(text, BENCH)
        ids = sorted(str(i) for i in named if i is not None)
        expected[doc_id, n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in found) == expected
    clean = decontaminate.clean_documents(make_docs(spark, rows), bench)
    assert clean.columns == make_docs(spark, rows).columns
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter((i, t) for i, t in rows if not brute_hits(t, BENCH)[1])


def test_contamination_of_nothing(spark, awkward):
    none = spark.createDataFrame([], "item_id bigint, text string")
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    assert decontaminate.contamination(make_docs(spark, []), bench).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(make_docs(spark, awkward), none).collect()} == {0}


def brute_near(text, items, slop=2):
    """Items of which a window has all but one word in five, each up to ``slop`` words behind its place."""
    own, named = words_of(text), set()
    for item_id, item in items:
        words = words_of(item)
        n = min(10, len(words))
        for s in range(len(words) - n + 1) if n else ():
            for base in range(-n - slop, len(own)):
                there = sum(any(0 <= base + k + e < len(own) and own[base + k + e] == words[s + k] for e in range(slop + 1)) for k in range(n))
                if there >= n - n // 5:
                    named.add(item_id)
    return named


NEAR = [
    (70, sentence(0, 25).replace("w5 ", "changed ")), (71, sentence(0, 25).replace("w5 ", "")), (72, "a b c d e x g h i j k l"),
    (73, "only four words"), (74, "only x four short words"), (75, sentence(300, 5) + " one two " + sentence(305, 6)),
    (76, sentence(300, 5) + " one two three " + sentence(305, 6)), (77, "éa b c never d e f never g h"), (78, "b a " * 9), (79, sentence(200, 8, 3)), (80, "x " + sentence(203, 8, 3)),
    (81, " ".join(reversed(sentence(0, 25).split()))), (82, sentence(2, 4) + " z " + sentence(6, 3) + " z z " + sentence(9, 3)),
]


def test_proximity(spark, awkward):
    bench_rows = BENCH + [(20, "a b c d e f g h i j k l"), (21, sentence(0, 9) + " lacking " + sentence(10, 9))]
    rows = [r for r in awkward if r[0] != 12] + DIRTY + NEAR
    bench = spark.createDataFrame(bench_rows, "item_id bigint, text string")
    expected = {(i, item) for i, t in rows for item in brute_near(t, bench_rows)}
    found = decontaminate.proximity_matches(make_docs(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == expected
    assert {(70, 1), (71, 1), (72, 20), (74, 2), (75, None)} <= expected and (81, 1) not in expected
    counts = {(r.doc_id, r._h): r.n_near for r in decontaminate.contamination(make_docs(spark, rows), bench).collect()}
    for (doc_id, _), n in counts.items():
        if doc_id not in (None, 14):
            assert n == len({item for i, item in expected if i == doc_id and item is not None})


def test_long_texts_of_one_word_or_passage(spark):
    """Rows stay few and small: one for each document and item, with one stretch."""
    passage = sentence(0, 25)
    docs = make_docs(spark, [(1, "a " * 20_000), (2, "a " * 200_000), (3, (passage + " ") * 2_000), (4, "b a " * 50_000)])
    bench = spark.createDataFrame([(1, "a " * 11), (2, passage), (3, passage + " " + passage), (4, "a " * 300), (5, "a b " * 40)], "item_id bigint, text string")
    found = decontaminate.matches(docs, bench)
    expected = {(1, 1, 0, 19_999), (2, 1, 0, 199_999), (1, 4, 0, 19_999), (2, 4, 0, 199_999), (3, 2, 0, 49_999), (3, 3, 0, 49_999), (4, 5, 0, 99_999)}
    rows = found.collect()
    assert {(r.doc_id, r.item_id, s.first, s.last) for r in rows for s in r.runs} == expected
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows})


# -- classifiers --------------------------------------------------------------------------------

def labelled(spark, texts, name):
    docs = make_docs(spark, [(i, t) for i, (t, _) in enumerate(texts)])
    return docs, spark.createDataFrame([(i, y, "x") for i, (_, y) in enumerate(texts)], f"doc_id bigint, {name} int, score string")


def test_quality(spark, awkward):
    good = [(sentence(7 * i, 90 + i, 1 + i % 5), 1) for i in range(120)]
    bad = [(sentence(3 * i, 70) + "\n" + " | ".join(["cell"] * 80), 0) for i in range(60)]
    docs, labels = labelled(spark, good + bad, "quality")
    model = quality.fit_quality(docs, labels)
    scored = {r.doc_id: r for r in quality.score_quality(docs, model).collect()}
    assert np.mean([scored[i].predicted == y for i, (_, y) in enumerate(good + bad)]) > 0.97
    rows = quality.score_quality(make_docs(spark, awkward), model)
    assert rows.count() == len(awkward) and rows.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert {r.score for r in rows.filter("doc_id IN (5, 6, 7)").collect()} == {0.0}
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.filter("doc_id < 120").count() > 115 and kept.filter("doc_id >= 120").count() < 3
    assert quality.score_quality(make_docs(spark, []), quality.fit_quality(docs, labels.limit(0))).count() == 0


def test_all_rows_are_kept_without_labels(spark, awkward):
    docs = make_docs(spark, awkward)
    unusable = [
        spark.createDataFrame([], "doc_id bigint, quality int"),
        spark.createDataFrame([(1, None), (2, None)], "doc_id bigint, quality int"),
        docs.filter(quality.held_out()).selectExpr("doc_id", "1 AS quality"),
        spark.createDataFrame([(5, 1), (6, 0)], "doc_id bigint, quality int"),
    ]
    for labels in unusable:
        kept = quality.keep_good(docs, labels)
        assert kept.columns == docs.columns
        assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(awkward)


def test_sample_has_a_bounded_size(spark):
    """One id that many documents hold, and long texts, stay within the bounds of rows and bytes."""
    docs = make_docs(spark, [(1, f"text {i}") for i in range(50)] + [(1, "text 7")] * 5 + [(2, "long " * 100), (3, "short")])
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id bigint, quality int").filter(~quality.held_out())
    named = {r.doc_id for r in labels.collect()}
    every = {r.text for r in docs.collect() if r.doc_id in named}
    rows = labelled_sample(docs, labels, "quality", 100, 1000).collect()
    assert Counter(r.text for r in rows) == Counter(every)
    assert len(labelled_sample(docs, labels, "quality", 10, 1000).collect()) == min(10, len(every))
    few = [r.text for r in labelled_sample(docs, labels, "quality", 100, 60).collect()]
    assert few and sum(map(len, few)) <= 60 and set(few) <= every


def test_attention_learns():
    """Fitting brings the scores nearer to the labels."""
    rng = np.random.default_rng(0)
    bags = [rng.random((n, quality.N_FEATURES)).astype(np.float32) for n in (1, 3, 5, 2)]
    labels = np.array([1, 0, 1, 0])
    before = quality.AttentionModel().scores(bags)
    after = quality.AttentionModel().fit(bags, labels).scores(bags)
    assert np.abs(after - labels).mean() < np.abs(before - labels).mean()


def test_toxicity_is_fair_to_groups(spark, awkward):
    terms = toxicity.IDENTITY_TERMS["en"]
    texts = [(f"{sentence(11 * i, 30)} you idiot {terms[0] if i % 2 else terms[3]}", 1) for i in range(60)]
    texts += [(sentence(5 * i, 40) + (f" the {terms[3]} people" if i % 8 == 0 else ""), 0) for i in range(160)]
    docs, labels = labelled(spark, texts, "toxic")
    model = toxicity.fit_toxicity(docs, labels)
    scored = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    assert np.mean([scored[i].predicted == y for i, (_, y) in enumerate(texts)]) > 0.97
    scores = [model.score(f"{sentence(9, 30)} the {t} people") for t in terms]
    assert max(scores) < toxicity.THRESHOLD
    partners = toxicity.listed_partners()
    pairs = [(model.score(f"a {a} person"), model.score(toxicity.swapped(f"a {a} person", partners))) for a in terms[:6]]
    assert max(abs(a - b) for a, b in pairs) < 0.1
    rows = toxicity.score_toxicity(make_docs(spark, awkward), model)
    assert rows.count() == len(awkward) and rows.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert {model.score("")} == {r.score for r in rows.filter("doc_id IN (5, 6, 7)").collect()}
    assert toxicity.score_toxicity(make_docs(spark, []), toxicity.fit_toxicity(docs, labels.limit(0))).count() == 0


def test_partners_stay_in_their_language():
    partners = toxicity.listed_partners()
    for words in toxicity.IDENTITY_TERMS.values():
        assert len(set(words)) == len(words)
        assert all(partners[w] in next(x for x in toxicity.IDENTITY_TERMS.values() if w in x) for w in words)
    assert toxicity.swapped("Die FRAUEN und frau", partners) == f"Die {partners['frauen']} und {partners['frau']}"
    assert toxicity.swapped("none here", partners) is None


def test_penalty_acts_on_mined_words(spark):
    """Two words in the same places say nothing of the label; without the penalty the rarer one is held against a text."""
    texts = [(f"{sentence(13 * i, 25)} the {'blorg' if i % 2 else 'fnord'} folk came {'you idiot' if i % 4 == 0 else ''}", int(i % 4 == 0)) for i in range(240)]
    docs, labels = labelled(spark, texts, "toxic")
    model = toxicity.fit_toxicity(docs, labels, terms={"xx": ("blorg", "fnord")})
    assert model.swapped_texts > 100
    assert abs(model.score("the blorg folk") - model.score("the fnord folk")) < 0.02
    sample = labelled_sample(docs, labels, "toxic", 1000, 1 << 20)
    rated = spark.createDataFrame([("blorg", 30, 90, 0.1), ("fnord", 30, 90, 0.2), ("idiot", 60, 0, 9.0)], "name string, a int, c int, z double")
    assert toxicity.mined_partners(sample, rated, 240) == {"blorg": "fnord", "fnord": "blorg"}


def test_toxicity_sample_is_bounded(spark):
    docs = make_docs(spark, [(i % 3, f"text {i}") for i in range(900)])
    labels = spark.createDataFrame([(i, 1) for i in range(3)], "doc_id bigint, toxic int")
    seen = []
    original = toxicity.labelled_sample
    toxicity.labelled_sample = lambda *a: seen.append(original(*a)) or seen[-1]
    try:
        toxicity.fit_toxicity(docs, labels, rows=10, text_bytes=50)
    finally:
        toxicity.labelled_sample = original
    rows = seen[0].collect()
    assert 0 < len(rows) <= 10 and sum(len(r.text) for r in rows) <= 50


def test_held_out_accuracy(spark, tables):
    labels = spark.read.parquet(f"{tables}/labels.parquet").select("doc_id", "quality", "toxic")
    for name, label, least in (("op1_quality", "quality", 0.9), ("op5_toxicity", "toxic", 0.85)):
        rows = QUERIES[name](spark, tables).join(labels, "doc_id").filter("held_out").collect()
        assert np.mean([r.predicted == r[label] for r in rows]) >= least


def test_labels_of_the_held_out_fold_are_not_learned(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit_quality(docs, labels), quality.fit_quality(docs, turned)
    assert all((a.p[k] == b.p[k]).all() for k in a.p)
    turned = labels.withColumn("toxic", F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    c, d = toxicity.fit_toxicity(docs, labels), toxicity.fit_toxicity(docs, turned)
    assert c.names == d.names and (c.weights == d.weights).all() and c.bias == d.bias


# -- queries and pipeline -----------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tables, name):
    assert compare(QUERIES[name](spark, tables), oracle_connection(tables), SQL[name]) == ""


def test_op4_columns(spark, tables):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()}
    for row in QUERIES["op4_secrets"](spark, tables).collect():
        spans = base_spans(docs[row.doc_id] or "")
        text = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(k == i for _, k, _ in spans) for i in range(3)]
        assert row.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(row.spans.split(","))


def test_pipeline(spark, tables):
    """Every stage against brute force on what its predecessor kept; the classifier by its own scores."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "bpe_encoding"]
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    scores = quality.score_quality(docs, quality.fit_quality(docs, spark.read.parquet(f"{tables}/labels.parquet")))
    good = {r.doc_id for r in scores.filter("predicted = 1").collect()}
    rows = {r.doc_id: r.text for r in docs.collect()}
    expected = {i: rows[i] for i in good}
    owner = {}
    for i, text in expected.items():
        owner[text or ""] = max(i, owner.get(text or "", i))
    expected = {i: rows[i] for i in owner.values()}
    links = brute_components(sorted(expected.items()), 5)
    expected = {i: rows[i] for i, _, least in links if i == least}
    bench = [tuple(r) for r in spark.read.parquet(f"{tables}/benchmark.parquet").select("item_id", "text").collect()]
    expected = {i: t for i, t in expected.items() if not brute_hits(t, bench)[1]}
    library = Tokenizer.from_file(corpus_pipeline.public_tokenizers.path("byte_bpe_50k.json"))
    found = corpus_pipeline.run(spark, tables).collect()
    assert {r.doc_id: list(r.ids) for r in found} == {i: library.encode(t or "", add_special_tokens=False).ids for i, t in expected.items()}
    assert stages["quality"](spark, docs, tables).columns == docs.columns
