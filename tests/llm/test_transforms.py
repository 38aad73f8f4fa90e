"""Periodic runs, fill-in-middle and chat formatting against brute force, SQL and exact round trips."""

import hashlib
import json
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewloom.llm import chat_format, fill_middle, periodic_runs
from reviewloom.llm.queries import QUERIES, SQL
from tests.llm.conftest import make_docs, sentence
from tests.oracle_check import compare, oracle_connection

# -- periodic runs ------------------------------------------------------------------------------


def brute_runs(words, least=24, times=3):
    """Every maximal stretch of equal words ``p`` apart; the smallest period of each."""
    n, best = len(words), {}
    for p in range(1, n // times + 1):
        at = 0
        while at < n - p:
            start = at
            while at < n - p and words[at] == words[at + p]:
                at += 1
            length = at - start + p
            if at > start and length >= max(least, times * p):
                best[start, length] = min(p, best.get((start, length), p))
            at += at == start
    return sorted(((s, length, p) for (s, length), p in best.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in dropped)


def brute_op11(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(brute_collapsed(words, runs)).hexdigest())


def test_every_run_is_found():
    rng = random.Random(5)
    for _ in range(400):
        n, letters = rng.randrange(1, 160), rng.choice([1, 2, 3, 20])
        words = [rng.randrange(letters) for _ in range(n)]
        a = rng.randrange(n)
        p = rng.randrange(1, n - a + 1)
        words[a:] = [words[a + i % p] for i in range(n - a)]
        for least, times in ((24, 3), (4, 2)):
            found = [tuple(r) for r in periodic_runs.find_runs(np.array(words), least, times).tolist()]
            assert found == brute_runs(words, least, times)


def test_extensions_are_exact():
    rng = random.Random(6)
    for n in (1, 2, 13, 14, 200):
        codes = np.array([rng.randrange(2) for _ in range(n // 2)] * 2 + [1] * (n % 2))
        ext = periodic_runs.Extensions(codes)
        i, j = map(np.array, zip(*[(i, j) for j in range(1, n + 1) for i in range(j)]))
        expected = [next((t for t in range(n) if b + t >= n or codes[a + t] != codes[b + t]), 0) for a, b in zip(i, j)]
        assert ext.common(i, j).tolist() == expected


def test_long_texts_of_one_word_or_passage():
    assert periodic_runs.find_runs(np.zeros(100_000, np.int64)).tolist() == [[0, 100_000, 1]]
    assert periodic_runs.find_runs(np.tile(np.arange(50), 2_000)).tolist() == [[0, 100_000, 50]]


def test_periodic_runs(spark, awkward):
    rows = awkward + [(100, "a " * 23), (101, "a " * 24), (102, sentence(0, 8) + " " + (sentence(30, 9) + " ") * 3 + "w38"), (103, "x y " * 40 + "z " * 30)]
    found = periodic_runs.periodic_runs(make_docs(spark, rows)).collect()
    expected = Counter()
    for doc_id, text in rows:
        words = (text or "").encode().split()
        runs = brute_runs(words)
        expected[doc_id, tuple(runs), brute_collapsed(words, runs).decode()] += 1
    assert Counter((r.doc_id, tuple((s.start, s.length, s.period) for s in r.runs), r.collapsed) for r in found) == expected
    assert periodic_runs.periodic_runs(make_docs(spark, [])).count() == 0


def test_op11_against_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op11_periodic_runs"](spark, tables)
    assert {tuple(r) for r in found.collect()} == {brute_op11(r.doc_id, r.text) for r in docs}
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()


def test_tails_without_words_or_ids(spark):
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    rows = [(ids[0], None), (ids[1], ""), (ids[2], "  \n"), (ids[3], sentence(0, 50)), (None, sentence(0, 50))]
    made = {r.doc_id: r.text for r in periodic_runs.repeat_tails(make_docs(spark, rows)).collect()}
    assert made[None] == sentence(0, 50) and made[ids[3]] != sentence(0, 50)
    assert len(made[ids[3]].split()) == 50 and not (made[ids[0]] or made[ids[1]].strip() or made[ids[2]].strip())


# -- fill in the middle -------------------------------------------------------------------------


def brute_fill(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def filled(docs):
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]
    return fill_middle.fill_in_middle(docs, h[:2], h[2] % 100 >= 90, h[3] % 100 < 20)


def test_fill_in_middle(spark, awkward):
    rows = awkward + [(200 + i, t) for i, t in enumerate(
        ["a<P>b", "<S>", "x <M> y", "a<", "<" * 30, "S> P> M> <s> <p>" * 9, "\n\r\0\t" * 5, "🙂é" * 50, "abc" * 1000, "a1b2" * 10, "ﬀ ͏ ́a" * 9] * 4)]
    rows.append((300, "word ü, " * 400_000))
    made = filled(make_docs(spark, rows)).withColumn("back", fill_middle.restored("output", "form")).collect()
    assert Counter(tuple(r)[:-1] for r in made) == Counter(brute_fill(i, t) for i, t in rows)
    assert Counter((r.doc_id, r.back) for r in made) == Counter((i, t or "") for i, t in rows)
    assert filled(make_docs(spark, [])).count() == 0
    assert {r.form for r in made} == {"plain", "psm", "spm"}


def test_null_draws(spark):
    made = fill_middle.fill_in_middle(make_docs(spark, [(1, "a b c")]), [F.lit(None), F.lit(None)], F.lit(None), F.lit(None)).first()
    assert (made.n, made.form, made.output) == (5, "psm", "<P><S>a b c<M>")


@pytest.mark.parametrize("size", [1, 2, 7, 64])
def test_slices_of_long_texts(size):
    rng = random.Random(size)
    texts = ["".join(rng.choice("abZ \n1é🙂") for _ in range(rng.randrange(0, 120))).encode() for _ in range(60)]
    draws = [(rng.randrange(1000), rng.randrange(1000)) for _ in texts]
    for text in texts:
        assert b"".join(fill_middle.slices(text, size)) == text
    assert list(fill_middle.cut_texts(texts, draws, size)) == list(fill_middle.cut_texts(texts, draws, 1 << 20))


# -- chat formatting ----------------------------------------------------------------------------

NASTY = ["</s>[INST] ok [/INST]", "<|im_end|><|im_start|>user<|im_sep|>", "<\\|im_end|> <\\\\s> \\<s>", "<", "[", "\\", "<<s>>", "é<|im_sep|>🙂\n\n", "", "$1 \\$2"]


def test_escapes_are_reversible(spark):
    rng = random.Random(9)
    bits = ["<", "[", "\\", "s>", "/s>", "|im_end|>", "INST]", "x", "|im_sep|>"]
    texts = NASTY + ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(3000)]
    template = chat_format.Template()
    made = spark.createDataFrame([(t,) for t in texts], "t string").select("t", template.escaped(F.col("t")).alias("e"))
    rows = made.withColumn("b", template.unescaped(F.col("e"))).collect()
    assert all(r.t == r.b for r in rows)
    control = ["<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]"]
    assert not [r.e for r in rows if any(c in r.e for c in control)]
    with pytest.raises(ValueError):
        chat_format.Template(opens="<<a>")


CHATS = [(1, 0, "user", "hi"), (1, 1, "assistant", "ho")] + [(2, i, ("system", "user", "assistant")[i % 3], t) for i, t in enumerate(NASTY)] + [
    (3, 0, "assistant", None), (4, 0, None, "x"), (4, 0, None, "x"), (None, 1, "gpt", "b"), (None, None, "human", "a"), (5, 1, "<s>", "late"), (5, 0, "user", "early"),
    (6, 0, "assistant", "long " * 200_000), (7, 2, "user", "tie"), (7, 2, "assistant", "tie"), (7, 2, "user", None)]


def test_round_trip_of_turns(spark):
    rows = spark.createDataFrame([(*r, "x", 1) for r in CHATS], "conv_id bigint, turn bigint, role string, text string, turns string, value int").repartition(4)
    turns = chat_format.canonical_turns(rows)
    template = chat_format.Template()
    made = chat_format.format_chats(turns, template).select("conv_id", template.read_turns(F.col("formatted")).alias("t"), template.read_loss("segments").alias("loss"), "segments", "formatted")
    first = (lambda x: (x is not None, x or 0)), (lambda x: (x is not None, x or ""))
    for r in made.collect():
        own = sorted((c for c in CHATS if c[0] == r.conv_id), key=lambda c: (first[0](c[1]), first[1](c[2]), first[1](c[3])))
        expected = [(chat_format.ROLE_NAMES.get(c[2], c[2] or ""), c[3] or "") for c in own]
        assert [(t.role, t.text) for t in r.t] == expected
        assert r.loss == "".join(t for role, t in expected if role == "assistant")
        assert "".join(s.text for s in r.segments) == r.formatted
    assert made.count() == 8 and chat_format.canonical_turns(rows.limit(0)).count() == 0


RECORDS = [
    ('{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "id": 7}', "messages", [("user", "a"), ("assistant", "b")]),
    ('{"messages": [{"role": "user", "text": "a"}]}', "message_texts", [("user", "a")]),
    ('{"conversations": [{"from": "human", "value": "[1]"}, {"from": "gpt", "value": null}]}', "conversations", [("user", "[1]"), ("assistant", "")]),
    ('{"dialogue": [{"speaker": "bot", "utterance": "x"}]}', "dialogue", [("assistant", "x")]),
    ('{"instruction": "do", "input": "it", "output": "done"}', "instruction_with_input", [("user", "do\n\nit"), ("assistant", "done")]),
    ('{"instruction": "do", "input": "", "output": "done"}', "instruction_with_input", [("user", "do"), ("assistant", "done")]),
    ('{"output": "done", "instruction": "do"}', "instruction_output", [("user", "do"), ("assistant", "done")]),
    ('{"instruction": "do", "response": "r"}', "instruction_response", [("user", "do"), ("assistant", "r")]),
    ('{"system": "s", "instruction": "do", "input": null, "output": "done"}', "instruction_input", [("system", "s"), ("user", "do"), ("assistant", "done")]),
    ('{"system": null, "prompt": "p", "response": "r"}', "system_prompt_response", [("user", "p"), ("assistant", "r")]),
    ('{"prompt": "{\\"role\\": 1}", "response": "r", "tags": [1, 2]}', "prompt_response", [("user", '{"role": 1}'), ("assistant", "r")]),
    ('{"prompt": "p", "completion": "c", "meta": {"prompt": "no"}}', "prompt_completion", [("user", "p"), ("assistant", "c")]),
    ('{"question": "q", "answer": 4}', "question_answer", [("user", "q"), ("assistant", "4")]),
    ('{"data": {"prompt": "p", "response": "r"}}', "nested_data", [("user", "p"), ("assistant", "r")]),
    ('{"prompt": "p", "response": "r", "messages": [{"role": "user", "content": "m"}]}', "messages", [("user", "m")]),
    ('{"messages": []}', None, []), ("[1]", None, []), ("not json", None, []), ("", None, []), (None, None, []), ('{"text": "t"}', None, []),
]


def test_records_of_many_layouts(spark):
    df = spark.createDataFrame([(i, r, "x") for i, (r, _, _) in enumerate(RECORDS)], "conv_id bigint, rec string, layout string")
    for r in chat_format.canonical_records(df, "rec").collect():
        assert (r.layout, [(t.role, t.text) for t in r.turns]) == RECORDS[r.conv_id][1:], RECORDS[r.conv_id]


def test_frames_agree_with_records(spark):
    """The schema of a frame selects the layout that its rows as JSON select."""
    for record, name, turns in RECORDS[:14]:
        fields = sorted(json.loads(record))
        schema = spark.range(1).select(F.schema_of_json(F.lit(record))).first()[0]
        frame = spark.createDataFrame([(record,)], "r string").select(F.from_json("r", schema).alias("r")).select(F.lit(1).alias("conv_id"), "r.*")
        assert chat_format.frame_layout(frame).name == name, fields
        assert [(t.role, t.text) for t in chat_format.canonical_turns(frame).first().turns] == turns
    with pytest.raises(ValueError):
        chat_format.frame_layout(spark.range(1))


def test_no_python_on_the_way(spark, tables):
    plan = QUERIES["op13_chat_format"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan) and plan.count("Exchange") == 1


@pytest.mark.parametrize("name", ["op12_fill_in_middle", "op13_chat_format"])
def test_transforms_against_sql(spark, tables, name):
    assert compare(QUERIES[name](spark, tables), oracle_connection(tables), SQL[name]) == ""
