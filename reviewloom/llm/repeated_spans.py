"""Repeated byte strings across documents, by sorting suffixes at sampled anchors.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts anywhere else.

1. Anchors: of the ``GRAM``-byte grams in each string of ``LENGTH`` bytes, the leftmost of least hash.
   Equal strings have equal anchors at equal places, so only suffixes at anchors need sorting: about
   one in 70. An anchor owns the neighbouring strings it was chosen for; together they are its span.
2. Anchors are dealt out by their gram. Spans that occur twice as a whole are repeated, all strings in
   them. Copies that meet in one map task are settled there, and one of them is passed on, so a text
   that a third of the rows share does not meet in one task.
3. Grams whose spans differ are contested: one copy of each span (a few hundred bytes) goes to the
   gram's group. There the suffixes behind the anchors and the reversed prefixes before them are
   sorted, shallow by multikey quicksort and deep by blind tries; shared lengths on either side tell
   which strings of ``LENGTH`` bytes occur in two spans.
4. Grams with more than ``GROUP`` different spans, such as a very common line, are not put into one
   group: their strings are counted one by one by 128-bit digest, with map-side combine.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import map_batches, stored, table
from reviewloom.llm.near_dedup import FILTER_BITS, id_filter
from reviewloom.llm.suffixes import deep_shallow_sort

LENGTH, GRAM = 200, 64
GROUP = 4096
PAIRWISE = 16
CHUNK = 1 << 19
#: Spans that a map task remembers to settle copies by itself.
REMEMBERED = 400_000

_ANCHORS = "gram bigint, span bigint, did bigint, h bigint, at bigint, first bigint, last bigint, copies int, settled boolean, row bigint"


def _word_hashes(raw: bytes) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each position on."""
    n = len(raw) - GRAM + 1
    words = np.ndarray((len(raw) - 7,), "<u8", np.frombuffer(raw, np.uint8).data, strides=(1,))
    h = np.zeros(n, np.uint64)
    for at in range(0, GRAM, 8):
        h = (h ^ words[at : at + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def anchors(raw: bytes) -> Iterator[tuple[int, int, int, int]]:
    """``(gram's hash, anchor, first, last)``: the anchor is that of the strings that start at first to last."""
    window = LENGTH - GRAM + 1
    for begin in range(0, max(0, len(raw) - LENGTH + 1), CHUNK):
        part = raw[begin : begin + CHUNK + LENGTH - 1]
        h = _word_hashes(part)
        starts = len(part) - LENGTH + 1
        key = (h & np.uint64(0xFFFFFFFFFFF00000)) | np.arange(len(h), dtype=np.uint64)
        rows = np.concatenate([key, np.full(-len(h) % window, np.uint64(0xFFFFFFFFFFFFFFFF))]).reshape(-1, window)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(behind[:starts], ahead[window - 1 : window - 1 + starts]) & np.uint64(0xFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.append(first[1:], starts) - 1
        yield from zip(
            h[at[first]].view(np.int64).tolist(), (at[first] + begin).tolist(), (first + begin).tolist(), (last + begin).tolist()
        )


def _rows(docs: DataFrame) -> DataFrame:
    """Rows are told apart by id and text; ``did`` is 0 for a NULL id, which ``h`` tells from a real 0."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("did"), F.xxhash64(F.col("doc_id").cast("bigint"), text).alias("h"), text.alias("text")
    )


def _find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    names = [c.split()[0] for c in _ANCHORS.split(", ")]
    kept: dict[tuple[int, int], list] = {}
    numbers = itertools.count(TaskContext.get().partitionId() << 40)

    def flush() -> dict[str, list]:
        rows = list(zip(*kept.values()))
        kept.clear()
        return dict(zip(names, rows))

    for batch in batches:
        done: list[tuple] = []
        for did, h, text in zip(*(c.to_pylist() for c in batch.columns)):
            raw = text.encode()
            for gram, at, first, last in anchors(raw):
                span = xxhash.xxh3_64_intdigest(raw[first : last + LENGTH]) - (1 << 63)
                own = kept.get((gram, span))
                if own is None:
                    kept[gram, span] = [gram, span, did, h, at, first, last, 1, False, next(numbers)]
                else:  # settled: it needs no partner, and its gram only spreads it
                    own[7] = 2
                    done.append((h ^ at, span, did, h, at, first, last, 2, True, next(numbers)))
        if done:
            yield dict(zip(names, zip(*done)))
        if len(kept) > REMEMBERED:
            yield flush()
    if kept:
        yield flush()


def _marks(docs: DataFrame) -> DataFrame:
    """Anchors that are not alone: ``repeated`` (the whole span is), ``copy`` (1: stands for its span in
    a contested gram) and ``contested`` (its gram has other spans).

    Spans are counted by gram and span, then grams by the least and largest of their spans, both with
    map-side combine; flags are joined back, so a gram that very many rows hold meets in no one task.
    """
    found = stored(map_batches(_rows(docs), _find_anchors, _ANCHORS), "anchors")
    open_spans = found.filter("NOT settled").groupBy("gram", "span").agg(F.sum("copies").alias("n"), F.min("row").alias("row"))
    spans = stored(open_spans, "spans")
    by_gram = spans.groupBy("gram").agg(F.min("span").alias("low"), F.max("span").alias("high"))
    contested = stored(by_gram.filter("low <> high").select("gram", F.lit(True).alias("contested")), "contested-marks")
    flagged = spans.join(contested, "gram", "left").filter("n > 1 OR contested").select(
        "gram", "span", (F.col("n") > 1).alias("repeated"), F.col("row").alias("least"), F.coalesce("contested", F.lit(False)).alias("contested")
    )
    place = ["gram", "did", "h", "at", "first", "last"]
    marked = found.filter("NOT settled").join(stored(flagged, "flagged-spans"), ["gram", "span"]).select(
        *place, "repeated", F.when(F.col("row") == F.col("least"), 1).otherwise(2).alias("copy"), "contested"
    )
    settled = found.filter("settled").select(*place, F.lit(True).alias("repeated"), F.lit(2).alias("copy"), F.lit(False).alias("contested"))
    return stored(marked.unionByName(settled), "anchor-marks")


def _with_text(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows(did, h, …)``, one per document, joined with its text, once for equal rows of ``docs``.

    Texts of other documents are mostly held back before the shuffle by a bitmap of fixed size.
    """
    bits = docs.sparkSession.sparkContext.broadcast(id_filter(rows, "h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        known = np.unpackbits(np.frombuffer(bits.value, np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            batch = batch.filter(pa.array(known[batch.column(3).to_numpy()]))
            yield dict(zip(("did", "h", "text"), batch.columns))

    placed = _rows(docs).withColumn("b", F.pmod(F.xxhash64("h"), F.lit(1 << FILTER_BITS)))
    return map_batches(placed, run, "did bigint, h bigint, text string").join(rows, ["did", "h"])


def _contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``gram, did, h, at, first, open, bytes`` for the chosen copies of contested spans."""
    listed = stored(
        wanted.groupBy("did", "h").agg(F.collect_list(F.struct("gram", "at", "first", "last", "open")).alias("spans")), "contested"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        names = ("gram", "did", "h", "at", "first", "open", "bytes")
        for batch in batches:
            rows = []
            for did, h, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                raw = text.encode()
                rows += [(s["gram"], did, h, s["at"], s["first"], s["open"], raw[s["first"] : s["last"] + LENGTH]) for s in spans]
            if rows:
                yield dict(zip(names, zip(*set(rows))))

    schema = "gram bigint, did bigint, h bigint, at bigint, first bigint, open boolean, bytes binary"
    return map_batches(_with_text(docs, listed), run, schema)


def shared_strings(texts: list[bytes], anchor: list[int], asked: list[bool]) -> list[tuple[int, int, int]]:
    """``(text, first, last)``: strings of ``LENGTH`` bytes that start there and occur in another text
    at the same distance from its anchor. Every text is the span of its anchor."""
    m = len(texts)
    right_order, right_shared = deep_shallow_sort([t[a:] for t, a in zip(texts, anchor)])
    left_order, left_shared = deep_shallow_sort([t[:a][::-1] for t, a in zip(texts, anchor)])
    # String d starts d bytes before the anchor; text i owns the strings from low[i] to anchor[i].
    low = [a - (len(t) - LENGTH) for t, a in zip(texts, anchor)]
    out = []
    if m <= PAIRWISE:
        def table_of(order: list[int], shared: list[int]) -> dict[tuple[int, int], int]:
            known = {}
            for x in range(m):
                least = LENGTH
                for y in range(x + 1, m):
                    least = min(least, shared[y])
                    known[order[x], order[y]] = known[order[y], order[x]] = least
            return known

        right, left = table_of(right_order, right_shared), table_of(left_order, left_shared)
        for i in range(m):
            for j in range(m) if asked[i] else ():
                if i != j:
                    near = max(LENGTH - right[i, j], low[i], low[j])
                    far = min(left[i, j], anchor[i], anchor[j])
                    if near <= far:
                        out.append((i, anchor[i] - far, anchor[i] - near))
        return out
    anchors_, lows, wanted = np.array(anchor), np.array(low), np.array(asked)
    right_order, left_order = np.array(right_order), np.array(left_order)
    right_shared, left_shared = np.array(right_shared), np.array(left_shared)
    right_class, left_class = np.zeros(m, np.int64), np.zeros(m, np.int64)
    for d in range(max(0, int(lows.min())), int(anchors_.max()) + 1):
        owners = np.flatnonzero((lows <= d) & (d <= anchors_))
        if len(owners) < 2:
            continue
        right_class[right_order] = np.cumsum(right_shared < LENGTH - d)
        left_class[left_order] = np.cumsum(left_shared < d)
        _, group, times = np.unique(right_class[owners] * (m + 1) + left_class[owners], return_inverse=True, return_counts=True)
        for i in owners[(times[group] > 1) & wanted[owners]].tolist():
            out.append((i, anchor[i] - d, anchor[i] - d))
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _sorted_groups(group: pa.Table) -> pa.Table:
    rows = sorted(zip(*(group.column(c).to_pylist() for c in ("bytes", "did", "h", "at", "first", "open"))))
    found = shared_strings([r[0] for r in rows], [r[3] - r[4] for r in rows], [r[5] for r in rows])
    by_row: dict[int, list] = {}
    for i, a, b in found:
        by_row.setdefault(i, []).append((rows[i][4] + a, rows[i][4] + b + LENGTH))
    out = [(rows[i][1], rows[i][2], a, b) for i, spans in by_row.items() for a, b in _merged(spans)]
    columns = list(zip(*out)) or [[], [], [], []]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("did", "h", "a", "b"), columns)})


def _counted_strings(contexts: DataFrame) -> DataFrame:
    """Grams with very many spans: every string by its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            rows = []
            for did, h, first, is_open, raw in zip(*(c.to_pylist() for c in batch.columns)):
                for j in range(len(raw) - LENGTH + 1):
                    w = np.frombuffer(xxhash.xxh3_128_digest(raw[j : j + LENGTH]), "<i8")
                    rows.append((int(w[0]), int(w[1]), did, h, first + j, is_open))
            if rows:
                yield dict(zip(("w1", "w2", "did", "h", "a", "open"), zip(*rows)))

    schema = "w1 bigint, w2 bigint, did bigint, h bigint, a bigint, open boolean"
    strings = stored(map_batches(contexts.select("did", "h", "first", "open", "bytes"), run, schema), "hot-strings")
    twice = strings.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return strings.filter("open").join(twice, ["w1", "w2"]).select("did", "h", "a", (F.col("a") + LENGTH).alias("b"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``did, h, spans``: for rows with repeated strings, the covering spans (unmerged, end exclusive)."""
    marks = _marks(docs)
    whole = marks.filter("repeated").select("did", "h", F.col("first").alias("a"), (F.col("last") + LENGTH).alias("b"))
    copies = marks.filter("contested AND copy = 1").withColumn("open", ~F.col("repeated"))
    grams = stored(
        copies.groupBy("gram").agg(F.count(F.lit(1)).alias("spans"), F.bool_or("open").alias("any_open")).filter("any_open"),
        "contested-grams",
    )
    contexts = stored(_contexts(docs, copies.join(grams.select("gram"), "gram")), "contexts")
    few = contexts.join(grams.filter(F.col("spans") <= GROUP).select("gram"), "gram")
    many = contexts.join(grams.filter(F.col("spans") > GROUP).select("gram"), "gram")
    sorted_out = few.groupBy("gram").applyInArrow(_sorted_groups, "did bigint, h bigint, a bigint, b bigint")
    found = whole.unionByName(sorted_out).unionByName(_counted_strings(many))
    return stored(found.groupBy("did", "h").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "repeated-spans")


def cut_repeats(docs: DataFrame) -> DataFrame:
    """Per distinct row with something to remove: ``did, h, n_removed, n_spans, kept`` (bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        names = ("did", "h", "n_removed", "n_spans", "kept")
        for batch in batches:
            rows = []
            for did, h, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                raw, at, kept = text.encode(), 0, []
                merged = _merged([(s["a"], s["b"]) for s in spans])
                for a, b in merged:
                    kept.append(raw[at:a])
                    at = b
                kept.append(raw[at:])
                rows.append((did, h, sum(b - a for a, b in merged), len(merged), b"".join(kept)))
            if rows:
                yield dict(zip(names, zip(*rows)))

    joined = _with_text(docs, repeated_spans(docs)).dropDuplicates(["did", "h"])
    return map_batches(joined, run, "did bigint, h bigint, n_removed bigint, n_spans bigint, kept binary")


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans, kept`` (remaining bytes).

    A NULL text is empty; nothing is removed from texts shorter than ``LENGTH``. Rows that are equal
    in id and text are two places of the same strings, so all of them go; a NULL id is an id like others.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.select(F.col("doc_id"), F.xxhash64(F.col("doc_id").cast("bigint"), text).alias("h"), text.cast("binary").alias("raw"))
    own = own.withColumn("did", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)))
    return own.join(stored(cut_repeats(docs), "cut"), ["did", "h"], "left").select(
        "doc_id", F.octet_length("raw").cast("bigint").alias("n_bytes"), F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce("kept", "raw").alias("kept"),
    )


def op3_repeated_spans(spark, sf_dir: str) -> DataFrame:
    """Removed bytes and spans of every document, and the digest of what is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    cut = cut_repeats(docs).select("did", "h", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"))
    own = docs.select(
        "doc_id", F.coalesce("doc_id", F.lit(0)).alias("did"), F.xxhash64("doc_id", text).alias("h"),
        F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text.cast("binary"), 256).alias("own_sha"),
    )
    return own.join(stored(cut, "cut"), ["did", "h"], "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce("sha", "own_sha").alias("kept_sha256"),
    )
