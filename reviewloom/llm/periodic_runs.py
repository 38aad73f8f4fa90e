"""Periodic runs of words, found by longest common extensions over a difference cover.

Words become numbers. Suffixes are sorted only at positions whose remainder lies in a difference
cover: any two positions reach such samples together after fewer than ``MODULUS`` words. A longest
common extension compares these few words and, if all agree, takes the minimum of the sorted samples'
common prefixes between the two ranks from a sparse table. A second structure over the reversed words
extends to the left.

Runs are enumerated on a harmonic grid: a run of period ``p`` and a length of at least
``max(least, times * p)`` has as many consecutive places ``i`` with equal words at ``i`` and ``i + p``
as that length less ``p``, so one of them is a multiple of this number. The grids of all periods
together have O(n log n) places. The sorted samples are made when the first extension reaches them;
most texts never need them. The work of one text stays in its row: no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import map_batches, table

LEAST, TIMES = 24, 3
# The differences of the cover's remainders give every remainder of the modulus.
MODULUS, COVER = 13, (0, 1, 3, 9)
PAIRS_AT_ONCE = 1 << 20


def steps_to_cover() -> np.ndarray:
    """``[a, b]``: words from positions with remainders ``a`` and ``b`` until both are in the cover."""
    both = {(a, b): t for t in reversed(range(MODULUS)) for a in range(MODULUS) for b in range(MODULUS)
            if (a + t) % MODULUS in COVER and (b + t) % MODULUS in COVER}
    return np.array([[both[a, b] for b in range(MODULUS)] for a in range(MODULUS)], np.int64)


STEPS = steps_to_cover()


class Extensions:
    """Longest common extensions between positions of one sequence of numbers from 0 on."""

    def __init__(self, codes: np.ndarray):
        self.size = len(codes)
        self.codes = np.concatenate([codes, np.full(MODULUS + 1, -1, codes.dtype)])
        self.rank: np.ndarray | None = None
        self.minima: list[np.ndarray] = []

    def _sort_samples(self) -> None:
        """Ranks of the sampled suffixes and the sparse table over neighbours' common prefixes.

        Equal blocks of ``MODULUS`` words get equal ranks; the block behind a sampled one is sampled
        as well, so ranks double until all differ.
        """
        at = np.flatnonzero(np.isin(np.arange(self.size) % MODULUS, COVER))
        place = np.full(self.size + 1, len(at), np.int64)  # behind the last sample: the empty suffix
        place[at] = np.arange(len(at))
        blocks = np.ascontiguousarray((self.codes[np.minimum(at[:, None] + np.arange(MODULUS), self.size)] + 1).astype(">u4"))
        _, rank = np.unique(blocks.view(f"V{4 * MODULUS}").ravel(), return_inverse=True)
        levels = [np.append(rank.astype(np.int64) + 1, 0)]
        width = MODULUS
        while levels[-1].max() < len(at):
            behind = levels[-1][place[np.minimum(at + width, self.size)]]
            _, rank = np.unique(levels[-1][:-1] * (len(at) + 1) + behind, return_inverse=True)
            levels.append(np.append(rank.astype(np.int64) + 1, 0))
            width *= 2
        order = np.argsort(levels[-1][:-1], kind="stable")
        a, b = at[order[:-1]], at[order[1:]]
        common = np.zeros(len(a), np.int64)
        for k in reversed(range(len(levels))):
            i, j = np.minimum(a + common, self.size), np.minimum(b + common, self.size)
            same = (levels[k][place[i]] == levels[k][place[j]]) & (place[i] < len(at)) & (place[j] < len(at))
            common += same * (MODULUS << k)
        # Equal blocks may run over the end; what is left is shorter than a block.
        common = np.minimum(common, self.size - np.maximum(a, b))
        open_ = np.arange(len(a))
        for _ in range(MODULUS):
            i, j = a[open_] + common[open_], b[open_] + common[open_]
            open_ = open_[(np.maximum(i, j) < self.size) & (self.codes[np.minimum(i, self.size)] == self.codes[np.minimum(j, self.size)])]
            common[open_] += 1
        self.rank = np.zeros(self.size + 1, np.int64)
        self.rank[at[order]] = np.arange(len(at))
        self.minima = [common]
        while 2 << (len(self.minima) - 1) <= len(common):
            last, half = self.minima[-1], 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(last[:-half], last[half:]))

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from ``i`` and from ``j`` on, for ``i < j <= size``."""
        found = np.zeros(len(i), np.int64)
        left = STEPS[i % MODULUS, j % MODULUS]
        open_ = np.flatnonzero(j < self.size)
        reached = []
        for t in range(MODULUS):
            there = left[open_] == t
            reached.append(open_[there])
            open_ = open_[~there]
            open_ = open_[self.codes[i[open_] + t] == self.codes[j[open_] + t]]
            found[open_] += 1
            if not len(open_):
                break
        synced = np.concatenate(reached)
        a, b = i[synced] + left[synced], j[synced] + left[synced]
        # Samples that differ at once need no ranks.
        more = (b < self.size) & (self.codes[np.minimum(a, self.size)] == self.codes[np.minimum(b, self.size)])
        synced, a, b = synced[more], a[more], b[more]
        if len(synced):
            if self.rank is None:
                self._sort_samples()
            low, high = np.minimum(self.rank[a], self.rank[b]), np.maximum(self.rank[a], self.rank[b])
            level = np.frexp((high - low).astype(float))[1] - 1
            for k in np.unique(level):
                here = level == k
                row = self.minima[k]
                found[synced[here]] += np.minimum(row[low[here]], row[high[here] - (1 << int(k))])
        return found


def grids(n: int, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``period, place, equal places needed`` of all grids over ``n`` words, a bounded number at once."""
    periods = np.arange(1, n // times + 1, dtype=np.int64)
    need = np.maximum(least, times * periods) - periods
    periods, need = periods[periods + need <= n], need[periods + need <= n]
    counts = (n - periods + need - 1) // need
    ends = np.cumsum(counts)
    at = 0
    while at < len(periods):
        done = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, "right")))
        some = counts[at:to]
        step = np.repeat(need[at:to], some)
        k = np.arange(int(some.sum())) - np.repeat(np.cumsum(some) - some, some)
        yield np.repeat(periods[at:to], some), k * step, step
        at = to


def find_runs(codes: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """``start, length, period`` of every run, by start, then period. ``times`` is at least 2.

    A stretch that has several of the periods looked at is found with each of them, always with the
    same ends, because the smallest divides the others; the smallest is its period.
    """
    n = len(codes)
    ahead = Extensions(codes)
    back: Extensions | None = None
    found = [np.zeros((0, 3), np.int64)]
    for period, place, need in grids(n, least, times):
        equal = codes[place] == codes[place + period]
        period, place, need = period[equal], place[equal], need[equal]
        if not len(place):
            continue
        right = ahead.common(place, place + period)
        back = back or Extensions(codes[::-1].copy())
        reached = back.common(n - place - period, n - place)
        long = right + reached >= need
        runs = np.stack([place - reached, right + reached + period, period], axis=1)[long]
        found.append(np.unique(runs, axis=0))
    every = np.concatenate(found)
    every = every[np.lexsort((every[:, 2], every[:, 1], every[:, 0]))]
    first = np.ones(len(every), bool)
    first[1:] = (every[1:, :2] != every[:-1, :2]).any(axis=1)
    every = every[first]
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space (blank, U+0009 to U+000D), in UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def number(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers from 0 on."""
    ids: dict[bytes, int] = {}
    return np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """True for words that no run contains after its first period."""
    borders = np.zeros(n + 1, np.int64)
    np.add.at(borders, runs[:, 0] + runs[:, 2], 1)
    np.add.at(borders, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(borders[:-1]) == 0


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``doc_id, runs, collapsed`` per row: ``array<struct<start, length, period>>`` of the maximal
    stretches of words with a length of at least ``max(least, times * period)``, by start, then period;
    and the text's words, joined by one blank, with each run cut down to its first period.

    Narrow: no shuffle; repeated rows and ids are passed on, each row by itself, as are NULL ids.
    NULL and empty texts have no words. A very long text takes time with n log n of its words, and
    memory with a few hundred bytes a word at most, as its samples are sorted in one task. An empty
    table gives an empty result; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            every, rest = [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                runs = find_runs(number(words), least, times) if len(words) >= least else np.zeros((0, 3), np.int64)
                if len(runs):
                    words = [words[i] for i in np.flatnonzero(kept_words(len(words), runs)).tolist()]
                every.append([{"start": s, "length": length, "period": p} for s, length, p in runs.tolist()])
                rest.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield {"doc_id": batch.column(0), "runs": every, "collapsed": rest}

    schema = "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, schema)


def repeat_tails(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: with h the CRC-32 of the id in decimal, and g = h // 10, a text whose h is a
    multiple of 10 has its words from a = g % n on replaced by repetitions of the first
    1 + (n - a) // (3 + g % 8) of them; others, and those with NULL ids, stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at, h in enumerate(batch.column(2).to_pylist()):
                if h is not None and h % 10 == 0 and (words := words_of(texts[at])):
                    a = h // 10 % len(words)
                    cycle = words[a : a + 1 + (len(words) - a) // (3 + h // 10 % 8)]
                    again = -(-(len(words) - a) // len(cycle))
                    texts[at] = b" ".join(words[:a] + (cycle * again)[: len(words) - a]).decode("utf-8", "surrogatepass")
            yield {"doc_id": batch.column(0), "text": texts}

    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    return map_batches(keyed, run, "doc_id bigint, text string")


def op11_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of all documents, the one with the greatest exponent, and digests of runs and kept words."""
    found = periodic_runs(repeat_tails(table(spark, sf_dir, "documents")))
    none = "CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>)"
    best = F.expr(f"aggregate(runs, {none}, (b, r) -> CASE WHEN b IS NULL OR r.length * b.period > b.length * r.period THEN r ELSE b END)")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
