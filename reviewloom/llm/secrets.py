"""Secrets in texts: keyword prefilter, anchored patterns near hits, embedded checksums.

An Aho-Corasick automaton finds the keywords of all kinds in one pass. Only where a keyword was
found is the kind's pattern tried, anchored there. Kinds with an embedded checksum are kept only if
it holds. Long hexadecimal runs have no keyword: for them the run itself is the hit.

Kinds, in this order: ``assign``, ``access``, ``hex`` (the base), and ``github`` and ``npm``, whose
last six characters are the CRC-32 of the thirty before them, in base 62.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import map_batches, table

# Fixed values.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE = ("assign", "access", "hex")
KEYWORDS = {
    "assign": ["password", "passwd", "secret", "token", "apikey", "api_key"],
    "access": ["akia"],
    "github": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"],
    "npm": ["npm_"],
}
PATTERNS = {
    "assign": rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": rb"AKIA[A-Z0-9]+",
    "github": rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])",
    "npm": rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])",
}
HEX_RUN = rb"[0-9a-f]{24,}"
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum_holds(token: bytes) -> bool:
    """``prefix_`` + 30 characters + their CRC-32 as six base-62 digits."""
    payload = token[token.index(b"_") + 1 :]
    value = 0
    for byte in payload[30:]:
        value = value * 62 + BASE62.index(byte)
    return zlib.crc32(payload[:30]) == value


#: What a match of a kind must fulfil; one that fails is dropped, and its characters stay used.
ACCEPT = {
    "assign": lambda m: len(m.group(1)) >= 6,
    "access": lambda m: len(m.group()) >= 20,
    "github": lambda m: checksum_holds(m.group()),
    "npm": lambda m: checksum_holds(m.group()),
}


class SecretScanner:
    def __init__(self):
        self.automaton = ahocorasick.Automaton()
        for kind, words in KEYWORDS.items():
            for word in words:
                self.automaton.add_word(word, (kind, len(word)))
        self.automaton.make_automaton()
        self.patterns = {kind: re.compile(p) for kind, p in PATTERNS.items()}
        self.hex_run = re.compile(HEX_RUN)

    @staticmethod
    @cache
    def shared() -> SecretScanner:
        return SecretScanner()

    def scan(self, text: str) -> list[tuple[int, int, int]]:
        """``(start, kind's place in KINDS, end)`` in code points, in order."""
        raw = text.encode("utf-8", "surrogatepass")
        found = [(m.start(), 2, m.end()) for m in self.hex_run.finditer(raw)]
        used = dict.fromkeys(KEYWORDS, 0)
        for end, (kind, size) in self.automaton.iter(raw.lower().decode("latin-1")):  # bytes.lower: A-Z alone
            start = end + 1 - size
            if start >= used[kind] and (m := self.patterns[kind].match(raw, start)):
                used[kind] = m.end()
                if ACCEPT[kind](m):
                    found.append((start, KINDS.index(kind), m.end()))
        if found and len(raw) != len(text):
            points, at, n = {}, 0, 0
            for place in sorted({p for a, _, b in found for p in (a, b)}):  # each stretch is decoded once
                n += len(raw[at:place].decode("utf-8", "surrogatepass"))
                points[place], at = n, place
            found = [(points[a], k, points[b]) for a, k, b in found]
        return sorted(found)


def find_secrets(docs: DataFrame) -> DataFrame:
    """``doc_id, secrets``: per row the spans found, ``array<struct<kind, start, end>>``, ends exclusive.

    Narrow: no shuffle. A NULL text is empty and has none. NULL and repeated ids are passed on, each
    row by itself. Matches of one kind never overlap; spans of different kinds may. The time for a very
    long text grows with its length alone. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        scanner = SecretScanner.shared()
        for batch in batches:
            spans = [
                [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scanner.scan(t)] if t else []
                for t in batch.column(1).to_pylist()
            ]
            yield {"doc_id": batch.column(0), "secrets": spans}

    schema = "doc_id bigint, secrets array<struct<kind: string, start: bigint, end: bigint>>"
    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, schema)


def op4_secrets(spark, sf_dir: str) -> DataFrame:
    """Spans of all documents: counts of the base kinds, digest of the base spans, all spans."""
    found = find_secrets(table(spark, sf_dir, "documents"))

    def joined(spans: F.Column) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def of(*kinds: str) -> F.Column:
        return F.filter("secrets", lambda s: s.kind.isin(*kinds))

    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in BASE],
        F.sha2(joined(of(*BASE)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )
