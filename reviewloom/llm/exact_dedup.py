"""Exact deduplication: Patricia tries own the texts of a length-and-hash partition.

Every map task first inserts its texts into a trie of its own, so a text that makes up a third of
all rows leaves each task once. The surviving byte strings are dealt out by length and content hash
and inserted, whole, into one trie per partition; its terminal nodes hold the owner's id and the
number of rows. A trie that outgrows its budget spills its largest subtree to task-local disk and
finishes it later on its own.
"""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import map_batches, table

BUDGET_BYTES = 96 << 20
NODE_BYTES = 250

_CLASS = "_bytes bigint, _sha binary, _text binary, _owner bigint, _n bigint"
_OWNER = "_bytes bigint, _sha binary, _owner bigint, _n bigint"


class _Node:
    __slots__ = ("children", "edge", "sha", "owner", "n")

    def __init__(self, edge: bytes):
        self.edge = edge
        self.children: dict[int, _Node] = {}
        self.sha: bytes | None = None
        self.owner: int | None = None
        self.n = 0


class PatriciaTrie:
    """Compressed radix trie over byte strings; equal strings end in one terminal node.

    ``largest``: the largest id owns a text, else the smallest. NULL ids own a text only if all its
    ids are NULL.
    """

    def __init__(self, largest: bool, budget: int = BUDGET_BYTES, skip: int = 0):
        self.largest, self.budget, self.skip = largest, budget, skip
        self.root = _Node(b"")
        self.held = 0
        self.spilled: dict[int, tempfile._TemporaryFileWrapper] = {}

    def insert(self, key: bytes, sha: bytes, owner: int | None, n: int) -> None:
        if len(key) > self.skip and key[self.skip] in self.spilled:
            pickle.dump((key, sha, owner, n), self.spilled[key[self.skip]])
            return
        node, at = self.root, self.skip
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = node.children[key[at]] = _Node(key[at:])
                self.held += len(child.edge) + NODE_BYTES
            elif not key.startswith(child.edge, at):
                same = len(os.path.commonprefix([child.edge, key[at : at + len(child.edge)]]))
                upper = _Node(child.edge[:same])
                node.children[key[at]] = upper
                child.edge = child.edge[same:]
                upper.children[child.edge[0]] = child
                self.held += NODE_BYTES
                child = upper
            node, at = child, at + len(child.edge)
        if node.n and node.sha != sha:
            raise ValueError("equal texts with different digests")
        better = max if self.largest else min
        ids = [x for x in (node.owner, owner) if x is not None]
        node.sha, node.owner, node.n = sha, better(ids, default=None), node.n + n

    def full(self) -> bool:
        return self.held > self.budget

    @staticmethod
    def _walk(node: _Node, path: bytes) -> Iterator[tuple[bytes, bytes, int | None, int]]:
        stack = [(node, path)]
        while stack:
            node, path = stack.pop()
            if node.n:
                yield path, node.sha, node.owner, node.n
            stack.extend((child, path + child.edge) for child in node.children.values())

    def spill(self, prefix: bytes) -> None:
        """Move the subtree that holds most to disk. ``prefix``: the bytes that all keys here share."""
        if not self.root.children:
            return
        sizes = {b: sum(len(k) for k, *_ in self._walk(c, c.edge)) for b, c in self.root.children.items()}
        byte = max(sizes, key=sizes.get)
        child = self.root.children.pop(byte)
        out = self.spilled[byte] = tempfile.TemporaryFile()
        for record in self._walk(child, prefix + child.edge):
            pickle.dump(record, out)
        held = [self.root]
        self.held = 0
        while held:
            node = held.pop()
            self.held += len(node.edge) + NODE_BYTES
            held.extend(node.children.values())

    def records(self, prefix: bytes = b"") -> Iterator[tuple[bytes, bytes, int | None, int]]:
        """All texts with digest, owner and count; spilled subtrees follow, one at a time."""
        yield from self._walk(self.root, prefix)
        self.root = _Node(b"")
        for file in self.spilled.values():
            file.seek(0)
            first = pickle.load(file)
            shared = first[0]
            file.seek(0)
            for key, *_ in _load(file):  # the subtree's common prefix, so that the next level splits
                shared = os.path.commonprefix([shared, key])
            below = PatriciaTrie(self.largest, self.budget, len(shared))
            file.seek(0)
            for record in _load(file):
                below.insert(*record)
                if below.full():
                    below.spill(shared)
            yield from below.records(shared)
            file.close()


def _load(file) -> Iterator[tuple[bytes, bytes, int | None, int]]:
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def _batched(records: Iterator[tuple], names: list[str], limit: int = 16 << 20) -> Iterator[dict[str, list]]:
    rows, size = [], 0
    for record in records:
        rows.append(record)
        size += sum(len(x) for x in record if isinstance(x, bytes)) + 64
        if size >= limit:
            yield dict(zip(names, zip(*rows)))
            rows, size = [], 0
    if rows:
        yield dict(zip(names, zip(*rows)))


def _combine(largest: bool, budget: int):
    """Map side: one row per distinct text of the task; the trie is emptied when it is full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        def records():
            trie = PatriciaTrie(largest, budget)
            for batch in batches:
                for doc_id, text, sha in zip(*(c.to_pylist() for c in batch.columns)):
                    trie.insert(text, sha, doc_id, 1)
                    if trie.full():
                        yield from trie.records()
                        trie = PatriciaTrie(largest, budget)
            yield from trie.records()

        rows = ((len(key), sha, key, owner, n) for key, sha, owner, n in records())
        yield from _batched(rows, ["_bytes", "_sha", "_text", "_owner", "_n"])

    return run


def _owners(largest: bool, budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        trie = PatriciaTrie(largest, budget)
        for batch in batches:
            for _, sha, text, owner, n in zip(*(c.to_pylist() for c in batch.columns)):
                trie.insert(text, sha, owner, n)
                if trie.full():
                    trie.spill(b"")
        rows = ((len(key), sha, owner, n) for key, sha, owner, n in trie.records())
        yield from _batched(rows, ["_bytes", "_sha", "_owner", "_n"])

    return run


def text_owners(docs: DataFrame, largest: bool = False, budget: int = BUDGET_BYTES) -> DataFrame:
    """One row per distinct text: ``_bytes, _sha, _owner, _n`` (length, SHA-256, owner's id, rows)."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", text.alias("text")).select("doc_id", "text", F.unhex(F.sha2("text", 256)).alias("_sha"))
    classes = map_batches(rows, _combine(largest, budget), _CLASS)
    return map_batches(classes.repartition("_bytes", "_sha"), _owners(largest, budget), _OWNER)


def with_owner(docs: DataFrame, largest: bool = False) -> DataFrame:
    """``docs`` with ``_bytes, _sha, _owner, _n``: what owns the row's text.

    NULL and empty texts are equal. Repeated rows (same id, same text) all have the same owner, so
    all of them count as its own. An empty table gives no rows. Other columns are kept as they are;
    names that begin with an underscore as above are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keyed = docs.drop("_bytes", "_sha", "_owner", "_n").withColumns(
        {"_bytes": F.octet_length(text).cast("bigint"), "_sha": F.unhex(F.sha2(text, 256))}
    )
    return keyed.join(text_owners(docs, largest), ["_bytes", "_sha"], "left")


def drop_copies(docs: DataFrame, largest: bool = False) -> DataFrame:
    """``docs`` without copies: of equal texts the owner's row stays, once.

    Rows are dealt by id and text together, so a text that many documents hold is spread over all
    tasks; rows that are equal in both are combined before the shuffle.
    """
    size, digest = ("_" * sum(c.startswith("_") for c in docs.columns) + n for n in ("_bytes", "_sha"))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keyed = docs.withColumns({size: F.octet_length(text).cast("bigint"), digest: F.unhex(F.sha2(text, 256))})
    once = keyed.dropDuplicates(["doc_id", size, digest])
    owners = text_owners(docs, largest).select("_owner", "_bytes", "_sha")
    same = once["doc_id"].eqNullSafe(owners["_owner"]) & (once[size] == owners["_bytes"]) & (once[digest] == owners["_sha"])
    return once.join(owners, same, "left_semi").select(*docs.columns)


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Per document: the row that stays (largest id of equal texts), group size, kept, digest."""
    owned = with_owner(table(spark, sf_dir, "documents").select("doc_id", "text"), largest=True)
    return owned.select(
        "doc_id",
        F.col("_owner").alias("keep_id"),
        F.col("_n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("_owner")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )


OP9_SQL = """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents
    WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
