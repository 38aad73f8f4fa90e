"""Byte-level BPE, encoded by backtracking and decoded through an offset table.

Encoding: an Aho-Corasick automaton over the vocabulary gives the longest token at every position of
a piece. The encoder takes the longest token whose pair with its left neighbour is compatible, goes
to the token's next shorter prefix if it is not, and one token back if none is left; positions that
led nowhere are marked, so every position is left at most once and the time is linear. A pair is
compatible if the merges, run on its bytes, would leave the border between them; the answers are
kept in a table. The result equals applying the merges by rank.

Decoding: all tokens' bytes lie in one array; ids are turned into byte ranges by an offset table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import map_batches, table
from reviewloom.llm.pieces import Remembered, chunks, cut, cuts_like_bytes, must_stay_whole

PAIRS_KEPT = 200_000
#: Smaller than a worker could hold: workers live on, and other stages of a pipeline need the memory.
GENERATION_BYTES = 48 << 20
#: Unicode white space, spelled out because libraries differ on the separators x1c to x1f.
_WHITE = r"\t-\r \x85\xa0  -     　"
#: Fixed value: how the vocabulary's texts are cut before merging.
PIECE_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WHITE}\p{{L}}\p{{N}}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 itself, the rest from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class BytePairs:
    """Vocabulary, merges and the structures made from them, for one tokenizer file, which must be plain
    byte-level BPE: another raises an error."""

    def __init__(self, path: str):
        if not cuts_like_bytes(path):
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.ids = vocab
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.length = [0] * size
        self.rank = [-1] * size  # -1: a single byte, there from the start
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            self.length[i] = len(token)
            self.automaton.add_word(token, i)
        self.automaton.make_automaton()
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, whole = vocab[left], vocab[right], vocab[left + right]
            self.merged[a, b] = (rank, whole)
            if self.parts[whole] is None:
                self.parts[whole], self.rank[whole] = (a, b), rank
        self.shorter = [-1] * size  # the longest token that is a proper prefix
        for token, i in vocab.items():
            for end in range(len(token) - 1, 0, -1):
                if (prefix := vocab.get(token[:end])) is not None:
                    self.shorter[i] = prefix
                    break
        letters = byte_letters()
        self.to_letters = {b: letter for b, letter in enumerate(letters)}
        byte_of = {letter: b for b, letter in enumerate(letters)}
        raw = [b""] * size
        for token, i in vocab.items():
            raw[i] = bytes(map(byte_of.__getitem__, token))
        for token, i in self.special.items():
            raw[i] = token.encode()
        self.blob = np.frombuffer(b"".join(raw), np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
        self.pattern = regex.compile(PIECE_PATTERN)
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.stays_whole = must_stay_whole(list(self.special))
        self.size = size
        self.table: dict[int, bool] = {}
        self.type = "<u2" if size <= 1 << 16 else "<u4"
        self.decimal = list(map(str, range(size)))
        self.pieces = Remembered(self._pieces, GENERATION_BYTES)

    @staticmethod
    @cache
    def shared(path: str) -> BytePairs:
        """One instance per worker process."""
        return BytePairs(path)

    def compatible(self, left: int, right: int) -> bool:
        pair = left * self.size + right
        known = self.table.get(pair)
        if known is None:
            if len(self.table) >= PAIRS_KEPT:
                self.table.clear()
            known = self.table[pair] = self._border_stays(left, right)
        return known

    def _border_stays(self, left: int, right: int) -> bool:
        """Undo the merges of both sides, latest first, and look whether one across the border came sooner.

        Equal merges run from left to right: one across the border comes behind the same merge on
        its left and before the same merge on its right.
        """
        until = float("inf")
        while True:
            across = self.merged.get((left, right))
            if across is not None and across[0] < until:
                return False
            if self.rank[left] < 0 and self.rank[right] < 0:
                return True
            if self.rank[left] > self.rank[right]:
                until = self.rank[left]
                left = self.parts[left][1]
            else:
                until = self.rank[right] + 0.5
                right = self.parts[right][0]

    def encode_word(self, word: str) -> list[int]:
        """Ids of one piece, given in byte letters."""
        if (whole := self.ids.get(word)) is not None:
            return [whole]
        size = len(word)
        longest = [0] * size
        length, shorter, compatible = self.length, self.shorter, self.compatible
        for end, token in self.automaton.iter(word):
            longest[end + 1 - length[token]] = token  # ends come in order: the last one is the longest
        out: list[int] = []
        dead: set[int] = set()
        at, token = 0, longest[0]
        while True:
            end = at + length[token]
            if end not in dead and (not out or compatible(out[-1], token)):
                out.append(token)
                at = end
                if at == size:
                    return out
                token = longest[at]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead.add(at)
                token = out.pop()
                at -= length[token]

    def _words(self, text: str) -> list[str]:
        return [w.encode().decode("latin-1").translate(self.to_letters) for w in self.pattern.findall(text)]

    def _encode(self, text: str) -> bytes:
        """Ids of a text, cut into words as the library does."""
        return np.array([i for word in self._words(text) for i in self.encode_word(word)], self.type).tobytes()

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        return list(map(self._encode, pieces))

    def _whole(self, text: str) -> bytes:
        """Ids of a text that is not cut at blanks; special tokens' strings become their ids."""
        parts = self.cut_special.split(text) if self.cut_special else [text]
        special = {s: np.array([i], self.type).tobytes() for s, i in self.special.items()}
        return b"".join([special[p] if p in special else self._encode(p) for p in parts])

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text."""
        for some in chunks(texts):
            parts = [None if self.stays_whole(t) else cut(t) for t in some]
            known = self.pieces.cover([p for p in parts if p])
            for text, pieces in zip(some, parts):
                raw = self._whole(text) if pieces is None else b"".join(map(known.__getitem__, pieces))
                yield np.frombuffer(raw, self.type)

    def in_decimal(self, ids: np.ndarray) -> str:
        return ",".join(map(self.decimal.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of the ids in UTF-8; bytes that are no UTF-8 become replacement characters."""
        ids = ids.astype(np.int64)
        starts, ends = self.offsets[ids], self.offsets[ids + 1]
        sizes = ends - starts
        before = np.cumsum(sizes) - sizes
        at = np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))
        raw = self.blob[at].tobytes()
        try:
            raw.decode()
        except UnicodeDecodeError:
            return raw.decode("utf-8", "replace").encode()
        return raw


def encode_documents(docs: DataFrame, tokenizer: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row, and ``ids`` if asked for.

    Narrow: no shuffle, some rows at a time. A NULL text is empty and has no ids. NULL and
    repeated ids are passed on, each row by itself; other columns are not read. A very long text takes
    a few times its own size in its task; an empty table gives an empty result. The tokenizer file
    must be there on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        bpe = BytePairs.shared(tokenizer)
        for batch in batches:
            n, digests, decoded, all_ids = [], [], [], []
            for ids in bpe.encode([t or "" for t in batch.column(1).to_pylist()]):
                n.append(len(ids))
                digests.append(hashlib.sha256(bpe.in_decimal(ids).encode()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                if with_ids:
                    all_ids.append(ids)
            columns = {"doc_id": batch.column(0), "n_tokens": n, "ids_sha256": digests, "decoded_sha256": decoded}
            if with_ids:
                ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                columns["ids"] = pa.ListArray.from_arrays(ends, np.concatenate([np.zeros(0, np.int32), *all_ids]).astype(np.int32))
            yield columns

    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, schema, remembers=True)


def op10_bpe(spark, sf_dir: str) -> DataFrame:
    """Encode and decode all documents."""
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
