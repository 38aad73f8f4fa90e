"""Token-id files with Elias-Fano document boundaries.

Documents are laid out by ascending id; every task writes one file: the concatenated ids, the
document ids, and the ends of the documents as an Elias-Fano sequence (low bits packed, high bits in
unary, one select sample in ``SELECT_EVERY``). Offsets come from select on that sequence: about
2 + log2(ids per document) bits a document and no table of 64-bit offsets. Only files listed in the
manifest, a table in the shared folder, count, so repeated attempts do no harm.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import attempt_name, folder, map_batches, stored, table
from reviewloom.llm.pieces import LibraryEncoder
from reviewloom.session import scratch_path, shuffle_width

MAGIC = b"TOKEF001"
SELECT_EVERY = 256
FLUSH_BYTES = 8 << 20
#: magic, bytes an id, documents, ids, low bits, bytes of: doc ids, low, high, samples.
_TRAILER = "<8sIQQIQQQQ"

_MANIFEST = "shard int, path string, n_docs bigint, n_ids bigint"


class EliasFano:
    """A non-decreasing sequence of n values up to ``top``."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, values: np.ndarray, top: int) -> EliasFano:
        n = len(values)
        low_bits = max(0, (max(1, top) // max(1, n)).bit_length() - 1)
        values = values.astype(np.uint64)
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        unary[ones] = 1
        return cls(n, low_bits, low, np.packbits(unary, bitorder="little"), ones[::SELECT_EVERY].astype(np.uint32))

    def select(self, first: int, last: int) -> np.ndarray:
        """Values ``first`` to ``last`` (exclusive): from the nearest sample on, only the bits between."""
        start = int(self.samples[first // SELECT_EVERY])
        after = (last - 1) // SELECT_EVERY + 1
        stop = int(self.samples[after]) if after < len(self.samples) else len(self.high) * 8
        bits = np.unpackbits(self.high[start // 8 : stop // 8 + 1], bitorder="little")
        ones = np.flatnonzero(bits) + start // 8 * 8
        ones = ones[ones >= start]
        skip = first - first // SELECT_EVERY * SELECT_EVERY
        high = ones[skip : skip + last - first] - np.arange(first, last)
        if not self.low_bits:
            return high
        at = np.arange(first, last)[:, None] * self.low_bits + np.arange(self.low_bits)
        low_bits = (self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1
        return (high << self.low_bits) | (low_bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)


class TokenFile:
    """Reads a file: offsets through select, ids by byte range."""

    def __init__(self, system, path: str):
        self.file = system.open_input_file(path)
        size = self.file.size()
        trailer = self.file.read_at(struct.calcsize(_TRAILER), size - struct.calcsize(_TRAILER))
        magic, self.width, self.n_docs, self.n_ids, low_bits, *lengths = struct.unpack(_TRAILER, trailer)
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token file")
        at = self.n_ids * self.width
        parts = []
        for length in lengths:
            parts.append(self.file.read_at(length, at))
            at += length
        ids, low, high, samples = parts
        self.doc_ids = np.frombuffer(ids, "<i8")
        self.ends = EliasFano(
            self.n_docs, low_bits, np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8), np.frombuffer(samples, "<u4")
        )

    def bounds(self, first: int, last: int) -> np.ndarray:
        """Start of document ``first`` and the ends of ``first`` to ``last`` (exclusive)."""
        if first:
            return self.ends.select(first - 1, last)
        return np.concatenate([[0], self.ends.select(0, last)])

    def ids(self, start: int, end: int) -> np.ndarray:
        raw = self.file.read_at((end - start) * self.width, start * self.width)
        return np.frombuffer(raw, f"<u{self.width}")


#: Stands for a NULL document id in a file.
NULL_ID = -(1 << 63)


def _write(path: str, tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        from pyspark import TaskContext

        encoder = LibraryEncoder.shared(tokenizer, 4 if end_id >= 1 << 16 else None)
        width = encoder.width
        end = np.array([end_id], f"<u{width}").tobytes()
        system, base = folder(path)
        name = f"{attempt_name('tokens')}.bin"
        doc_ids: list[np.ndarray] = []
        lengths: list[int] = []
        with system.open_output_stream(f"{base}/{name}", compression=None) as out:
            for batch in batches:
                doc_ids.append(batch.column(0).fill_null(NULL_ID).to_numpy())
                buffer: list[bytes] = []
                held = 0
                for ids in encoder.encode(batch.column(1).to_pylist()):
                    buffer += (ids, end)
                    lengths.append(len(ids) // width + 1)
                    held += len(ids) + width
                    if held > FLUSH_BYTES:
                        out.write(b"".join(buffer))
                        buffer, held = [], 0
                out.write(b"".join(buffer))
            ends = np.cumsum(np.array(lengths, np.int64))
            n_ids = int(ends[-1]) if lengths else 0
            fano = EliasFano.encode(ends, n_ids)
            ids = np.concatenate(doc_ids) if doc_ids else np.zeros(0, np.int64)
            parts = [ids.astype("<i8").tobytes(), fano.low.tobytes(), fano.high.tobytes(), fano.samples.astype("<u4").tobytes()]
            out.write(b"".join(parts))
            out.write(struct.pack(_TRAILER, MAGIC, width, len(lengths), n_ids, fano.low_bits, *map(len, parts)))
        if lengths:
            yield {"shard": [TaskContext.get().partitionId()], "path": [name], "n_docs": [len(lengths)], "n_ids": [n_ids]}

    return run


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 0, path: str | None = None, files: int | None = None) -> tuple[str, DataFrame]:
    """Encode and write all documents by ascending ``doc_id``; returns (folder, manifest).

    ``tokenizer``: path of a ``tokenizers`` file. NULL texts have the end id alone. NULL ids come
    first and are read back as NULL; rows with equal ids are ordered by text digest. An empty table
    gives an empty manifest. Texts are encoded whole, after the shuffle, one batch at a time.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("_tie"))
    laid = rows.repartitionByRange(files or shuffle_width(spark), "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie")
    return path, stored(map_batches(laid.select("doc_id", "text"), _write(path, tokenizer, end_id), _MANIFEST, remembers=True), "token-manifest")


def read_token_files(path: str, manifest: DataFrame, docs_at_once: int = 1024) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    The manifest has one row per file; their sizes, added up in order, give each file's first position.
    """
    spark = manifest.sparkSession
    files, start = [], 0
    for _, name, n_docs, n_ids in sorted(tuple(r) for r in manifest.collect()):
        files.append((name, start, n_docs))
        start += n_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        system, base = folder(path)
        for batch in batches:
            for name, before, n_docs in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = TokenFile(system, f"{base}/{name}")
                for first in range(0, n_docs, docs_at_once):
                    last = min(first + docs_at_once, n_docs)
                    bounds = tokens.bounds(first, last)
                    crcs = [zlib.crc32(tokens.ids(a, b).astype("<u4").tobytes()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                    names = tokens.doc_ids[first:last]
                    yield {
                        "doc_id": pa.array(names, pa.int64(), mask=names == NULL_ID),
                        "start": bounds[:-1] + before,
                        "n_tokens": np.diff(bounds),
                        "ids_crc32": crcs,
                    }

    listed = spark.createDataFrame(files, "name string, before bigint, n_docs bigint")
    return map_batches(
        listed.repartition(max(1, len(files))), run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )


def op6_token_files(spark, sf_dir: str) -> DataFrame:
    """Write all documents as token files, id 0 behind each, and read them back."""
    docs = table(spark, sf_dir, "documents")
    return read_token_files(*write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json")))
