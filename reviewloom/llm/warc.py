"""WARC archives with a two-level capture index.

Pages are laid out by reversed-host URL key. Every task writes one gzip-per-record WARC file, and
beside it the index of that file: capture lines, sorted by key, in compressed blocks, and a sparse
directory with the first key of every block. A lookup binary-searches the shards' first keys, then a
shard's directory, inflates one block, searches it, and reads the byte range of the record.

Files carry the task attempt in their name; only those listed in the manifest, which is a table in
the shared folder, belong to the archive, so repeated attempts do no harm.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import attempt_name, folder, map_batches, stored, table
from reviewloom.session import scratch_path, shuffle_width

MIN_REVISIT_BYTES = 100
LINES_PER_BLOCK = 256
# Fixed values of the format.
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

_MANIFEST = "shard int, first_key string, last_key string, warc string, blocks string, directory string, n_records bigint"
_CAPTURE = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"


def url_key(url: str) -> F.Column:
    """Reversed-host key of a URL column: ``https://a.B.org:80/x y`` gives ``org,b,a):80/x%20y``; NULL gives ``)``."""
    rest = F.regexp_replace(F.coalesce(F.col(url), F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^[^/?#:]*", 0))
    tail = F.regexp_replace(rest, "^[^/?#:]*", "")
    reversed_host = F.array_join(F.reverse(F.split(host, r"\.")), ",")
    return F.regexp_replace(F.concat(reversed_host, F.lit(")"), tail), r"[\s\x00-\x20]", "%20")


def with_key(pages: DataFrame) -> DataFrame:
    """Add ``_key``: URL key, blank, page id as 16 hex digits in numeric order (``-`` for NULL)."""
    ordered = F.lpad(F.hex(F.col("page_id").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return pages.withColumn("_key", F.concat(url_key("url"), F.lit(" "), F.coalesce(ordered, F.lit("-"))))


def with_record_type(pages: DataFrame) -> DataFrame:
    """Add ``_bytes, _digest, _refers_to`` (NULL: the page is the response of its payload).

    Of equal payloads of at least ``MIN_REVISIT_BYTES`` bytes the smallest page id is the response.
    Pages without an id are responses. Digests are counted before the join, so a payload that a
    third of the pages share is combined on the map side. The shared digests are stored first: Spark
    knows their size then, and broadcasts them below ``spark.sql.autoBroadcastJoinThreshold``, so that
    the payloads are not shuffled for it; otherwise adaptive skew joins split a hot digest.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.withColumns({"_bytes": F.octet_length(payload).cast("bigint"), "_digest": F.sha2(payload, 256)})
    shared = stored(
        keyed.filter(F.col("_bytes") >= MIN_REVISIT_BYTES)
        .groupBy("_bytes", "_digest")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .drop("_n"),
        "shared-payloads",
    )
    return keyed.join(shared, ["_bytes", "_digest"], "left").withColumn(
        "_refers_to", F.when(F.col("page_id") != F.col("_first"), F.col("_first"))
    ).drop("_first")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record, its own gzip member. A revisit holds the HTTP head alone."""
    name = "null" if page_id is None else page_id
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    block = HTTP_HEAD % len(payload) + (payload if refers_to is None else b"")
    lines.append(f"Content-Length: {len(block)}")
    body = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(body) + packer.flush()


def parse_record(member: bytes) -> dict:
    """Headers and payload of a record; the digest of a response is computed from its payload."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(headers["Content-Length"])]
    kind = headers["WARC-Type"]
    name = headers["WARC-Record-ID"][len("<urn:page:") : -1]
    digest, length = headers["WARC-Payload-Digest"].removeprefix("sha256:"), int(headers["WARC-Payload-Length"])
    payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != length or hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"record {name}: the payload does not fit its digest")
    refers = headers.get("WARC-Refers-To")
    return {
        "page_id": None if name == "null" else int(name),
        "url": headers.get("WARC-Target-URI"),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": refers and int(refers[len("<urn:page:") : -1]),
        "payload": payload,
    }


def _write(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        from pyspark import TaskContext

        system, base = folder(path)
        name = attempt_name("capture")
        first = last = None
        at = n = block_at = 0
        lines: list[str] = []
        entries: list[str] = []
        warc, blocks = f"{base}/{name}.warc.gz", f"{base}/{name}.idx"
        with system.open_output_stream(warc, compression=None) as out, system.open_output_stream(blocks, compression=None) as index:

            def close_block():
                nonlocal block_at, lines
                packed = zlib.compress("\n".join(lines).encode(), 4)
                entries.append(f"{lines[0].rsplit(' ', 2)[0]} {block_at} {len(packed)}")
                index.write(packed)
                block_at, lines = block_at + len(packed), []

            for batch in batches:
                for key, page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    member = record(page_id, url, (html or "").encode(), digest, refers_to)
                    out.write(member)
                    lines.append(f"{key} {at} {len(member)}")
                    at, n = at + len(member), n + 1
                    first, last = key if first is None else first, key
                    if len(lines) == LINES_PER_BLOCK:
                        close_block()
            if lines:
                close_block()
        if n:
            with system.open_output_stream(f"{base}/{name}.dir", compression=None) as out:
                out.write("\n".join(entries).encode())
            yield {
                "shard": [TaskContext.get().partitionId()], "first_key": [first], "last_key": [last],
                "warc": [f"{name}.warc.gz"], "blocks": [f"{name}.idx"], "directory": [f"{name}.dir"], "n_records": [n],
            }

    return run


@dataclass
class Archive:
    path: str
    manifest: DataFrame

    def shards(self) -> list[tuple]:
        """One row per file of the archive, in key order."""
        return sorted(tuple(r) for r in self.manifest.collect())


def write_archive(pages: DataFrame, path: str | None = None, shards: int | None = None) -> Archive:
    """Write all pages. Rows are laid out by URL key and page id, so one hot host or URL spreads over many files.

    NULL url: key ``)``, no target URI. NULL html: an empty payload. NULL page id: record ``null``.
    Repeated rows become repeated records. An empty table makes an empty archive.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    rows = with_record_type(with_key(pages.select("page_id", "url", "html")))
    laid = rows.repartitionByRange(shards or shuffle_width(spark), "_key").sortWithinPartitions("_key")
    laid = laid.select("_key", "page_id", "url", "html", "_digest", "_refers_to")
    return Archive(path, stored(map_batches(laid, _write(path), _MANIFEST), "warc-manifest"))


class CaptureIndex:
    """Two-level lookup in the files of an archive."""

    def __init__(self, path: str, shards: list[tuple]):
        self.system, self.base = folder(path)
        self.shards = shards
        self.last_keys = [s[2] for s in shards]
        self.open_shard: int | None = None
        self.block_at: int | None = None

    def _enter(self, shard: int) -> None:
        if self.open_shard == shard:
            return
        _, _, _, warc, blocks, directory, _ = self.shards[shard]
        with self.system.open_input_stream(f"{self.base}/{directory}", compression=None) as file:
            entries = [line.rsplit(" ", 2) for line in file.read().decode().split("\n")]
        self.first_keys = [e[0] for e in entries]
        self.ranges = [(int(e[1]), int(e[2])) for e in entries]
        self.warc = self.system.open_input_file(f"{self.base}/{warc}")
        self.blocks = self.system.open_input_file(f"{self.base}/{blocks}")
        self.open_shard, self.block_at = shard, None

    def _lines(self, block: int) -> list[str]:
        if self.block_at != block:
            at, size = self.ranges[block]
            self.lines = zlib.decompress(self.blocks.read_at(size, at)).decode().split("\n")
            self.keys = [line.rsplit(" ", 2)[0] for line in self.lines]
            self.block_at = block
        return self.lines

    def find(self, low: str, high: str | None = None) -> Iterator[dict]:
        """Records of the captures with keys from ``low`` to ``high`` (left out: equal to ``low``)."""
        high = low if high is None else high
        shard = bisect_left(self.last_keys, low)  # the first one that ends at or behind low
        while shard < len(self.shards) and self.shards[shard][1] <= high:
            self._enter(shard)
            block = max(0, bisect_left(self.first_keys, low) - 1)
            while block < len(self.ranges) and self.first_keys[block] <= high:
                lines = self._lines(block)
                for line in lines[bisect_left(self.keys, low) : bisect_right(self.keys, high)]:
                    _, at, size = line.rsplit(" ", 2)
                    yield parse_record(self.warc.read_at(int(size), int(at)))
                block += 1
            shard += 1

    def find_url(self, key: str) -> Iterator[dict]:
        """All captures of a URL key, in page-id order."""
        return self.find(f"{key} ", f"{key} ~")


def read_captures(archive: Archive, pages: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records of every capture named by (url, page_id) in ``pages``, looked up through the index.

    Distinct capture keys are laid out by range and sorted inside a task, so that blocks are inflated
    once and ranges read in file order; a hot URL has one key per page and spreads over many tasks.
    Repeated records are all returned, once.
    """
    shards, path = archive.shards(), archive.path

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        index = CaptureIndex(path, shards)
        yield from _out((r for b in batches for key in b.column(0).to_pylist() for r in index.find(key)), with_payload)

    asked = with_key(pages.select("url", "page_id")).select("_key").distinct()
    laid = asked.repartitionByRange(shuffle_width(pages.sparkSession), "_key").sortWithinPartitions("_key")
    return map_batches(laid, run, _CAPTURE)


def _out(records: Iterable[dict], with_payload: bool) -> Iterator[dict[str, list]]:
    names = [c.split()[0] for c in _CAPTURE.split(", ")]
    rows, size = [], 0
    for row in records:
        if not with_payload:
            row["payload"] = None
        rows.append(row)
        size += 200 + len(row["payload"] or b"")
        if size > 8 << 20:
            yield {n: [r[n] for r in rows] for n in names}
            rows, size = [], 0
    if rows:
        yield {n: [r[n] for r in rows] for n in names}


def op7_warc(spark, sf_dir: str) -> DataFrame:
    """Write all pages and read them back through the index; one row per record."""
    pages = table(spark, sf_dir, "pages")
    return read_captures(write_archive(pages), pages).drop("payload", "url")


OP7_SQL = """
    WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS d, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
         q AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY d, n) END AS f FROM p)
    SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
           CASE WHEN f <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN f <> page_id THEN f END AS refers_to
    FROM q
"""
