"""BPE, token files and WARC archives: exact round trips."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reviewloom.llm import bpe, pieces, token_files, warc
from reviewloom.llm.queries import QUERIES
from tests.llm.conftest import make_docs

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "\n", "\nA", "A\n", " a", "a ", "a  b", "a   b", "a\n b", "a.\nB,\nC.", "a\n\nb. c", "it's  x, 'll I'd", "!!, x.", "x., y",
    "<|endoftext|> a <|endoftext|>", "a\x1f b\x1c\x1d ", "\0 x y", "a" * 5000, "the" * 50, "日本語 テスト🙂🙂", "　x  y\xa0z ́", "''''s't  \t\r\n\n x",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(1)
    letters = "ab ct\nhe'sAé日🙂12.,!\t"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 80))) for _ in range(1500)]


def test_encoders_equal_the_library(library, odd_texts):
    expected = [e.ids for e in library.encode_batch(odd_texts, add_special_tokens=False)]
    own, wrapped = bpe.BytePairs(PATH), pieces.LibraryEncoder(PATH)
    assert [ids.tolist() for ids in own.encode(odd_texts)] == expected
    assert [np.frombuffer(b, "<u2").tolist() for b in wrapped.encode(odd_texts)] == expected
    for text, ids in zip(odd_texts, expected):
        assert own.decode(np.array(ids, "<u4")).decode() == library.decode(ids, skip_special_tokens=False) == text


def test_small_memory_gives_the_same(library, odd_texts):
    own = bpe.BytePairs(PATH)
    own.pieces.generation = 5
    expected = [e.ids for e in library.encode_batch(odd_texts[:300], add_special_tokens=False)]
    assert [ids.tolist() for t in odd_texts[:300] for ids in own.encode([t])] == expected


def test_memory_of_pieces_is_bounded_in_bytes(library):
    """Texts without blanks come once and are not kept; small pieces are kept up to the bound."""
    for encoder, memory in ((e := bpe.BytePairs(PATH), e.pieces), (w := pieces.LibraryEncoder(PATH), w.pieces)):
        memory.generation = 100_000
        for i in range(60):
            texts = [f"{i}_{k}_" + "x" * 5000 for k in range(10)] + [" ".join(f"w{i}q{k}" for k in range(100))]
            list(encoder.encode(texts))
            kept = {**memory.old, **memory.young}
            assert sum(len(p) > pieces.REMEMBERED_CHARS for p in kept) <= 10
            assert sum(pieces.PIECE_BYTES + 2 * len(p) + len(b) for p, b in kept.items() if len(p) <= pieces.REMEMBERED_CHARS) < 300_000
        for text in ("x" * 5000, "1_2_" + "x" * 5000 + " w1q2 w3q4."):
            ids = library.encode(text, add_special_tokens=False).ids
            assert [np.frombuffer(x, "<u2").tolist() if isinstance(x, bytes) else x.tolist() for x in encoder.encode([text])] == [ids]


def test_other_ways_of_cutting(odd_texts):
    """A file that cuts texts in another way is refused by the own encoder; the library's gets whole texts."""
    path = public_tokenizers.path("word_bpe_49k.json")
    assert pieces.cuts_like_bytes(PATH) and not pieces.cuts_like_bytes(path)
    with pytest.raises(ValueError):
        bpe.BytePairs(path)
    texts = odd_texts[:400]
    expected = [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u2").tolist() for b in pieces.LibraryEncoder(path).encode(texts)] == expected


def test_queries_equal_the_library(spark, tables, library):
    """op6 and op10 on the given documents: ids, digests and, in id order, where each document starts."""
    docs = sorted(spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text").collect())
    ids = [e.ids for e in library.encode_batch([d.text or "" for d in docs], add_special_tokens=False)]
    starts = np.concatenate([[0], np.cumsum([len(i) + 1 for i in ids])]).tolist()
    files = {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op6_token_files"](spark, tables).collect()}
    assert files == {(d.doc_id, at, len(i) + 1, zlib.crc32(np.array([*i, 0], "<u4").tobytes())) for d, i, at in zip(docs, ids, starts)}
    coded = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op10_bpe"](spark, tables).collect()}
    assert coded == {
        (d.doc_id, len(i), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
         hashlib.sha256(library.decode(i, skip_special_tokens=False).encode()).hexdigest())
        for d, i in zip(docs, ids)
    }


def test_broken_utf8_is_replaced(library):
    ids = [library.encode("日", add_special_tokens=False).ids[0]]
    assert bpe.BytePairs(PATH).decode(np.array(ids)).decode() == library.decode(ids, skip_special_tokens=False)


def test_encode_documents(spark, awkward, library):
    found = bpe.encode_documents(make_docs(spark, awkward), PATH, with_ids=True).collect()
    expected = Counter()
    for doc_id, text in awkward:
        ids = library.encode(text or "", add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected[doc_id, len(ids), digest, hashlib.sha256((text or "").encode()).hexdigest(), tuple(ids)] += 1
    assert Counter((*r[:4], tuple(r.ids)) for r in found) == expected
    assert bpe.encode_documents(make_docs(spark, []), PATH).count() == 0


def test_elias_fano():
    for n in (1, 2, 255, 256, 257, 3000):
        for step in (1, 2, 900):
            values = np.cumsum(np.random.default_rng(n).integers(0, step + 1, n))
            fano = token_files.EliasFano.encode(values, int(values[-1]))
            assert (fano.select(0, n) == values).all()
            for a in (0, n // 3, n - 1):
                assert (fano.select(a, min(n, a + 300)) == values[a : a + 300]).all()
            bits = 8 * (len(fano.low) + len(fano.high))
            assert bits <= n * (3 + max(1, int(values[-1]) // n).bit_length()) + 64


def test_token_files(spark, awkward, library):
    docs = make_docs(spark, awkward)
    found = token_files.read_token_files(*token_files.write_token_files(docs, PATH, end_id=0, files=3), docs_at_once=2).collect()
    lengths = Counter()
    for doc_id, text in awkward:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        lengths[doc_id, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == lengths
    at = 0
    ordered = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((r.doc_id for r in found), key=lambda i: (i is not None, i or 0))
    for row in ordered:
        assert row.start == at
        at += row.n_tokens
    empty = token_files.write_token_files(make_docs(spark, []), PATH)
    assert token_files.read_token_files(*empty).count() == 0


# -- WARC ---------------------------------------------------------------------------------------

PAGES = [
    (3, "http://a.B.org/x y?q=1", "p" * 100), (1, "https://b.org:8080/", "p" * 100), (2, "http://b.org:8080/", "p" * 99),
    (4, None, "p" * 99), (5, "http://c.org", None), (6, "http://c.org", ""), (7, "http://ünï.org/\n", "é" * 60), (8, "no host", "é" * 60),
    (None, "http://c.org", "p" * 100), (9, "http://c.org", "z" * 200_000), (9, "http://c.org", "z" * 200_000), (-5, "http://c.org/neg", "n\r\n\r\nn"),
]


def expected_records(pages):
    first = {}
    for page_id, _, html in pages:
        if page_id is not None:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    out = Counter()
    for page_id, _, html in pages:
        raw = (html or "").encode()
        refers = first.get(html or "") if len(raw) >= 100 and page_id is not None else None
        refers = None if refers == page_id else refers
        out[page_id, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if refers is not None else "response", refers] += 1
    return out


def pages_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, _key string, _digest int").repartition(3)


def test_archive_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "LINES_PER_BLOCK", 2)
    pages = pages_frame(spark, PAGES)
    archive = warc.write_archive(pages, shards=3)
    found = warc.read_captures(archive, pages, with_payload=True).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == expected_records(PAGES)
    texts = {i: (h or "").encode() for i, _, h in PAGES}
    assert all(bytes(r.payload) == texts[r.page_id] for r in found if r.record_type == "response")
    index = warc.CaptureIndex(archive.path, archive.shards())
    assert sorted((r["page_id"] for r in index.find_url("org,c)")), key=str) == [5, 6, 9, 9, None]
    assert list(index.find_url("org,zz)")) == list(index.find("")) == []
    (one,) = warc.read_captures(archive, pages.filter("page_id = 3")).collect()
    assert (one.url, one.refers_to) == ("http://a.B.org/x y?q=1", 1)


def test_empty_archive(spark):
    pages = pages_frame(spark, [])
    assert warc.read_captures(warc.write_archive(pages), pages).count() == 0
