"""Whole texts through a tokenizer, one distinct piece at a time.

A byte-level tokenizer cuts a text before every blank that stands between two characters that are
not white space, and on both sides of such a line feed, so such pieces can be encoded on their own
and remembered; so can letters before one closing mark. Texts with other white space beside a blank,
and texts with a special token's string, are encoded whole. So are all texts where the tokenizer file
asks for another way of cutting (:func:`cuts_like_bytes`). The memory of pieces has two generations,
each bounded in bytes; pieces that are met again move to the young one. Longer pieces, such as texts
without blanks, are hardly met again: they are kept no longer than the texts they come from.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import cache
from itertools import islice

import numpy as np
from tokenizers import Tokenizer

from reviewloom.llm.common import FORGET

#: Bytes of a generation, by PIECE_BYTES a piece and what its characters and ids take.
GENERATION_BYTES = 128 << 20
PIECE_BYTES = 170
#: Longer pieces are not remembered.
REMEMBERED_CHARS = 64
TEXT_CHARS_AT_ONCE = 1 << 20
#: One of these behind a letter, at a piece's end, is a token of its own.
MARKS = (",", ".")
#: White space as Unicode has it but for blank and line feed, the separators that only some libraries count, and NUL.
RARE_SPACE = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000\0" + "".join(map(chr, range(0x2000, 0x200B)))


def must_stay_whole(special: list[str]) -> Callable[[str], bool]:
    """Tells texts that must not be cut at blanks. Plain substring tests: they run on every text."""
    marks = ["  ", " \n", "\n ", *special, *RARE_SPACE]

    def test(text: str) -> bool:
        return text[:1] == " " or text[-1:] == " " or any(mark in text for mark in marks)

    return test


def cut(text: str) -> list[str]:
    """Pieces of a text that need not stay whole; some may be empty."""
    text = text.replace(" ", "\0 ")
    return (text if "\n\n" in text else text.replace("\n", "\0\n\0")).split("\0")


def chunks(texts: list[str]) -> Iterator[list[str]]:
    """``texts`` in order, in lists of bounded total length (or one longer text)."""
    held, chars = [], 0
    for text in texts:
        if held and chars + len(text) > TEXT_CHARS_AT_ONCE:
            yield held
            held, chars = [], 0
        held.append(text)
        chars += len(text)
    if held:
        yield held


class Remembered:
    """The bytes that ``make`` gives for each piece, for the last distinct pieces."""

    def __init__(self, make: Callable[[list[str]], list], generation: int = GENERATION_BYTES):
        self.make, self.generation = make, generation
        self.young: dict = {}
        self.old: dict = {}
        self.held = 0
        self.passing: list[str] = []
        FORGET.append(self.forget)

    def forget(self) -> bool:
        held = bool(self.young or self.old)
        self.young, self.old, self.held, self.passing = {}, {}, 0, []
        return held

    def cover(self, texts: list[list[str]]) -> dict:
        """A dict that holds the pieces of all ``texts``, until the next call."""
        for piece in self.passing:
            del self.young[piece]
        if self.held > self.generation:
            self.old, self.young, self.held = self.young, {}, 0
        new = set().union(*texts).difference(self.young)
        young, old = self.young, self.old
        fresh, closed = set(), []
        for piece in new:
            if piece in old:
                young[piece] = old[piece]
            elif piece[-1:] in MARKS and piece[-2:-1].isalpha():
                closed.append(piece)
                for part in (piece[:-1], piece[-1]):
                    if part not in young:
                        fresh.add(part)
            else:
                fresh.add(piece)
        young.update(zip(fresh, self.make(list(fresh))))
        for piece in closed:
            young[piece] = young[piece[:-1]] + young[piece[-1]]
        added = new | fresh
        self.passing = [p for p in added if len(p) > REMEMBERED_CHARS]
        added.difference_update(self.passing)
        self.held += PIECE_BYTES * len(added) + 2 * sum(map(len, added)) + sum(map(len, map(young.__getitem__, added)))
        return young


def cuts_like_bytes(path: str) -> bool:
    """Whether a ``tokenizers`` file cuts texts as this module does: plain byte-level BPE, no normalizer."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    cutter, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges"))
    byte_level = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
    whole_added = all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized")) for t in spec.get("added_tokens", []))
    return bool(model.get("type") == "BPE" and plain and byte_level and whole_added and spec.get("normalizer") is None and spec.get("post_processor") is None)


class LibraryEncoder:
    """``tokenizers`` with ``add_special_tokens=False``; ids as little-endian bytes of ``width``."""

    def __init__(self, path: str, width: int | None = None):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.largest_id = max(self.tokenizer.get_vocab().values())
        self.width = width or (2 if self.largest_id < 1 << 16 else 4)
        added = self.tokenizer.get_added_tokens_decoder()
        plain = [i for i, t in added.items() if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self.between = plain[0] if plain else None
        self.mark = added[plain[0]].content if plain else None
        self.stays_whole = must_stay_whole([t.content for t in added.values()]) if cuts_like_bytes(path) else lambda text: True
        self.pieces = Remembered(self._pieces)

    @staticmethod
    @cache
    def shared(path: str, width: int | None = None) -> LibraryEncoder:
        """One encoder per worker process."""
        return LibraryEncoder(path, width)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, f"<u{self.width}").tobytes()

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Pieces are joined by a special token, at which the library cuts the text again."""
        if self.mark is None:
            return [self._whole(p) for p in pieces]
        found: list[bytes] = []
        left = iter(pieces)
        while some := list(islice(left, 4096)):
            encoded = self.tokenizer.encode_batch_fast([self.mark.join(some)], add_special_tokens=False)[0].ids
            ids = np.array(encoded, f"<u{self.width}")
            cuts = (np.flatnonzero(ids == self.between) * self.width).tolist()
            raw = ids.tobytes()
            found += [raw[a:b] for a, b in zip([0, *(c + self.width for c in cuts)], [*cuts, len(raw)])]
        return found

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for some in chunks(texts):
            parts = [None if self.stays_whole(t) else cut(t) for t in some]
            known = self.pieces.cover([p for p in parts if p])
            for text, pieces in zip(some, parts):
                yield self._whole(text) if pieces is None else b"".join(map(known.__getitem__, pieces))
