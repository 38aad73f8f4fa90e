"""Fill-in-the-middle texts by a pipeline of ``pyarrow.compute`` steps over whole batches.

Texts are bytes of UTF-8, marked with a byte that UTF-8 never has behind every unit (a run of letters
A-Z, or one other character). The steps: split at the mark into lists of units, flatten the lists
with the index of each unit's text, compute each unit's ordinal within its text, give it a role by
the two cut ordinals, filter by role, rebuild one list a text and role, and join each list. A text
longer than ``SLICE_BYTES`` goes through the same steps in slices that end between units, whose
ordinals go on where the slice before ended, so no text is expanded as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import map_batches, table

# The marks of the output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Bytes that are expanded into units at once; a unit takes some 40 bytes.
SLICE_BYTES = 2 << 20
MARK = b"\xff"
# Arrow matches bytes, not characters, in binary arrays: a character is a lead byte and what continues it.
UNIT = rb"([A-Za-z]+|[^A-Za-z\x80-\xff]|[\xc0-\xff][\x80-\xbf]*)"
_BETWEEN = re.compile(rb"(?<![A-Za-z])(?![\x80-\xbf])|(?<=[A-Za-z])(?![A-Za-z\x80-\xbf])")


def slices(raw: bytes, size: int) -> list[bytes]:
    """``raw`` cut between units into slices of ``size`` bytes, or more where a run of letters is longer."""
    out, at = [], 0
    while at < len(raw):
        cut = _BETWEEN.search(raw, at + size) if at + size < len(raw) else None
        end = cut.start() if cut else len(raw)
        out.append(raw[at:end])
        at = end
    return out


def split_units(raw: pa.Array) -> pa.Array:
    """Lists of the units of each text."""
    marked = pc.replace_substring_regex(raw, UNIT, rb"\1" + MARK)
    lists = pc.split_pattern(marked, MARK)  # the last of each list is the empty rest behind the last mark
    flat, sizes = pc.list_flatten(lists), pc.list_value_length(lists).to_numpy()
    kept = np.ones(len(flat), bool)
    kept[np.cumsum(sizes) - 1] = False
    return _rebuilt(flat.filter(pa.array(kept)), sizes - 1)


def _rebuilt(flat: pa.Array, sizes: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int64()), flat)


def pieces(units: pa.Array, first: np.ndarray, second: np.ndarray) -> list[pa.Array]:
    """Units before ordinal ``first``, from there before ``second``, and the rest, joined for each text."""
    flat, parents = pc.list_flatten(units), pc.list_parent_indices(units)
    starts = units.offsets.slice(0, len(units))
    ordinals = pc.subtract(pa.array(np.arange(len(flat))), pc.take(starts, parents))
    before_first = pc.less(ordinals, pc.take(pa.array(first), parents))
    before_second = pc.less(ordinals, pc.take(pa.array(second), parents))
    out = []
    for role in (before_first, pc.and_not(before_second, before_first), pc.invert(before_second)):
        sizes = np.bincount(parents.filter(role).to_numpy(), minlength=len(units))
        out.append(pc.binary_join(_rebuilt(flat.filter(role), sizes), pa.scalar(b"", pa.large_binary())))
    return out


def cut_texts(raw: list[bytes], draws: list[tuple[int, int]], size: int = SLICE_BYTES) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """Number of units and the three pieces of each text; ``draws`` modulo one more than its units are the cuts."""
    at = 0
    while at < len(raw):
        to, room = at + 1, size - len(raw[at])
        while to < len(raw) and len(raw[to]) <= room:
            room -= len(raw[to])
            to += 1
        if len(raw[at]) > size:
            yield _cut_long(raw[at], draws[at], size)
        else:
            units = split_units(pa.array(raw[at:to], pa.large_binary()))
            n = pc.list_value_length(units).to_numpy()
            cuts = np.sort(np.array(draws[at:to], np.int64).reshape(-1, 2) % (n[:, None] + 1), axis=1)
            yield from zip(n.tolist(), *(p.to_pylist() for p in pieces(units, cuts[:, 0], cuts[:, 1])))
        at = to


def _cut_long(raw: bytes, draws: tuple[int, int], size: int) -> tuple[int, bytes, bytes, bytes]:
    parts = slices(raw, size)
    sizes = [len(split_units(pa.array([p], pa.large_binary()))[0]) for p in parts]
    n = sum(sizes)
    a, b = sorted(d % (n + 1) for d in draws)
    roles: list[list[bytes]] = [[], [], []]
    done = 0
    for part, own in zip(parts, sizes):
        units = split_units(pa.array([part], pa.large_binary()))
        for role, piece in zip(roles, pieces(units, np.array([a - done]), np.array([b - done]))):
            role.append(piece[0].as_py())
        done += own
    return n, *(b"".join(r) for r in roles)


def fill_in_middle(docs: DataFrame, draws: list[Column], plain: Column, suffix_first: Column) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` per row.

    ``draws``: two whole numbers whose remainders by one more than the units cut the text; ``plain``
    and ``suffix_first`` choose the form. A text that is empty or has one of the marks is always
    plain. Narrow: no shuffle; each row by itself, repeated ones as well. A NULL text is empty, NULL
    ids are passed on; NULL draws count as 0 and NULL choices as false. A very long text takes a few
    times its own size in its task. An empty table gives an empty result; other columns are not read.
    """
    text = F.coalesce("text", F.lit(""))
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    form = F.when((text == "") | marked | F.coalesce(plain, F.lit(False)), "plain").when(F.coalesce(suffix_first, F.lit(False)), "spm").otherwise("psm")
    a, b = (F.coalesce(d.cast("bigint"), F.lit(0)) for d in draws)
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.cast("binary").alias("raw"), a.alias("a"), b.alias("b"), form.alias("form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            raw = batch.column(1).to_pylist()
            forms = batch.column(4)
            cut = list(cut_texts(raw, list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()))))
            n, prefix, middle, suffix = ([c[k] for c in cut] for k in range(4))
            is_plain = pc.equal(forms, "plain")
            spm = pc.equal(forms, "spm")
            p, m, s = (pa.array(x, pa.large_binary()) for x in (prefix, middle, suffix))
            joined = pc.binary_join_element_wise(
                pc.if_else(spm, SUFFIX.encode(), PREFIX.encode()).cast(pa.large_binary()), pc.if_else(spm, s, p),
                pc.if_else(spm, PREFIX.encode(), SUFFIX.encode()).cast(pa.large_binary()), pc.if_else(spm, p, s),
                pa.scalar(MIDDLE.encode(), pa.large_binary()), m, pa.scalar(b"", pa.large_binary()),
            )
            output = pc.if_else(is_plain, pa.array(raw, pa.large_binary()), joined).cast(pa.large_string()).cast(pa.string())
            chars = [pc.if_else(is_plain, None, pc.utf8_length(x.cast(pa.large_string()))).cast(pa.int64()) for x in (p, m)]
            yield {"doc_id": batch.column(0), "n": n, "form": forms, "prefix_chars": chars[0], "middle_chars": chars[1], "output": output}

    schema = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    return map_batches(keyed, run, schema)


def restored(output: str | Column, form: str | Column) -> Column:
    """The text as it was, from output and form alone. A text in which a mark occurs is plain, so the
    marks of the others can only be those that were put there."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", 4)
    return F.when(form == "plain", output).when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(form == "spm", F.concat(parts[2], parts[3], parts[1]))


def op12_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """All documents, cut and arranged by digests of their ids, and the texts rebuilt from the output."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    h = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)]
    made = fill_in_middle(table(spark, sf_dir, "documents"), h[:2], h[2] % 100 >= 90, h[3] % 100 < 20)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored("output", "form").cast("binary"), 256).alias("restored_sha256"),
    )


OP12_SQL = r"""
    WITH units AS (
        SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
               sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d
        FROM documents),
    drawn AS (
        SELECT *, len(u) AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2, ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4
        FROM units),
    cuts AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM drawn),
    parts AS (
        SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix FROM cuts)
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM parts
"""
