"""Near-duplicates by bottom-k sketches from one hash function.

1. Every document becomes the set of its word shingles, hashed once. Documents with equal sets form
   one class, which one member stands for; its sketch is the ``SKETCH`` smallest hashes.
2. The ``LISTED`` smallest values of a sketch are retained. Similar sets share most of theirs, so
   each set enters the inverted lists of its rarest retained values only: as many as are enough to
   meet in one list. Values that very many documents hold because of a common line drop out this way
   and not by a cap.
3. Lists of at most ``PAIRED`` sets give pairs whose union-sketch estimate does not rule them out.
   Longer lists give a star, without pairs. The components of both are clusters of sets that may be
   similar; sets in different clusters are not.
4. Clusters get the full sets and verify exact Jaccard similarity. A cluster of many or large sets is
   dealt out in blocks, and every pair of blocks is a task. Tasks return a spanning forest of the
   links, never all pairs, and its components are the result.

Step 2 and the estimate leave a margin of ``SIGMAS`` standard deviations, so a link at the threshold is
lost with a chance below 1e-9; sets that fit their sketch whole are compared without one.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewloom.llm.common import map_batches, stored, table
from reviewloom.llm.components import components

SKETCH, LISTED, PAIRED = 64, 32, 64
SIGMAS = 7.0
#: Shingles (8 bytes each) that a block of a cluster holds about; a set counts as SET_WEIGHT more,
#: so that a block has 2,048 sets at most.
BLOCK_SHINGLES, SET_WEIGHT = 1 << 20, 512
#: Up to so many shared shingles a matrix product is quicker than comparing pairs.
MATRIX_SHINGLES = 50_000
FILTER_BITS = 23

_SETS = "doc_id bigint, n bigint, k1 bigint, k2 bigint, sketch array<bigint>"


def shingle_set(text: str, width: int) -> np.ndarray:
    """Distinct shingle hashes, sorted. ASCII letters in lower case; words are cut at ASCII white space.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    span = min(width, len(words))
    value = np.full(len(words) - span + 1, span, np.uint64)
    for i in range(span):
        value = (value ^ h[i : len(words) - span + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(32)
    value = (value ^ (value >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return np.unique(value ^ (value >> np.uint64(29)))


def _set_key(values: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(values.tobytes())
    return tuple(np.frombuffer(digest, "<i8").tolist())


def _signed(values: np.ndarray) -> np.ndarray:
    """Keeps the order."""
    return (values ^ np.uint64(1 << 63)).view(np.int64)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """Per row: size and key of its shingle set, and the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            sets = [shingle_set(t or "", width) for t in batch.column(1).to_pylist()]
            keys = [_set_key(s) for s in sets]
            yield {
                "doc_id": batch.column(0), "n": [len(s) for s in sets], "k1": [k[0] for k in keys], "k2": [k[1] for k in keys],
                "sketch": [_signed(s[:SKETCH]) for s in sets],
            }

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, _SETS)


def _least_common(threshold: float) -> int:
    """So many of the retained values two sets at the threshold share, but for the margin."""
    return max(1, math.floor(LISTED * threshold - SIGMAS * math.sqrt(LISTED * threshold * (1 - threshold))))


def inverted_lists(classes: DataFrame, threshold: float) -> DataFrame:
    """``value, rep``: each set under its rarest retained values."""
    held = classes.select("rep", "n", F.explode(F.slice("sketch", 1, LISTED)).alias("value"))
    counts = held.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    size = F.least("n", F.lit(LISTED))
    whole = F.col("n") <= F.floor(F.lit(LISTED * threshold))
    common = F.when(whole, F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9))).otherwise(_least_common(threshold))
    listed = held.join(counts, "value").groupBy("rep", "n").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("shared"))
    # Values that no other set retains come first in the order of rarity, and need no list.
    places = size - common + 1 - (size - F.size("shared"))
    return listed.select("rep", F.explode(F.slice("shared", F.lit(1), F.greatest(F.lit(0), places).cast("int"))).alias("s")).select("rep", "s.value")


def _may_link(a: tuple, b: tuple, threshold: float) -> bool:
    """Union-sketch estimate of two (size, sorted sketch, its set): False if it rules out a link."""
    (na, sa, xa), (nb, sb, xb) = a, b
    if min(na, nb) < threshold * max(na, nb) - 1e-9:
        return False
    common = len(xa & xb)
    whole_a, whole_b = na <= len(sa), nb <= len(sb)
    if whole_a and whole_b:
        return common >= threshold * (na + nb - common) - 1e-9
    top = min(sa[-1] if not whole_a else sb[-1], sb[-1] if not whole_b else sa[-1])
    union = bisect_right(sa, top) + bisect_right(sb, top) - common
    return common >= union * threshold - SIGMAS * math.sqrt(union * threshold * (1 - threshold))


def candidate_pairs(lists: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """``u, v`` from lists of 2 to ``PAIRED`` sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            u, v = [], []
            for members in batch.column(0).to_pylist():
                sets = sorted((m["n"], m["rep"], m["sketch"], frozenset(m["sketch"])) for m in members)
                for i, (n, rep, *own) in enumerate(sets):
                    for n2, rep2, *other in sets[i + 1 :]:
                        if n < threshold * n2 - 1e-9:
                            break
                        if _may_link((n, *own), (n2, *other), threshold):
                            u.append(max(rep, rep2))
                            v.append(min(rep, rep2))
            yield {"u": u, "v": v}

    members = lists.join(classes, "rep").groupBy("value").agg(F.collect_list(F.struct("rep", "n", "sketch")).alias("members"))
    return map_batches(members.select("members"), run, "u bigint, v bigint").filter("u <> v").distinct()


def id_filter(ids: DataFrame, column: str) -> bytes:
    """A bitmap of fixed size that tells most ids that are not in ``ids``; the join behind it decides.

    Past the size where it holds most bits it lets all rows through, which costs time alone.
    """
    bit = F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))
    words = ids.select(bit.alias("b")).select(F.shiftright("b", 15).alias("part"), (F.col("b") % 32768).alias("at"))
    packed = words.groupBy("part").agg(F.expr("bitmap_construct_agg(at)").alias("bits")).collect()
    out = bytearray(1 << (FILTER_BITS - 3))
    for row in packed:
        out[row.part * 4096 : row.part * 4096 + len(row.bits)] = row.bits
    return bytes(out)


def full_sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """``rep, values, cluster, blocks`` of the classes in ``nodes``, made from the representatives' texts."""
    spark = docs.sparkSession
    bits = spark.sparkContext.broadcast(id_filter(nodes, "rep"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        known = bits.value
        for batch in batches:
            rows = []
            for doc_id, text, b in zip(*(c.to_pylist() for c in batch.columns)):
                if known[b >> 3] >> (b & 7) & 1:
                    values = shingle_set(text, width)
                    rows.append((doc_id, *_set_key(values), values.tobytes()))
            if rows:
                yield dict(zip(("rep", "k1", "k2", "values"), zip(*rows)))

    keyed = docs.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.pmod(F.xxhash64(F.col("doc_id").cast("bigint")), F.lit(1 << FILTER_BITS)).alias("b"),
    )
    made = map_batches(keyed, run, "rep bigint, k1 bigint, k2 bigint, values binary")
    return made.join(nodes, ["rep", "k1", "k2"]).select("rep", "values", "cluster", "blocks")


def spanning_links(ids: list[int], sides: list[int], sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets; where ``sides`` differ, only across them."""
    root = list(range(len(ids)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []

    def link(i: int, j: int) -> None:
        a, b = find(i), find(j)
        if a != b:
            root[a] = b
            out.append((ids[i], ids[j]))

    m = len(ids)
    across = len(set(sides)) > 1
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    values, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    n_shared = int(shared.sum())
    if m > 8 and n_shared <= MATRIX_SHINGLES:
        keep = shared[place]
        rows, columns = owner[keep], column[place[keep]]
        common = np.zeros((m, m), np.float32)
        for at in range(0, n_shared, 4096):
            part = (columns >= at) & (columns < at + 4096)
            grid = np.zeros((m, min(4096, n_shared - at)), np.float32)
            grid[rows[part], columns[part] - at] = 1
            common += grid @ grid.T
        for i in range(m):
            near = common[i, :i] * (1 + threshold) >= threshold * (sizes[i] + sizes[:i]) - 1e-2
            for j in np.flatnonzero(near).tolist():
                if (not across or sides[i] != sides[j]) and _linked(sets[i], sets[j], threshold, int(common[i, j])):
                    link(i, j)
        return out
    order = sorted(range(m), key=lambda i: sizes[i])
    brief = [(int(sizes[i]), (x := s[: 4 * SKETCH].tolist()), frozenset(x)) for i, s in enumerate(sets)]
    for a, i in enumerate(order):
        for j in order[a + 1 :]:
            if sizes[i] < threshold * sizes[j] - 1e-9:
                break
            if across and sides[i] == sides[j] or find(i) == find(j):
                continue
            if _may_link(brief[i], brief[j], threshold) and _linked(sets[i], sets[j], threshold):
                link(i, j)
    return out


def _linked(a: np.ndarray, b: np.ndarray, threshold: float, common: int | None = None) -> bool:
    """Exact: 100 * |a & b| >= percent * |a | b| in integers."""
    if common is None:
        common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= round(100 * threshold) * (len(a) + len(b) - common)


def cluster_links(sets: DataFrame, threshold: float) -> DataFrame:
    """``u, v``: spanning links of every cluster, found block pair by block pair."""
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    met = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda o: F.struct(F.least("own", o).alias("low"), F.greatest("own", o).alias("high")))
    dealt = sets.withColumn("own", own).select("rep", "values", "cluster", "own", F.explode(met).alias("p"))
    dealt = dealt.select("cluster", "p.low", "p.high", "rep", "own", "values")

    def run(group: pa.Table) -> pa.Table:
        raw = {r: (o, v) for r, o, v in zip(*(group.column(c).to_pylist() for c in ("rep", "own", "values")))}
        ids = sorted(raw)
        sets = [np.frombuffer(raw[i][1], np.uint64) for i in ids]
        links = spanning_links(ids, [raw[i][0] for i in ids], sets, threshold) if len(ids) > 1 else []
        return pa.table({"u": pa.array([a for a, _ in links], pa.int64()), "v": pa.array([b for _, b in links], pa.int64())})

    return dealt.groupBy("cluster", "low", "high").applyInArrow(run, "u bigint, v bigint")


def near_components(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id``, the smallest id reachable by links.

    Texts without words (NULL, empty, white space) have no shingles and are linked with nothing. Rows
    without id are linked with nothing and have no component. Rows that share an id are one document:
    whatever any of their texts is linked with is reachable. An empty table gives no rows.
    ``threshold`` counts in whole percent.
    """
    rows = stored(sketches(docs, width), "sketches")
    usable = rows.filter("n > 0 AND doc_id IS NOT NULL")
    classes = stored(
        usable.groupBy("n", "k1", "k2").agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch")), "set-classes"
    )
    lists = stored(inverted_lists(classes, threshold), "inverted-lists")
    lengths = stored(lists.groupBy("value").agg(F.count(F.lit(1)).alias("m"), F.min("rep").alias("hub")).filter("m > 1"), "list-lengths")
    short = lists.join(lengths.filter(F.col("m") <= PAIRED).select("value"), "value")
    long = lists.join(lengths.filter(F.col("m") > PAIRED), "value").select(F.col("rep").alias("u"), F.col("hub").alias("v")).distinct()
    may_link = candidate_pairs(short, classes.select("rep", "n", "sketch"), threshold).unionByName(long)
    clustered = components(may_link).withColumnsRenamed({"node": "rep", "component": "cluster"})
    nodes = stored(clustered.join(classes.drop("sketch"), "rep"), "cluster-nodes")
    blocks = nodes.groupBy("cluster").agg(F.ceil(F.sum(F.col("n") + SET_WEIGHT) / BLOCK_SHINGLES).cast("bigint").alias("blocks"))
    nodes = stored(nodes.join(blocks, "cluster"), "cluster-blocks")
    links = cluster_links(full_sets(docs, nodes, width), threshold)
    same_id = usable.join(classes.select("n", "k1", "k2", "rep"), ["n", "k1", "k2"]).filter("doc_id <> rep")
    own_sets = same_id.groupBy("doc_id").agg(F.min("rep").alias("first"), F.max("rep").alias("last")).filter("first <> last")
    bridges = same_id.join(own_sets.select("doc_id"), "doc_id").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    found = stored(components(links.unionByName(bridges)), "components").withColumnsRenamed({"node": "rep", "component": "least"})
    named = classes.select("n", "k1", "k2", "rep").join(found, "rep", "left").select("n", "k1", "k2", F.coalesce("least", "rep").alias("c"))
    slim = rows.select("doc_id", "n", "k1", "k2")
    return slim.join(named, ["n", "k1", "k2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id")).alias("component_id")
    )


def drop_near_copies(docs: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """Rows of ``docs``, with all their columns: one document of each component stays, that with the
    smallest id. Rows without id stay."""
    gone = near_components(docs, width, threshold).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(stored(gone, "near-copies"), "doc_id", "left_anti").select(*docs.columns)


def op2_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Component of every document by four-word shingles at a similarity of 0.8."""
    found = near_components(table(spark, sf_dir, "documents").select("doc_id", "text"), width=4, threshold=0.8)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


OP2_SQL = r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
        FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[s : s + 3], ' ') AS v
        FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) AS s FROM words WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    pairs AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
        FROM shingles a JOIN shingles b ON a.v = b.v AND a.doc_id <> b.doc_id GROUP BY ALL),
    links AS (
        SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
        WHERE 100 * shared >= 80 * (a.n + b.n - shared)),
    reach(doc_id, r) AS (
        SELECT doc_id, doc_id FROM documents
        UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.r)
    SELECT doc_id, coalesce(max(n), 0)::BIGINT AS n_shingles, min(r) AS component_id, doc_id = min(r) AS kept
    FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id
"""
