"""Benchmark decontamination over a distributed positional inverted index. DataFrame functions only.

1. Training occurrences of the benchmark's terms are counted (map-side combine).
2. Every different window of an item is probed through its rarest terms, terms without any occurrence
   included. Postings (term, document, position) of the probe terms alone are stored.
3. Posting lists are intersected after taking the term's offset in the item from its position: places
   where two probes of an item agree, up to ``SLOP`` words, are its anchors in a document.
4. Anchors are verified word by word, one row per document and item: along an anchor's diagonal for
   exact phrases, and with words put in, left out or replaced for proximity.

An exact match is a whole window in a row. A proximity match is a window of which at most one word in
five (``missing``) is absent while the others stand at their offsets with a play of ``SLOP`` words: two
probes more than may be missing are enough to find it, because two of them must be there.

Terms are hashes of lower-case words, which only choose candidates; the words themselves decide.
Joins with benchmark data carry no hint: Spark broadcasts that side where its stored size is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.llm.common import stored, table

# What stands between words. A word is a run of ASCII letters, digits and characters from U+0080 on.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
SLOP = 2
#: One word of so many may be missing in a proximity match.
MISSING_OF = 5


def cut(text: str | Column) -> Column:
    """Words as they stand (case does not change where a text is cut), with an empty one at either
    end of a text that does not begin or end with a word; places of words are places in this array."""
    return F.split(text, BETWEEN)


def exact_cut(text: str | Column) -> Column:
    """:func:`cut` with A-Z, and no other letters, in lower case."""
    return F.split(F.translate(text, UPPER, LOWER), BETWEEN)


def count_words(parts: Column) -> Column:
    """Words of a text that was cut."""
    at_end = (F.size(parts) > 1) & (F.element_at(parts, -1) == "")
    return (F.size(parts) - (parts[0] == "").cast("int") - at_end.cast("int")).cast("bigint")


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows are told apart by id and text, so repeated ids with other texts do not mix."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))


def _terms(docs: DataFrame) -> DataFrame:
    """One row per word occurrence: ``doc_id, _h, pos, term``."""
    placed = _keyed(docs).select("doc_id", "_h", F.posexplode(cut("text")).alias("pos", "word"))
    return placed.select("doc_id", "_h", "pos", F.xxhash64(F.lower("word")).alias("term"))


def missing(width: str | Column) -> Column:
    """Words of a window that a proximity match may lack."""
    return F.floor(F.col(width) / MISSING_OF) if isinstance(width, str) else F.floor(width / MISSING_OF)


def benchmark_items(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Items that have words: ``item_id, item, words, terms, width, firsts, covered`` (``item``: a key of id and
    text; ``firsts``: where each different window stands first, so that a repeated word is one window;
    ``covered``: the offsets in these windows)."""
    items = benchmark.select("item_id", F.filter(exact_cut(F.coalesce("text", F.lit(""))), lambda w: w != "").alias("words"))
    items = items.filter(F.size("words") > 0).select(
        "item_id",
        F.xxhash64("item_id", "words").alias("item"),
        "words",
        F.transform("words", lambda w: F.xxhash64(F.lower(w))).alias("terms"),
        F.least(F.size("words"), F.lit(window)).alias("width"),
    ).dropDuplicates(["item_id", "item"])
    starts = F.sequence(F.lit(0), F.size("words") - F.col("width"))
    windows = items.select("item", F.posexplode(F.transform(starts, lambda s: F.slice("words", s + 1, F.col("width")))).alias("s", "window"))
    firsts = windows.groupBy("item", "window").agg(F.min("s").alias("s")).groupBy("item").agg(F.array_sort(F.collect_list("s")).alias("firsts"))
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("firsts", lambda s: F.sequence(s, s + F.col("width") - 1)))))
    return items.join(firsts, "item").select("item_id", "item", "words", "terms", "width", "firsts", covered.alias("covered"))


def probe_terms(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rarest terms of every different window, two more than may be missing: ``item, q, term, width``."""
    placed = items.select("item", F.posexplode("terms").alias("q", "term"))
    used = stored(placed.select("term").distinct(), "benchmark-terms")
    counts = stored(_terms(docs).join(used, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term-counts")
    rated = placed.join(counts, "term", "left").groupBy("item").agg(
        F.array_sort(F.collect_list(F.struct("q", F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("places")
    )
    by_count = F.transform("places", lambda p: F.struct(p.n.alias("n"), p.q.alias("q"), p.term.alias("term")))
    rarest = F.transform(
        "firsts", lambda s: F.slice(F.array_sort(F.slice("places", s + 1, F.col("width"))), F.lit(1), (missing("width") + 2).cast("int"))
    )
    chosen = rated.withColumn("places", by_count).join(items.select("item", "width", "firsts"), "item")
    chosen = chosen.select("item", "width", F.explode(F.flatten(rarest)).alias("p")).filter("p.n > 0")
    return chosen.select("item", "p.q", "p.term", "width").distinct()


def index_postings(docs: DataFrame, probes: DataFrame) -> DataFrame:
    """Stored postings of the probe terms: ``term, doc_id, _h, pos``."""
    used = stored(probes.select("term").distinct(), "probe-terms")
    return stored(_terms(docs).join(used, "term"), "postings")


def anchors(postings: DataFrame, probes: DataFrame, slop: int = SLOP, window: int = WINDOW) -> DataFrame:
    """``doc_id, _h, found``: for every document with candidates its ``array<struct<item, diagonals>>``.

    A diagonal (position less offset) is a candidate if another probe of the item, less than a window
    away, stands up to ``slop`` words behind it; of items of one word, all are. Probes without any
    neighbour, which are most, are left out first.
    """
    aligned = postings.join(probes, "term").select("doc_id", "_h", "item", "width", "q", (F.col("pos") - F.col("q")).alias("diagonal"))
    of_item = Window.partitionBy("doc_id", "_h", "item").orderBy("diagonal")
    behind, before = F.lead("diagonal").over(of_item) - F.col("diagonal"), F.col("diagonal") - F.lag("diagonal").over(of_item)
    single = F.col("width") == 1
    close = aligned.withColumn("close", F.coalesce(F.least(behind, before), F.lit(slop + 1)) <= slop).filter(F.col("close") | single)
    others = F.collect_set("q").over(of_item.rangeBetween(0, slop))
    agrees = F.exists("others", lambda q: (q != F.col("q")) & (F.abs(q - F.col("q")) < window))
    found = close.withColumn("others", others).filter(single | agrees)
    by_item = found.groupBy("doc_id", "_h", "item").agg(F.array_sort(F.collect_set("diagonal")).alias("diagonals"))
    return by_item.groupBy("doc_id", "_h").agg(F.collect_list(F.struct("item", "diagonals")).alias("found"))


def _bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: inside lambdas Spark repeats shared expressions."""
    return F.transform(F.array(value), body)[0]


def _window_starts(diagonal: Column) -> Column:
    """Places in the document where a different window of the item begins along a diagonal."""
    same = F.filter("covered", lambda q: F.coalesce(F.when(q + diagonal >= 0, F.get("own", q + diagonal)) == F.get("words", q), F.lit(False)))
    last = F.col("width") - 1
    whole = _bound(same, lambda x: F.filter(x, lambda q, i: F.coalesce(F.get(x, i + last) == q + last, F.lit(False))))
    return F.transform(F.array_intersect(whole, F.col("firsts")), lambda q: q + diagonal)


def _merged(starts: Column) -> Column:
    """``array<struct<first, last>>`` of what windows at sorted ``starts`` cover, as maximal stretches."""

    def of(s: Column) -> Column:
        heads = F.filter(s, lambda x, i: (i == 0) | (x - F.get(s, i - 1) > F.col("width")))
        tails = F.filter(s, lambda x, i: (i == F.size(s) - 1) | (F.get(s, i + 1) - x > F.col("width")))
        return F.arrays_zip(heads.alias("first"), F.transform(tails, lambda x: x + F.col("width") - 1).alias("last"))

    return _bound(starts, of).cast("array<struct<first: int, last: int>>")


def _is_near(diagonal: Column, slop: int) -> Column:
    """Whether a window has enough of its words at their offsets from ``diagonal``, or up to ``slop`` further."""
    behind = (F.col("width") - missing("width") - 1).cast("int")

    def there(q: Column) -> Column:
        found = F.lit(False)
        for e in range(slop + 1):
            at = q + diagonal + e
            found = found | F.coalesce(F.when(at >= 0, F.get("own", at)) == F.get("words", q), F.lit(False))
        return found

    def close(found: Column) -> Column:
        """Places that as many words of one window follow as it needs."""
        return F.filter(found, lambda q, i: F.coalesce(F.get(found, i + behind) - q < F.col("width"), F.lit(False)))

    return _bound(F.filter("covered", there), lambda x: F.size(close(x)) > 0)


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """``doc_id, _h, item_id, runs, near`` of the documents and items that meet: ``runs`` are the stretches that
    whole windows cover (places in :func:`cut`, both inclusive), ``near`` says that a proximity match is there.

    An item of fewer words than a window is one window as a whole. NULL texts have no words; NULL ids are
    ids like others. Equal rows give equal matches, each its own. Empty tables give no matches. A very long
    text comes once for each item that has an anchor in it, and its work grows with its anchors times the
    item's length; however often a word or passage repeats, one row is made from both.
    """
    items = stored(benchmark_items(benchmark, window), "benchmark-items")
    probes = stored(probe_terms(docs, items), "probes")
    candidates = stored(anchors(index_postings(docs, probes), probes, slop, window), "anchors")
    texts = _same_row(_keyed(docs), candidates, "inner").select("doc_id", "_h", exact_cut("text").alias("own"), "found")
    each = texts.select("doc_id", "_h", "own", F.explode("found").alias("f")).select("doc_id", "_h", "own", "f.item", "f.diagonals")
    paired = each.join(items.drop("terms"), "item")
    starts = F.array_sort(F.array_distinct(F.flatten(F.transform("diagonals", _window_starts))))
    bases = F.array_distinct(F.flatten(F.transform("diagonals", lambda d: F.sequence(d - slop, d))))
    near = F.exists(bases, lambda d: _is_near(d, slop))
    return paired.select("doc_id", "_h", "item_id", _merged(starts).alias("runs"), near.alias("near")).filter((F.size("runs") > 0) | F.col("near"))


def phrase_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, _h, item_id, first, last``: the stretches of :func:`matches`, each once."""
    found = matches(docs, benchmark, window)
    return found.select("doc_id", "_h", "item_id", F.explode("runs").alias("r")).select("doc_id", "_h", "item_id", "r.first", "r.last").distinct()


def proximity_matches(docs: DataFrame, benchmark: DataFrame, slop: int = SLOP, window: int = WINDOW) -> DataFrame:
    """``doc_id, _h, item_id`` of documents and items with a proximity match, exact ones included."""
    return matches(docs, benchmark, window, slop).filter("near").select("doc_id", "_h", "item_id").distinct()


def _same_row(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    right = right.withColumnsRenamed({"doc_id": "_doc_id", "_h": "_other_h"})
    joined = left.join(right, left["doc_id"].eqNullSafe(right["_doc_id"]) & (left["_h"] == right["_other_h"]), how)
    return joined.drop("_doc_id", "_other_h")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """Per row: ``doc_id, _h, n_words, n_hit, n_items, items_sha256, n_near``. An item without id counts no item.

    Empty tables give no rows, or rows without hits; very long texts are treated as :func:`matches` says.
    """
    found = stored(matches(docs, benchmark, window, slop), "matches")
    whole = found.filter(F.size("runs") > 0)
    places = whole.select("doc_id", "_h", F.explode("runs").alias("r")).select("doc_id", "_h", F.explode(F.sequence("r.first", "r.last")).alias("pos"))
    hits = places.distinct().groupBy("doc_id", "_h").agg(F.count(F.lit(1)).alias("n_hit"))
    named = found.groupBy("doc_id", "_h").agg(
        F.array_sort(F.collect_set(F.when(F.size("runs") > 0, F.col("item_id").cast("string")))).alias("items"),
        F.size(F.collect_set(F.when(F.col("near"), F.col("item_id")))).alias("n_near"),
    )
    marked = _same_row(named, hits, "left")
    counted = _keyed(docs).withColumn("parts", cut("text")).select("doc_id", "_h", count_words(F.col("parts")).alias("n_words"))
    return _same_row(counted, marked, "left").select(
        "doc_id",
        "_h",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias("items_sha256"),
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows of ``docs``, with all their columns, in which no window occurs."""
    whole = stored(matches(docs, benchmark, window), "matches").filter(F.size("runs") > 0)
    hit = whole.select("doc_id", "_h").distinct()
    keyed = docs.withColumn("_h", F.xxhash64(F.coalesce("text", F.lit(""))))
    return _same_row(keyed, hit, "left_anti").select(*docs.columns)


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    """Words, hit words, items and items nearby per document."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("_h").withColumn("contaminated", F.col("n_hit") > 0)


OP8_SQL = r"""
    WITH words AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
        FROM documents),
    item_words AS (
        SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
        FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS v
        FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS s FROM item_words WHERE len(w) > 0)),
    widths AS (SELECT DISTINCT n FROM windows),
    starts AS (
        SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM words, widths WHERE len(w) >= n),
    hits AS (
        SELECT d.doc_id, d.s, d.n, v.item_id
        FROM (SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS v FROM starts) d JOIN windows v USING (n, v)),
    places AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY doc_id),
    items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY doc_id),
    -- Proximity: of a window of n words, n less one in five, each up to two words behind its place.
    offsets AS (SELECT item_id, least(len(w), 10) AS n, unnest(w) AS v, generate_subscripts(w, 1) AS q FROM item_words),
    positions AS (SELECT doc_id, unnest(w) AS v, generate_subscripts(w, 1) AS p FROM words),
    aligned AS (
        SELECT DISTINCT doc_id, item_id, n, q, p - q - e AS base
        FROM positions JOIN offsets USING (v), (SELECT unnest([0, 1, 2]) AS e)),
    near AS (
        SELECT DISTINCT doc_id, item_id
        FROM (SELECT *, lead(q, (n - n // 5 - 1)::INTEGER) OVER (PARTITION BY doc_id, item_id, base ORDER BY q) AS last FROM aligned)
        WHERE last - q < n),
    nearby AS (SELECT doc_id, count(*) AS n_near FROM near GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(n_near, 0)::BIGINT AS n_near, coalesce(n_hit, 0) > 0 AS contaminated
    FROM words LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN nearby USING (doc_id)
"""
