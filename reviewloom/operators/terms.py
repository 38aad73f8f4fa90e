"""Words and bigrams per catalogue, rating and part of the review.

All ratings and categories come out of one aggregation. A review is three parts (pros, cons,
comment); the whole review is all pros, then all cons, then all comments of a cell, so a term's place
in the whole is (part, product, review, position). That place is one decimal number, which lets
counts and first places run in the same hash aggregation with map-side combine. Where the ids and
positions of a stored table allow, it is replaced by a 64-bit number of the same order, which is a
fraction of the work and of the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.constants import CATEGORIES, PARTS, RATINGS, RUSSIAN_STOP_WORDS, TOP_CLOUD, TOP_REPORT
from reviewloom.functions import text as tx
from reviewloom.operators.ordering import next_in_order, top_k
from reviewloom.session import ready_checkpoints, stored

CELL = ("catalog", "rating")
# Decimal digits of a place: part 1, product 13, review 14, position 10.
PRODUCT_LIMIT = 10**13
REVIEW_LIMIT = 10**14
POSITION_LIMIT = 10**10
#: Counters of a sketch per cell.
BUCKETS = 1 << 16
#: So many times the wanted terms are the fullest buckets whose terms are counted first.
LEADING = 4
#: So many cells are named in the plan of a second reading, which skips the others before their words are paired.
CELLS_NAMED = 1 << 10


def place(part: Column, product_id: Column, review_id: Column) -> Column:
    """Place of a review's first token in the whole text of its cell.

    The ids must lie in [0, 10**13) and [0, 10**14); anything else fails the job. Give larger or
    non-numeric keys dense ids with ``number_rows`` first.
    """

    def scaled(column: Column, unit: int) -> Column:
        return column.cast("decimal(38,0)") * F.lit(Decimal(unit)).cast("decimal(38,0)")

    value = (
        scaled(part, PRODUCT_LIMIT * REVIEW_LIMIT * POSITION_LIMIT)
        + scaled(product_id, REVIEW_LIMIT * POSITION_LIMIT)
        + scaled(review_id, POSITION_LIMIT)
    ).cast("decimal(38,0)")
    fits = product_id.between(0, PRODUCT_LIMIT - 1) & review_id.between(0, REVIEW_LIMIT - 1)
    return F.when(fits, value).otherwise(
        F.raise_error("product_id or review_id outside the range of a place").cast("decimal(38,0)")
    )


def compact_places(tokens: DataFrame) -> DataFrame:
    """Stored :func:`part_tokens` with places as 64-bit numbers of the same order, if what is found fits into them.

    Products, reviews and positions are counted from the least to the largest one that the table has, which
    are read from the places and array sizes first. Places of different tables do not compare.
    """
    return compact_together(tokens, F.size("words"), tokens)[0]


def compact_together(spanning: DataFrame, n_words: Column, *tables: DataFrame) -> list[DataFrame]:
    """The tables with the places of :func:`compact_places`, in one numbering, so that they compare.

    ``spanning`` has a row for every part of the tables, with its place and, as ``n_words``, its number of words.
    """
    product, review = F.col("_lead") % PRODUCT_LIMIT, F.col("_review")
    part = F.expr(f"_lead div {PRODUCT_LIMIT}")
    found = _split_places(spanning).agg(
        F.max(part), F.min(product), F.max(product), F.min(review), F.max(review), F.max(n_words)
    ).first()
    if found[0] is None:
        return [*tables]
    products, reviews, positions = found[2] - found[1] + 1, found[4] - found[3] + 1, found[5]
    if (found[0] + 1) * products * reviews * positions >= 1 << 63:
        return [*tables]
    number = ((part * products + product - found[1]) * reviews + review - found[3]) * positions
    return [_split_places(t).withColumn("place", number.cast("bigint")).drop("_lead", "_review") for t in tables]


def _split_places(rows: DataFrame) -> DataFrame:
    lead, review = F.expr(f"place div {REVIEW_LIMIT * POSITION_LIMIT}"), F.expr(f"place % {REVIEW_LIMIT * POSITION_LIMIT} div {POSITION_LIMIT}")
    return rows.withColumns({"_lead": lead, "_review": review})


def review_parts(
    reviews: DataFrame,
    cell: Sequence[str] = CELL,
    parts: Sequence[str] = tuple(column for column, _ in PARTS),
) -> DataFrame:
    """One row per present part: cell, ``part`` (0, 1, …), ``place`` and ``text``. NULL parts fall out."""
    options = F.array(*[F.struct(F.lit(i).alias("part"), F.col(c).alias("text")) for i, c in enumerate(parts)])
    return (
        reviews.select(*cell, "product_id", "review_id", F.explode(options).alias("p"))
        .filter(F.col("p.text").isNotNull())
        .select(
            *cell,
            F.col("p.part").alias("part"),
            place(F.col("p.part"), F.col("product_id"), F.col("review_id")).alias("place"),
            F.col("p.text").alias("text"),
        )
    )


def word_rows(
    parts: DataFrame, cell: Sequence[str] = CELL, stop_words: Iterable[str] = RUSSIAN_STOP_WORDS
) -> DataFrame:
    """One row per content word: cell, ``part``, ``crosses`` (false), ``place``, ``term``."""
    return (
        parts.select(*cell, "part", "place", F.posexplode(tx.clean_tokens(F.col("text"))).alias("pos", "term"))
        .filter(tx.is_content_word(F.col("term"), list(stop_words), lowered=True))
        .select(*cell, "part", F.lit(False).alias("crosses"), _plus(parts, F.col("pos")).alias("place"), "term")
    )


def part_tokens(
    parts: DataFrame, cell: Sequence[str] = CELL, stop_words: Iterable[str] = RUSSIAN_STOP_WORDS
) -> DataFrame:
    """Parts with their content words as an array ``words``; parts without any fall out.

    The one-element explode keeps the filter from being pushed below the tokeniser, which would
    tokenise every text twice.
    """
    words = tx.drop_stop_words(tx.clean_tokens(F.col("text")), stop_words, lowered=True)
    once = F.explode(F.array(words))
    return parts.select(*cell, "part", "place", once.alias("words")).filter(F.size("words") > 0)


def bigram_rows(
    tokens: DataFrame, cell: Sequence[str] = CELL, cross_review: bool = True, slices: int | None = None
) -> DataFrame:
    """One row per adjacent pair: cell, ``part``, ``crosses``, ``place`` (of the left word), ``term``.

    Pairs inside a part come from its array. With ``cross_review`` the last word of a part also pairs
    with the first word of the next part in order; ``crosses`` marks the pairs that lead from one kind
    of part into the next and therefore count for the whole review only.
    """
    inner = (
        _neighbours(tokens, cell)
        .filter(F.col("right").isNotNull())
        .select(*cell, "part", "crosses", "place", F.concat_ws(" ", "left", "right").alias("term"))
    )
    return inner.unionByName(border_bigrams(tokens, cell, slices)) if cross_review else inner


def word_and_bigram_rows(
    tokens: DataFrame, cell: Sequence[str] = CELL, cross_review: bool = True, slices: int | None = None
) -> DataFrame:
    """Words and bigrams from one pass over the tokens: the rows of both with ``term_kind``."""
    kinds = F.explode(F.array(F.lit("word"), F.lit("bigram")))
    is_word = F.col("term_kind") == "word"
    term = F.when(is_word, F.col("left")).otherwise(F.concat_ws(" ", "left", "right"))
    inner = (
        _neighbours(tokens, cell)
        .select("*", kinds.alias("term_kind"))
        .filter(is_word | F.col("right").isNotNull())
        .select(*cell, "term_kind", "part", "crosses", "place", term.alias("term"))
    )
    if not cross_review:
        return inner
    border = border_bigrams(tokens, cell, slices).withColumn("term_kind", F.lit("bigram"))
    return inner.unionByName(border)


def _neighbours(tokens: DataFrame, cell: Sequence[str]) -> DataFrame:
    """One row per token, ``left``, with the token behind it in the same part, ``right``.

    The next token is taken from the array right above the explode, so no pair is built and no array leaves the stage.
    """
    return tokens.select(*cell, "part", "place", "words", F.posexplode("words").alias("pos", "left")).select(
        *cell,
        "part",
        F.lit(False).alias("crosses"),
        _plus(tokens, F.col("pos")).alias("place"),
        "left",
        F.get("words", F.col("pos") + 1).alias("right"),
    )


def part_ends(tokens: DataFrame, cell: Sequence[str] = CELL) -> DataFrame:
    """First and last word of every part, which is all that the pairs across parts and reviews depend on."""
    last = F.size("words") - 1
    return tokens.select(
        *cell,
        "part",
        "place",
        F.get("words", F.lit(0)).alias("first_word"),
        F.get("words", last).alias("last_word"),
        last.alias("last_pos"),
    )


def border_bigrams(tokens: DataFrame, cell: Sequence[str] = CELL, slices: int | None = None) -> DataFrame:
    """Pairs of the last word of a part and the first word of the next one.

    First and last words are checkpointed when the plan is built: linking them samples its input for
    range slices, which would otherwise read the tokens once more.
    """
    ready_checkpoints(tokens.sparkSession)
    return linked_ends(part_ends(tokens, cell).checkpoint(), cell, slices)


def linked_ends(ends: DataFrame, cell: Sequence[str] = CELL, slices: int | None = None) -> DataFrame:
    """The pairs of :func:`border_bigrams` from stored :func:`part_ends`."""
    return (
        next_in_order(ends, cell, ["place"], ["part", "first_word"], "following", slices)
        .filter(F.col("following").isNotNull())
        .select(
            *cell,
            "part",
            (F.col("following.part") != F.col("part")).alias("crosses"),
            _plus(ends, F.col("last_pos")).alias("place"),
            F.concat_ws(" ", "last_word", "following.first_word").alias("term"),
        )
    )


def wide_counts(rows: DataFrame, cell: Sequence[str] = CELL, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """``(cell, term, n_0, first_0, …, n_all, first_all)``: count and first place in every part, and in the whole review."""
    here = [(F.col("part") == i) & ~F.col("crosses") for i in range(len(categories) - 1)]
    aggregates = [F.count(F.lit(1)).alias("n_all"), F.min("place").alias("first_all")]
    for i, condition in enumerate(here):
        aggregates.append(F.count(F.when(condition, 1)).alias(f"n_{i}"))
        aggregates.append(F.min(F.when(condition, F.col("place"))).alias(f"first_{i}"))
    return rows.groupBy(*cell, "term").agg(*aggregates)


def merge_counts(counts: DataFrame, cell: Sequence[str] = CELL, key: str = "term") -> DataFrame:
    """Wide counts, or sketches by their ``key``, of several sets of reviews as those of all of them: counts add up, the least place is the first."""
    values = [c for c in counts.columns if c not in (*cell, key)]
    return counts.groupBy(*cell, key).agg(*[(F.sum if c.startswith("n_") else F.min)(c).alias(c) for c in values])


def long_counts(wide: DataFrame, cell: Sequence[str] = CELL, categories: Sequence[str] = CATEGORIES) -> DataFrame:
    """``(cell, category, term, n, first_place)`` of wide counts, without zeros."""
    suffixes = [*range(len(categories) - 1), "all"]
    long = F.stack(F.lit(len(suffixes)), *[x for c, s in zip(categories, suffixes) for x in (F.lit(c), F.col(f"n_{s}"), F.col(f"first_{s}"))])
    return wide.select(*cell, "term", long.alias("category", "n", "first_place")).select(
        *cell, "category", "term", "n", "first_place"
    ).filter(F.col("n") > 0)


def term_counts(
    rows: DataFrame, cell: Sequence[str] = CELL, categories: Sequence[str] = CATEGORIES
) -> DataFrame:
    """``(cell, category, term, n, first_place)`` for every part and, last, for the whole review.

    One shuffle on (cell, term): the parts are columns of the aggregation, and the whole review is
    added up from them.
    """
    return long_counts(wide_counts(rows, cell, categories), cell, categories)


def joined_texts(parts: DataFrame, cell: Sequence[str] = CELL) -> DataFrame:
    """``(cell, joined_length, digest)`` of each cell's text, all parts in order joined by blanks,
    without building it.

    ``digest`` adds up 60 bits of each part's SHA-256, bound to its place, so it changes with any
    text and with their order; the aggregation combines map-side, however large a cell is.
    """
    bound = F.sha2(F.concat_ws(":", F.col("place").cast("string"), "text"), 256)
    piece = F.conv(F.substring(bound, 1, 15), 16, 10).cast("bigint")
    return parts.groupBy(*cell).agg(
        (F.sum(F.length("text")) + F.count(F.lit(1)) - 1).cast("bigint").alias("joined_length"), F.bit_xor(piece).alias("digest")
    )


def single_counts(rows: DataFrame, cell: Sequence[str]) -> DataFrame:
    """``(cell, term, n, first_place)`` where the text has one part only."""
    return rows.groupBy(*cell, "term").agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("first_place")
    )


def top_terms(counts: DataFrame, cell: Sequence[str] = (*CELL, "category"), k: int = TOP_REPORT) -> DataFrame:
    """``(cell, rank, term, n)``: most frequent first, ties in order of first appearance.

    Every partition first cuts its cells by count alone, ties kept, because a sort that compares
    places is dear; the full order is taken among the rest. Any assignment of rows to lanes gives the
    same result.
    """
    by_count = Window.partitionBy("_lane", *cell).orderBy(F.desc("n"))
    head = (
        counts.withColumn("_lane", F.spark_partition_id())
        .withColumn("_at", F.rank().over(by_count))
        .filter(F.col("_at") <= k)
        .drop("_lane", "_at")
    )
    ranked = top_k(head, cell, [F.desc("n"), F.asc("first_place")], k)
    return ranked.select(*cell, "rank", "term", "n")


def possible_top_rows(
    rows: DataFrame,
    cell: Sequence[str] = CELL,
    k: int = TOP_REPORT,
    categories: Sequence[str] = CATEGORIES,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The rows of those terms alone that can be among the first ``k`` of their cell in some category.

    A sketch counts hashes of terms instead of terms: every term of a bucket has at most the bucket's
    count. The terms of the ``2 * k`` fullest buckets are counted exactly; the ``k``-th largest of these
    counts is a bound that the ``k``-th term of the cell reaches at least. Buckets below it hold no term
    that could come in; ties at the bound stay. The sketch has at most ``buckets`` rows a cell and
    task, whatever the vocabulary is, and what remains to be counted are few terms.

    For cells with many terms, such as bigrams of large catalogues; ``rows`` are read three times, so
    they should come from a stored table or from stored tokens. Building the plan starts jobs. Where cells are so many that
    their chosen buckets are no small table, counting all terms at once is better.
    """
    spread = _in_buckets(rows, buckets)
    counted = stored(_long_sketch(sketch_counts(rows, cell, categories, buckets), cell, categories), "sketch")
    fullest = _fullest_buckets(counted, cell, 2 * k)
    first = term_counts(_of_buckets(spread, stored(fullest, "fullest-buckets"), [*cell, "_bucket"]), cell, categories)
    able = _able_buckets(counted, first, cell, k)
    return _of_buckets(spread, stored(able, "possible-buckets"), [*cell, "_bucket"]).drop("_bucket")


def sketch_counts(
    rows: DataFrame, cell: Sequence[str] = CELL, categories: Sequence[str] = CATEGORIES, buckets: int = BUCKETS
) -> DataFrame:
    """``(cell, _bucket, n_all, n_0, …)``: the counts of all terms of a hash bucket together.

    At most ``buckets`` rows a cell, and never more than its terms. Sketches add up (:func:`merge_counts`).
    While counting, the buckets of bigrams are numbered behind those of words, as keys without a string are looked up faster.
    """
    per_bucket = [F.count(F.lit(1)).alias("n_all")]
    per_bucket += [F.count(F.when((F.col("part") == i) & ~F.col("crosses"), 1)).alias(f"n_{i}") for i in range(len(categories) - 1)]
    spread, kind = _in_buckets(rows, buckets), F.col("term_kind")
    if "term_kind" not in cell:
        return spread.groupBy(*cell, "_bucket").agg(*per_bucket)
    behind = F.when(kind == "word", 0).when(kind == "bigram", buckets).otherwise(F.raise_error(F.lit("unknown kind of term")).cast("int"))
    counted = spread.withColumn("_bucket", F.col("_bucket") + behind).groupBy(*[c for c in cell if c != "term_kind"], "_bucket").agg(*per_bucket)
    is_word = F.col("_bucket") < buckets
    named = counted.withColumns({"term_kind": F.when(is_word, "word").otherwise("bigram"), "_bucket": F.when(is_word, F.col("_bucket")).otherwise(F.col("_bucket") - buckets)})
    return named.select(*cell, "_bucket", *[c for c in counted.columns if c.startswith("n_")])


def leading_counts(
    rows: DataFrame,
    sketch: DataFrame,
    cell: Sequence[str] = CELL,
    k: int = TOP_REPORT,
    categories: Sequence[str] = CATEGORIES,
    buckets: int = BUCKETS,
) -> DataFrame:
    """:func:`term_counts` of the terms that can be among the first ``k`` of their cell in some category.

    ``sketch`` are the :func:`sketch_counts` of ``rows``, however they were put together. The terms of the
    fullest buckets are counted exactly; the others are counted, by a second reading, only in buckets that
    reach the ``k``-th of these counts, which as a rule are none or few. A term has one bucket, so none is counted in part.
    Building the plan starts jobs.
    """
    key = [*cell, "_bucket"]
    spread = _in_buckets(rows, buckets)
    counted = stored(_long_sketch(sketch, cell, categories), "sketch")
    fullest = stored(_fullest_buckets(counted, cell, LEADING * k), "fullest-buckets")
    first = stored(term_counts(_of_buckets(spread, fullest, key), cell, categories), "leading-counts")
    able = _able_buckets(counted, first, cell, k)
    rest = stored(_of_buckets(able, fullest, key, "left_anti"), "possible-buckets")
    whole = F.xxhash64(*[c for c in cell if c != "term_kind"])  # what tokens have: a filter by it goes below their pairing
    found = [r[0] for r in rest.select(whole).distinct().limit(CELLS_NAMED + 1).collect()]
    if not found:
        return first
    if len(found) <= CELLS_NAMED:
        spread = spread.filter(whole.isin(*found))
    return first.unionByName(term_counts(_of_buckets(spread, rest, key), cell, categories))


def _in_buckets(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("_bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int"))


def _long_sketch(sketch: DataFrame, cell: Sequence[str], categories: Sequence[str]) -> DataFrame:
    """``(cell, _bucket, category, n)`` without zeros."""
    long = F.array(*[F.struct(F.lit(c).alias("category"), F.col(f"n_{s}").alias("n")) for c, s in zip(categories, [*range(len(categories) - 1), "all"])])
    return sketch.select(*cell, "_bucket", F.explode(long).alias("c")).select(*cell, "_bucket", "c.category", "c.n").filter("n > 0")


def _fullest_buckets(counted: DataFrame, cell: Sequence[str], k: int) -> DataFrame:
    by_category = [*cell, "category"]
    return top_k(counted, by_category, [F.desc("n"), F.asc("_bucket")], k).select(*cell, "_bucket").distinct()


def _able_buckets(counted: DataFrame, first: DataFrame, cell: Sequence[str], k: int) -> DataFrame:
    """Buckets that reach the ``k``-th of the exact counts ``first`` of their cell in some category."""
    by_category = [*cell, "category"]
    bound = top_k(first, by_category, [F.desc("n"), F.asc("first_place")], k).groupBy(*by_category).agg(
        F.when(F.count(F.lit(1)) == k, F.min("n")).otherwise(F.lit(1)).alias("_bound")
    )
    bound = bound.withColumnsRenamed({c: f"_{c}" for c in by_category})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by_category]
    return counted.join(bound, same).filter(F.col("n") >= F.col("_bound")).select(*cell, "_bucket").distinct()


def _of_buckets(rows: DataFrame, chosen: DataFrame, key: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows whose key is chosen, or is not with ``left_anti``; cells may have NULLs.

    Keys meet as one 64-bit hash, which is looked up at a fraction of the work. Where two keys had the same hash, the
    rows of both would be kept or left out as a whole: terms are counted that need not be, none in part and none twice.
    """
    chosen = chosen.select(F.xxhash64(*key).alias("_chosen"))
    return rows.join(chosen, F.xxhash64(*key) == F.col("_chosen"), how)


def cloud_terms(counts: DataFrame, cell: Sequence[str] = (*CELL, "category"), k: int = TOP_CLOUD) -> DataFrame:
    """Top terms with ``weight``: the count relative to the largest one of the cell (at most ``k`` rows)."""
    top = top_terms(counts, cell, k)
    largest = F.max("n").over(Window.partitionBy(*cell))
    return top.withColumn("weight", F.col("n") / largest)


def rating_counts(
    reviews: DataFrame,
    cell: Sequence[str] = ("catalog",),
    ratings: Sequence[int] = RATINGS,
    catalogs: DataFrame | None = None,
) -> DataFrame:
    """Number of reviews per rating; every rating appears for every catalogue, other ratings do not.

    ``catalogs`` names the catalogues, those without reviews too; left out, they are those of ``reviews``.
    Reviews are counted once by catalogue and rating; the grid is made from these few rows.
    """
    found = reviews.groupBy(*cell, "rating").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.array(*[F.struct(F.lit(r).cast("int").alias("rating"), F.lit(0).cast("bigint").alias("n")) for r in ratings])
    named = (found if catalogs is None else catalogs).select(*cell).distinct()
    zeros = named.select(*cell, F.explode(wanted).alias("z")).select(*cell, "z.rating", "z.n")
    counted = found.filter(F.col("rating").isin(*ratings)).select(*cell, F.col("rating").cast("int").alias("rating"), "n")
    return zeros.unionByName(counted).groupBy(*cell, "rating").agg(F.sum("n").alias("n"))


def rating_grid(
    catalogs: DataFrame,
    cell: Sequence[str] = ("catalog",),
    ratings: Sequence[int] = RATINGS,
    categories: Sequence[str] = CATEGORIES,
) -> DataFrame:
    """Every (catalogue, rating, category) cell, the empty ones included."""
    return (
        catalogs.select(*cell)
        .distinct()
        .withColumn("rating", _options(ratings, "int"))
        .withColumn("category", _options(categories, "string"))
    )


def fill_grid(grid: DataFrame, results: DataFrame, cell: Sequence[str] = (*CELL, "category")) -> DataFrame:
    """Results on the full grid; cells without any result keep one row of NULLs."""
    return grid.join(results, list(cell), "left")


def _options(values: Sequence, kind: str) -> Column:
    return F.explode(F.array(*[F.lit(v).cast(kind) for v in values]))


def _plus(rows: DataFrame, pos: Column) -> Column:
    """The place ``pos`` words behind that of the row."""
    if dict(rows.dtypes)["place"] == "bigint":
        return F.col("place") + pos
    return (F.col("place") + pos.cast("decimal(10,0)")).cast("decimal(38,0)")
