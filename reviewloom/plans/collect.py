"""Collecting products and reviews from captured pages, and the run over all catalogues.

Pages are captured outside Spark. Three tables come in:

* ``listings``  (catalog_link, page, html) - listing pages of a catalogue;
* ``products``  (product_article, html)    - product pages;
* ``feedbacks`` (product_article, variant_group, html) - the reviews of a product's own page.

Pages may be captured any number of times: of each product's pages the newest counts, by the column
``captured`` where the table has it, then by a digest of the page.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewloom.constants import MAX_PRODUCTS, MAX_REVIEWS, RUSSIAN_STOP_WORDS
from reviewloom.functions import keys, pages
from reviewloom.functions import text as tx
from reviewloom.operators import quota, relate, terms
from reviewloom.operators.filters import drop_unrated
from reviewloom.plans import growth
from reviewloom.plans.analyse import load_reviews, report_of
from reviewloom.session import ready_checkpoints, stored
from reviewloom.sources.reports import TERM_NAME, analysis_rows, newest, read_cloud, read_report, write_cloud, write_report
from reviewloom.sources.store import FeedbackStore

ANALYSIS_ORDER = ["term_kind", "catalog", "df_index", "column", "rank"]


def listed_links(listings: DataFrame, catalog: str, page: str, pattern: str, html: str = "html") -> DataFrame:
    """Links of listing pages: ``(catalog, position, link)``; ``position`` is ``(page, at)``, which sorts in listing order."""
    links = listings.select(
        catalog, page, F.posexplode(pages.all_fields(F.col(html), pattern)).alias("at", "link")
    )
    return links.select(catalog, F.struct(F.col(page).cast("bigint").alias("page"), "at").alias("position"), "link")


def candidates(links: DataFrame, catalog: str, pattern: str = keys.ARTICLE_IN_LINK) -> DataFrame:
    """Links that name a product: ``(catalog, product_article, position)``."""
    found = links.withColumn("product_article", keys.article_or_null(F.col("link"), pattern))
    return found.filter(F.col("product_article").isNotNull()).select(catalog, "product_article", "position")


def rejected(links: DataFrame, pattern: str = keys.ARTICLE_IN_LINK) -> DataFrame:
    """Links without a product article."""
    return links.filter(keys.article_or_null(F.col("link"), pattern).isNull())


def capture_mark(captured: DataFrame) -> Column:
    """What orders the captures of a page: ``captured``, if the table has it, then a digest of the page."""
    at = [F.col("captured").cast("bigint").alias("at")] if "captured" in captured.columns else []
    return F.struct(*at, F.xxhash64("html").alias("digest"))


def product_rows(captured: DataFrame, patterns: pages.PagePatterns = pages.SHOP_PAGES) -> DataFrame:
    """Rated products of captured pages: ``(product_article, name, rating, price)``; absent fields are NULL.

    One row a product, of its newest page; a product whose newest page has no rating is left out. Pages
    are read first, so that only their fields are shuffled.
    """
    html = F.col("html")
    fields = captured.select(capture_mark(captured).alias("mark"), pages.readable(html).alias("html")).select(
        pages.text_field(html, patterns.article).try_cast("bigint").alias("product_article"),
        "mark",
        pages.text_field(html, patterns.title).alias("name"),
        pages.text_field(html, patterns.rating).alias("product_rating"),
        pages.text_field(html, patterns.price).alias("price"),
    )
    newest = fields.groupBy("product_article").agg(F.max(F.struct("mark", "name", "product_rating", "price")).alias("p")).select("product_article", "p.*")
    return drop_unrated(newest).select(
        "product_article", "name", keys.decimal_comma(F.col("product_rating")).alias("rating"), "price"
    )


def review_rows(captured: DataFrame, patterns: pages.PagePatterns = pages.SHOP_PAGES) -> DataFrame:
    """Reviews of captured pages: ``(product_article, variant_group, review_pos, rating, pros, cons, text_all, parts…)``.

    Only items of the page's review lists that hold a readable rating are reviews; lists inside a
    review are part of it. ``pros`` and ``cons`` are the page's own blocks, NULL where it has none.
    """
    lists = pages.all_fields(pages.readable(F.col("html")), patterns.review_list)
    listed = F.flatten(F.transform(lists, lambda x: pages.all_fields(x, patterns.review_item)))
    items = captured.select("product_article", "variant_group", F.posexplode(listed).alias("review_pos", "item"))
    read = items.select(
        "product_article",
        "variant_group",
        F.col("review_pos").cast("bigint").alias("review_pos"),
        pages.last_digit(pages.field(F.col("item"), patterns.review_stars)).alias("rating"),
        pages.text_field(F.col("item"), patterns.review_plus).alias("pros"),
        pages.text_field(F.col("item"), patterns.review_minus).alias("cons"),
        pages.text_field(F.col("item"), patterns.review_text).alias("_text"),
    )
    return with_captured_parts(read.filter(F.col("rating").isNotNull()), "_text")


def with_captured_parts(reviews: DataFrame, text: str) -> DataFrame:
    """``text_all`` and its parts; an unreadable (NULL) text is empty and misses every part."""
    parts = tx.split_captured_review(F.col(text), F.col(text).isNull())
    return (
        reviews.withColumn("_parts", parts)
        .withColumn("text_all", tx.text_or_empty(F.col(text)))
        .select(*[c for c in reviews.columns if c != text], "text_all", "_parts.*")
    )


def scope_key(article: str, variant_group: str) -> Column:
    """What products are pooled by: the variant group, or the product itself where it has none."""
    alone = F.when(F.col(variant_group).isNull(), F.col(article))
    return F.struct(F.col(variant_group).alias("variant_group"), alone.alias("alone"))


def needed_pages(feedbacks: DataFrame, picks: DataFrame) -> DataFrame:
    """The newest feedback page of each picked product and of its variants, before anything is parsed.

    A product belongs to the variant group that its newest page names. Marks alone decide which pages
    these are, and are stored, as building the result starts jobs: pages are cut down to the wanted ones
    before any page is shuffled. Captures that are equal are combined before the shuffle, so a page captured
    very often is spread like any other.
    """
    marked = feedbacks.withColumn("_mark", F.struct(capture_mark(feedbacks), F.col("variant_group").alias("group")))
    newest = stored(marked.groupBy("product_article").agg(F.max("_mark").alias("_mark")), "newest-pages")
    placed = newest.select("product_article", F.col("_mark.group").alias("variant_group"))
    groups = placed.join(picks.select("product_article").distinct(), "product_article", "left_semi").select("variant_group").distinct()
    variants = placed.join(groups, "variant_group", "left_semi").select("product_article")
    articles = variants.unionByName(picks.select("product_article")).distinct()
    wanted = stored(newest.join(articles, "product_article"), "wanted-pages")
    same = (marked["product_article"] == wanted["product_article"]) & marked["_mark"].eqNullSafe(wanted["_mark"])
    once = marked.join(wanted, same, "left_semi").dropDuplicates(["product_article", "_mark"])
    return once.select("product_article", "variant_group", "html")


def members_of(shown: DataFrame, patterns: pages.PagePatterns = pages.SHOP_PAGES) -> DataFrame:
    """``(product_article, variant_group, own_count)`` of the pages: the count that the page itself names."""
    return shown.select("product_article", "variant_group", pages.own_count(pages.readable(F.col("html")), patterns).alias("own_count"))


def collected(
    products: DataFrame,
    reviews: DataFrame,
    picks: DataFrame,
    max_reviews: int = MAX_REVIEWS,
    members: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """New product and review rows, not numbered yet.

    ``picks`` (catalog_id, product_article, position) says which products are collected. The
    reviews of a product are its own, or those of all its variants when it has few or none.
    ``members`` (product_article, variant_group) also names products without reviews, and with
    ``own_count`` says how many reviews of its own a product has; left out, those with reviews are known
    and the captured ones counted. A product without a variant group is a group of its own. Picked
    products and their reviews are checkpointed, so pages are read once for the counts, the numbering
    and the store.
    """
    ready_checkpoints(reviews.sparkSession)
    rated = picks.join(products, "product_article").checkpoint()
    key = scope_key("product_article", "variant_group")
    known = reviews if members is None else members
    counted = [c for c in ("own_count",) if c in known.columns]
    known = known.select("product_article", key.alias("_group"), *counted).distinct()
    grouped = reviews.withColumn("_group", key).drop("variant_group")
    shown = relate.reviews_in_scope(grouped, "product_article", "_group", ["product_article", "review_pos"], max_reviews, known)
    taken = shown.join(rated.select("product_article", "catalog_id", "position"), "product_article").checkpoint()
    counted = relate.review_counts(taken, cap=max_reviews)
    new_products = rated.join(counted, "product_article", "left").withColumn(
        "count_reviews", F.coalesce("count_reviews", F.lit(0))
    )
    return new_products, taken


def store_collected(store: FeedbackStore, new_products: DataFrame, new_reviews: DataFrame) -> None:
    """Append reviews, then products. Rows of products that are stored already are left out, so a
    run that was broken off between the two writes can be repeated. Catalogues that get products are
    open for analysis again, from before the first write."""
    order = ["catalog_id", "position", "product_article"]
    store.reopen(new_products.select("catalog_id").distinct())
    reviews = relate.unseen(new_reviews, store.read("reviews"))
    store.append_numbered("reviews", reviews, "review_id", [*order, "rank"])
    products = relate.unseen(new_products, store.read("products"))
    store.append_numbered("products", products, "product_id", order)


def collect_catalogs(
    store: FeedbackStore,
    listings: DataFrame,
    products: DataFrame,
    feedbacks: DataFrame,
    links: DataFrame,
    patterns: pages.PagePatterns = pages.SHOP_PAGES,
    max_products: int = MAX_PRODUCTS,
    max_reviews: int = MAX_REVIEWS,
) -> DataFrame:
    """Collect the catalogues in ``links`` (catalog_link, link_order) from captured pages.

    Catalogues get their ids, and with them their precedence, in link order. Returns the progress.
    """
    store.create()
    store.register_catalogs(links)
    listings = listings.join(links.select("catalog_link").distinct(), "catalog_link", "left_semi")
    catalogs = store.read("catalogs").groupBy("catalog_link").agg(F.min("catalog_id").alias("catalog_id"))
    listed = listings.join(catalogs, "catalog_link")
    found = candidates(listed_links(listed, "catalog_id", "page", patterns.link), "catalog_id")
    picks = quota.select_new_products(found, store.read("products"), target=max_products)
    shown = stored(needed_pages(feedbacks, picks), "shown-pages")
    new_products, new_reviews = collected(
        product_rows(products, patterns), review_rows(shown, patterns), picks, max_reviews, members_of(shown, patterns)
    )
    store_collected(store, new_products, new_reviews)
    touched = listed.select("catalog_id").distinct()
    store.flag_catalogs(touched, "collected")
    return relate.collection_progress(store.read("catalogs"), store.read("products"), max_products)


def analyse_catalogs(
    store: FeedbackStore,
    results: str,
    stop_words: Iterable[str] = RUSSIAN_STOP_WORDS,
    links: DataFrame | None = None,
) -> None:
    """Analyse the catalogues in ``links`` (catalog_link), or all, as far as they are not analysed or have grown since.

    ``<results>/cloud`` holds the top terms with weights, ``<results>/report`` its first ranks on the
    full grid of catalogue, rating and category (empty cells have a row of NULLs), and
    ``<results>/rating_counts`` the reviews per rating, 0 included; the ``analysis`` table has the
    reports of all catalogues. What was counted is kept (:mod:`reviewloom.plans.growth`), so a run reads
    the texts of new reviews alone and writes the cells that they touch; a cell's newest run is valid,
    and any number of runs gives what one run over all reviews would. A run's files and ``analysis`` rows
    carry the number of the catalogue version that sets its flags; they count from when that version is
    written, last, and a run that broke off before is simply overwritten by the next.
    """
    open_catalogs = store.read("catalogs").filter("NOT coalesce(analyzed, false)")
    if links is not None:
        open_catalogs = open_catalogs.join(links.select("catalog_link").distinct(), "catalog_link", "left_semi")
    ready_checkpoints(store.spark)
    catalogs = open_catalogs.checkpoint()
    if catalogs.isEmpty():
        return
    number = store.next_version("catalogs")
    run = f"run={number}"
    runs = [*store.finished_runs(), number]
    loaded = load_reviews(catalogs, store.read("products"), store.read("reviews"))
    grown = growth.count_growth(loaded, catalogs.select(F.col("catalog_id").alias("catalog")), results, number, runs[:-1], stop_words)

    def linked(frame: DataFrame) -> DataFrame:
        return relate.with_catalog_link(frame.withColumnRenamed("catalog", "catalog_id"), catalogs)

    spine = catalogs.select(F.col("catalog_id").alias("catalog"))
    linked(terms.rating_counts(loaded, catalogs=spine)).write.mode("overwrite").parquet(f"{results}/rating_counts/{run}")
    write_cloud(linked(grown.cloud), f"{results}/cloud/{run}")
    clouds = read_cloud(store.spark, f"{results}/cloud/{run}")
    kinds = F.explode(F.array(*[F.lit(k) for k in TERM_NAME])).alias("term_kind")
    touched = linked(grown.cells)
    grid = terms.rating_grid(catalogs.select(F.col("catalog_link").alias("catalog"))).join(touched, list(terms.CELL), "left_semi").select("*", kinds)
    full = terms.fill_grid(grid, report_of(clouds), (*terms.CELL, "category", "term_kind"))
    write_report(full, f"{results}/report/{run}")
    report = read_report(store.spark, f"{results}/report", runs).filter(F.col("term").isNotNull())
    rows = analysis_rows(report, keep=("catalog", "rank", "term_kind"))
    store.replace("analysis", relate.with_new_ids(rows, ANALYSIS_ORDER, "id"), number)
    store.flag_catalogs(catalogs.select("catalog_id"), "analyzed")


def read_rating_counts(store: FeedbackStore, results: str) -> DataFrame:
    """Reviews per catalogue and rating, as each catalogue's newest finished analysis counted them."""
    return newest(store.spark.read.parquet(f"{results}/rating_counts"), ["catalog"], store.finished_runs())
