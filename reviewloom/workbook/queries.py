"""Every operator and job as a query over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from reviewloom.constants import TOP_CLOUD, TOP_REPORT, UNRATED
from reviewloom.functions import keys, pages
from reviewloom.functions import text as tx
from reviewloom.operators import dedup, filters, ordering, quota, relate, terms
from reviewloom.plans import analyse, collect
from reviewloom.plans.clean import Cleaned, clean_catalogs, clean_tree
from reviewloom.schemas import PROCESSED_REVIEW_CSV
from reviewloom.session import freed_shuffles, scratch_path, stored
from reviewloom.sources import csv_tree, reports
from reviewloom.sources.store import FeedbackStore
from reviewloom.streaming import ingest
from reviewloom.workbook import tables as t
from reviewloom.workbook.tables import STOP_WORDS

#: Text of a captured file, about.
CAPTURED_FILE_BYTES = 64 << 20
CATEGORY_CELL = ["catalog", "rating", "category"]
PAGE_PATTERNS = pages.PagePatterns(
    link=r'href="([^"]+)"', title=r"(?s)<h1>(.*?)</h1>", review_item=r"(?s)<p>(.*?)</p>"
)


# -- words and bigrams --------------------------------------------------------------------------

def _one_part_words(reviews: DataFrame) -> DataFrame:
    parts = terms.review_parts(reviews, ["catalog"], ["text"])
    return terms.single_counts(terms.word_rows(parts, ["catalog"], STOP_WORDS), ["catalog"])


def _one_part_bigrams(reviews: DataFrame) -> DataFrame:
    return analyse.one_part_bigram_counts(reviews, ["catalog"], "text", STOP_WORDS, first=TOP_REPORT)


def top_words_by_lang(spark: SparkSession, folder: str) -> DataFrame:
    return terms.top_terms(_one_part_words(t.documents(spark, folder)), ["catalog"])


def top_words_by_role(spark: SparkSession, folder: str) -> DataFrame:
    return terms.top_terms(_one_part_words(t.conversations(spark, folder)), ["catalog"])


def top_words_rating_category(spark: SparkSession, folder: str) -> DataFrame:
    return terms.top_terms(analyse.word_counts(t.reviews(spark, folder), STOP_WORDS))


def top_bigrams_by_lang(spark: SparkSession, folder: str) -> DataFrame:
    return terms.top_terms(_one_part_bigrams(t.documents(spark, folder)), ["catalog"])


def top_bigrams_by_role(spark: SparkSession, folder: str) -> DataFrame:
    return terms.top_terms(_one_part_bigrams(t.conversations(spark, folder)), ["catalog"])


def top_bigrams_rating_category(spark: SparkSession, folder: str) -> DataFrame:
    return terms.top_terms(analyse.bigram_counts(t.reviews(spark, folder), STOP_WORDS, first=TOP_REPORT))


def sketched_top_bigrams(spark: SparkSession, folder: str) -> DataFrame:
    """The same list as ``top_bigrams_rating_category``, counting only bigrams that a sketch does not rule out."""
    return analyse.top_bigrams_of_large_cells(t.reviews(spark, folder), STOP_WORDS)


def top_bigrams_within_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return terms.top_terms(analyse.bigram_counts(t.reviews(spark, folder), STOP_WORDS, cross_review=False, first=TOP_REPORT))


def word_cloud_weights(spark: SparkSession, folder: str) -> DataFrame:
    return terms.cloud_terms(analyse.word_counts(t.reviews(spark, folder), STOP_WORDS)).withColumn(
        "weight", F.round("weight", 9)
    )


def bigram_cloud_weights(spark: SparkSession, folder: str) -> DataFrame:
    return terms.cloud_terms(analyse.bigram_counts(t.reviews(spark, folder), STOP_WORDS, first=TOP_CLOUD)).withColumn(
        "weight", F.round("weight", 9)
    )


def word_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    return analyse.word_counts(t.reviews(spark, folder), STOP_WORDS).select(*CATEGORY_CELL, "term", "n")


def bigram_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    return analyse.bigram_counts(t.reviews(spark, folder), STOP_WORDS).select(*CATEGORY_CELL, "term", "n")


def rating_counts_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Languages as catalogues, and roles, which have no reviews here."""
    roles = t.table(spark, folder, "conversations").select(F.col("role").alias("catalog"))
    reviews = t.reviews(spark, folder)
    return terms.rating_counts(reviews, catalogs=roles.unionByName(reviews.select("catalog")).filter("catalog IS NOT NULL"))


def report_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews by catalogue = source: many of the cells are empty and still present."""
    reviews = t.reviews(spark, folder).withColumn("catalog", F.concat("catalog", F.lit("/"), F.col("product_id").cast("string")))
    top = terms.top_terms(analyse.word_counts(reviews, STOP_WORDS), k=3)
    return terms.fill_grid(terms.rating_grid(reviews), top)


# -- text functions -----------------------------------------------------------------------------

def split_review_parts(spark: SparkSession, folder: str) -> DataFrame:
    return t.labelled(spark, folder).select("review_id", tx.split_review(F.col("text")).alias("p")).select("review_id", "p.*")


def split_unreadable_default(spark: SparkSession, folder: str) -> DataFrame:
    marked = t.labelled(spark, folder).withColumn("text", F.when(F.col("review_id") % 5 != 0, F.col("text")))
    return collect.with_captured_parts(marked.select("review_id", "text"), "text")


def preprocess_reviews(spark: SparkSession, folder: str) -> DataFrame:
    stale = t.labelled(spark, folder).select(
        "review_id",
        F.col("text").alias("review_text"),
        F.lit(None).cast("string").alias("review_text_plus"),
        F.lit(None).cast("string").alias("review_text_minus"),
    )
    return filters.with_parts(stale)


def normalised_text(spark: SparkSession, folder: str) -> DataFrame:
    return t.documents(spark, folder).select("review_id", tx.clean_text(F.col("text")).alias("clean"))


def token_positions(spark: SparkSession, folder: str) -> DataFrame:
    return t.documents(spark, folder).select(
        "review_id", F.posexplode(tx.tokens(tx.clean_text(F.col("text")))).alias("pos", "token")
    )


def stop_words_removed(spark: SparkSession, folder: str) -> DataFrame:
    words = tx.drop_stop_words(tx.clean_tokens(F.col("text")), STOP_WORDS)
    return t.documents(spark, folder).select("review_id", tx.join_tokens(words).alias("content"))


def review_bigrams(spark: SparkSession, folder: str) -> DataFrame:
    words = tx.drop_stop_words(tx.clean_tokens(F.col("text")), STOP_WORDS)
    return t.conversations(spark, folder).select(
        "product_id", "review_id", F.posexplode(tx.inner_bigrams(words)).alias("pos", "bigram")
    )


def ordered_concatenation(spark: SparkSession, folder: str) -> DataFrame:
    """Length and order-bound digest of the joined text of every cell, without joining it."""
    return terms.joined_texts(terms.review_parts(t.reviews(spark, folder)))


def rated_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as reviews with ratings 0 to 6 and NULL; 1 to 5 stay."""
    mark = F.pmod("o_orderkey", F.lit(8)).cast("int")
    orders = t.table(spark, folder, "orders").select("o_orderkey", F.when(mark < 7, mark).alias("rating"))
    return filters.rated_reviews(orders)


def null_parts_dropped(spark: SparkSession, folder: str) -> DataFrame:
    """Review parts of orders, of which one is always and one is often NULL."""
    orders = t.shop(spark, folder)[2].withColumn("text_plus", F.when(F.col("review_id") % 3 > 0, F.col("text_plus")))
    placed = orders.select(F.lit("all").alias("catalog"), F.col("product_article").alias("product_id"), "*")
    return terms.review_parts(placed).groupBy("rating", "part").agg(F.count(F.lit(1)).alias("n"))


# -- cleaning -----------------------------------------------------------------------------------

def _rated_documents(spark: SparkSession, folder: str) -> DataFrame:
    marks = t.table(spark, folder, "labels").select("doc_id", "quality", "toxic")
    rating = (
        F.when(F.col("quality") == 0, F.lit(UNRATED))
        .when(F.col("quality").isNotNull(), F.concat(F.lit("4,"), F.col("toxic").cast("string")))
    )
    return (
        t.table(spark, folder, "documents").select("doc_id", "n_chars")
        .join(marks, "doc_id", "left")
        .select("doc_id", rating.alias("product_rating"), (F.col("n_chars") % 3).alias("count_reviews"))
    )


def drop_unrated(spark: SparkSession, folder: str) -> DataFrame:
    return filters.drop_unrated(_rated_documents(spark, folder))


def drop_without_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return filters.drop_without_reviews(filters.drop_unrated(_rated_documents(spark, folder)))


def decimal_comma(spark: SparkSession, folder: str) -> DataFrame:
    return _rated_documents(spark, folder).select("doc_id", keys.decimal_comma(F.col("product_rating")).alias("rating"))


def _identical_sets(spark: SparkSession, folder: str) -> DataFrame:
    lines = t.document_lines(spark, folder)
    listing = t.table(spark, folder, "documents").select(
        F.col("lang").alias("catalog"), F.col("doc_id").alias("product_article"), F.col("doc_id").alias("listed")
    )
    return dedup.review_set_groups(listing, lines, ["catalog"], "product_article", "listed", "review_pos", ["line"])


def identical_review_sets(spark: SparkSession, folder: str) -> DataFrame:
    return _identical_sets(spark, folder)


def dedup_catalog(spark: SparkSession, folder: str) -> DataFrame:
    dropped = _identical_sets(spark, folder).filter("product_article <> kept").select("product_article")
    catalog = t.table(spark, folder, "documents").select(
        F.col("doc_id").alias("product_article"), F.col("lang").alias("catalog"), "source", "n_chars"
    )
    return dedup.drop_keys(catalog, dropped, ["product_article"])


def _cleaned(spark: SparkSession, folder: str) -> Cleaned:
    """Documents as products: rating and review count of the catalogue, lines as reviews, one file each."""
    languages = t.table(spark, folder, "documents").select("doc_id", F.col("lang").alias("catalog"))
    catalogs = _rated_documents(spark, folder).join(languages, "doc_id").withColumnRenamed("doc_id", "product_article")
    reviews = t.document_lines(spark, folder).select(
        "catalog",
        "product_article",
        "review_pos",
        (F.length("line") % 5 + 1).alias("review_rating"),
        F.col("line").alias("review_text"),
        F.lit(None).cast("string").alias("review_text_plus"),
        F.lit(None).cast("string").alias("review_text_minus"),
    )
    files = languages.select(
        "catalog", F.col("doc_id").alias("product_article"), F.concat(F.col("doc_id").cast("string"), F.lit(".csv")).alias("file_name")
    )
    return clean_catalogs(catalogs, reviews, files)


def clean_catalog_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder).catalogs


def clean_review_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(spark, folder).reviews.select("catalog", "product_article", "review_pos", "review_rating", "review_text")


# -- relations ----------------------------------------------------------------------------------

def load_catalog_reviews(spark: SparkSession, folder: str) -> DataFrame:
    catalogs, products, orders = t.shop(spark, folder)
    return relate.with_catalog_link(relate.catalog_reviews(catalogs, products, orders), catalogs)


def analysis_projection(spark: SparkSession, folder: str) -> DataFrame:
    return filters.analysis_columns(t.shop(spark, folder)[2])


def catalog_id_of_link(spark: SparkSession, folder: str) -> DataFrame:
    catalogs = t.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("catalog_id"), F.col("c_mktsegment").alias("catalog_link")
    )
    hit = filters.catalog_id_of_link(catalogs, "BUILDING").withColumn("link", F.lit("BUILDING"))
    return hit.unionByName(filters.catalog_id_of_link(catalogs, "absent").withColumn("link", F.lit("absent")))


def articles_of_catalog(spark: SparkSession, folder: str) -> DataFrame:
    return filters.articles_of_catalog(t.shop(spark, folder)[1], 7)


def reviews_of_article(spark: SparkSession, folder: str) -> DataFrame:
    orders = t.shop(spark, folder)[2]
    either = filters.reviews_of_article(orders, 20).withColumn("asked", F.lit("any"))
    return either.unionByName(filters.reviews_of_article(orders, 20, 5).withColumn("asked", F.lit("5"))).select(
        "asked", "review_id", "rating"
    )


def product_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as catalogues and their orders as products: many customers have none."""
    catalogs = t.table(spark, folder, "customer").select(F.col("c_custkey").alias("catalog_id"))
    return relate.product_counts(catalogs, t.table(spark, folder, "orders").select(F.col("o_custkey").alias("catalog_id")))


def product_count(spark: SparkSession, folder: str) -> DataFrame:
    products = t.shop(spark, folder)[1]
    known = relate.product_count(products, 7).withColumn("asked", F.lit("7"))
    return known.unionByName(relate.product_count(products, None).withColumn("asked", F.lit("unknown")))


def collection_progress(spark: SparkSession, folder: str) -> DataFrame:
    catalogs, products, _ = t.shop(spark, folder)
    return relate.collection_progress(catalogs, products, target=60)


def review_counts(spark: SparkSession, folder: str) -> DataFrame:
    return relate.review_counts(t.shop(spark, folder)[2], cap=12)


def value_profile(spark: SparkSession, folder: str) -> DataFrame:
    return filters.value_profile(_rated_documents(spark, folder), "product_rating")


def preview(spark: SparkSession, folder: str) -> DataFrame:
    return filters.preview(t.shop(spark, folder)[1], ["product_id"])


def union_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and turns as one table of reviews; turns have no rating."""
    documents = t.documents(spark, folder).withColumn("rating", F.pmod("review_id", F.lit(5)).cast("int"))
    return filters.union_reviews(documents, t.conversations(spark, folder))


def unseen_products(spark: SparkSession, folder: str) -> DataFrame:
    listings, stored = t.part_listings(spark, folder)
    return relate.unseen(listings.select("product_article").distinct(), stored)


def stored_products(spark: SparkSession, folder: str) -> DataFrame:
    listings, stored = t.part_listings(spark, folder)
    return relate.stored(listings.select("product_article").distinct(), stored)


def quota_selection(spark: SparkSession, folder: str) -> DataFrame:
    listings, stored = t.part_listings(spark, folder)
    return quota.select_new_products(listings, stored, target=30)


def cap_reviews(spark: SparkSession, folder: str) -> DataFrame:
    lines = t.table(spark, folder, "lineitem").select("l_partkey", *t.LINE_ORDER)
    return relate.first_reviews(lines, ["l_partkey"], t.LINE_ORDER, 25)


def cap_turns(spark: SparkSession, folder: str) -> DataFrame:
    turns = t.conversations(spark, folder)
    return relate.first_reviews(turns, ["product_id"], ["review_id"], 3).select("product_id", "review_id", "rank", "text")


def adaptive_scope(spark: SparkSession, folder: str) -> DataFrame:
    """All parts show reviews, those without order lines the pooled ones of their brand."""
    members = t.table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    shown = relate.reviews_in_scope(t.part_lines(spark, folder), "l_partkey", "p_brand", [*t.LINE_ORDER], members=members)
    return shown.select("l_partkey", "p_brand", "scope", "rank", "reviewed_article", "l_orderkey", "l_linenumber")


def integrity_report(spark: SparkSession, folder: str) -> DataFrame:
    named = {name: t.table(spark, folder, name) for name in ("orders", "labels", "conversations", "lineitem", "documents")}
    named["rated"] = _rated_documents(spark, folder)
    return relate.integrity_report(
        named,
        unique={"orders": ["o_orderkey"], "conversations": ["conv_id"], "labels": ["doc_id"]},
        not_null={"rated": ["product_rating"], "lineitem": ["l_orderkey"]},
        references=[("documents", "doc_id", "labels", "doc_id"), ("labels", "doc_id", "documents", "doc_id")],
    )


def flag_update(spark: SparkSession, folder: str) -> DataFrame:
    catalogs = t.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("catalog_id"), (F.col("o_orderstatus") == "F").alias("collected")
    )
    ids = t.table(spark, folder, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("catalog_id"))
    return relate.set_flag(catalogs, ids, "collected", True)


def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    stored = t.table(spark, folder, "part").select(F.col("p_partkey").alias("review_id"))
    new = t.table(spark, folder, "orders").select("o_custkey", "o_orderkey")
    return relate.with_new_ids(new, ["o_custkey", "o_orderkey"], "review_id", stored)


def dense_positions(spark: SparkSession, folder: str) -> DataFrame:
    orders = t.table(spark, folder, "orders").select("o_orderpriority", "o_orderkey")
    return ordering.dense_positions(orders, ["o_orderpriority"], ["o_orderkey"])


# -- keys and pages -----------------------------------------------------------------------------

def page_keys(spark: SparkSession, folder: str) -> DataFrame:
    url = F.col("url")
    article = keys.article_or_null(url, r"/(\d+)")
    return t.table(spark, folder, "pages").select(
        "page_id",
        keys.article_from_link(url, r"/(\d+)").alias("article"),
        keys.article_or_null(url, r"page=(\d+)").alias("page"),
        keys.result_slug(url, "https://").alias("slug"),
        keys.file_slug(url, "http://").alias("file_slug"),
        keys.key_from_file_name(F.concat(F.lit("reviews/shoes/"), F.col("page_id").cast("string"), F.lit(".csv"))).alias("file_key"),
        keys.listing_page_link(url, F.col("page_id")).alias("listing_link"),
        keys.feedback_page_link(article, "https://shop.example").alias("feedback_link"),
    )


def cell_titles(spark: SparkSession, folder: str) -> DataFrame:
    grid = terms.rating_grid(t.documents(spark, folder))
    return grid.select("catalog", keys.cell_title(F.col("category"), F.col("rating")).alias("title"))


def page_fields(spark: SparkSession, folder: str) -> DataFrame:
    html = F.col("html")
    return t.table(spark, folder, "pages").select(
        "page_id",
        pages.text_field(html, PAGE_PATTERNS.title).alias("title"),
        pages.field(html, r'<html lang="([a-z]+)"').alias("lang"),
        pages.text_field(html, PAGE_PATTERNS.price).alias("price"),
        pages.last_digit(keys.result_slug(F.regexp_extract("url", r"^[^?#]*", 0))).alias("last_digit"),
    )


def page_links(spark: SparkSession, folder: str) -> DataFrame:
    captured = t.table(spark, folder, "pages").withColumn("site", F.regexp_extract("url", "//([^/]+)/", 1))
    links = collect.listed_links(captured, "site", "page_id", PAGE_PATTERNS.link)
    return links.select("site", "position.page", "position.at", "link")


def links_without_article(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses of pages that name no further page."""
    links = t.table(spark, folder, "pages").select("page_id", F.col("url").alias("link"))
    return collect.rejected(links, r"page=(\d+)")


def page_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Paragraphs of pages as captured reviews; an empty paragraph counts as unreadable."""
    items = t.table(spark, folder, "pages").select(
        "page_id", F.posexplode(pages.all_fields(F.col("html"), PAGE_PATTERNS.review_item)).alias("review_pos", "item")
    )
    read = items.select("page_id", "review_pos", F.nullif(pages.visible_text(F.col("item")), F.lit("")).alias("text"))
    return collect.with_captured_parts(read, "text")


def crawl_frontier(spark: SparkSession, folder: str) -> DataFrame:
    """New products of every site: pages as listing entries, parts as stored products."""
    entries = t.table(spark, folder, "pages").select(
        F.regexp_extract("url", "//([^/]+)/", 1).alias("site"), F.col("page_id").alias("position"), F.col("url").alias("link")
    )
    stored = t.table(spark, folder, "part").filter("p_partkey % 7 = 0").select(
        F.col("p_partkey").alias("product_article"), F.lit("www.example.com").alias("site")
    )
    found = collect.candidates(entries, "site", r"/(\d+)")
    return quota.select_new_products(found, stored, "site", target=5)


def nested_page_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Paragraphs of pages as reviews that have lists and blocks of their own inside, read by their elements.

    Each paragraph is an item of a review list, in front of the page itself with its other lists.
    """
    before = (
        '<li class="comments__item"><ul class="photos"><li><img alt="</ul>"/></li><li>2</li></ul><span class="stars-line star4"></span>'
        '<div class="feedback__content"><div class="name"><div>Комментарий:</div></div> '
    )
    after = " <!-- </div> --></div><div>no part of it</div></li>"
    found = pages.all_fields(F.col("html"), PAGE_PATTERNS.review_item)
    items = F.array_join(F.transform(found, lambda p: F.concat(F.lit(before), p, F.lit(after))), "\n")
    listed = F.concat(F.lit('<ul class="other"><li>no</li></ul><ul class="comments__list">'), items, F.lit("</ul><li>after</li>"), "html")
    captured = t.table(spark, folder, "pages").select(
        F.col("page_id").alias("product_article"), F.lit(None).cast("bigint").alias("variant_group"), listed.alias("html")
    )
    read = collect.review_rows(captured)
    return read.select(F.col("product_article").alias("page_id"), "review_pos", "rating", "text_all", "text_comment")


def collect_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Collect products from pages into a store: site = catalogue, heading = name, paragraphs = reviews.

    Every page of an article is a capture of it, and comes one to three times; the one with the largest
    id is the newest. Three quarters of the articles have variants.
    """
    captured = t.table(spark, folder, "pages").select(
        F.regexp_extract("url", "//([^/]+)/", 1).alias("catalog_link"),
        "page_id",
        keys.article_or_null(F.col("url"), r"/(\d+)").alias("product_article"),
        "html",
    )
    listings = captured.select(
        "catalog_link", F.col("page_id").alias("page"), F.format_string('<a href="/catalog/%d/">', "product_article").alias("html")
    )
    times = F.explode(F.sequence(F.lit(0), F.col("page_id") % 3))
    pages_of = captured.withColumn("time", times).withColumnRenamed("page_id", "captured").drop("time")
    mark = F.format_string('<span id="productNmId">%d</span><b class="rating">4,%d</b>', "product_article", F.col("captured") % 10)
    products = pages_of.select("product_article", "captured", F.concat(mark, "html").alias("html"))
    starred = F.regexp_replace("html", "<p>", '<p><i class="stars-line star3"></i>')
    variants = F.when(F.col("product_article") % 4 > 0, F.col("product_article") % 40)
    feedbacks = pages_of.select("product_article", "captured", variants.cast("bigint").alias("variant_group"), starred.alias("html"))
    links = captured.groupBy("catalog_link").agg(F.min("page_id").alias("link_order"))
    patterns = pages.PagePatterns(
        link=r'href="([^"]+)"',
        title=PAGE_PATTERNS.title,
        rating=r'<b class="rating">(.*?)</b>',
        review_list=r"(?s)^(.*)$",
        review_item=PAGE_PATTERNS.review_item,
        review_text=r"(?s)^(.*)$",
        review_stars=r'<i class="(stars-line[^"]*)"',
    )
    store = FeedbackStore(spark, scratch_path(spark, "shop"))
    collect.collect_catalogs(store, listings, products, feedbacks, links, patterns, max_products=3, max_reviews=8)
    stored = store.read("products").select(
        "product_id", "product_article", "catalog_id", "name", F.col("rating").alias("product_rating"), "count_reviews"
    )
    flags = store.read("catalogs").select("catalog_id", "catalog_link", "collected", "analyzed")
    return stored.join(flags, "catalog_id").join(
        store.read("reviews").select("review_id", "product_article", "rating", "text_all"), "product_article", "left"
    )


# -- sources and sinks --------------------------------------------------------------------------

def csv_roundtrip_multiline(spark: SparkSession, folder: str) -> DataFrame:
    turns = t.conversations(spark, folder).withColumn("product_article", F.floor(F.col("product_id") / 100))
    key = ["catalog", "product_article"]
    placed = ordering.dense_positions(turns, key, ["product_id", "review_id"], "review_pos")
    reviews = placed.select(
        *key,
        "review_pos",
        F.col("review_id").cast("int").alias("review_rating"),
        F.col("text").alias("review_text"),
        F.when(F.col("review_id") == 0, F.lit("")).alias("review_text_plus"),
        F.concat(F.lit(' "'), F.col("catalog"), F.lit('",\n')).alias("review_text_minus"),
        F.lit("\\").alias("review_text_comment"),
    )
    path = scratch_path(spark, "roundtrip")
    csv_tree.write_reviews(reviews, path, rows_per_file=1000)
    return csv_tree.read_written_reviews(spark, path, PROCESSED_REVIEW_CSV)


def catalog_csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as catalogue rows by brand, written in chunks and read back in their order."""
    rows = t.table(spark, folder, "part").select(
        F.col("p_brand").alias("catalog"),
        F.col("p_partkey").alias("product_article"),
        F.concat(F.col("p_name"), F.lit(', "new"')).alias("product_name"),
        F.format_string("%d,%d", F.col("p_size") % 5, F.col("p_size") % 10).alias("product_rating"),
        F.col("p_size").alias("count_reviews"),
    )
    path = scratch_path(spark, "catalogs")
    listed = ordering.dense_positions(rows, ["catalog"], ["product_article"], "listing")
    csv_tree.write_catalogs(listed, path, rows_per_file=1000)
    return csv_tree.read_written_catalogs(spark, path)


def catalog_files(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as one catalogue file per brand, half of them under names that files cannot have, read back with their rows' order."""
    odd = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("."), F.col("p_brand"), F.lit(" 50%25 +a/b=мужская обувь@7"))).otherwise(F.col("p_brand"))
    rows = t.table(spark, folder, "part").select(
        odd.alias("catalog"),
        F.col("p_partkey").alias("product_article"),
        F.concat(F.col("p_name"), F.lit(', "new"\nline')).alias("product_name"),
        F.when(F.col("p_size") % 5 > 0, F.lit("4,5")).alias("product_rating"),
        F.col("p_size").alias("count_reviews"),
    )
    path = scratch_path(spark, "catalogs")
    csv_tree.write_catalogs(ordering.dense_positions(rows, ["catalog"], ["product_article"], "listing"), f"{path}/written")
    csv_tree.name_files(spark, f"{path}/written", f"{path}/named", lambda k: k["catalog"])
    return csv_tree.read_catalogs(spark, f"{path}/named", chunked=True)


def review_files(spark: SparkSession, folder: str) -> DataFrame:
    """Turns as one review file per role and some hundred conversations, read back in their order."""
    turns = t.conversations(spark, folder).withColumn("product_article", F.floor(F.col("product_id") / 100))
    key = ["catalog", "product_article"]
    placed = ordering.dense_positions(turns, key, ["product_id", "review_id"], "review_pos")
    rows = placed.select(
        *key, "review_pos", F.col("review_id").cast("int").alias("review_rating"), F.col("text").alias("review_text"),
        F.lit('say "yes", or\nno').alias("review_text_plus"), F.lit(None).cast("string").alias("review_text_minus"),
    )
    path = scratch_path(spark, "reviews")
    csv_tree.write_reviews(rows, f"{path}/written")
    csv_tree.name_files(spark, f"{path}/written", f"{path}/named", lambda k: f"{k['catalog']}/{k['product_article']}")
    return csv_tree.read_reviews(spark, f"{path}/named", chunked=True)


def ranged_review_files(spark: SparkSession, folder: str) -> DataFrame:
    """Turns as one large review file per role, read in small ranges by many tasks, with the place of every row in its file."""
    rows = ordering.dense_positions(t.conversations(spark, folder), ["catalog"], ["product_id", "review_id"], "review_pos").select(
        "catalog", F.lit(1).alias("product_article"), "review_pos", F.col("review_id").cast("int").alias("review_rating"),
        F.concat(F.col("text"), F.lit('\n"end",\n')).alias("review_text"),
        F.lit(None).cast("string").alias("review_text_plus"), F.col("catalog").alias("review_text_minus"),
    )
    path = scratch_path(spark, "large")
    csv_tree.write_reviews(rows, f"{path}/written")
    csv_tree.name_files(spark, f"{path}/written", f"{path}/named", lambda k: f"{k['catalog']}/{k['product_article']}")
    small = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        return stored(csv_tree.read_reviews(spark, f"{path}/named", chunked=True, ranged=True), "large-read")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def combined_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """All turns of a role as one table without helper columns."""
    turns = t.conversations(spark, folder).select(
        "catalog",
        F.col("product_id").alias("product_article"),
        F.col("review_id").alias("review_pos"),
        F.col("review_id").cast("int").alias("review_rating"),
        F.col("text").alias("review_text"),
        F.lit(None).cast("string").alias("review_text_plus"),
        F.lit(None).cast("string").alias("review_text_minus"),
    )
    path = scratch_path(spark, "combined")
    csv_tree.write_combined(filters.with_parts(turns), path, files_per_catalog=2)
    return spark.read.options(**csv_tree.READ).schema(StructType([*PROCESSED_REVIEW_CSV.fields, StructField("catalog", StringType())])).csv(path)


def _labelled_store(spark: SparkSession, folder: str) -> tuple[FeedbackStore, DataFrame]:
    """A store with languages as catalogues and sources as products, and the reviews that belong in it, without their parts."""
    store = FeedbackStore(spark, scratch_path(spark, "stored"))
    store.create()
    docs = t.whole_reviews(spark, folder).withColumn(
        "product_article", F.ascii(F.substring("catalog", 2, 1)) * 1000 + F.col("product_id")
    )
    store.register_catalogs(docs.groupBy("catalog").agg(F.lit(1).alias("link_order")).withColumnRenamed("catalog", "catalog_link"))
    links = store.read("catalogs").select("catalog_id", F.col("catalog_link").alias("catalog"))
    products = docs.groupBy("catalog", "product_article").agg(F.count(F.lit(1)).alias("count_reviews"))
    named = products.join(links, "catalog").withColumns({"name": F.col("catalog"), "rating": F.lit("4.5")})
    store.append_numbered("products", named, "product_id", ["catalog_id", "product_article"])
    return store, docs.withColumnRenamed("review_id", "_order")


def _analysis_rows(store: FeedbackStore) -> DataFrame:
    flags = store.read("catalogs").filter("analyzed").agg(F.count(F.lit(1)).alias("n_analyzed"))
    return store.read("analysis").unionByName(
        flags.select(F.lit(0).cast("bigint").alias("id"), F.lit("analyzed").alias("word"),
                     F.col("n_analyzed").cast("double").alias("frequency"), F.lit("").alias("df_index"), F.lit("").alias("column"))
    )


def stored_analysis(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents go into a store as catalogues, products and reviews and are analysed from it."""
    store, reviews = _labelled_store(spark, folder)
    store.append_numbered("reviews", reviews, "review_id", ["_order"], t.with_parts)
    collect.analyse_catalogs(store, scratch_path(spark, "results"), STOP_WORDS)
    return _analysis_rows(store)


def reanalysis_after_growth(spark: SparkSession, folder: str) -> DataFrame:
    """The same reviews in three steps, older documents first, each analysed before the next: the tables are those of one analysis."""
    store, reviews = _labelled_store(spark, folder)
    results = scratch_path(spark, "results")
    most = reviews.agg(F.max("_order")).first()[0] or 0
    for step in range(3):
        grown = reviews.filter(F.floor(3 * F.col("_order") / (most + 1)) == step)
        store.reopen(store.read("catalogs").select("catalog_id"))
        store.append_numbered("reviews", grown, "review_id", ["_order"], t.with_parts)
        collect.analyse_catalogs(store, results, STOP_WORDS)
    return _analysis_rows(store)


def report_tables(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "report")
    top = terms.top_terms(analyse.word_counts(t.reviews(spark, folder), STOP_WORDS))
    reports.write_report(top.withColumn("term_kind", F.lit("word")), path)
    return reports.read_report(spark, path)


def full_analysis(spark: SparkSession, folder: str) -> DataFrame:
    """Words and bigrams of the joint analysis, with the display title of their cell."""
    return reports.titled(analyse.analyse(t.reviews(spark, folder), STOP_WORDS).report())


def report_sheet(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sheet(analyse.analyse(t.reviews(spark, folder), STOP_WORDS).report(), "en", 5, "Достоинства", "word")


def bigram_sheet(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sheet(analyse.analyse(t.reviews(spark, folder), STOP_WORDS).report(), "en", 5, "Достоинства", "bigram")


def analysis_table(spark: SparkSession, folder: str) -> DataFrame:
    return reports.analysis_rows(terms.top_terms(analyse.bigram_counts(t.reviews(spark, folder), STOP_WORDS, first=TOP_REPORT)))


def store_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two appends with text values that the store casts, numbered one after the other."""
    store = FeedbackStore(spark, scratch_path(spark, "store"))
    store.create()
    orders = t.shop(spark, folder)[2].withColumn("rating", F.col("rating").cast("string"))
    for half in (0, 1):
        store.append_numbered(
            "reviews", orders.withColumnRenamed("review_id", "_order").filter(f"_order % 2 = {half}"), "review_id", ["_order"]
        )
    return store.read("reviews")


def _ingested(spark: SparkSession, folder: str, files: int, files_per_batch: int) -> FeedbackStore:
    """Labelled documents arrive as captured review files, a product's reviews in several of them.

    For large tables each file is several, dealt by review, so that no task writes more than some of them;
    a batch takes as many times more. The files are compressed, quickly rather than closely.
    """
    base = scratch_path(spark, "ingest")
    size = t.documents(spark, folder).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spread = 1 + size // (files * CAPTURED_FILE_BYTES)
    docs = t.reviews(spark, folder, files * spread).withColumn("product_article", F.floor(F.col("review_id") / 10))
    captured = docs.select(
        F.lit(1).cast("bigint").alias("catalog_id"),
        F.col("product_article").alias("position"),
        "product_article",
        F.col("product_article").alias("variant_group"),
        F.concat(F.lit("product "), F.col("product_article").cast("string")).alias("name"),
        F.when(F.col("product_article") % 9 == 0, F.lit(UNRATED)).otherwise(F.lit("4,5")).alias("product_rating"),
        F.col("review_id").alias("review_pos"),
        "rating",
        F.col("text_all").alias("text"),
    )
    with freed_shuffles(spark):
        captured.write.option("zlib.compress.level", "BEST_SPEED").json(f"{base}/incoming", compression="gzip")
    store = FeedbackStore(spark, f"{base}/store")
    stream = ingest.captured_stream(spark, f"{base}/incoming", files_per_batch * spread)
    ingest.start_ingest(store, stream, f"{base}/checkpoint").awaitTermination()
    ingest.settle(store)
    return store


def streaming_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The stored products and reviews of captured files that came in one batch."""
    store = _ingested(spark, folder, 4, 1000)
    products = store.read("products").select("product_article", F.col("rating").alias("product_rating"), "count_reviews")
    reviews = store.read("reviews").select(
        "review_id", "product_article", "rating", F.length("text_all").cast("bigint").alias("chars"), "text_plus"
    )
    return reviews.join(products, "product_article")


def streaming_ingest_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The same, a quarter of the files a batch, so that products come in several batches."""
    store = _ingested(spark, folder, 4, 1)
    products = store.read("products").select("product_article", F.col("rating").alias("product_rating"), "count_reviews")
    reviews = store.read("reviews").select(
        "product_article", "rating", F.length("text_all").cast("bigint").alias("chars"), "text_plus"
    )
    return reviews.join(products, "product_article")


def clean_tree_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as a written raw tree, cleaned and read back, with the products that have no rows.

    A document without text is a review file without rows: one product stands for them all in a language.
    """
    root = scratch_path(spark, "tree")
    lines = t.document_lines(spark, folder)
    empty = t.table(spark, folder, "documents").filter("coalesce(text, '') = ''").select(F.col("doc_id").alias("product_article"))
    rows = lines.join(empty, "product_article", "left_anti").select(
        "catalog", "product_article", "review_pos",
        (F.length("line") % 5 + 1).cast("int").alias("review_rating"),
        F.col("line").alias("review_text"),
        F.lit(None).cast("string").alias("review_text_plus"),
        F.lit(None).cast("string").alias("review_text_minus"),
    )
    files = t.table(spark, folder, "documents").select(F.col("lang").alias("catalog"), F.col("doc_id").alias("product_article")).distinct()
    listed = ordering.dense_positions(files, ["catalog"], ["product_article"], "listing").select(
        "catalog", "product_article", "listing", F.lit("name").alias("product_name"), F.lit("4,5").alias("product_rating"),
        F.lit(1).alias("count_reviews"),
    )
    csv_tree.write_catalogs(listed, f"{root}/raw/catalogs")
    csv_tree.write_shared_reviews(rows, f"{root}/raw/reviews")
    csv_tree.write_kept_files(files, f"{root}/raw/kept_files")
    clean_tree(spark, f"{root}/raw", f"{root}/clean")
    _, reviews, kept = csv_tree.read_tree(spark, f"{root}/clean")
    counted = reviews.groupBy("catalog", "product_article").agg(F.count(F.lit(1)).alias("n_rows"))
    return kept.drop("file_name").join(counted, ["catalog", "product_article"], "left").select(
        "catalog", "product_article", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows")
    )


def all_queries() -> dict:
    """Public query functions of this module by name, in their order."""
    return {
        name: value
        for name, value in globals().items()
        if callable(value) and getattr(value, "__module__", "") == __name__ and not name.startswith("_") and name != "all_queries"
    }
