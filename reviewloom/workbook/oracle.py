"""The same results as plain SQL over the given tables."""

from __future__ import annotations

from reviewloom.constants import (
    CATEGORIES,
    LABEL_COMMENT,
    LABEL_MINUS,
    LABEL_PLUS,
    MISSING_PART,
    PUNCTUATION,
    UNRATED,
    WHITESPACE_CLASS,
)
from reviewloom.workbook.tables import LINE_ORDER, STOP_WORDS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


NEWLINE = "chr(10)"
PLUS, MINUS, COMMENT = (_text(f"{label}:") for label in (LABEL_PLUS, LABEL_MINUS, LABEL_COMMENT))
STOP_LIST = "[" + ", ".join(_text(w) for w in STOP_WORDS) + "]"
LINE_KEYS = ", ".join(LINE_ORDER)


def clean(column: str) -> str:
    return f"translate(lower({column}), {_text(PUNCTUATION)}, '')"


def words(column: str, stop: bool = True) -> str:
    keep = "w <> ''" + (f" AND NOT list_contains({STOP_LIST}, w)" if stop else "")
    return f"list_filter(string_split_regex({clean(column)}, '{WHITESPACE_CLASS}+'), lambda w: {keep})"


def visible(column: str) -> str:
    text = f"regexp_replace(regexp_replace({column}, '(?i)<br\\s*/?>', {NEWLINE}, 'g'), '<[^>]*>', '', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = f"replace({text}, {_text(entity)}, {_text(char)})"
    return f"trim({text})"


def split_parts(column: str) -> str:
    def part(label: str) -> str:
        return f"regexp_extract({column}, '{label}:{WHITESPACE_CLASS}*([^\\n]*)', 1)"

    body = f"regexp_replace({column}, '^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+\\z', '', 'g')"
    missing = _text(MISSING_PART)
    return f"""
    CASE WHEN contains({column}, {PLUS}) THEN {part(LABEL_PLUS)} ELSE {missing} END AS text_plus,
    CASE WHEN contains({column}, {MINUS}) THEN {part(LABEL_MINUS)} ELSE {missing} END AS text_minus,
    CASE WHEN contains({column}, {COMMENT}) THEN {part(LABEL_COMMENT)}
         WHEN starts_with({body}, {PLUS}) OR starts_with({body}, {MINUS}) THEN {missing}
         ELSE regexp_extract({body}, '^([^\\n]*)', 1) END AS text_comment"""


DOCS = """docs AS (
    SELECT lang AS catalog, CAST(substr(source, 4) AS BIGINT) AS product_id, doc_id AS review_id, text
    FROM documents)"""
TURNS = """docs AS (
    SELECT role AS catalog, conv_id AS product_id, turn AS review_id, text FROM conversations)"""
LABELLED = f"""labelled AS (
    SELECT catalog, product_id, review_id,
      CASE review_id % 6
        WHEN 0 THEN {PLUS} || ' ' || flat
        WHEN 1 THEN {MINUS} || ' ' || flat
        WHEN 2 THEN {PLUS} || ' ' || coalesce(lines[1], '') || {NEWLINE} || {MINUS} || ' '
                    || coalesce(lines[2], '') || {NEWLINE} || {COMMENT} || flat
        WHEN 3 THEN text
        WHEN 4 THEN {PLUS} || {NEWLINE} || flat || {NEWLINE} || {COMMENT}
        ELSE {COMMENT} || {NEWLINE} || '  ' || flat END AS text
    FROM (SELECT *, replace(text, {NEWLINE}, ' ') AS flat, string_split(text, {NEWLINE}) AS lines FROM docs))"""
REVIEWS = f"""reviews AS (
    SELECT catalog, product_id, review_id, rating, text AS text_all, {split_parts("text")}
    FROM (SELECT l.*, CAST(coalesce(1 + 2 * quality + toxic, 5) AS INTEGER) AS rating
          FROM labelled l LEFT JOIN labels ON review_id = doc_id))"""
SPLIT_REVIEWS = (DOCS, LABELLED, REVIEWS)
PARTS = """parts AS (
    SELECT catalog, rating, 0 AS part, product_id, review_id, text_plus AS text FROM reviews
    UNION ALL SELECT catalog, rating, 1, product_id, review_id, text_minus FROM reviews
    UNION ALL SELECT catalog, rating, 2, product_id, review_id, text_comment FROM reviews)"""
ONE_PART = "parts AS (SELECT catalog, 0 AS rating, 0 AS part, product_id, review_id, text FROM docs)"
TOKENS = f"""arrays AS (
    SELECT catalog, rating, part, product_id, review_id, {words("text")} AS words FROM parts WHERE text IS NOT NULL),
tokens AS (
    SELECT *, row_number() OVER (ORDER BY catalog, rating, part, product_id, review_id, pos) AS seq
    FROM (SELECT catalog, rating, part, product_id, review_id,
                 unnest(words) AS term, generate_subscripts(words, 1) AS pos FROM arrays))"""
WORDS = "terms AS (SELECT catalog, rating, part, part AS last_part, term, seq FROM tokens)"


def bigrams(window: str) -> str:
    return f"""terms AS (
    SELECT catalog, rating, part, last_part, term || ' ' || following AS term, seq
    FROM (SELECT *, lead(term) OVER w AS following, lead(part) OVER w AS last_part
          FROM tokens WINDOW w AS (PARTITION BY {window} ORDER BY seq))
    WHERE following IS NOT NULL)"""


BIGRAMS = bigrams("catalog, rating")
INNER_BIGRAMS = bigrams("catalog, rating, part, product_id, review_id")
NAMES = "CASE part " + " ".join(f"WHEN {i} THEN {_text(c)}" for i, c in enumerate(CATEGORIES[:-1])) + " END"
COUNTS = f"""counts AS (
    SELECT catalog, rating, category, term, count(*) AS n, min(seq) AS first_seq
    FROM (SELECT catalog, rating, {NAMES} AS category, term, seq FROM terms WHERE part = last_part
          UNION ALL SELECT catalog, rating, {_text(CATEGORIES[-1])}, term, seq FROM terms)
    GROUP BY ALL)"""
SINGLE_COUNTS = """counts AS (
    SELECT catalog, term, count(*) AS n, min(seq) AS first_seq FROM terms GROUP BY ALL)"""


def ranked(cell: str, k: int) -> str:
    return f"""top AS (
    SELECT {cell}, CAST(rank AS INTEGER) AS rank, term, n
    FROM (SELECT *, row_number() OVER (PARTITION BY {cell} ORDER BY n DESC, first_seq) AS rank FROM counts)
    WHERE rank <= {k})"""


CELL = "catalog, rating, category"
ALL_WORDS = (*SPLIT_REVIEWS, PARTS, TOKENS, WORDS, COUNTS)
ALL_BIGRAMS = (*SPLIT_REVIEWS, PARTS, TOKENS, BIGRAMS, COUNTS)
CLOUD = f"""SELECT *, round(n / max(n) OVER (PARTITION BY {CELL}), 9) AS weight FROM top"""
RATED = f"""rated AS (
    SELECT doc_id,
      CASE WHEN quality = 0 THEN {_text(UNRATED)} WHEN quality IS NOT NULL THEN '4,' || toxic END AS product_rating,
      n_chars % 3 AS count_reviews
    FROM (SELECT doc_id, n_chars FROM documents) LEFT JOIN labels USING (doc_id))"""
SHOP = """catalogs AS (SELECT CAST(n_nationkey AS BIGINT) AS catalog_id, n_name AS catalog_link FROM nation),
products AS (
    SELECT c_custkey AS product_id, c_custkey AS product_article, CAST(c_nationkey AS BIGINT) AS catalog_id, c_name AS name
    FROM customer),
shop_reviews AS (
    SELECT o_orderkey AS review_id, o_custkey AS product_article,
      CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rating, o_orderpriority AS text_all,
      o_orderstatus AS text_plus, CAST(NULL AS VARCHAR) AS text_minus, o_orderpriority AS text_comment
    FROM orders)"""
LISTINGS = """listings AS (
    SELECT l_suppkey AS catalog_id, l_partkey AS product_article, l_orderkey * 10 + l_linenumber AS position FROM lineitem),
stored AS (SELECT p_partkey AS product_article, p_partkey % 100 AS catalog_id FROM part WHERE p_size <= 20)"""
IDENTICAL = """sets AS (
    SELECT lang AS catalog, doc_id AS product_article, min(doc_id) OVER (PARTITION BY lang, text) AS kept
    FROM documents)"""


FIRST_FILES = """kept AS (
    SELECT product_article FROM (
        SELECT doc_id AS product_article,
          row_number() OVER (PARTITION BY lang, text ORDER BY CAST(doc_id AS VARCHAR) || '.csv') AS place FROM documents)
    WHERE place = 1)"""


def picks(catalog: str, listings: str, stored: str, target: int) -> str:
    """Catalogues filled one after the other, smallest first."""
    return f"""
    WITH RECURSIVE free AS (
        SELECT {catalog}, product_article, min(position) AS position FROM {listings}
        WHERE product_article NOT IN (SELECT product_article FROM {stored}) GROUP BY ALL),
    turns AS (
        SELECT {catalog}, row_number() OVER (ORDER BY {catalog}) AS k, {target} - coalesce(done, 0) AS room
        FROM (SELECT DISTINCT {catalog} FROM free)
        LEFT JOIN (SELECT {catalog}, count(*) AS done FROM {stored} GROUP BY ALL) USING ({catalog})),
    filled(k, taken, own) AS (
        SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST([] AS BIGINT[])
        UNION ALL
        SELECT k, list_concat(any_value(taken), coalesce(list(product_article) FILTER (place <= room), [])),
               coalesce(list(product_article ORDER BY place) FILTER (place <= room), [])
        FROM (SELECT t.k, f.taken, room, l.product_article,
                     CASE WHEN l.product_article IS NOT NULL
                          THEN row_number() OVER (PARTITION BY l.product_article IS NULL ORDER BY position, l.product_article) END AS place
              FROM filled f JOIN turns t ON t.k = f.k + 1
              LEFT JOIN free l ON l.{catalog} = t.{catalog} AND NOT list_contains(f.taken, l.product_article))
        GROUP BY k)
    SELECT {catalog}, product_article, position, CAST(pick AS INTEGER) AS pick
    FROM (SELECT k, unnest(own) AS product_article, generate_subscripts(own, 1) AS pick FROM filled)
    JOIN turns USING (k) JOIN free USING ({catalog}, product_article)"""


PAGE_URL_PATH = "regexp_extract(url, '^[^?#]*', 0)"
TITLE = "(?s)<h1>(.*?)</h1>"
PARAGRAPH = "(?s)<p>(.*?)</p>"

STORED_ANALYSIS = _with(
    *SPLIT_REVIEWS, PARTS, TOKENS, WORDS, COUNTS, ranked(CELL, 10),
    BIGRAMS.replace("terms AS", "pairs AS"), COUNTS.replace("counts AS", "pair_counts AS").replace("FROM terms", "FROM pairs"),
    ranked(CELL, 10).replace("top AS", "pair_top AS").replace("FROM counts", "FROM pair_counts"),
) + """
    SELECT row_number() OVER (ORDER BY term_kind, catalog, CAST(rating AS VARCHAR), category, rank) AS id, term AS word,
           CAST(n AS DOUBLE) AS frequency, CAST(rating AS VARCHAR) AS df_index, category AS "column"
    FROM (SELECT *, 'word' AS term_kind FROM top UNION ALL SELECT *, 'bigram' FROM pair_top)
    UNION ALL SELECT 0, 'analyzed', CAST(count(DISTINCT lang) AS DOUBLE), '', '' FROM documents"""

SQL: dict[str, str] = {
    "top_words_by_lang": _with(DOCS, ONE_PART, TOKENS, WORDS, SINGLE_COUNTS, ranked("catalog", 10)) + " SELECT * FROM top",
    "top_words_by_role": _with(TURNS, ONE_PART, TOKENS, WORDS, SINGLE_COUNTS, ranked("catalog", 10)) + " SELECT * FROM top",
    "top_words_rating_category": _with(*ALL_WORDS, ranked(CELL, 10)) + " SELECT * FROM top",
    "top_bigrams_by_lang": _with(DOCS, ONE_PART, TOKENS, BIGRAMS, SINGLE_COUNTS, ranked("catalog", 10)) + " SELECT * FROM top",
    "top_bigrams_by_role": _with(TURNS, ONE_PART, TOKENS, BIGRAMS, SINGLE_COUNTS, ranked("catalog", 10)) + " SELECT * FROM top",
    "top_bigrams_rating_category": _with(*ALL_BIGRAMS, ranked(CELL, 10)) + " SELECT * FROM top",
    "sketched_top_bigrams": _with(*ALL_BIGRAMS, ranked(CELL, 10)) + " SELECT * FROM top",
    "top_bigrams_within_reviews": _with(*SPLIT_REVIEWS, PARTS, TOKENS, INNER_BIGRAMS, COUNTS, ranked(CELL, 10)) + " SELECT * FROM top",
    "word_cloud_weights": _with(*ALL_WORDS, ranked(CELL, 100)) + CLOUD,
    "bigram_cloud_weights": _with(*ALL_BIGRAMS, ranked(CELL, 100)) + CLOUD,
    "word_frequencies": _with(*ALL_WORDS) + f" SELECT {CELL}, term, n FROM counts",
    "bigram_frequencies": _with(*ALL_BIGRAMS) + f" SELECT {CELL}, term, n FROM counts",
    "rating_counts_grid": _with(*SPLIT_REVIEWS) + """
        SELECT catalog, rating, count(review_id) AS n
        FROM (SELECT catalog FROM reviews UNION SELECT role FROM conversations)
        CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS rating)
        LEFT JOIN reviews USING (catalog, rating) GROUP BY ALL""",
    "report_grid": _with(
        *SPLIT_REVIEWS[:2],
        REVIEWS.replace("reviews AS (\n    SELECT catalog,", "reviews AS (\n    SELECT catalog || '/' || product_id AS catalog,"),
        PARTS, TOKENS, WORDS, COUNTS, ranked(CELL, 3),
    ) + f"""
        SELECT catalog, rating, category, rank, term, n
        FROM (SELECT DISTINCT catalog FROM reviews)
        CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS rating)
        CROSS JOIN (SELECT unnest([{", ".join(_text(c) for c in CATEGORIES)}]) AS category)
        LEFT JOIN top USING ({CELL})""",
    "split_review_parts": _with(DOCS, LABELLED) + f" SELECT review_id, {split_parts('text')} FROM labelled",
    "split_unreadable_default": _with(DOCS, LABELLED) + f"""
        SELECT review_id, text AS text_all, {split_parts("text")} FROM labelled WHERE review_id % 5 <> 0
        UNION ALL SELECT review_id, '', 'Нет', 'Нет', 'Нет' FROM labelled WHERE review_id % 5 = 0""",
    "preprocess_reviews": _with(DOCS, LABELLED) + f"""
        SELECT review_id, review_text, text_plus AS review_text_plus, text_minus AS review_text_minus,
               text_comment AS review_text_comment
        FROM (SELECT review_id, text AS review_text, {split_parts("text")} FROM labelled)""",
    "normalised_text": f"SELECT doc_id AS review_id, {clean('text')} AS clean FROM documents",
    "token_positions": f"""
        SELECT doc_id AS review_id, CAST(generate_subscripts(words, 1) - 1 AS INTEGER) AS pos, unnest(words) AS token
        FROM (SELECT doc_id, {words("text", stop=False)} AS words FROM documents)""",
    "stop_words_removed": f"SELECT doc_id AS review_id, array_to_string({words('text')}, ' ') AS content FROM documents",
    "review_bigrams": f"""
        SELECT conv_id AS product_id, turn AS review_id, CAST(pos - 1 AS INTEGER) AS pos, term || ' ' || following AS bigram
        FROM (SELECT *, lead(term) OVER (PARTITION BY conv_id, turn ORDER BY pos) AS following
              FROM (SELECT conv_id, turn, unnest(words) AS term, generate_subscripts(words, 1) AS pos
                    FROM (SELECT conv_id, turn, {words("text")} AS words FROM conversations)))
        WHERE following IS NOT NULL""",
    "ordered_concatenation": _with(*SPLIT_REVIEWS, PARTS) + """
        SELECT catalog, rating, CAST(length(string_agg(text, ' ' ORDER BY part, product_id, review_id)) AS BIGINT) AS joined_length,
               bit_xor(CAST('0x' || substr(sha256(
                   CASE WHEN part > 0 THEN part || lpad(CAST(product_id AS VARCHAR), 13, '0') || lpad(CAST(review_id AS VARCHAR), 14, '0')
                        WHEN product_id > 0 THEN product_id || lpad(CAST(review_id AS VARCHAR), 14, '0')
                        ELSE CAST(review_id AS VARCHAR) END
                   || CASE WHEN part = 0 AND product_id = 0 AND review_id = 0 THEN '' ELSE '0000000000' END || ':' || text), 1, 15) AS BIGINT)) AS digest
        FROM parts GROUP BY ALL""",
    "rated_reviews": """
        SELECT o_orderkey, CAST(o_orderkey % 8 AS INTEGER) AS rating FROM orders WHERE o_orderkey % 8 BETWEEN 1 AND 5""",
    "null_parts_dropped": """
        SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rating, CAST(0 AS INTEGER) AS part, count(*) AS n
        FROM orders WHERE o_orderkey % 3 > 0 GROUP BY ALL
        UNION ALL SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 2, count(*) FROM orders GROUP BY ALL""",
    "drop_unrated": _with(RATED) + f" SELECT * FROM rated WHERE product_rating IS DISTINCT FROM {_text(UNRATED)}",
    "drop_without_reviews": _with(RATED) + f"""
        SELECT * FROM rated WHERE product_rating IS DISTINCT FROM {_text(UNRATED)} AND count_reviews IS DISTINCT FROM 0""",
    "decimal_comma": _with(RATED) + " SELECT doc_id, TRY_CAST(replace(product_rating, ',', '.') AS DOUBLE) AS rating FROM rated",
    "identical_review_sets": _with(IDENTICAL) + " SELECT * FROM sets",
    "dedup_catalog": _with(IDENTICAL) + """
        SELECT doc_id AS product_article, lang AS catalog, source, n_chars FROM documents
        WHERE doc_id IN (SELECT kept FROM sets)""",
    "clean_catalog_rows": _with(RATED, FIRST_FILES) + f"""
        SELECT product_article, product_rating, count_reviews, catalog
        FROM (SELECT r.*, doc_id AS product_article, lang AS catalog FROM rated r JOIN documents USING (doc_id))
        JOIN kept USING (product_article)
        WHERE product_rating IS DISTINCT FROM {_text(UNRATED)} AND count_reviews IS DISTINCT FROM 0""",
    "clean_review_rows": _with(FIRST_FILES) + """
        SELECT catalog, product_article, review_pos, CAST(length(line) % 5 + 1 AS INTEGER) AS review_rating, line AS review_text
        FROM (SELECT lang AS catalog, doc_id AS product_article, unnest(lines) AS line,
                     CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS review_pos
              FROM (SELECT *, string_split(text, chr(10)) AS lines FROM documents))
        JOIN kept USING (product_article)""",
    "load_catalog_reviews": _with(SHOP) + """
        SELECT catalog_link AS catalog, product_id, product_article, rating, text_plus, text_comment, text_all, review_id, text_minus
        FROM catalogs JOIN products USING (catalog_id) JOIN shop_reviews USING (product_article)""",
    "analysis_projection": _with(SHOP) + """
        SELECT product_article, rating, text_plus, text_comment, text_all, review_id, text_minus FROM shop_reviews""",
    "catalog_id_of_link": """
        SELECT min(c_custkey) AS catalog_id, 'BUILDING' AS link FROM customer WHERE c_mktsegment = 'BUILDING'
        UNION ALL SELECT min(c_custkey), 'absent' FROM customer WHERE c_mktsegment = 'absent'""",
    "articles_of_catalog": "SELECT c_custkey AS product_article FROM customer WHERE c_nationkey = 7",
    "reviews_of_article": _with(SHOP) + """
        SELECT 'any' AS asked, review_id, rating FROM shop_reviews WHERE product_article = 20
        UNION ALL SELECT '5', review_id, rating FROM shop_reviews WHERE product_article = 20 AND rating = 5""",
    "product_counts": """
        SELECT c_custkey AS catalog_id, count(o_orderkey) AS n_products
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""",
    "product_count": """
        SELECT count(*) AS n_products, '7' AS asked FROM customer WHERE c_nationkey = 7
        UNION ALL SELECT count(*), 'unknown' FROM customer WHERE c_nationkey IS NULL""",
    "collection_progress": _with(SHOP) + """
        SELECT catalog_id, count(product_id) AS n_done, CAST(60 AS BIGINT) AS n_target, count(product_id) >= 60 AS complete
        FROM catalogs LEFT JOIN products USING (catalog_id) GROUP BY ALL""",
    "review_counts": "SELECT o_custkey AS product_article, least(count(*), 12) AS count_reviews FROM orders GROUP BY ALL",
    "value_profile": _with(RATED) + " SELECT product_rating AS value, count(*) AS n FROM rated GROUP BY ALL",
    "preview": _with(SHOP) + " SELECT * FROM products ORDER BY product_id LIMIT 5",
    "union_reviews": """
        SELECT lang AS catalog, CAST(substr(source, 4) AS BIGINT) AS product_id, doc_id AS review_id, text,
               CAST(doc_id % 5 AS INTEGER) AS rating FROM documents
        UNION ALL SELECT role, conv_id, turn, text, NULL FROM conversations""",
    "unseen_products": _with(LISTINGS) + """
        SELECT DISTINCT product_article FROM listings WHERE product_article NOT IN (SELECT product_article FROM stored)""",
    "stored_products": _with(LISTINGS) + """
        SELECT DISTINCT product_article FROM listings WHERE product_article IN (SELECT product_article FROM stored)""",
    "quota_selection": _with(LISTINGS) + f" SELECT * FROM ({picks('catalog_id', 'listings', 'stored', 30)})",
    "cap_reviews": f"""
        SELECT l_partkey, {LINE_KEYS}, CAST(rank AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY {LINE_KEYS}) AS rank FROM lineitem)
        WHERE rank <= 25""",
    "cap_turns": """
        SELECT conv_id AS product_id, turn AS review_id, CAST(rank AS INTEGER) AS rank, text
        FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rank FROM conversations) WHERE rank <= 3""",
    "adaptive_scope": f"""
        WITH lines AS (SELECT l.*, p_brand FROM lineitem l JOIN part ON p_partkey = l_partkey),
        members AS (
            SELECT p_partkey AS l_partkey, p_brand, count(l_partkey) > 100 / 3.0 AS own
            FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY ALL),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY {LINE_KEYS}) AS own_rank,
                      row_number() OVER (PARTITION BY p_brand ORDER BY {LINE_KEYS}) AS group_rank
            FROM lines)
        SELECT l_partkey, p_brand, 'own' AS scope, CAST(own_rank AS INTEGER) AS rank, l_partkey AS reviewed_article,
               l_orderkey, l_linenumber
        FROM ranked JOIN members USING (l_partkey, p_brand) WHERE own AND own_rank <= 100
        UNION ALL
        SELECT m.l_partkey, m.p_brand, 'pooled', CAST(group_rank AS INTEGER), r.l_partkey, l_orderkey, l_linenumber
        FROM ranked r JOIN members m USING (p_brand) WHERE NOT own AND group_rank <= 100""",
    "integrity_report": _with(RATED) + """
        SELECT 'orders' AS table_name, 'unique' AS rule, 'o_orderkey' AS column_name,
          (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey) WHERE n > 1) AS n_rows
        UNION ALL SELECT 'conversations', 'unique', 'conv_id',
          (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM conversations GROUP BY conv_id) WHERE n > 1)
        UNION ALL SELECT 'labels', 'unique', 'doc_id',
          (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM labels GROUP BY doc_id) WHERE n > 1)
        UNION ALL SELECT 'rated', 'not null', 'product_rating', (SELECT count(*) FROM rated WHERE product_rating IS NULL)
        UNION ALL SELECT 'lineitem', 'not null', 'l_orderkey', (SELECT count(*) FROM lineitem WHERE l_orderkey IS NULL)
        UNION ALL SELECT 'documents', 'foreign key', 'doc_id',
          (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
        UNION ALL SELECT 'labels', 'foreign key', 'doc_id',
          (SELECT count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))""",
    "flag_update": """
        SELECT o_orderkey AS catalog_id,
          o_orderstatus = 'F' OR o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS collected
        FROM orders""",
    "surrogate_keys": """
        SELECT o_custkey, o_orderkey,
          (SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY o_custkey, o_orderkey) AS review_id FROM orders""",
    "dense_positions": """
        SELECT o_orderpriority, o_orderkey,
          row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1 AS pos FROM orders""",
    "page_keys": """
        SELECT page_id, TRY_CAST(regexp_extract(url, '/(\\d+)', 1) AS BIGINT) AS article,
          TRY_CAST(regexp_extract(url, 'page=(\\d+)', 1) AS BIGINT) AS page,
          replace(replace(replace(url, 'https://', ''), '/', '_'), '?', '_') AS slug,
          replace(replace(replace(url, 'http://', ''), '/', ''), '-', '_') AS file_slug,
          page_id AS file_key,
          url || '?sort=popular&page=' || page_id AS listing_link,
          'https://shop.example/catalog/' || regexp_extract(url, '/(\\d+)', 1) || '/feedbacks' AS feedback_link
        FROM pages""",
    "cell_titles": f"""
        SELECT lang AS catalog, category || ' (Оценка ' || rating || '/5)' AS title
        FROM (SELECT DISTINCT lang FROM documents)
        CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS rating)
        CROSS JOIN (SELECT unnest([{", ".join(_text(c) for c in CATEGORIES)}]) AS category)""",
    "page_fields": f"""
        SELECT page_id,
          CASE WHEN regexp_matches(html, '{TITLE}') THEN {visible(f"regexp_extract(html, '{TITLE}', 1)")} END AS title,
          CASE WHEN regexp_matches(html, '<html lang="([a-z]+)"') THEN regexp_extract(html, '<html lang="([a-z]+)"', 1) END AS lang,
          CASE WHEN contains(html, '<span class="price-block__price">') THEN '' END AS price,
          TRY_CAST(right({PAGE_URL_PATH}, 1) AS INTEGER) AS last_digit
        FROM pages""",
    "page_links": """
        SELECT site, page_id AS page, CAST(generate_subscripts(links, 1) - 1 AS INTEGER) AS at, unnest(links) AS link
        FROM (SELECT page_id, regexp_extract(url, '//([^/]+)/', 1) AS site,
                     regexp_extract_all(html, 'href="([^"]+)"', 1) AS links FROM pages)""",
    "links_without_article": "SELECT page_id, url AS link FROM pages WHERE NOT regexp_matches(url, 'page=[0-9]+')",
    "page_reviews": f"""
        WITH items AS (
            SELECT page_id, CAST(generate_subscripts(found, 1) - 1 AS INTEGER) AS review_pos, unnest(found) AS item
            FROM (SELECT page_id, regexp_extract_all(html, '{PARAGRAPH}', 1) AS found FROM pages)),
        read AS (SELECT page_id, review_pos, {visible("item")} AS text FROM items)
        SELECT page_id, review_pos, text AS text_all, {split_parts("text")} FROM read WHERE text <> ''
        UNION ALL SELECT page_id, review_pos, '', 'Нет', 'Нет', 'Нет' FROM read WHERE text = ''""",
    "nested_page_reviews": f"""
        WITH items AS (
            SELECT page_id, generate_subscripts(found, 1) - 1 AS review_pos, 'Комментарий: ' || unnest(found) || ' ' AS item
            FROM (SELECT page_id, regexp_extract_all(html, '{PARAGRAPH}', 1) AS found FROM pages)),
        read AS (SELECT page_id, review_pos, {visible("item")} AS text FROM items)
        SELECT page_id, review_pos, CAST(4 AS INTEGER) AS rating, text_all, text_comment
        FROM (SELECT page_id, review_pos, text AS text_all, {split_parts("text")} FROM read)""",
    "crawl_frontier": """
        WITH entries AS (
            SELECT regexp_extract(url, '//([^/]+)/', 1) AS site, page_id AS position,
                   CAST(regexp_extract(url, '/(\\d+)', 1) AS BIGINT) AS product_article FROM pages),
        stored AS (SELECT p_partkey AS product_article, 'www.example.com' AS site FROM part WHERE p_partkey % 7 = 0)"""
        + f" SELECT * FROM ({picks('site', 'entries', 'stored', 5)})",
    "collect_pages": f"""
        WITH entries AS (
            SELECT regexp_extract(url, '//([^/]+)/', 1) AS catalog_link, page_id, html,
                   CAST(regexp_extract(url, '/(\\d+)', 1) AS BIGINT) AS product_article FROM pages),
        catalogs AS (
            SELECT catalog_link, row_number() OVER (ORDER BY min(page_id), catalog_link) AS catalog_id
            FROM entries GROUP BY catalog_link),
        listed AS (SELECT catalog_id, product_article, page_id AS position FROM entries JOIN catalogs USING (catalog_link)),
        none AS (SELECT catalog_id, product_article FROM listed WHERE false),
        picked AS ({picks("catalog_id", "listed", "none", 3)}),
        pages_of AS (
            SELECT product_article, max(page_id) AS page_id, arg_max(html, page_id) AS html,
                   CASE WHEN product_article % 4 > 0 THEN 'g' || product_article % 40 ELSE 'p' || product_article END AS pool
            FROM entries GROUP BY product_article),
        items AS (
            SELECT product_article, pool, unnest(found) AS item, generate_subscripts(found, 1) AS place
            FROM (SELECT *, regexp_extract_all(html, '{PARAGRAPH}', 1) AS found FROM pages_of)),
        shown AS (
            SELECT p.product_article, item, row_number() OVER (PARTITION BY p.product_article ORDER BY i.product_article, place) AS rank
            FROM (SELECT product_article, pool, (SELECT count(*) FROM items i WHERE i.product_article = o.product_article) > 8 / 3.0 AS own
                  FROM pages_of o) p
            JOIN items i ON CASE WHEN own THEN i.product_article = p.product_article ELSE i.pool = p.pool END
            WHERE p.product_article IN (SELECT product_article FROM picked)
            QUALIFY rank <= 8),
        products AS (
            SELECT row_number() OVER (ORDER BY catalog_id, position, product_article) AS product_id, product_article, catalog_id,
                   {visible(f"regexp_extract(html, '{TITLE}', 1)")} AS name,
                   CAST('4.' || page_id % 10 AS DOUBLE) AS product_rating,
                   (SELECT CAST(count(*) AS INTEGER) FROM shown s WHERE s.product_article = o.product_article) AS count_reviews
            FROM picked JOIN pages_of o USING (product_article)),
        reviews AS (
            SELECT product_article, row_number() OVER (ORDER BY product_id, rank) AS review_id, {visible("item")} AS text_all
            FROM products JOIN shown USING (product_article))
        SELECT product_article, catalog_id, product_id, name, product_rating, count_reviews,
               catalog_link, true AS collected, false AS analyzed,
               review_id, CASE WHEN review_id IS NOT NULL THEN CAST(3 AS INTEGER) END AS rating, text_all
        FROM products JOIN catalogs USING (catalog_id) LEFT JOIN reviews USING (product_article)""",
    "csv_roundtrip_multiline": """
        SELECT role AS catalog, conv_id // 100 AS product_article,
          row_number() OVER (PARTITION BY role, conv_id // 100 ORDER BY conv_id, turn) - 1 AS review_pos,
          CAST(turn AS INTEGER) AS review_rating, text AS review_text,
          CAST(NULL AS VARCHAR) AS review_text_plus,
          ' "' || role || '",' || chr(10) AS review_text_minus, '\\' AS review_text_comment
        FROM conversations""",
    "catalog_csv_roundtrip": """
        SELECT p_brand AS catalog, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS listing,
          p_partkey AS product_article, p_name || ', "new"' AS product_name,
          (p_size % 5) || ',' || (p_size % 10) AS product_rating, p_size AS count_reviews FROM part""",
    "catalog_files": """
        SELECT CASE WHEN p_size % 2 = 0 THEN '.' || p_brand || ' 50%25 +a/b=мужская обувь@7' ELSE p_brand END AS catalog,
          row_number() OVER (PARTITION BY p_brand, p_size % 2 ORDER BY p_partkey) - 1 AS listing,
          p_partkey AS product_article, p_name || ', "new"' || chr(10) || 'line' AS product_name,
          CASE WHEN p_size % 5 > 0 THEN '4,5' END AS product_rating, p_size AS count_reviews FROM part""",
    "review_files": """
        SELECT role AS catalog, conv_id // 100 AS product_article,
          row_number() OVER (PARTITION BY role, conv_id // 100 ORDER BY conv_id, turn) - 1 AS review_pos,
          CAST(turn AS INTEGER) AS review_rating, text AS review_text, 'say "yes", or' || chr(10) || 'no' AS review_text_plus,
          CAST(NULL AS VARCHAR) AS review_text_minus
        FROM conversations""",
    "ranged_review_files": """
        SELECT role AS catalog, CAST(1 AS BIGINT) AS product_article, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1 AS review_pos,
          CAST(turn AS INTEGER) AS review_rating, text || chr(10) || '"end",' || chr(10) AS review_text,
          CAST(NULL AS VARCHAR) AS review_text_plus, role AS review_text_minus
        FROM conversations""",
    "combined_reviews": f"""
        SELECT catalog, review_rating, review_text, text_plus AS review_text_plus, text_minus AS review_text_minus,
               nullif(text_comment, '') AS review_text_comment
        FROM (SELECT role AS catalog, CAST(turn AS INTEGER) AS review_rating, text AS review_text, {split_parts("text")}
              FROM conversations)""",
    "stored_analysis": STORED_ANALYSIS,
    "reanalysis_after_growth": STORED_ANALYSIS,
    "report_tables": _with(*ALL_WORDS, ranked(CELL, 10)) + """
        SELECT catalog, rank, term, n, 'word' AS term_kind, rating, category FROM top""",
    "full_analysis": "SELECT *, category || ' (Оценка ' || rating || '/5)' AS title FROM (SELECT *, 'word' AS term_kind FROM (" + _with(*ALL_WORDS, ranked(CELL, 10))
        + " SELECT * FROM top) UNION ALL SELECT *, 'bigram' FROM (" + _with(*ALL_BIGRAMS, ranked(CELL, 10)) + " SELECT * FROM top))",
    "bigram_sheet": _with(*ALL_BIGRAMS, ranked(CELL, 10)) + """
        SELECT rank - 1 AS "index", term AS "Bigram", n AS "Top 10 Bigrams (Category: Достоинства)" FROM top
        WHERE catalog = 'en' AND rating = 5 AND category = 'Достоинства'""",
    "report_sheet": _with(*ALL_WORDS, ranked(CELL, 10)) + """
        SELECT rank - 1 AS "index", term AS "Word", n AS "Top 10 Words (Category: Достоинства)" FROM top
        WHERE catalog = 'en' AND rating = 5 AND category = 'Достоинства'""",
    "analysis_table": _with(*ALL_BIGRAMS, ranked(CELL, 10)) + """
        SELECT term AS word, CAST(n AS DOUBLE) AS frequency, CAST(rating AS VARCHAR) AS df_index, category AS "column" FROM top""",
    "store_append": _with(SHOP) + """
        SELECT row_number() OVER (ORDER BY review_id % 2, review_id) AS review_id, product_article, rating,
               text_all, text_plus, text_minus, text_comment
        FROM shop_reviews""",
    "streaming_ingest": _with(*SPLIT_REVIEWS) + """
        SELECT product_article, row_number() OVER (ORDER BY doc) AS review_id, rating, chars, text_plus,
               CAST(4.5 AS DOUBLE) AS product_rating,
               CAST(count(*) OVER (PARTITION BY product_article) AS INTEGER) AS count_reviews
        FROM (SELECT review_id // 10 AS product_article, review_id AS doc, rating, length(text_all) AS chars, text_plus
              FROM reviews)
        WHERE product_article % 9 <> 0""",
    "streaming_ingest_batches": _with(*SPLIT_REVIEWS) + """
        SELECT product_article, rating, chars, text_plus, CAST(4.5 AS DOUBLE) AS product_rating,
               CAST(count(*) OVER (PARTITION BY product_article) AS INTEGER) AS count_reviews
        FROM (SELECT review_id // 10 AS product_article, rating, length(text_all) AS chars, text_plus FROM reviews)
        WHERE product_article % 9 <> 0""",
    "clean_tree_roundtrip": """
        WITH files AS (
            SELECT lang AS catalog, doc_id AS product_article, nullif(text, '') AS body FROM documents)
        SELECT catalog, product_article, CAST(CASE WHEN body IS NULL THEN 0 ELSE len(string_split(body, chr(10))) END AS BIGINT) AS n_rows
        FROM files
        QUALIFY row_number() OVER (PARTITION BY catalog, body ORDER BY product_article || '.csv') = 1""",
}
