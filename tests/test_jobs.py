"""Collecting, storing, streaming and the CSV trees, end to end on small made-up shops."""

import json
import os

import pytest
from pyspark.sql import functions as F

from reviewloom.plans.clean import clean_tree, preprocess_tree
from reviewloom.plans.collect import analyse_catalogs, collect_catalogs, read_rating_counts, rejected
from reviewloom.schemas import PROCESSED_REVIEW_CSV
from reviewloom.sources import csv_tree
from reviewloom.sources.reports import read_report, sheet
from reviewloom.sources.store import FeedbackStore
from reviewloom.functions.keys import key_from_file_name
from reviewloom.plans.collect import product_rows, review_rows
from reviewloom.streaming.ingest import captured_stream, first_captures, settle, start_ingest

SHOES = "https://www.shop.example/catalog/shoes"
BAGS = "https://www.shop.example/catalog/bags"


def listing(*articles):
    card = '<div class="product-card__wrapper">\n<a class="x" href="https://www.shop.example/catalog/{}/detail.aspx">ok</a></div>'
    return "".join(card.format(a) for a in articles)


def product(article, name, rating):
    return (
        article,
        f'<h1 class="product-page__title">{name}</h1><span id="productNmId">{article}</span>'
        f'<span class="a product-review__rating b">{rating}</span>',
    )


def feedback(article, group, reviews):
    items = "".join(
        '<li class="comments__item"><span class="feedback__rating stars-line star{}"></span>{}</li>'.format(
            stars, "" if text is None else f'<div class="feedback__content">{text}</div>'
        )
        for stars, text in reviews
    )
    return (article, group, f'<ul class="comments__list">{items}</ul>')


@pytest.fixture
def shop(spark):
    listings = spark.createDataFrame(
        [(SHOES, 1, listing(11, 12, 11)), (SHOES, 2, listing(13, 14)), (BAGS, 1, listing(21, 12))],
        "catalog_link string, page int, html string",
    )
    products = spark.createDataFrame(
        [product(11, "Кеды &amp; шнурки", "4,7"), product(12, "Боты", "5"), product(13, "Тапки", "Нет оценок"),
         product(14, "Сапоги", "3,1"), product(21, "Сумка", "4")],
        "product_article bigint, html string",
    )
    feedbacks = spark.createDataFrame(
        [
            feedback(11, 1, [(5, "Достоинства: лёгкие<br>Недостатки: маломерят<br>Комментарий: отличные кеды"), (1, None)]),
            feedback(12, 1, [(4, "хорошие боты")]),
            feedback(14, None, [(2, "Недостатки: текут")]),
            feedback(21, None, []),
        ],
        "product_article bigint, variant_group bigint, html string",
    )
    links = spark.createDataFrame([(SHOES, 1), (BAGS, 2)], "catalog_link string, link_order int")
    return listings, products, feedbacks, links


def test_collect_then_analyse(spark, shop, tmp_path):
    store = FeedbackStore(spark, str(tmp_path / "store"))
    progress = collect_catalogs(store, *shop, max_products=3, max_reviews=6)
    assert {r.catalog_id: (r.n_done, r.complete) for r in progress.collect()} == {1: (2, False), 2: (1, False)}

    products = store.read("products").orderBy("product_id").collect()
    assert [(r.product_article, r.catalog_id, r.name, r.rating, r.count_reviews) for r in products] == [
        (11, 1, "Кеды & шнурки", 4.7, 3), (12, 1, "Боты", 5.0, 3), (21, 2, "Сумка", 4.0, 0),
    ]
    reviews = store.read("reviews").orderBy("review_id").collect()
    assert [r.review_id for r in reviews] == list(range(1, 7))
    assert [(r.product_article, r.rating, r.text_plus, r.text_minus, r.text_comment) for r in reviews[:3]] == [
        (11, 5, "лёгкие", "маломерят", "отличные кеды"), (11, 1, "Нет", "Нет", "Нет"), (11, 4, "Нет", "Нет", "хорошие боты"),
    ]
    assert reviews[1].text_all == ""

    # The unrated product was picked and skipped; the next run fills the catalogue up.
    progress = collect_catalogs(store, *shop, max_products=4, max_reviews=6)
    assert {r.catalog_id: r.n_done for r in progress.collect()} == {1: 3, 2: 1}
    assert store.read("reviews").count() == 7
    assert store.read("catalogs").filter("collected AND NOT analyzed").count() == 2

    results = str(tmp_path / "results")
    only_bags = shop[3].filter(F.col("catalog_link") == BAGS)
    analyse_catalogs(store, results, links=only_bags)
    assert [r.catalog_link for r in store.read("catalogs").filter("analyzed").collect()] == [BAGS]
    analyse_catalogs(store, results)
    assert store.read("catalogs").filter("analyzed").count() == 2
    stored = store.read("analysis").count()
    analyse_catalogs(store, results)
    assert store.read("analysis").count() == stored
    grid = read_report(spark, f"{results}/report")
    assert grid.select("catalog", "rating", "category", "term_kind").distinct().count() == 2 * 5 * 4 * 2
    report = grid.filter("term IS NOT NULL")
    words = report.filter("term_kind = 'word'")
    assert [tuple(r) for r in sheet(report, SHOES, 2, "Недостатки", "word").collect()] == [(0, "текут", 1)]
    analysis = store.read("analysis")
    assert analysis.count() == report.count() > words.count() > 0
    counts = read_rating_counts(store, results)
    assert counts.count() == 10
    assert {(r.catalog, r.rating): r.n for r in counts.filter("n > 0").collect()} == {
        (SHOES, 1): 2, (SHOES, 2): 1, (SHOES, 4): 2, (SHOES, 5): 2,
    }
    assert analysis.select("id").distinct().count() == analysis.count()
    assert analysis.filter(F.col("word") == "отличные кеды").count() == 2


def test_links_without_article_are_set_aside(spark):
    links = spark.createDataFrame([("https://shop.example/catalog/5/x",), ("https://shop.example/about",)], "link string")
    assert [r.link for r in rejected(links).collect()] == ["https://shop.example/about"]


def test_store_versions(spark, tmp_path):
    store = FeedbackStore(spark, str(tmp_path / "store"))
    store.create()
    links = spark.createDataFrame([("b", 2), ("a", 1), ("a", 3)], "catalog_link string, link_order int")
    store.register_catalogs(links)
    store.register_catalogs(links)
    assert [(r.catalog_id, r.catalog_link) for r in store.read("catalogs").orderBy("catalog_id").collect()] == [(1, "a"), (2, "b")]
    store.flag_catalogs(spark.createDataFrame([(2,)], "catalog_id bigint"), "analyzed")
    os.makedirs(tmp_path / "store" / "catalogs" / "version=7")  # a version that was never finished
    assert {r.catalog_id: r.analyzed for r in store.read("catalogs").collect()} == {1: False, 2: True}
    store.create()
    assert store.read("catalogs").count() == 2


def test_streaming_ingest_repeats_safely(spark, tmp_path):
    incoming = tmp_path / "incoming"
    incoming.mkdir()

    def capture(name, rows):
        (incoming / name).write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows), encoding="utf8")

    def review(article, pos, text):
        return {"catalog_id": 1, "position": article, "product_article": article, "variant_group": None,
                "name": f"p{article}", "product_rating": "4,5", "review_pos": pos, "rating": 5, "text": text}

    def ingest(checkpoint, files=1000):
        start_ingest(store, captured_stream(spark, str(incoming), files), str(tmp_path / checkpoint)).awaitTermination()
        settle(store, max_reviews=3)

    store = FeedbackStore(spark, str(tmp_path / "store"))
    capture("1.json", [review(1, 0, "Достоинства: да"), review(1, 1, None), review(2, 0, "нет")])
    ingest("cp")
    assert (store.read("products").count(), store.read("reviews").count()) == (2, 3)
    kept = {r.review_id for r in store.read("reviews").filter("product_article = 2").collect()}
    # Known rows come again, stored products grow, and no product passes the limit over all batches.
    capture("2.json", [review(2, 0, "нет"), review(3, 0, "ещё"), review(1, 2, "два"), review(1, 3, "три")])
    capture("3.json", [review(3, 1, "и ещё"), review(3, None, None)])
    ingest("cp", files=1)
    # A lost checkpoint replays everything and adds nothing.
    before = sorted(map(tuple, store.read("reviews").collect()))
    ingest("cp-new")
    assert sorted(map(tuple, store.read("reviews").collect())) == before
    assert {r.product_article: r.count_reviews for r in store.read("products").collect()} == {1: 3, 2: 1, 3: 2}
    assert store.read("reviews").count() == 6
    assert store.read("products").select("product_article").distinct().count() == store.read("products").count() == 3
    assert {r.review_id for r in store.read("reviews").filter("product_article = 2").collect()} == kept
    texts = [r.text_all for r in store.read("reviews").filter("product_article = 1").orderBy("review_id").collect()]
    assert texts == ["Достоинства: да", "", "два"]


def test_page_fields_of_reviews(spark):
    item = '<li><span class="stars-line star{}"></span><div class="feedback__content">да</div>{}</li>'
    blocks = '<div class="feedback__text--item-pro">лёгкие</div><div class="x feedback__text--item-con">узкие</div>'
    html = ('<ul class="comments__list">' + item.format(5, blocks) + item.format("x", "") + "<li>реклама</li>"
            + item.format(3, "") + '</ul><ul class="menu"><li>меню</li></ul>')
    pages = spark.createDataFrame([(1, None, html)], "product_article bigint, variant_group bigint, html string")
    rows = review_rows(pages).orderBy("review_pos").collect()
    assert [(r.review_pos, r.rating, r.pros, r.cons) for r in rows] == [(0, 5, "лёгкие", "узкие"), (3, 3, None, None)]
    shop = spark.createDataFrame(
        [(product(1, "a", "4")[1] + '<span class="price-block__price"> 9 ₽</span>',), (product(2, "b", "5")[1],)], "html string"
    )
    assert {r.product_article: r.price for r in product_rows(shop).collect()} == {1: "9 ₽", 2: None}


def test_file_names_without_a_key_fail(spark):
    with pytest.raises(Exception, match="no key in file name"):
        spark.createDataFrame([("x/abc.csv",)], "path string").select(key_from_file_name(F.col("path"))).collect()


def test_csv_trees(spark, tmp_path):
    raw = tmp_path / "raw"
    (raw / "catalogs").mkdir(parents=True)
    (raw / "reviews" / "shoes").mkdir(parents=True)
    (raw / "catalogs" / "shoes.csv").write_text(
        'product_article,product_name,product_rating,count_reviews\n5,"Кеды, ""лето""","4,7",2\n6,Боты,"4,7",2\n'
        "7,Тапки,Нет оценок,1\n8,Сапоги,3,0\n",
        encoding="utf8",
    )
    head = "review_rating,review_text,review_text_plus,review_text_minus\n"
    body = '5,"Достоинства: ""лёгкие""\n\nКомментарий: да",,\n4,,,\n'
    for name, text in (("5", head + body), ("6", head + body), ("9", head)):
        (raw / "reviews" / "shoes" / f"{name}.csv").write_text(text, encoding="utf8")

    clean, processed = str(tmp_path / "clean"), str(tmp_path / "processed")
    clean_tree(spark, str(raw), clean)
    preprocess_tree(spark, clean, processed)
    catalog = spark.read.options(**csv_tree.READ).csv(f"{clean}/catalogs").collect()
    assert [(r.product_article, r.product_name, r.product_rating) for r in catalog] == [("5", 'Кеды, "лето"', "4,7")]
    rows = csv_tree.read_written_reviews(spark, f"{processed}/reviews", PROCESSED_REVIEW_CSV).orderBy("review_pos").collect()
    assert [(r.catalog, r.product_article, r.review_pos, r.review_rating) for r in rows] == [("shoes", 5, 0, 5), ("shoes", 5, 1, 4)]
    assert rows[0].review_text == 'Достоинства: "лёгкие"\n\nКомментарий: да'
    assert (rows[0].review_text_plus, rows[0].review_text_minus, rows[0].review_text_comment) == ('"лёгкие"', "Нет", "да")
    assert (rows[1].review_text, rows[1].review_text_comment) == (None, None)
    _, _, kept = csv_tree.read_tree(spark, clean)
    assert sorted((r.catalog, r.product_article) for r in kept.collect()) == [("shoes", 5), ("shoes", 9)]
    again = str(tmp_path / "again")
    clean_tree(spark, clean, again)
    assert csv_tree.read_kept_files(spark, f"{again}/kept_files").count() == 2
    assert csv_tree.read_written_reviews(spark, f"{again}/reviews").count() == 2
    combined = spark.read.options(**csv_tree.READ).csv(f"{processed}/all")
    assert combined.columns == [*PROCESSED_REVIEW_CSV.names, "catalog"] and combined.count() == 2


def test_chunks_keep_positions(spark, tmp_path):
    rows = [("c", 1, i, 5, f"текст {i}", None, None) for i in range(25)]
    df = spark.createDataFrame(
        rows, "catalog string, product_article bigint, review_pos bigint, review_rating int, review_text string, "
        "review_text_plus string, review_text_minus string"
    )
    csv_tree.write_reviews(df, str(tmp_path / "out"), rows_per_file=10)
    back = csv_tree.read_written_reviews(spark, str(tmp_path / "out"))
    assert sorted((r.review_pos, r.review_text) for r in back.collect()) == [(i, f"текст {i}") for i in range(25)]


def test_named_files_keep_all_chunks(spark, tmp_path):
    rows = [(c, c == "d" and 2 or 1, i, i, f"имя {i}", "4,5", i) for c, n in (("c", 25), ("d", 4)) for i in range(n)]
    df = spark.createDataFrame(
        rows, "catalog string, article bigint, listing bigint, product_article bigint, product_name string, product_rating string, count_reviews int"
    )
    csv_tree.write_catalogs(df.drop("article"), str(tmp_path / "catalogs"), rows_per_file=10)
    assert csv_tree.name_files(spark, str(tmp_path / "catalogs"), str(tmp_path / "named"), lambda k: k["catalog"]) == 4
    back = csv_tree.read_catalogs(spark, str(tmp_path / "named"), chunked=True).collect()
    assert sorted((r.catalog, r.listing, r.product_article) for r in back) == [(r[0], r[2], r[3]) for r in rows]
    reviews = df.selectExpr(
        "catalog", "article AS product_article", "listing AS review_pos", "count_reviews AS review_rating", "product_name AS review_text",
        "CAST(NULL AS string) AS review_text_plus", "CAST(NULL AS string) AS review_text_minus",
    )
    csv_tree.write_reviews(reviews, str(tmp_path / "reviews"), rows_per_file=10)
    csv_tree.name_files(spark, str(tmp_path / "reviews"), str(tmp_path / "by_key"), lambda k: f"{k['catalog']}/{k['product_article']}")
    back = csv_tree.read_reviews(spark, str(tmp_path / "by_key"), chunked=True).collect()
    assert sorted((r.catalog, r.product_article, r.review_pos, r.review_rating) for r in back) == [r[:3] + (r[2],) for r in rows]
    csv_tree.write_catalogs(df.drop("article"), str(tmp_path / "again"), rows_per_file=10)
    with pytest.raises(Exception, match="name is taken"):
        csv_tree.name_files(spark, str(tmp_path / "again"), str(tmp_path / "one"), lambda k: "same")


def test_files_are_not_cut_by_the_session(spark, tmp_path):
    rows = [("c", i, i, f"имя {i}", "4,5", i) for i in range(25)]
    df = spark.createDataFrame(
        rows, "catalog string, listing bigint, product_article bigint, product_name string, product_rating string, count_reviews int"
    )
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "3")
    try:
        csv_tree.write_catalogs(df, str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert len(list((tmp_path / "out").rglob("part-*"))) == 1
    back = csv_tree.read_written_catalogs(spark, str(tmp_path / "out"))
    assert sorted((r.listing, r.product_article) for r in back.collect()) == [(i, i) for i in range(25)]


ODD_NAMES = ["мужская обувь", "Brand#11", "a b+c", "50%25 off", "x=1", "a@7", "ключ&", "q[1]{2}"]
NO_FILE_NAMES = ["a/b", ".hidden", "_own", "t:1", None]


def test_catalog_names_of_every_kind(spark, tmp_path):
    """Raw trees with odd names keep all their reviews when cleaned."""
    raw = tmp_path / "raw"
    (raw / "catalogs").mkdir(parents=True)
    for i, name in enumerate(ODD_NAMES):
        (raw / "reviews" / name).mkdir(parents=True)
        (raw / "catalogs" / f"{name}.csv").write_text("product_article,product_name,product_rating,count_reviews\n" + f'{i + 1},p,"4,5",1\n')
        (raw / "reviews" / name / f"{i + 1}.csv").write_text("review_rating,review_text,review_text_plus,review_text_minus\n5,да,,\n4,нет,,\n")
    clean_tree(spark, str(raw), str(tmp_path / "clean"))
    rows, reviews, kept = csv_tree.read_tree(spark, str(tmp_path / "clean"))
    expected = {(name, i + 1) for i, name in enumerate(ODD_NAMES)}
    assert {(r.catalog, r.product_article) for r in rows.collect()} == expected
    assert sorted((r.catalog, r.product_article) for r in reviews.collect()) == sorted([*expected, *expected])
    assert {(r.catalog, r.product_article) for r in kept.collect()} == expected


def test_named_files_of_every_kind(spark, tmp_path):
    names = ODD_NAMES + NO_FILE_NAMES
    df = spark.createDataFrame(
        [(c, j, i, "n", "4,5", j) for i, c in enumerate(names) for j in range(3)],
        "catalog string, listing bigint, product_article bigint, product_name string, product_rating string, count_reviews int",
    )
    csv_tree.write_catalogs(df, str(tmp_path / "written"), rows_per_file=2)
    csv_tree.name_files(spark, str(tmp_path / "written"), str(tmp_path / "named"), lambda k: k["catalog"])
    assert {"Brand#11.csv", "мужская обувь.csv", "a%2Fb.csv", "%NULL.csv", "%NULL@2.csv", "a%407@2.csv"} <= set(os.listdir(tmp_path / "named"))
    back = csv_tree.read_catalogs(spark, str(tmp_path / "named"), chunked=True).collect()
    assert sorted(((r.catalog, r.listing, r.product_article) for r in back), key=str) == sorted(((c, j, i) for i, c in enumerate(names) for j in range(3)), key=str)


def test_a_batch_touches_what_it_brings(spark, tmp_path):
    """A batch writes its new rows alone and reads no captured ones; a batch that is replayed takes its own place."""
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    rows = [{"catalog_id": 1, "position": a, "product_article": a, "variant_group": None, "name": "p", "product_rating": "5", "review_pos": p, "rating": 5, "text": f"{a} {p}"}
            for a in range(20) for p in range(3)]
    for i in range(4):  # every file repeats the one before
        part = rows[15 * max(0, i - 1) : 15 * (i + 1)]
        (incoming / f"{i}.json").write_text("\n".join(json.dumps(r) for r in part), encoding="utf8")
        os.utime(incoming / f"{i}.json", (1_000_000 + i, 1_000_000 + i))
    store = FeedbackStore(spark, str(tmp_path / "store"))
    query = start_ingest(store, captured_stream(spark, str(incoming), 1), str(tmp_path / "cp"))
    query.awaitTermination()
    sizes = [spark.read.parquet(f"{tmp_path}/store/captured/version=0/batch={b}").count() for b in store.batches("captured")]
    assert sizes == [15, 15, 15, 15] and first_captures(store).count() == 60
    assert not any("store/captured" in str(source) for p in query.recentProgress for source in p["sources"])
    again = store.read_batches("captured").limit(0)
    store.write_batch("captured", again, store.batches("captured")[-1])
    assert first_captures(store).count() == 45


def test_many_products_share_files(spark, tmp_path):
    """a written tree has as many files as asked for, not one for each product, and the same rows and positions."""
    rows = [(c, p, i, 5, f"{c} {p} {i}", None, ' "q",\n') for c in ("c", "d/e", None) for p in range(40) for i in (0, 0, 1, 12)]
    schema = "catalog string, product_article bigint, review_pos bigint, review_rating int, review_text string, review_text_plus string, review_text_minus string"
    df = spark.createDataFrame([*rows, ("c", None, 0, 1, "no product", None, None)], schema).repartition(5)
    csv_tree.write_shared_reviews(df, str(tmp_path / "shared"), rows_per_file=10, files_per_catalog=3)
    csv_tree.write_reviews(df, str(tmp_path / "single"), rows_per_file=10)
    assert len(list((tmp_path / "shared").rglob("part-*"))) <= 9
    both = [csv_tree.read_written_reviews(spark, str(tmp_path / x)).collect() for x in ("shared", "single")]
    assert sorted(map(str, both[0])) == sorted(map(str, both[1])) and len(both[0]) == len(rows) + 1
    raw = tmp_path / "raw"
    csv_tree.write_shared_reviews(df.filter("catalog = 'c' AND product_article IS NOT NULL"), f"{raw}/reviews", files_per_catalog=3)
    listed = df.filter("catalog = 'c' AND product_article IS NOT NULL").select("catalog", "product_article").distinct()
    csv_tree.write_catalogs(listed.selectExpr("*", "product_article AS listing", "'n' AS product_name", "'4,5' AS product_rating", "1 AS count_reviews"), f"{raw}/catalogs")
    csv_tree.write_kept_files(listed, f"{raw}/kept_files")
    clean_tree(spark, str(raw), str(tmp_path / "clean"))
    assert len(list((tmp_path / "clean" / "reviews").rglob("part-*"))) < 40
    assert csv_tree.read_written_reviews(spark, f"{tmp_path}/clean/reviews").count() == 160


def test_captured_files_follow_the_size(spark, tmp_path, monkeypatch):
    """the captured files of a large table are several times four, and the same rows come in."""
    from reviewloom.workbook import queries

    made = [(i, "en", f"src{i % 3}", f"слово {i} " * 20) for i in range(400)]
    spark.createDataFrame([(i, t, lang, s, len(t)) for i, lang, s, t in made], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(queries, "CAPTURED_FILE_BYTES", 2000)
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    rows = queries.streaming_ingest(spark, str(tmp_path)).collect()
    assert len(list((tmp_path / "ingest" / "incoming").glob("part-*"))) > 8
    expected = {i // 10 for i, *_ in made if (i // 10) % 9}
    assert {r.product_article for r in rows} == expected and len(rows) == 10 * len(expected)


def _capture(folder, name, rows):
    folder.mkdir(exist_ok=True)
    names = ["product_article", "variant_group", "review_pos", "rating", "text"]
    made = [{"catalog_id": 1, "position": r[0], "name": f"p{r[0]}", "product_rating": "4,5", **dict(zip(names, r))} for r in rows]
    (folder / name).write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in made), encoding="utf8")


def _kept_bytes(spark):
    """Bytes of the shuffle files and of the checkpointed rows that are on disk."""
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = [os.path.join(d, f) for top in manager.localDirsString() for d, _, names in os.walk(top) for f in names if f.startswith("shuffle_")]
    kept = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    rows = [os.path.join(d, f) for d, _, names in os.walk(kept) for f in names if f.startswith("part-") and "/rdd-" in d]
    return sum(map(os.path.getsize, files)), sum(map(os.path.getsize, rows))


def test_settling_leaves_no_texts_on_disk(spark, tmp_path):
    """texts are in no checkpoint, and shuffle files go with the action that made them."""
    rows = [(a, None, p, 5, os.urandom(4000).hex()) for a in range(40) for p in range(10)]
    size = sum(len(r[-1]) for r in rows)
    _capture(tmp_path / "incoming", "1.json", rows)
    store = FeedbackStore(spark, str(tmp_path / "store"))
    store.create()
    store.read("reviews").limit(1).checkpoint()
    before = _kept_bytes(spark)
    start_ingest(store, captured_stream(spark, str(tmp_path / "incoming")), str(tmp_path / "cp")).awaitTermination()
    captured = _kept_bytes(spark)
    settle(store)
    shuffled, checkpointed = _kept_bytes(spark)
    assert captured[0] - before[0] < size / 10 and shuffled - before[0] < size / 10
    assert checkpointed - before[1] < size / 10
    found = {(r.product_article, r.text_all, r.text_comment) for r in store.read("reviews").collect()}
    assert found == {(a, text, text) for a, _, _, _, text in rows}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_settled_reviews_keep_their_own_texts(spark, tmp_path):
    """pooled reviews, missing texts, one place in batches of two streams, and products that grow have the texts of their rows."""
    store = FeedbackStore(spark, str(tmp_path / "store"))

    def ingest(checkpoint):
        start_ingest(store, captured_stream(spark, str(tmp_path / "incoming")), str(tmp_path / checkpoint)).awaitTermination()
        settle(store, max_reviews=6)

    def found():
        rows = store.read("reviews").orderBy("review_id").collect()
        return [(r.review_id, r.product_article, r.rating, r.text_all, r.text_plus, r.text_comment) for r in rows]

    def by_product():
        return [r[1:4] for r in sorted(found(), key=lambda r: (r[1], r[0]))]

    first = [(1, 7, 0, 5, "Достоинства: один\nКомментарий: да"), (1, 7, 1, 4, None), (1, 7, 2, 3, "три"), (2, 7, None, 5, "nowhere"), (3, 7, 0, 1, "чужой"), (4, None, 0, 2, "один")]
    _capture(tmp_path / "incoming", "1.json", first)
    ingest("cp")
    own = [(5, "Достоинства: один\nКомментарий: да", "один", "да"), (4, "", "Нет", "Нет"), (3, "три", "Нет", "три")]
    pooled = [*own, (1, "чужой", "Нет", "чужой")]
    expected = [(1, r) for r in own] + [(2, r) for r in pooled] + [(3, r) for r in pooled] + [(4, (2, "один", "Нет", "один"))]
    assert found() == [(i, a, *r) for i, (a, r) in enumerate(expected, 1)]
    # A second stream captures a place again, which does not count, and one more.
    _capture(tmp_path / "incoming", "2.json", [(4, None, 0, 5, "другой"), (4, None, 1, 3, "ещё")])
    os.utime(tmp_path / "incoming" / "1.json", (1_000_000, 1_000_000))
    ingest("cp-new")
    assert by_product()[-2:] == [(4, 2, "один"), (4, 3, "ещё")]
    assert [r[:2] for r in found()[:11]] == [(i, a) for i, (a, _) in enumerate(expected[:11], 1)]
    settled = found()
    settle(store, max_reviews=6)
    assert found() == settled


def test_captured_files_are_compressed(spark, tmp_path, monkeypatch):
    """captured files and the store's tables take less room than their texts, and the rows are the same."""
    from reviewloom.workbook import queries

    made = [(i, f"слово {i} и ещё слово {i % 7} " * 40, "en", f"src{i % 3}", 1000) for i in range(300)]
    spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    rows = queries.streaming_ingest(spark, str(tmp_path)).collect()
    files = list((tmp_path / "ingest" / "incoming").glob("part-*"))
    assert sum(f.stat().st_size for f in files) < sum(len(r[1].encode()) for r in made) / 4
    assert {f.suffixes[-2] for f in (tmp_path / "ingest" / "store" / "reviews").rglob("part-*.parquet")} == {".zstd"}
    kept = [r for r in made if r[0] // 10 % 9]
    assert sorted((r.review_id, r.product_article) for r in rows) == [(i, r[0] // 10) for i, r in enumerate(kept, 1)]


def test_reviews_are_dealt_with_one_shuffle(spark, tmp_path):
    """dealing reviews into files takes over the join with their labels, whichever way it is made; rows stay as they are."""
    from reviewloom.workbook import tables

    made = [(None if i % 50 == 0 else i // 2, f"text {i}", "en", f"src{i % 3}", 6) for i in range(400)]
    spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, i % 2, 0) for i in range(0, 100, 3)] * 2 + [(None, 1, 1)]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    expected = sorted(map(str, tables.whole_reviews(spark, str(tmp_path)).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            dealt = tables.whole_reviews(spark, str(tmp_path), 3)
            assert dealt.rdd.getNumPartitions() <= 3
            plan = str(dealt._jdf.queryExecution().executedPlan()).partition("== Initial Plan ==")[0]
            assert plan.count("Exchange hashpartitioning") == 2  # of the reviews and of the labels
            assert sorted(map(str, dealt.collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
