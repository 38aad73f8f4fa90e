from reviewloom.operators.dedup import fingerprints, review_set_groups
from reviewloom.plans.clean import clean_catalogs, preprocess_reviews


def groups(spark, products, listing=None):
    rows = [("c", key, i, a, b) for key, lines in products.items() for i, (a, b) in enumerate(lines)]
    df = spark.createDataFrame(rows, "catalog string, article bigint, pos bigint, rating int, text string").repartition(4)
    names = [("c", key, f"{key}.csv") for key in (listing or products)]
    listed = spark.createDataFrame(names, "catalog string, article bigint, file_name string")
    out = review_set_groups(listed, df, ["catalog"], "article", "file_name", "pos", ["rating", "text"])
    return {r.article: r.kept for r in out.collect()}


def test_order_null_and_repeats_matter(spark):
    same = [(5, "да"), (4, None)]
    products = {
        11: same,
        12: list(same),
        13: same[::-1],
        14: [(5, "да"), (4, "")],
        15: [*same, same[0]],
        16: [same[0], same[0]],
        17: [same[1], same[1]],
    }
    assert groups(spark, products) == {11: 11, 12: 11, 13: 13, 14: 14, 15: 15, 16: 16, 17: 17}


def test_products_without_rows_share_the_empty_set(spark):
    assert groups(spark, {21: [(5, "да")]}, [21, 22, 23]) == {21: 21, 22: 22, 23: 22}


def test_large_product(spark):
    many = [(i % 5, f"отзыв {i}") for i in range(20_000)]
    assert groups(spark, {1: many, 2: list(many), 3: many[:-1]}) == {1: 1, 2: 1, 3: 3}


def test_same_set_in_two_catalogs_is_kept_twice(spark):
    files = spark.createDataFrame([("a", 1, "1.csv"), ("b", 2, "2.csv")], "catalog string, article bigint, file_name string")
    rows = spark.createDataFrame(
        [("a", 1, 0, 5, "x"), ("b", 2, 0, 5, "x")], "catalog string, article bigint, pos bigint, rating int, text string"
    )
    out = review_set_groups(files, rows, ["catalog"], "article", "file_name", "pos", ["rating", "text"])
    assert {r.article: r.kept for r in out.collect()} == {1: 1, 2: 2}


def test_clean_catalogs(spark):
    catalogs = spark.createDataFrame(
        [
            ("c", 0, 1, "один", "4,7", 2), ("c", 1, 2, "два", "4,7", 2), ("c", 2, 3, "три", "Нет оценок", 1),
            ("c", 3, 4, "четыре", "5", 0), ("c", 4, 5, "пять", None, None), ("c", 5, 1, "один", "4,7", 2),
        ],
        "catalog string, listing bigint, product_article bigint, product_name string, product_rating string, count_reviews int",
    )
    lines = [(0, 5, "Достоинства: лёгкие\nНедостатки: маломерят"), (1, 4, None)]
    reviews = spark.createDataFrame(
        [("c", a, p, r, t, None, None) for a in (1, 2) for p, r, t in lines] + [("c", 3, 0, 1, "плохо", None, None)],
        "catalog string, product_article bigint, review_pos bigint, review_rating int, review_text string, "
        "review_text_plus string, review_text_minus string",
    )
    files = spark.createDataFrame(
        [("c", a, f"{a}.csv") for a in (1, 2, 3)], "catalog string, product_article bigint, file_name string"
    )
    cleaned = clean_catalogs(catalogs, reviews, files)
    assert [r.product_article for r in cleaned.catalogs.orderBy("listing").collect()] == [1, 5, 1]
    assert {(r.product_article, r.review_pos) for r in cleaned.reviews.collect()} == {(1, 0), (1, 1), (3, 0)}

    parsed = preprocess_reviews(cleaned.reviews).orderBy("product_article", "review_pos").collect()
    parts = [(r.review_text_plus, r.review_text_minus, r.review_text_comment) for r in parsed]
    assert parts == [("лёгкие", "маломерят", "Нет"), ("Нет", "Нет", ""), ("Нет", "Нет", "плохо")]


def test_fingerprint_words_are_independent(spark):
    """The four words are the four parts of the row's SHA-256, so none is a function of another."""
    import hashlib

    rows = spark.createDataFrame([(7, 0, "да")], "article bigint, pos bigint, text string")
    found = fingerprints(rows, ["article"], "pos", ["text"]).first()
    digest = hashlib.sha256('{"p":0,"text":"да"}'.encode()).hexdigest()
    words = [int.from_bytes(bytes.fromhex(digest[16 * i : 16 * i + 16]), "big", signed=True) for i in range(4)]
    assert [found[f"fp{i}"] for i in range(4)] == words and found.n_rows == 1
