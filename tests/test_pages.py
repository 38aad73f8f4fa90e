"""Elements of pages against a parser with a stack, repeated captures, and the count that a page names."""

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from reviewloom.functions import pages
from reviewloom.operators.relate import integrity_report
from reviewloom.plans.collect import collect_catalogs, members_of, needed_pages, product_rows, review_rows
from reviewloom.sources.store import FeedbackStore
from tests.test_jobs import BAGS, SHOES, feedback, listing, product, shop  # noqa: F401


class Outermost(HTMLParser):
    """Inner HTML of the outermost elements of one name and class."""

    def __init__(self, tag, css):
        super().__init__(convert_charrefs=False)
        self.tag, self.css, self.stack, self.found, self.text = tag, css, [], [], []

    def handle_starttag(self, tag, attrs):
        if self.stack or (tag == self.tag and dict(attrs).get("class") == self.css):
            if self.stack:
                self.text.append(self.get_starttag_text())
            if tag == self.tag:
                self.stack.append(tag)

    def handle_startendtag(self, tag, attrs):
        if self.stack:
            self.text.append(self.get_starttag_text())
        elif tag == self.tag and dict(attrs).get("class") == self.css:
            self.found.append("")

    def handle_endtag(self, tag):
        if self.stack and tag == self.tag:
            self.stack.pop()
            if not self.stack:
                self.found.append("".join(self.text))
                self.text = []
                return
        if self.stack:
            self.text.append(f"</{tag}>")

    def handle_data(self, data):
        if self.stack:
            self.text.append(data)

    def outermost(self, html):
        self.feed(html)
        self.close()
        return self.found + (["".join(self.text)] if self.stack else [])


def markup(rng, depth=0):
    """Nested lists and blocks with tags in attribute values; most are closed."""
    out = []
    for _ in range(rng.randrange(1, 5)):
        tag, css = rng.choice([("ul", "x"), ("ul", "y"), ("li", "x"), ("div", "x"), ("ulx", "x")])
        kind = rng.randrange(6)
        if kind == 0 or depth > 4:
            out.append(rng.choice(["text", "a 1", "é", '<img alt="</ul>">', "<b>q</b>", '<ul class="x"/>']))
        else:
            out.append(f'<{tag} id="<{tag}>" class="{css}">' + markup(rng, depth + 1) + f"</{tag}>")
    return "".join(out)


def test_elements_against_a_stack(spark):
    rng = random.Random(3)
    texts = [markup(rng) for _ in range(400)] + ["", "no tags", '<ul class="x">open <ul class="x">twice</ul>', '</ul><ul class="x">a</ul>']
    rows = spark.createDataFrame([(t,) for t in texts], "h string").select(
        "h", pages.elements(F.col("h"), pages.Element("ul", 'class="x"')).alias("found")
    )
    for r in rows.collect():
        assert r.found == Outermost("ul", "x").outermost(r.h), r.h


def test_unread_parts_and_odd_tags(spark):
    html = (
        '<!-- <ul class="comments__list"><li>no</li></ul> --><script>"<ul class=\'comments__list\'>"</script><STYLE>ul{}</STYLE>'
        '<UL id="1" class="comments__list"\n><LI>a<!-- </li> --><ul><li>b</li></ul></LI ><li title="x>y">c</li></UL ><ul class="comments__list"><li/></ul><!-- open <li>'
    )
    frame = spark.createDataFrame([(html,), (None,)], "h string").select(pages.readable(F.col("h")).alias("h"))
    lists = pages.elements(F.col("h"), pages.SHOP_PAGES.review_list)
    items = F.flatten(F.transform(lists, lambda x: pages.elements(x, pages.SHOP_PAGES.review_item)))
    assert [r[0] for r in frame.select(items).collect()] == [["a<ul><li>b</li></ul>", "c", ""], None]


def test_reviews_with_lists_and_blocks_inside(spark):
    nested = (
        '<ul class="comments__list"><li><ul class="photos"><li>1</li><li>2</li></ul><span class="stars-line star4"></span>'
        '<div class="feedback__content"><div>Достоинства: да</div><br>Комментарий: <b>всё <div>хорошо</div></b></div></li>'
        '<li><span class="stars-line star2"></span><div class="feedback__content">нет</div></li></ul>'
    )
    captured = spark.createDataFrame([(1, None, nested)], "product_article bigint, variant_group bigint, html string")
    found = review_rows(captured).orderBy("review_pos").collect()
    assert [(r.review_pos, r.rating, r.text_all) for r in found] == [(0, 4, "Достоинства: да\nКомментарий: всё хорошо"), (1, 2, "нет")]
    assert (found[0].text_plus, found[0].text_comment) == ("да", "всё хорошо")


def store_rows(store):
    return {name: sorted(map(tuple, store.read(name).collect()), key=str) for name in ("catalogs", "products", "reviews")}


def test_repeated_captures_count_once(spark, shop, tmp_path):  # noqa: F811
    listings, products, feedbacks, links = shop
    once = FeedbackStore(spark, str(tmp_path / "once"))
    collect_catalogs(once, listings, products, feedbacks, links, max_products=3, max_reviews=6)
    times = F.explode(F.sequence(F.lit(0), F.pmod(F.xxhash64("html"), F.lit(3))))
    again = FeedbackStore(spark, str(tmp_path / "again"))
    many = [x.withColumn("t", times).drop("t") for x in (listings, products, feedbacks)]
    assert sum(x.count() for x in many) > sum(x.count() for x in (listings, products, feedbacks))
    collect_catalogs(again, *many, links, max_products=3, max_reviews=6)
    assert store_rows(once) == store_rows(again)
    report = integrity_report(
        {n: again.read(n) for n in ("products", "reviews")}, {"products": ["product_article", "product_id"], "reviews": ["review_id"]}, {},
        [("reviews", "product_article", "products", "product_article")],
    )
    assert {r.n_rows for r in report.collect()} == {0}


def test_the_newest_capture_counts(spark):
    captured = spark.createDataFrame(
        [(*product(1, "old", "4,0"), 1), (*product(1, "new", "4,5"), 2), (*product(2, "rated", "5"), 1), (*product(2, "not any more", "Нет оценок"), 3)],
        "product_article bigint, html string, captured int",
    )
    assert [(r.product_article, r.name, r.rating) for r in product_rows(captured).collect()] == [(1, "new", 4.5)]
    old, new = feedback(1, 7, [(1, "old"), (1, "gone")]), feedback(1, 8, [(5, "new")])
    other = feedback(3, 7, [(3, "former variant")])
    pages_of = spark.createDataFrame([(*old, 1), (*new, 2), (*new, 2), (*other, 1)], "product_article bigint, variant_group bigint, html string, captured int")
    shown = needed_pages(pages_of, spark.createDataFrame([(1,)], "product_article bigint"))
    assert [(r.product_article, r.variant_group, r.text_all) for r in review_rows(shown).collect()] == [(1, 8, "new")]


def test_the_count_on_the_page_decides(spark, tmp_path):
    """A product that names many reviews of its own shows those, although fewer were captured; one that names none is pooled."""
    def tab(n):
        return f'<li class="product-feedbacks__tab"><a>этот вариант <span class="product-feedbacks__count"> {n} </span></a></li>'

    rows = [feedback(1, 1, [(5, "own of one")]), feedback(2, 1, [(4, "of two")] * 3), feedback(3, 1, [(4, "of three")])]
    told = [(a, g, tab(n) + html) for (a, g, html), n in zip(rows, (40, 0, "много"))]
    feedbacks = spark.createDataFrame(told, "product_article bigint, variant_group bigint, html string")
    assert {r.product_article: r.own_count for r in members_of(feedbacks).collect()} == {1: 40, 2: 0, 3: None}
    products = spark.createDataFrame([product(i, f"p{i}", "5") for i in (1, 2, 3)], "product_article bigint, html string")
    listings = spark.createDataFrame([(SHOES, 1, listing(1, 2, 3))], "catalog_link string, page int, html string")
    links = spark.createDataFrame([(SHOES, 1)], "catalog_link string, link_order int")
    store = FeedbackStore(spark, str(tmp_path / "store"))
    collect_catalogs(store, listings, products, feedbacks, links, max_products=3, max_reviews=6)
    assert {r.product_article: r.count_reviews for r in store.read("products").collect()} == {1: 1, 2: 5, 3: 5}


def test_pages_are_cut_down_before_they_are_shuffled(spark):
    """F16: equal captures are combined above the join with the wanted pages, which is read from a stored table."""
    rows = [(1, 1, None, "a"), (1, 2, 5, "b"), (1, 2, 5, "b"), (2, 1, 5, "c"), (3, 1, 6, "d"), (None, 1, 5, "e")]
    pages_of = spark.createDataFrame(rows, "product_article bigint, captured bigint, variant_group bigint, html string")
    shown = needed_pages(pages_of, spark.createDataFrame([(1,)], "product_article bigint"))
    assert sorted(map(tuple, shown.collect())) == [(1, 5, "b"), (2, 5, "c")]
    plan = shown._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Join LeftSemi") and plan.count("Aggregate") == 1
