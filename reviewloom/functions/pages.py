"""Fields of captured pages: elements up to their own closing tag, or patterns that callers give.

An element is found by its tag and what its opening tag contains. The page is cut into tags and the text
between them, and one pass over the pieces keeps the depth of tags of that name, so elements inside
elements of the same name do not end it, nor do tags in quoted values. Everything stays in built-in
expressions, inside the row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# What may stand inside a tag: anything but its end, which quoted values may contain.
ATTRIBUTES = r"""[^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+"""
PIECES = rf"(?s)</?[a-zA-Z]{ATTRIBUTES}>|[^<]++|<"
# Parts of a page that hold no markup, whatever they contain.
UNREAD = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"


@dataclass(frozen=True)
class Element:
    """Elements called ``tag`` whose opening tag contains the pattern ``having``."""

    tag: str
    having: str = ""


@dataclass(frozen=True)
class PagePatterns:
    """Where the fields stand in a page: elements, or patterns whose group 1 is the field."""

    # The markup of the shop pages.
    link: str = r'(?s)<div class="product-card__wrapper">\s*<a\b[^>]*?\bhref="([^"]+)"'
    title: str | Element = Element("h1", r'class="product-page__title"')
    article: str | Element = Element("span", r'id="productNmId"')
    rating: str | Element = Element("span", r'class="[^"]*product-review__rating[^"]*"')
    price: str | Element = Element("span", r'class="price-block__price"')
    review_list: str | Element = Element("ul", r'class="comments__list"')
    review_item: str | Element = Element("li")
    review_text: str | Element = Element("div", r'class="feedback__content"')
    review_stars: str = r'<span\b[^>]*?\bclass="([^"]*stars-line[^"]*)"'
    review_plus: str | Element = Element("div", r'class="[^"]*feedback__text--item-pro[^"]*"')
    review_minus: str | Element = Element("div", r'class="[^"]*feedback__text--item-con[^"]*"')
    own_tab: str | Element = Element("li", r'class="product-feedbacks__tab"')
    own_count: str | Element = Element("span", r'class="product-feedbacks__count"')


SHOP_PAGES = PagePatterns()


def readable(html: Column) -> Column:
    """A page without comments, scripts and styles; an open one reaches to the end."""
    special = html.contains("<!--") | F.regexp_like(html, F.lit(r"(?i)<s(?:cript|tyle)\b"))
    return F.when(special, F.regexp_replace(html, UNREAD, "")).otherwise(html)


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once: lambdas repeat an expression for each element."""
    return F.transform(F.array(value), body)[0]


def elements(html: Column, wanted: Element) -> Column:
    """Inner HTML of the outermost wanted elements, in order; NULL of a NULL page.

    An element ends at its own closing tag; one that is never closed reaches to the end. A tag that
    closes itself is an empty element; one whose quotes are open is text. The work grows with the tags
    of the page, and with the square of the wanted elements, which are few hundreds.
    """

    def kind(piece: Column) -> Column:
        """-1 closes, 1 opens, 2 opens a wanted one, 3 is a wanted one that closes itself, 0 anything else."""
        name = F.lower(F.substring(piece, 1, len(wanted.tag) + 3))
        opens = F.startswith(name, F.lit(f"<{wanted.tag}")) & F.regexp_like(piece, F.lit(rf"(?i)^<{wanted.tag}[\s/>]"))
        closes = F.startswith(name, F.lit(f"</{wanted.tag}")) & F.regexp_like(piece, F.lit(rf"(?i)^</{wanted.tag}[\s/>]"))
        is_wanted = F.regexp_like(piece, F.lit(f"(?s){wanted.having}")) if wanted.having else F.lit(True)
        closed = F.endswith(piece, F.lit("/>"))
        opened = F.when(is_wanted & closed, 3).when(closed, 0).when(is_wanted, 2).otherwise(1)
        return F.when(closes, -1).when(opens, opened).otherwise(0)

    def step(state: Column, k: Column) -> Column:
        outside = state["start"] < 0
        depth = F.when(outside, F.when(k == 2, 1).otherwise(0)).otherwise(state["depth"] + F.when(k == 2, 1).when(F.abs(k) == 1, k).otherwise(0))
        ends = ~outside & (depth == 0)
        empty = outside & (k == 3)
        span = F.struct(F.when(empty, state["at"]).otherwise(state["start"]).alias("start"), F.when(empty, state["at"] + 1).otherwise(state["at"]).alias("end"))
        return F.struct(
            (state["at"] + 1).alias("at"),
            depth.alias("depth"),
            F.when(outside & (k == 2), state["at"]).when(ends, -1).otherwise(state["start"]).alias("start"),
            F.when(ends | empty, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    none = F.array().cast("array<struct<start: int, end: int>>")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(-1).alias("start"), none.alias("spans"))

    def finish(state: Column) -> Column:
        rest = F.array(F.struct(state["start"].alias("start"), state["at"].alias("end")))
        return F.when(state["start"] >= 0, F.concat(state["spans"], rest)).otherwise(state["spans"])

    def inner(pieces: Column) -> Column:
        spans = F.aggregate(F.transform(pieces, kind), start, step, finish)
        return F.transform(spans, lambda s: F.array_join(F.slice(pieces, s["start"] + 2, s["end"] - s["start"] - 1), ""))

    return F.when(html.isNotNull(), bound(F.regexp_extract_all(html, F.lit(PIECES), F.lit(0)), inner))


def visible_text(html: Column) -> Column:
    """Text of a fragment: tags dropped, ``<br>`` as a line break, basic entities resolved."""
    text = F.regexp_replace(html, r"(?i)<br\s*/?>", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    text = F.when(html.contains("<"), text).otherwise(html)
    resolved = text
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        resolved = F.replace(resolved, F.lit(entity), F.lit(char))
    return F.trim(F.when(html.contains("&"), resolved).otherwise(text))


def field(html: Column, pattern: str | Element) -> Column:
    """Raw field of a page, the first of several; NULL where there is none."""
    if isinstance(pattern, Element):
        return F.get(elements(html, pattern), F.lit(0))
    return F.when(F.regexp_like(html, F.lit(pattern)), F.regexp_extract(html, pattern, 1))


def text_field(html: Column, pattern: str | Element) -> Column:
    return visible_text(field(html, pattern))


def all_fields(html: Column, pattern: str | Element) -> Column:
    if isinstance(pattern, Element):
        return elements(html, pattern)
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


def own_count(html: Column, patterns: PagePatterns = SHOP_PAGES) -> Column:
    """How many reviews of its own a product's page names; NULL where it names none."""
    return F.trim(text_field(field(html, patterns.own_tab), patterns.own_count)).try_cast("int")


def last_digit(css_class: Column) -> Column:
    """A class such as ``stars-line star4`` names the rating in its last character."""
    return F.substring(css_class, -1, 1).try_cast("int")
