"""Keys and names taken from links, file names and numbers in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of this module: link patterns and suffixes, the title of a cell.
ARTICLE_IN_LINK = r"/catalog/(\d+)/"


def article_or_null(url: Column, pattern: str = ARTICLE_IN_LINK) -> Column:
    """Product article in a link; NULL where the link has none."""
    return F.regexp_extract(url, pattern, 1).try_cast("bigint")


def article_from_link(url: Column, pattern: str = ARTICLE_IN_LINK) -> Column:
    """Product article in a link; the job fails on a link that has none."""
    article = article_or_null(url, pattern)
    return F.when(article.isNotNull(), article).otherwise(
        F.raise_error(F.concat(F.lit("no product article in link: "), F.coalesce(url, F.lit("NULL"))))
        .cast("bigint")
    )


def key_from_file_name(path: Column) -> Column:
    """``.../123.csv`` -> 123; the job fails on a name that is no key."""
    key = F.regexp_extract(path, r"(?:^|/)(\d+)\.csv$", 1).try_cast("bigint")
    return F.when(key.isNotNull(), key).otherwise(
        F.raise_error(F.concat(F.lit("no key in file name: "), F.coalesce(path, F.lit("NULL")))).cast("bigint")
    )


def stem_from_file_name(path: Column) -> Column:
    """``.../shoes.csv`` -> ``shoes``."""
    return F.regexp_extract(path, r"([^/]+)\.csv$", 1)


def result_slug(link: Column, host: str = "https://www.") -> Column:
    """Folder name of a catalogue's results."""
    return F.replace(F.replace(F.replace(link, F.lit(host), F.lit("")), F.lit("/"), F.lit("_")), F.lit("?"), F.lit("_"))


def file_slug(link: Column, prefix: str) -> Column:
    """File name of a catalogue's exchange files; ``prefix`` is the part of the link to cut off."""
    return F.replace(F.replace(F.replace(link, F.lit(prefix), F.lit("")), F.lit("/"), F.lit("")), F.lit("-"), F.lit("_"))


def decimal_comma(text: Column) -> Column:
    """``'4,7'`` -> 4.7; text that is no number gives NULL."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def listing_page_link(catalog_link: Column, page: Column) -> Column:
    return F.concat(catalog_link, F.lit("?sort=popular&page="), page.cast("string"))


def feedback_page_link(article: Column, site: str) -> Column:
    return F.concat(F.lit(f"{site.rstrip('/')}/catalog/"), article.cast("string"), F.lit("/feedbacks"))


def cell_title(category: Column, rating: Column, best: int = 5) -> Column:
    return F.concat(category, F.lit(" (Оценка "), rating.cast("string"), F.lit(f"/{best})"))
