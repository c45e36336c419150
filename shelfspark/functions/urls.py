"""URL rules: joining, canonical forms and classification."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions.text import strip, text

# First path segments that are content or category pages, never products.
CONTENT_SLUGS = [
    "agb", "buero", "klimaschutz", "datenschutz", "deko-und-ladenzubehoer", "displaymaterial", "essen",
    "festivals", "gastrobedarf", "hygiene-und-bedarfsartikel", "impressum", "mehrwegartikel-mieten",
    "mehrweggeschirr-mieten", "oeko-line-label", "oeko-line-produkte", "reinigung", "sale", "services",
    "trinken", "unternehmen",
]
EXCLUDED_SECTIONS = [
    "agb", "impressum", "datenschutz", "checkout", "account", "widgets", "navigation", "bundles",
]
ARTICLE_URL = r"(?i)^https?://[^/]+/.+-\d+\.html$"
CATALOG_URL = r"(?i)^https?://[^/]+/catalog2/products/\d+/[^/?#]+/?$"
ARTICLE_NUMBER = r"(?i)-(\d+)\.html$"


def _dot_segments(path: Column) -> Column:
    """Resolve '.' and '..' segments of an absolute path, as many as there are; query and fragment stay."""
    tail = F.regexp_extract(path, r"[?#].*$", 0)
    segments = F.split(F.regexp_replace(path, r"[?#].*$", ""), "/")
    resolved = F.aggregate(segments, F.array().cast("array<string>"), lambda done, segment: (
        F.when(segment == ".", done)
        .when(segment == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(segment)))))
    ends_in_folder = F.element_at(segments, -1).isin(".", "..")
    return F.concat(F.array_join(resolved, "/"), F.when(ends_in_folder, "/").otherwise(""), tail)


def absolute_url(base: Column, href: Column) -> Column:
    """Resolve a link against the page it was found on; '' for a missing link."""
    href = text(href)
    origin = F.regexp_extract(base, r"^(https?://[^/?#]+)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.regexp_extract(F.regexp_replace(page, r"^https?://[^/]+", ""), r"^(.*/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    return (
        F.when(href == "", "")
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^(https?:)", 1), href))
        .when(href.startswith("/"), F.concat(origin, _dot_segments(href)))
        .when(href.startswith("?"), F.concat(page, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href))
        .otherwise(F.concat(origin, _dot_segments(F.concat(folder, href))))
    )


def without_query(url: Column) -> Column:
    return F.regexp_replace(url, r"[?#].*$", "")


def normalized_url(url: Column, bare_host: str = "", full_host: str = "") -> Column:
    """Trim, move a bare host to its full name, end with exactly one slash."""
    trimmed = strip(url)
    if bare_host:
        trimmed = F.when(
            trimmed.startswith(f"https://{bare_host}/"),
            F.concat(F.lit(f"https://{full_host}/"), F.substr(trimmed, F.lit(len(bare_host) + 10))),
        ).otherwise(trimmed)
    return F.concat(F.regexp_replace(trimmed, "/+$", ""), F.lit("/"))


def url_path(url: Column) -> Column:
    return F.regexp_replace(without_query(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")


def url_query(url: Column) -> Column:
    return F.regexp_extract(url, r"\?([^#]*)", 1)


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def _query_parts(url: Column) -> Column:
    return F.filter(F.split(url_query(url), "&"), lambda p: p.rlike("^[^=]+=.+"))


def keep_page_only(url: Column) -> Column:
    """Drop query and fragment but keep the last page parameter `p`."""
    pages = F.filter(_query_parts(url), lambda p: p.startswith("p="))
    return F.concat(without_query(url), F.coalesce(F.concat(F.lit("?"), F.try_element_at(pages, F.lit(-1))), F.lit("")))


def with_page(url: Column, page: Column) -> Column:
    """Set the page parameter `p`, keeping the other parameters in order."""
    name = lambda part: F.substring_index(part, "=", 1)
    parts = F.concat(_query_parts(url), F.array(F.concat(F.lit("p="), page.cast("string"))))
    names = F.array_distinct(F.transform(parts, name))
    last = F.transform(names, lambda n: F.element_at(F.filter(parts, lambda p: name(p) == n), -1))
    return F.concat(without_query(url), F.lit("?"), F.array_join(last, "&"))


def is_root_product(url: Column) -> Column:
    """/detail/<id>, or one path segment that is not a known content page."""
    path = F.regexp_replace(url_path(url), "^/+|/+$", "")
    return path.rlike("^detail/[^/]+$") | ((path != "") & ~path.contains("/") & ~path.isin(CONTENT_SLUGS))


def is_article(url: Column) -> Column:
    return without_query(strip(url)).rlike(ARTICLE_URL)


def is_catalog_product(url: Column) -> Column:
    return strip(url).rlike(CATALOG_URL)


def is_excluded(url: Column, base: str) -> Column:
    return url.rlike("^" + re.escape(base) + "/(" + "|".join(EXCLUDED_SECTIONS) + ")")


def is_listing_category(url: Column, prefix: str) -> Column:
    path = F.lower(url_path(url))
    return path.startswith(prefix) & path.endswith("/") & (url_query(url) == "") & ~is_article(url)


def is_shop_category(url: Column, host: str) -> Column:
    path = url_path(url)
    return (url_host(url) == host) & path.startswith("/Shop/") & path.endswith("/")


def page_kind(url: Column, base: str, category_roots: list[str]) -> Column:
    """product / category / other, or excluded."""
    first = F.substring_index(F.regexp_replace(url_path(url), "^/+", ""), "/", 1)
    return (
        F.when(is_excluded(url, base), "excluded").when(is_root_product(url), "product")
        .when(first.isin(category_roots), "category").otherwise("other")
    )


def article_number(url: Column) -> Column:
    return F.regexp_extract(without_query(strip(url)), ARTICLE_NUMBER, 1)


def last_segment(url: Column) -> Column:
    return F.regexp_extract(url_path(url), r"([^/]+)/*$", 1)


def path_and_query(url: Column) -> Column:
    query = url_query(url)
    return F.concat(url_path(url), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
