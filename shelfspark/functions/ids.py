"""Stable identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions.text import first_non_empty, has_text, sorted_json_map, strip


def slug(c: Column, fallback: str = "item") -> Column:
    """Lower case, '&' spelled out, other characters to dashes, outer dashes dropped."""
    lowered = F.replace(F.lower(strip(c)), F.lit("&"), F.lit("and"))
    dashed = F.regexp_replace(F.regexp_replace(lowered, "[^a-z0-9_-]+", "-"), "^-+|-+$", "")
    return F.when(dashed == "", fallback).otherwise(dashed)


def short_hash(c: Column, length: int = 10) -> Column:
    return F.substring(F.sha1(c), 1, length)


def category_id(path: Column, supplier: Column) -> Column:
    source = first_non_empty(path, F.lit("Uncategorized"))
    return F.concat_ws("__", supplier, F.lit("cat"), slug(source, "uncategorized"), short_hash(source))


def source_identifier(sku: Column, canonical_url: Column, options: Column) -> Column:
    """SKU, else the canonical URL with its variant options; also the record-dedupe key."""
    return F.when(has_text(sku), sku).otherwise(
        F.concat(canonical_url, F.lit("|"), sorted_json_map(options))
    )


def product_id(sku: Column, canonical_url: Column, options: Column, supplier: Column) -> Column:
    source = source_identifier(sku, canonical_url, options)
    return F.concat_ws("__", supplier, slug(source), short_hash(source))


def record_key(sku: Column, product_url: Column, options: Column) -> Column:
    return F.when(has_text(sku), F.concat(F.lit("sku:"), sku)).otherwise(
        F.concat(F.lit("url:"), product_url, F.lit("|"), sorted_json_map(options))
    )


def _file_slug(c: Column) -> Column:
    return F.substring(F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "-"), 1, 120)


def snapshot_name(url: Column) -> Column:
    """File name of a landed page: hash prefix plus a readable slug of the whole URL."""
    tail = F.regexp_replace(url, "^.*?://", "")
    return F.concat(short_hash(url, 12), F.lit("_"), _file_slug(tail), F.lit(".html"))


def snapshot_path_name(url: Column, html: bool = True) -> Column:
    """As snapshot_name, with the slug of the URL path only."""
    path = F.regexp_replace(F.coalesce(F.parse_url(url, F.lit("PATH")), F.lit("")), "^/+|/+$", "")
    named = F.when(path == "", "homepage").otherwise(F.replace(path, F.lit("/"), F.lit("__")))
    return F.concat(short_hash(url, 12), F.lit("_"), _file_slug(named), F.lit(".html" if html else ".bin"))
