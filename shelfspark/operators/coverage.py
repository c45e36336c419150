"""Crawl discovery and coverage over landed link and fetch tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions.urls import article_number
from shelfspark.functions.text import first_non_empty
from shelfspark.operators.identity import latest_per_key

PAGE_BLOCK = 1024


def running_total(df: DataFrame, value: str, order: str, within: list[str], name: str) -> DataFrame:
    """Cumulative sum along an integer order column, in blocks so no group needs one task."""
    blocked = df.withColumn("_block", F.floor(F.col(order) / PAGE_BLOCK))
    inside = Window.partitionBy(*within, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*within).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        blocked.groupBy(*within, "_block").agg(F.sum(value).alias("_sum"))
        .select(*within, "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    return (
        blocked.join(blocks, [*within, "_block"])
        .withColumn(name, F.sum(value).over(inside) + F.col("_before")).drop("_block", "_before")
    )


def with_identity(links: DataFrame) -> DataFrame:
    """Article number where the URL carries one, else the URL itself."""
    return links.withColumn("identity", first_non_empty(article_number(F.col("url")), F.col("url")))


def crawl_cumulative(links: DataFrame, within: list[str]) -> DataFrame:
    """Per listing page: product links found, products seen for the first time, running total."""
    seen = with_identity(links).groupBy(*within, "page_index", "identity").agg(F.count_distinct("url").alias("urls"))
    per_page = seen.groupBy(*within, "page_index").agg(F.sum("urls").alias("found"))
    first = (
        seen.groupBy(*within, "identity").agg(F.min("page_index").alias("page_index"))
        .groupBy(*within, "page_index").agg(F.count(F.lit(1)).alias("added"))
    )
    pages = per_page.join(first, [*within, "page_index"], "left").na.fill(0, ["added"])
    return running_total(pages, "added", "page_index", within, "cumulative")


def category_counts(links: DataFrame, within: list[str] | None = None) -> DataFrame:
    """Distinct pages and products per category (of a supplier); pairs are deduplicated before counting."""
    keys = [*(within or []), "category"]
    pages = links.select(*keys, "page_index").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("pages"))
    products = (
        with_identity(links).select(*keys, "identity").distinct()
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("products"))
    )
    return pages.join(products, keys)


def scrape_counters(outcomes: DataFrame, within: list[str]) -> DataFrame:
    """Raw, interpreted and failed records per group; failures also per stage."""
    stage = F.coalesce("stage", F.lit("detail"))
    failed = F.col("failed")
    return outcomes.groupBy(*within).agg(
        F.count_if(~failed | (stage != "listing")).alias("raw_records"), F.count_if(~failed).alias("interpreted"),
        F.count_if(failed).alias("failures"),
        *[F.count_if(failed & (stage == s)).alias(f"{s}_failures") for s in ("detail", "transform", "listing", "external")],
    )


def latest_fetch(manifest: DataFrame, order: str) -> DataFrame:
    """Newest fetch per URL; of several at one time the greatest snapshot path."""
    return latest_per_key(manifest, ["url"], order, "fetches", ties=("snapshot_path",))


def pending_urls(frontier: DataFrame, manifest: DataFrame, force: bool = False) -> DataFrame:
    """URLs without a landed snapshot, or all of them when forced."""
    wanted = frontier.select("url").distinct()
    return wanted if force else wanted.join(manifest.select("url").distinct(), "url", "left_anti")


def discovered_union(*sources: DataFrame, keep: Column | None = None) -> DataFrame:
    """Distinct URLs of all sources, filtered before the shuffle."""
    merged = None
    for source in sources:
        urls = source.select("url")
        urls = urls if keep is None else urls.filter(keep)
        merged = urls if merged is None else merged.unionByName(urls)
    return merged.distinct()


def with_fallback(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """The primary source, or the fallback when the primary has no row.

    The emptiness probe is at most one row, so it can be broadcast at any scale.
    """
    probe = F.broadcast(primary.limit(1).select(F.lit(1).alias("_any")))
    return primary.unionByName(fallback.join(probe, F.lit(True), "left_anti"))


def expand_pages(categories: DataFrame, page_url: Column) -> DataFrame:
    """One row per further listing page (2..page_count)."""
    pages = F.when(F.col("page_count") >= 2, F.sequence(F.lit(2), F.col("page_count").cast("int")))
    return categories.select("*", F.explode(pages).alias("page")).withColumn("page_url", page_url)
