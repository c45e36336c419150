"""Record identity: dedupe, item ids, first-seen and latest rows per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.functions.ids import record_key, source_identifier
from shelfspark.functions.text import has_text
from shelfspark.operators.skew import landed, with_sequence


def first_per_key(df: DataFrame, keys: list[str], order: str, copies: str | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """One row per key: the earliest by `order`, of several the least by `ties` and then by content."""
    return _pick(df, keys, order, ties, False, copies)


def latest_per_key(df: DataFrame, keys: list[str], order: str, copies: str | None = None, ties: tuple[str, ...] = ()) -> DataFrame:
    """One row per key: the last by `order`, of several the greatest by `ties` and then by content."""
    return _pick(df, keys, order, ties, True, copies)


def _pick(df: DataFrame, keys: list[str], order: str, ties: tuple[str, ...], last: bool, copies: str | None) -> DataFrame:
    """Null is a key like any other; rows without an order come in only where a key has no other.

    Rows are landed with a number, and only keys, order and that number are aggregated, map side
    first.  Wide rows meet the picked numbers, which are unique, so neither a hot key nor a
    tie puts rows of a key together.
    """
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    content = F.xxhash64(*[F.col(f"`{c}`") for c in plain])
    rows = landed(df.withColumn("_at", F.monotonically_increasing_id()), "keyed")
    present = F.col(order).isNotNull() if last else F.col(order).isNull()
    place = F.struct(present.alias("present"), F.col(order).alias("order"), *[F.col(c) for c in ties], content.alias("content"), F.col("_at"))
    picked = rows.groupBy(*keys).agg((F.max if last else F.min)(place).alias("_place"), F.count(F.lit(1)).alias("_rows"))
    chosen = picked.select(F.col("_place._at").alias("_at"), *([F.col("_rows").alias(copies)] if copies else []))
    return rows.join(chosen, "_at").select(*df.columns, *([copies] if copies else []))


def dedupe_products(products: DataFrame, ordinal: str = "ordinal", within: list[str] | None = None) -> DataFrame:
    """First record per SKU (or canonical URL and options), with how many were skipped."""
    key = source_identifier(F.col("sku"), F.col("canonical_url"), F.col("variant_options"))
    keyed = products.withColumn("dedupe_key", key)
    kept = first_per_key(keyed, [*(within or []), "dedupe_key"], ordinal, copies="_copies")
    return kept.withColumn("skipped", F.col("_copies") - 1).drop("_copies")


def item_ids(products: DataFrame, supplier: str = "supplier_slug", ordinal: str = "ordinal") -> DataFrame:
    """(supplier, record key, item id): the SKU, else a per-supplier running number.

    Numbers follow (product URL, item name); a repeated key keeps its last number.
    """
    key = record_key(F.col("sku"), F.col("product_url"), F.col("variant_options"))
    keyed = products.select(supplier, key.alias("record_key"), "sku", "product_url", "item_name", ordinal)
    with_sku = (
        keyed.filter(has_text(F.col("sku")))
        .select(supplier, "record_key", F.col("sku").alias("item_id")).distinct()
    )
    numbered = with_sequence(
        keyed.filter(~has_text(F.col("sku"))),
        [F.col("product_url"), F.col("item_name"), F.col(ordinal)], "number", within=[supplier],
    )
    label = F.concat(F.upper(supplier), F.lit("_NO_ID_"), F.format_string("%06d", F.col("number")))
    without = (
        numbered.groupBy(supplier, "record_key").agg(F.max("number").alias("number"))
        .select(supplier, "record_key", label.alias("item_id"))
    )
    return with_sku.unionByName(without)


def with_item_ids(products: DataFrame, supplier: str = "supplier_slug", ordinal: str = "ordinal") -> DataFrame:
    """Attach the item id; only records without a SKU need the key join."""
    numbered = item_ids(products.filter(~has_text(F.col("sku"))), supplier, ordinal)
    key = record_key(F.lit(""), F.col("product_url"), F.col("variant_options"))
    known = products.filter(has_text(F.col("sku"))).withColumn("item_id", F.col("sku"))
    unknown = (
        products.filter(~has_text(F.col("sku"))).withColumn("record_key", key)
        .join(numbered, [supplier, "record_key"]).drop("record_key")
    )
    return known.unionByName(unknown)


def first_seen_links(links: DataFrame, key: str = "identity", within: list[str] | None = None) -> DataFrame:
    """Product identity over crawl order, per supplier: the first URL per identity is kept."""
    keys = [*(within or []), key]
    return links.groupBy(*keys, "page_index").agg(F.min("url").alias("url")).groupBy(*keys).agg(
        F.min_by("url", "page_index").alias("url"), F.min("page_index").alias("first_page"))


def checksum(products: DataFrame, columns: list[str], within: list[str] | None = None) -> DataFrame:
    """Order-independent catalogue fingerprint that keeps duplicate rows apart, per `within` key if there is one.

    Row hashes are added, not collected: one small buffer per task at any catalogue size.
    """
    digest = F.sha1(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))
    part = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")
    own = within or []
    return products.select(*own, part.alias("h")).groupBy(*own).agg(
        F.count(F.lit(1)).alias("product_count"),
        F.coalesce(F.sum("h"), F.lit(0)).cast("string").alias("hash_sum"),
    ).select(*own, "product_count", F.sha1(F.concat_ws(":", F.col("product_count"), F.col("hash_sum"))).alias("checksum"))


def export_order(products: DataFrame) -> DataFrame:
    return products.orderBy("category_path", "item_name", F.coalesce(F.nullif("sku", F.lit("")), "canonical_url"))
