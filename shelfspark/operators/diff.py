"""Change payloads and the create / update / unchanged / inactivate plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.functions.ids import category_id, product_id
from shelfspark.functions.numbers import cents, is_integral, payload_number
from shelfspark.functions.text import blank_to_null, collapse_space, first_non_empty, has_text, split_clean, strip, text
from shelfspark.functions.units import PAYLOAD_LABELS, payload_bundle_code, payload_vessel_code
from shelfspark.operators.skew import join_checked, landed

NAME_LENGTH = 64
PAYLOAD_FIELDS = [
    "id", "status", "category", "name", "order_by", "vessel", "bundles", "price", "price_per",
    "min_order_count", "gtin", "custom_properties", "image",
]


def _vessel(identifier: Column, size: Column, unit: Column, code: Column) -> Column:
    """Null unless size and unit are known; grams must be whole."""
    valid = size.isNotNull() & has_text(unit) & ((unit != "g") | is_integral(size))
    return F.when(valid, F.struct(
        F.concat(identifier, F.lit("__vessel")).alias("id"), size.alias("size"),
        unit.alias("unit"), code.alias("type"),
    ))


def _bundles(identifier: Column, size: Column, code: Column) -> Column:
    valid = is_integral(size) & (size >= 2) & has_text(code)
    return F.when(valid, F.array(F.struct(
        F.concat(identifier, F.lit("__bundle")).alias("id"), code.alias("type"),
        size.cast("bigint").alias("size"),
    )))


def _non_empty_array(c: Column) -> Column:
    return F.when(F.size(c) > 0, c)


def _struct_or_null(fields: dict[str, Column]) -> Column:
    filled = F.coalesce(*[F.when(c.isNotNull(), F.lit(True)) for c in fields.values()])
    return F.when(filled, F.struct(*[c.alias(n) for n, c in fields.items()]))


def _image(url: Column) -> Column:
    return F.when(has_text(url), F.struct(url.alias("url")))


def payload_from_rows(rows: DataFrame, supplier: str = "supplier_slug", order: str | None = None) -> DataFrame:
    """Cleaned import rows -> payload columns (null means the field is left out), and the column `order` if one is named."""
    c = lambda name: text(F.col(name))
    item = c("Item ID")
    country = F.upper(strip(c("Country")))
    properties = _struct_or_null({
        "manufacturer": blank_to_null(c("Manufacturer")), "brand": blank_to_null(c("Brand")),
        "region": blank_to_null(c("Region")), "description": blank_to_null(c("Description")),
        "ingredients": blank_to_null(c("Ingredients")),
        "allergens": _non_empty_array(F.filter(F.transform(F.split(c("Allergens"), ","), strip), lambda x: x != "")),
        "color": blank_to_null(c("Color")), "storage_advice": blank_to_null(c("Storage advice")),
        "labels": _non_empty_array(F.filter(F.transform(F.split(c("Labels"), ","), strip), lambda x: x.isin(PAYLOAD_LABELS))),
        "country": F.when(F.length(country) == 2, country),
    })
    return rows.select(
        F.col(supplier), item.alias("id"), c("Status").alias("status"),
        category_id(c("Category name"), F.col(supplier)).alias("category"),
        blank_to_null(F.substring(collapse_space(c("Item name")), 1, NAME_LENGTH)).alias("name"),
        first_non_empty(c("Order by"), F.lit("vessel")).alias("order_by"),
        _vessel(item, payload_number(c("Vessel size")), c("Vessel unit"),
                first_non_empty(c("Vessel type"), F.lit("NA"))).alias("vessel"),
        _bundles(item, payload_number(c("Bundle size")), c("Bundle type")).alias("bundles"),
        cents(c("Price")).alias("price"), blank_to_null(c("Price per")).alias("price_per"),
        payload_number(c("Minimum order count")).alias("min_order_count"),
        blank_to_null(c("GTIN")).alias("gtin"), properties.alias("custom_properties"),
        _image(c("Image")).alias("image"), *([order] if order else []),
    )


def payload_from_products(products: DataFrame, supplier: str = "supplier_slug") -> DataFrame:
    """Product records -> payload columns, with identifiers owned by the supplier."""
    c = lambda name: text(F.col(name))
    item = product_id(c("sku"), c("canonical_url"), F.col("variant_options"), F.col(supplier))
    country = F.upper(strip(c("country")))
    properties = _struct_or_null({
        "manufacturer": blank_to_null(c("manufacturer")), "brand": blank_to_null(c("brand")),
        "region": blank_to_null(c("region")), "description": blank_to_null(c("description")),
        "ingredients": F.lit(None).cast("string"), "allergens": F.lit(None).cast("array<string>"),
        "color": blank_to_null(c("color")), "storage_advice": F.lit(None).cast("string"),
        "labels": _non_empty_array(F.array_sort(F.filter("labels", lambda x: x.isin(PAYLOAD_LABELS)))),
        "country": F.when(country.rlike(r"(?U)^\p{L}{2}$"), country),
    })
    staged = products.withColumn("_id", item)
    item = F.col("_id")
    return staged.select(
        F.col(supplier), item.alias("id"), c("status").alias("status"),
        category_id(c("category_path"), F.col(supplier)).alias("category"),
        blank_to_null(F.substring(collapse_space(c("item_name")), 1, NAME_LENGTH)).alias("name"),
        first_non_empty(c("order_by"), F.lit("vessel")).alias("order_by"),
        _vessel(item, payload_number(c("vessel_size")), c("vessel_unit"), payload_vessel_code(c("vessel_type"))).alias("vessel"),
        _bundles(item, payload_number(c("bundle_size")), payload_bundle_code(c("bundle_type"))).alias("bundles"),
        cents(c("price")).alias("price"), blank_to_null(c("price_per")).alias("price_per"),
        payload_number(c("min_order_count")).alias("min_order_count"),
        blank_to_null(c("gtin")).alias("gtin"), properties.alias("custom_properties"),
        _image(c("image_url")).alias("image"),
    )


def payload_json(payloads: DataFrame) -> DataFrame:
    """Payload as JSON text; null fields disappear."""
    return payloads.select("id", F.to_json(F.struct(*PAYLOAD_FIELDS)).alias("payload"))


def fingerprint(payloads: DataFrame) -> Column:
    """Canonical comparison value: id dropped, image URL only, bundles and labels sorted,
    empty values dropped.  Equal payloads have equal fingerprints on both sides."""
    present = lambda field: blank_to_null(F.col(field))
    p = lambda field: blank_to_null(F.col(f"custom_properties.{field}"))
    properties = _struct_or_null({
        **{f: p(f) for f in ("manufacturer", "brand", "region", "description", "ingredients")},
        "allergens": _non_empty_array(F.col("custom_properties.allergens")),
        "color": p("color"), "storage_advice": p("storage_advice"),
        "labels": _non_empty_array(F.array_sort("custom_properties.labels")),
        "country": p("country"),
    })
    vessel = _struct_or_null({
        "id": blank_to_null(F.col("vessel.id")), "size": F.col("vessel.size"),
        "unit": blank_to_null(F.col("vessel.unit")), "type": blank_to_null(F.col("vessel.type")),
    })
    canonical = F.struct(
        *[present(f).alias(f) for f in ("status", "category", "name", "order_by", "price_per", "gtin")],
        vessel.alias("vessel"), _non_empty_array(F.array_sort("bundles")).alias("bundles"),
        F.col("price"), F.col("min_order_count"), properties.alias("custom_properties"),
        blank_to_null(F.col("image.url")).alias("image"),
    )
    return F.sha2(F.to_json(canonical), 256)


def _owner(owner: Column | None) -> Column:
    """The supplier a remote product belongs to: by default its id up to '__'."""
    return owner if owner is not None else F.when(F.col("id").contains("__"), F.substring_index("id", "__", 1))


def _of_run(remote: DataFrame, run: DataFrame, supplier: str) -> DataFrame:
    """Add `_ours`: whether the row's `_owner` is a supplier of this run (a table with a supplier column)."""
    run = run.select(F.col(supplier).alias("_owner")).distinct()
    return join_checked(remote, run.withColumn("_ours", F.lit(True)), "_owner")


def last_per_id(local: DataFrame, supplier: str, order: str | None, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The landed feed, and (supplier, id, _local, _at) of the row that counts per id.

    Of several rows of a supplier with one id the last by `order` (else by position) counts; rows that share the place too are
    ordered by their content, so the choice does not depend on partitions.  `limit` keeps that many
    ids per supplier, in id order, after ids are unique.
    """
    feed = landed(local.select(
        F.col(supplier), "id", fingerprint(local).alias("_local"), F.to_json(F.struct(*PAYLOAD_FIELDS)).alias("_payload"),
        (F.col(order).cast("bigint") if order else F.monotonically_increasing_id()).alias("_place"),
        F.monotonically_increasing_id().alias("_at")), "feed")
    # one narrow shuffle on the id, which the join with the other side uses again; no payloads
    narrow = feed.select(supplier, "id", "_local", "_place", "_at", F.xxhash64("_payload").alias("_content")).repartition("id")
    picked = narrow.groupBy("id", supplier).agg(F.max(F.struct("_place", "_content", "_at", "_local")).alias("p"))
    last = picked.select(supplier, "id", "p._local", "p._at")
    if limit is not None:
        place = F.row_number().over(Window.partitionBy(supplier).orderBy("id"))
        last = last.withColumn("_nth", place).filter(F.col("_nth") <= limit).drop("_nth")
    return feed, last


def catalog_plan(
    local: DataFrame, remote: DataFrame, supplier: str = "supplier_slug", owner: Column | None = None,
    skip_inactivate: Column | bool = False, limit: int | None = None, suppliers: DataFrame | None = None,
    order: str | None = None,
) -> DataFrame:
    """One row per product to create, update or inactivate, and per unchanged product.

    Only (id, status, fingerprint) of both sides meets in the join; payloads are attached to
    the rows that need one.  A product that left the feed is touched only if its owner is a
    supplier of this run.  Of several feed rows with one id the last by `order` (a row number) counts.
    `limit` takes that many products of each supplier.  `skip_inactivate` keeps products that
    disappeared from the feed.
    """
    feed, last = last_per_id(local, supplier, order, limit)
    theirs = _of_run(remote.select(
        _owner(owner).alias("_owner"), "id", F.col("status").alias("remote_status"), fingerprint(remote).alias("_remote"),
        F.lit(True).alias("_known")), local if suppliers is None else suppliers, supplier)
    in_feed = F.col("_at").isNotNull()
    action = (
        F.when(in_feed & F.col("_known").isNull(), "create")
        .when(in_feed & (F.col("_local") == F.col("_remote")), "unchanged")
        .when(in_feed, "update")
        .when(F.col("remote_status") == "INACTIVE", "unchanged")
        .otherwise("inactivate")
    )
    skip = F.lit(skip_inactivate) if isinstance(skip_inactivate, bool) else skip_inactivate
    plan = last.join(theirs, "id", "full_outer").filter(in_feed | (F.coalesce("_ours", F.lit(False)) & ~skip)).select(
        F.coalesce(supplier, "_owner").alias(supplier), "id", action.alias("action"), "_at",
        F.when(in_feed, "feed").otherwise("remote").alias("origin"))
    sent = plan.withColumn("_at", F.when(F.col("action").isin("create", "update"), F.col("_at")))
    # on the id as well, by which the plan already lies
    return sent.join(feed.select("id", "_at", "_payload"), ["id", "_at"], "left").select(
        supplier, "id", "action",
        F.when(F.col("action") == "inactivate", F.to_json(F.struct(F.lit("INACTIVE").alias("status"))))
        .otherwise(F.col("_payload")).alias("payload"), "origin")


def missing_from_feed(
    local: DataFrame, remote: DataFrame, owner: Column | None = None, suppliers: DataFrame | None = None,
) -> DataFrame:
    """Remote products of this run's suppliers that are no longer in the feed."""
    owned = _of_run(remote.select(_owner(owner).alias("_owner"), "id", "status"), local if suppliers is None else suppliers, "supplier_slug")
    action = F.when(F.col("status") == "INACTIVE", "unchanged").otherwise("inactivate")
    return owned.filter("_ours").join(local.select("id"), "id", "left_anti").select(
        F.col("_owner").alias("supplier_slug"), "id", action.alias("action"))


def skip_inactivate(explicit: Column, policy: Column) -> Column:
    """An explicit flag wins; otherwise the policy text decides."""
    return F.coalesce(explicit, F.lower(strip(text(policy))) == "keep_existing")


def plan_summary(plan: DataFrame, category_plan: DataFrame | None = None, supplier: str = "supplier_slug") -> DataFrame:
    """Counters per supplier."""
    counted = plan.groupBy(supplier).agg(*[
        F.count_if(F.col("action") == a).alias(n) for a, n in [
            ("create", "created_products"), ("update", "updated_products"),
            ("inactivate", "inactivated_products"), ("unchanged", "unchanged_products"),
        ]
    ])
    if category_plan is None:
        return counted
    categories = category_plan.groupBy(supplier).agg(
        F.count_if(F.col("action") == "create").alias("created_categories"),
        F.count_if(F.col("action") == "update").alias("updated_categories"),
    )
    return counted.join(categories, supplier, "full_outer").na.fill(0)
