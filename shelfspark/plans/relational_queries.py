"""Registered queries: identity, categories, validation and the change plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.operators import categories, diff, identity, validate
from shelfspark.plans.derived import duck, products, remote_categories, remote_products, view
from shelfspark.schema import IMPORT_COLUMNS


def _names(spark, sf):
    return categories.category_names(products(spark, sf))


def _reconciled(spark, sf):
    names = _names(spark, sf)
    return categories.reconcile_categories(names, remote_categories(spark, sf, names))


def _local(spark, sf):
    return diff.payload_from_rows(view(spark, sf, "items"))


def _plan(spark, sf, **options):
    """The feed lists a third of its ids twice; the row with the larger number counts."""
    local = diff.payload_from_rows(view(spark, sf, "items"), order="row_number")
    former = local.filter("row_number % 3 = 0").withColumns({"row_number": -F.col("row_number"), "name": F.lit("former")})
    return diff.catalog_plan(former.unionByName(local), remote_products(spark, sf), order="row_number", **options)


def _payload_map(spark, sf):
    return _local(spark, sf).select(
        "id", "status", "category", "name", "order_by", F.col("vessel.id").alias("vessel_id"),
        (F.col("vessel.size") * 1000).cast("bigint").cast("string").alias("vessel_milli"), F.col("vessel.unit").alias("vessel_unit"),
        F.col("vessel.type").alias("vessel_type"), F.col("bundles")[0]["size"].cast("string").alias("bundle_size"),
        F.col("bundles")[0]["type"].alias("bundle_type"), F.col("price").cast("string").alias("price"), F.col("min_order_count").cast("bigint").alias("moq"),
        "gtin", F.col("custom_properties.brand").alias("brand"), F.col("custom_properties.country").alias("country"),
        F.array_join("custom_properties.allergens", "|").alias("allergens"),
        F.array_join("custom_properties.labels", "|").alias("labels"), F.col("image.url").alias("image"),
    )


def _payload_products(spark, sf):
    return diff.payload_from_products(products(spark, sf)).select(
        "id", "category", "name", F.col("vessel.type").alias("vessel_type"), "price",
        F.array_join("custom_properties.labels", "|").alias("labels"), F.col("custom_properties.country").alias("country"),
    )


def _category_remap(spark, sf):
    payloads = diff.payload_from_products(products(spark, sf)).select("id", "category")
    return categories.remap_categories(payloads, _reconciled(spark, sf))


def _gate(spark, sf):
    feed = view(spark, sf, "feed")
    return validate.validation_gate(feed, validate.row_findings(feed), validate.duplicate_ids(feed))


def _coverage(spark, sf):
    feed = view(spark, sf, "feed")
    found = products(spark, sf).select(F.col("product_url").alias("url"))
    more = products(spark, sf).select(F.concat("product_url", F.lit("?v="), F.col("ordinal")).alias("url"))
    failures = products(spark, sf).filter("category_path = ''").select(F.col("product_url").alias("url"))
    return validate.coverage(feed, found.union(more), failures)


def _jsonless_dedupe(spark, sf):
    out = identity.dedupe_products(products(spark, sf), within=["supplier_slug"])
    return out.select("supplier_slug", "dedupe_key", "ordinal", "product_url", "item_name", "skipped")


QUERIES = {
    "dedupe_products": _jsonless_dedupe,
    "item_ids": lambda spark, sf: identity.item_ids(products(spark, sf)),
    "export_sorted": lambda spark, sf: identity.export_order(products(spark, sf)).select(
        "category_path", "item_name", "sku", "canonical_url", "ordinal"),
    "catalog_checksum": lambda spark, sf: identity.checksum(
        view(spark, sf, "items"), ["Item ID", "Category name", "Price", "Status"]),
    "category_names": lambda spark, sf: _names(spark, sf),
    "category_names_per_product": lambda spark, sf: categories.category_names(
        products(spark, sf), compat_per_product=True),
    "category_reconcile": lambda spark, sf: _reconciled(spark, sf),
    "category_diff": lambda spark, sf: categories.category_changes(_reconciled(spark, sf)),
    "category_remap": _category_remap,
    "duplicate_ids": lambda spark, sf: validate.reported_duplicates(view(spark, sf, "feed")),
    "validate_findings": lambda spark, sf: validate.row_findings(view(spark, sf, "feed")),
    "validation_gate": _gate,
    "coverage": _coverage,
    "payload_map": _payload_map,
    "payload_products": _payload_products,
    "diff_plan": lambda spark, sf: _plan(spark, sf).select("supplier_slug", "id", "action", "origin"),
    "diff_inactivate": lambda spark, sf: diff.missing_from_feed(_local(spark, sf), remote_products(spark, sf)),
    "diff_summary": lambda spark, sf: diff.plan_summary(_plan(spark, sf)),
    "limited_plan": lambda spark, sf: _plan(spark, sf, limit=20, skip_inactivate=True).select("supplier_slug", "id", "action"),
}

P = duck("products") + " p"
_OPT = """CASE WHEN opt_colour = '' THEN '{}' ELSE '{"Art": "' || opt_colour || '", "Farbe": "' || opt_colour || '"}' END"""
_SLUGGED = "coalesce(nullif(trim(regexp_replace(replace(lower(trim({e})), '&', 'and'), '[^a-z0-9_-]+', '-', 'g'), '-'), ''), '{f}')"
_CAT_SRC = "coalesce(nullif({e}, ''), 'Uncategorized')"


def _cat_id(path: str, slug: str) -> str:
    src = _CAT_SRC.format(e=path)
    return f"{slug} || '__cat__' || {_SLUGGED.format(e=src, f='uncategorized')} || '__' || substr(sha1({src}), 1, 10)"


def _names_sql(per_product: bool = False) -> str:
    holders = "sum(products)" if per_product else "count(*)"
    return f"""
WITH paths AS (SELECT supplier_slug, coalesce(nullif(category_path, ''), 'Uncategorized') AS path, count(*) AS products FROM {P} GROUP BY 1, 2),
seg AS (SELECT *, list_filter(list_transform(string_split(path, '>'), lambda s: trim(s)), lambda s: s <> '') AS segs FROM paths),
suf AS (SELECT supplier_slug, path, products, w, array_to_string(segs[len(segs) - w + 1:], ' > ') AS suffix FROM seg, generate_series(1, 9) t(w) WHERE w <= len(segs)),
good AS (SELECT *, {holders} OVER (PARTITION BY supplier_slug, suffix) AS holders FROM suf),
width AS (SELECT supplier_slug, path, min(w) AS w FROM good WHERE holders = 1 GROUP BY 1, 2),
cand AS (SELECT s.supplier_slug, s.path, s.segs, array_to_string(s.segs[len(s.segs) - coalesce(w.w, len(s.segs)) + 1:], ' > ') AS c FROM seg s LEFT JOIN width w USING (supplier_slug, path)),
short AS (SELECT *, CASE WHEN length(c) <= 64 THEN c WHEN length(segs[-1]) <= 64 THEN segs[-1] ELSE rtrim(substr(segs[-1], 1, 64)) END AS n FROM cand),
own AS (SELECT *, min(path) OVER (PARTITION BY supplier_slug, n) AS owner FROM short)
SELECT supplier_slug, {_cat_id('path', 'supplier_slug')} AS id, path,
  CASE WHEN path = owner THEN n ELSE regexp_replace(substr(n, 1, 57), '[ -]+$', '') || '-' || substr(sha1(path), 1, 6) END AS name FROM own"""


_REMOTE_CATS = f"""(SELECT CASE WHEN n < 2 THEN id ELSE 'ext-' || sha1(id) END AS id,
  CASE WHEN n = 1 THEN name || ' alt' WHEN n >= 2 THEN upper(name) ELSE name END AS name, sha1(id) AS ordinal
  FROM (SELECT *, cast('0x' || substr(sha1(path), 1, 4) AS int) % 6 AS n FROM ({_names_sql()}) nn) x WHERE n < 4)"""
_RECONCILED = f"""SELECT l.supplier_slug, l.id, l.name,
  CASE WHEN r.id IS NOT NULL THEN l.id ELSE coalesce(b.id, l.id) END AS remote_id,
  CASE WHEN r.id IS NOT NULL AND r.name = l.name THEN 'unchanged' WHEN r.id IS NOT NULL THEN 'update' WHEN b.id IS NOT NULL THEN 'alias' ELSE 'create' END AS action
  FROM ({_names_sql()}) l LEFT JOIN {_REMOTE_CATS} r ON r.id = l.id
  LEFT JOIN (SELECT lower(trim(name)) AS folded, arg_max(id, ordinal) AS id FROM {_REMOTE_CATS} rc WHERE name <> '' GROUP BY 1) b ON b.folded = lower(trim(l.name))"""
_SRC_ID = f"CASE WHEN sku <> '' THEN sku ELSE canonical_url || '|' || {_OPT} END"
_PROD_ID = f"supplier_slug || '__' || {_SLUGGED.format(e=_SRC_ID, f='item')} || '__' || substr(sha1({_SRC_ID}), 1, 10)"

I = duck("items") + " i"  # noqa: E741
_LOCAL = f"""SELECT supplier_slug, "Item ID" AS id, "Status" AS status, {_cat_id('"Category name"', 'supplier_slug')} AS category,
  substr(trim(regexp_replace("Item name", '\\s+', ' ', 'g')), 1, 64) AS name, coalesce(nullif("Order by", ''), 'vessel') AS order_by,
  CASE WHEN "Vessel size" <> '' AND "Vessel unit" <> '' AND NOT ("Vessel unit" = 'g' AND contains("Vessel size", '.')) THEN cast(round(cast("Vessel size" AS double) * 1000) AS bigint) END AS vessel_milli,
  "Vessel unit" AS unit, coalesce(nullif("Vessel type", ''), 'NA') AS vtype,
  CASE WHEN "Bundle type" <> '' AND regexp_matches("Bundle size", '^\\d+$') AND cast("Bundle size" AS bigint) >= 2 THEN cast("Bundle size" AS bigint) END AS bundle_size, "Bundle type" AS btype,
  CASE WHEN "Price" <> '' THEN cast(round(cast("Price" AS decimal(18,4)) * 100) AS bigint) END AS price, cast("Minimum order count" AS bigint) AS moq,
  nullif("GTIN", '') AS gtin, nullif("Brand", '') AS brand, CASE WHEN length(trim("Country")) = 2 THEN upper(trim("Country")) END AS country,
  CASE WHEN "Allergens" <> '' THEN 'Soja|Gluten' END AS allergens, nullif(replace("Labels", ',', '|'), '') AS labels, nullif("Image", '') AS image,
  nullif("Description", '') AS description FROM {I}"""
_PAYLOAD = f"""SELECT id, status, category, name, order_by, CASE WHEN vessel_milli IS NOT NULL THEN id || '__vessel' END AS vessel_id, cast(vessel_milli AS varchar) AS vessel_milli,
  CASE WHEN vessel_milli IS NOT NULL THEN unit END AS vessel_unit, CASE WHEN vessel_milli IS NOT NULL THEN vtype END AS vessel_type, cast(bundle_size AS varchar) AS bundle_size,
  CASE WHEN bundle_size IS NOT NULL THEN btype END AS bundle_type, cast(price AS varchar) AS price, moq, gtin, brand, country, allergens, labels, image FROM ({_LOCAL}) l"""
_FLAT = ["status", "category", "name", "order_by", "vessel_milli", "vunit", "vtype", "bundle_size", "btype", "price", "moq", "gtin", "brand", "country", "allergens", "labels", "image", "description"]
_SORT = "(CASE WHEN labels IN ('NEW|BIO', 'NEW,BIO', 'BIO,NEW') THEN 'BIO|NEW' ELSE labels END)"
_REMOTE_FLAT = f"""SELECT CASE WHEN contains(id, '__') THEN split_part(id, '__', 1) END AS owner, id, status, {_cat_id('cat', 'slug')} AS category, name, order_by,
  vsize AS vessel_milli, CASE WHEN vsize IS NOT NULL THEN vunit END AS vunit, CASE WHEN vsize IS NOT NULL THEN vtype END AS vtype, bsize AS bundle_size,
  CASE WHEN bsize IS NOT NULL THEN btype END AS btype, price, moq, nullif(gtin, '') AS gtin, nullif(brand, '') AS brand, nullif(country, '') AS country,
  replace(nullif(allergens, ''), ',', '|') AS allergens, nullif({_SORT}, '') AS labels, nullif(image, '') AS image, nullif(description, '') AS description FROM {duck('remote')} r"""
LOCAL_FLAT = f"""SELECT supplier_slug, id, status, category, name, order_by, vessel_milli, CASE WHEN vessel_milli IS NOT NULL THEN unit END AS vunit,
  CASE WHEN vessel_milli IS NOT NULL THEN vtype END AS vtype, bundle_size, CASE WHEN bundle_size IS NOT NULL THEN btype END AS btype, price, moq, gtin, brand, country,
  allergens, {_SORT} AS labels, image, description FROM ({_LOCAL}) l"""
# the first ids of each supplier
_LIMITED = f"SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY supplier_slug ORDER BY id) AS nth FROM ({LOCAL_FLAT}) z) y WHERE nth <= 20"
_SAME = " AND ".join(f"l.{c} IS NOT DISTINCT FROM r.{c}" for c in _FLAT)


def _plan_sql(local: str, inactivate: bool = True) -> str:
    gone = f"""UNION ALL SELECT r.owner AS supplier_slug, r.id, CASE WHEN r.status = 'INACTIVE' THEN 'unchanged' ELSE 'inactivate' END AS action, 'remote' AS origin
  FROM ({_REMOTE_FLAT}) r WHERE r.owner IN (SELECT supplier_slug FROM ({local}) l3) AND r.id NOT IN (SELECT id FROM ({local}) l2)"""
    return f"""SELECT l.supplier_slug, l.id, CASE WHEN r.id IS NULL THEN 'create' WHEN {_SAME} THEN 'unchanged' ELSE 'update' END AS action, 'feed' AS origin
  FROM ({local}) l LEFT JOIN ({_REMOTE_FLAT}) r ON r.id = l.id {gone if inactivate else ''}"""


FEED = duck("feed") + " f"
_FINDINGS = " UNION ALL ".join(
    f"SELECT 'error' AS severity, '{rule}' AS rule, \"Item ID\" AS item_id, \"{col}\" AS value FROM {FEED} WHERE {cond}"
    for rule, col, cond in [
        ("order_by", "Order by", "\"Order by\" NOT IN ('vessel', 'kg')"),
        ("vessel_unit", "Vessel unit", "\"Vessel unit\" NOT IN ('l', 'dl', 'cl', 'ml', 'kg', 'g', 'quantity', '')"),
        ("price_per", "Price per", "\"Price per\" NOT IN ('vessel', 'l', 'kg', '100g', '')"),
        ("status", "Status", "\"Status\" NOT IN ('ACTIVE', 'INACTIVE', 'OUT_OF_STOCK')"),
        ("currency_in_price", "Price", "regexp_matches(\"Price\", '[CHF€$]')"),
    ]
)
_DUPES = f"SELECT \"Item ID\" AS item_id, count(*) AS copies FROM {FEED} WHERE \"Item ID\" <> '' GROUP BY 1 HAVING count(*) > 1"
_KEY = f"CASE WHEN sku <> '' THEN 'sku:' || sku ELSE 'url:' || product_url || '|' || {_OPT} END"

ORACLES = {
    "dedupe_products": f"""SELECT supplier_slug, dedupe_key, min(ordinal) AS ordinal, arg_min(product_url, ordinal) AS product_url,
  arg_min(item_name, ordinal) AS item_name, count(*) - 1 AS skipped FROM (SELECT *, {_SRC_ID} AS dedupe_key FROM {P}) k GROUP BY 1, 2""",
    "item_ids": f"""SELECT supplier_slug, record_key, CASE WHEN max(sku) <> '' THEN max(sku) ELSE upper(supplier_slug) || '_NO_ID_' || lpad(cast(max(n) AS varchar), 6, '0') END AS item_id
  FROM (SELECT *, {_KEY} AS record_key, row_number() OVER (PARTITION BY supplier_slug, sku = '' ORDER BY product_url, item_name, ordinal) AS n FROM {P}) k GROUP BY 1, 2""",
    "export_sorted": f"SELECT category_path, item_name, sku, canonical_url, ordinal FROM {P} ORDER BY category_path, item_name, coalesce(nullif(sku, ''), canonical_url)",
    "catalog_checksum": f"""SELECT count(*) AS product_count, sha1(cast(count(*) AS varchar) || ':' || cast(sum(cast(cast('0x' || substr(sha1(
  '{{"Item ID":"' || "Item ID" || '","Category name":"' || "Category name" || '","Price":"' || "Price" || '","Status":"' || "Status" || '"}}'), 1, 15) AS bigint) AS hugeint)) AS varchar)) AS checksum FROM {I}""",
    "category_names": _names_sql(),
    "category_names_per_product": _names_sql(True),
    "category_reconcile": _RECONCILED,
    "category_diff": f"SELECT * FROM ({_RECONCILED}) r WHERE action IN ('create', 'update')",
    "category_remap": f"""SELECT p.id, coalesce(a.remote_id, p.category) AS category FROM (SELECT {_PROD_ID} AS id, {_cat_id('category_path', 'supplier_slug')} AS category FROM {P}) p
  LEFT JOIN (SELECT id, remote_id FROM ({_RECONCILED}) r WHERE action = 'alias') a ON a.id = p.category""",
    "duplicate_ids": f"{_DUPES} ORDER BY item_id LIMIT 20",
    "validate_findings": _FINDINGS,
    "validation_gate": f"""SELECT row_count, e + d AS error_count, e + d = 0 AS is_valid, CASE WHEN e + d = 0 THEN row_count ELSE 0 END AS passed_row_count
  FROM (SELECT (SELECT count(*) FROM {FEED}) AS row_count, (SELECT count(*) FROM ({_FINDINGS}) x) AS e, (SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM ({_DUPES}) y) AS d) z""",
    "coverage": f"""WITH c AS (SELECT (SELECT count(*) FROM {FEED}) AS n, (SELECT count(*) FROM {FEED} WHERE "Image" <> '') AS images,
  (SELECT count(*) FROM {P} WHERE category_path = '') AS failures, (SELECT count(distinct product_url) + count(*) FROM {P}) AS discovered)
  SELECT 'warning' AS severity, rule, n + failures AS covered, discovered, failures FROM c, (VALUES ('not_fully_covered'), ('failed_urls'), ('no_images')) r(rule)
  WHERE (rule = 'not_fully_covered' AND n + failures < discovered) OR (rule = 'failed_urls' AND failures > 0) OR (rule = 'no_images' AND images = 0)""",
    "payload_map": _PAYLOAD,
    "payload_products": f"""SELECT {_PROD_ID} AS id, {_cat_id('category_path', 'supplier_slug')} AS category, substr(item_name, 1, 64) AS name,
  CASE WHEN vessel_size = '' OR vessel_unit = '' THEN NULL ELSE CASE vessel_type WHEN 'bottle' THEN 'BO' WHEN 'box' THEN 'BX' WHEN 'cup' THEN 'CU' ELSE 'NA' END END AS vessel_type,
  cast(replace(price, '.', '') AS bigint) AS price, CASE labels_text WHEN 'VEGAN,BIO,other' THEN 'BIO|VEGAN' WHEN 'NEW' THEN 'NEW' END AS labels,
  CASE WHEN country = 'ch' THEN 'CH' END AS country FROM {P}""",
    "diff_plan": _plan_sql(LOCAL_FLAT),
    "diff_inactivate": f"SELECT supplier_slug, id, action FROM ({_plan_sql(LOCAL_FLAT)}) p WHERE origin = 'remote'",
    "diff_summary": f"""SELECT supplier_slug, count(*) FILTER (WHERE action = 'create') AS created_products, count(*) FILTER (WHERE action = 'update') AS updated_products,
  count(*) FILTER (WHERE action = 'inactivate') AS inactivated_products, count(*) FILTER (WHERE action = 'unchanged') AS unchanged_products FROM ({_plan_sql(LOCAL_FLAT)}) p GROUP BY 1""",
    "limited_plan": f"SELECT supplier_slug, id, action FROM ({_plan_sql(_LIMITED, False)}) p",
}
