"""Registered queries of runs with several suppliers: every result is that of each supplier alone."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.operators import clean, diff, identity, operations, validate
from shelfspark.plans import oracle_clean
from shelfspark.plans.derived import duck, remote_products, view
from shelfspark.plans.relational_queries import ORACLES as RELATIONAL

# Feed rows dealt to three suppliers, of which one has half; ids repeat within and across them.
_SUPPLIER = "CASE WHEN row_number % 2 = 0 THEN 'hub' ELSE 'shop' || cast(row_number % 3 AS string) END"
_SUMMED = ["Price", "Status"]


def _feed(spark, sf):
    return view(spark, sf, "feed").withColumn("supplier_slug", F.expr(_SUPPLIER))


def _clean(spark, sf):
    cleaned = clean.clean_catalog(_feed(spark, sf), within="supplier_slug")
    return cleaned.select("supplier_slug", "row_number", F.col("Item ID").alias("item_id"), F.col("Price").alias("price"), F.col("Vessel unit").alias("vessel_unit"))


def _parts(spark, sf):
    """Rows of which only one supplier's are free of findings."""
    feed = _feed(spark, sf)
    calm = F.col("supplier_slug") != "shop1"
    for name, value in (("Order by", "vessel"), ("Vessel unit", ""), ("Price per", ""), ("Status", "ACTIVE"), ("Price", "1.00")):
        feed = feed.withColumn(name, F.when(calm, F.col(name)).otherwise(value))
    feed = feed.withColumn("Item ID", F.when(calm, F.col("Item ID")).otherwise(F.concat(F.lit("n"), F.col("row_number").cast("string"))))
    return feed, validate.row_findings(feed, "supplier_slug"), validate.duplicate_ids(feed, ["supplier_slug"])


def _gate(spark, sf):
    return validate.supplier_gate(*_parts(spark, sf), "supplier_slug")


def _checksum(spark, sf):
    return identity.checksum(_feed(spark, sf), _SUMMED, ["supplier_slug"]).select("supplier_slug", "product_count", "checksum")


def _summary(spark, sf):
    feed, findings, duplicates = _parts(spark, sf)
    gate = validate.supplier_gate(feed, findings, duplicates, "supplier_slug")
    failures = feed.filter("row_number % 10 = 0").select("supplier_slug", F.when(F.expr("row_number % 20 = 0"), "listing").otherwise("detail").alias("stage"))
    found = feed.select("supplier_slug", F.concat(F.lit("u"), (F.col("row_number") % 50).cast("string")).alias("url"))
    passed = gate.filter("is_valid").select("supplier_slug")
    local = diff.payload_from_rows(feed.join(passed, "supplier_slug", "left_semi"), order="row_number")
    plan = diff.catalog_plan(local, remote_products(spark, sf), suppliers=passed, order="row_number")
    out = operations.supplier_summary(
        feed, failures, found, gate, findings, operations.finding_messages(findings, duplicates), diff.plan_summary(plan), "scrape_and_sync", "now",
        checksum=identity.checksum(feed, _SUMMED, ["supplier_slug"]), rows=feed,
        covered=passed.withColumn("covered_product_url_count", F.lit(7).cast("bigint")), output_paths={"csv": "/out/products.csv"})
    return out.select(
        "supplier_slug", "product_count", "failure_count", "raw_record_count", "discovered_product_url_count", "covered_product_url_count", "error_count", "is_valid",
        "checksum", "created_products", "sync_performed", "sync_reason", F.size("errors").alias("errors"), F.array_join("warnings", "|").alias("warnings"),
        F.col("output_paths")["csv"].alias("csv"), F.col("stages.scrape.raw_record_count").alias("scraped"), F.col("stages.sync.aborted").alias("aborted"),
        F.col("stages.validation.warning_count").alias("warned"))


QUERIES = {"clean_suppliers": _clean, "supplier_gate": _gate, "supplier_checksum": _checksum, "supplier_summary": _summary}

_FEED = f"(SELECT * REPLACE ({_SUPPLIER.replace('AS string', 'AS varchar')} AS supplier_slug) FROM {duck('feed')} f0)"
_CALM = f"""(SELECT * REPLACE (CASE WHEN calm THEN "Order by" ELSE 'vessel' END AS "Order by", CASE WHEN calm THEN "Vessel unit" ELSE '' END AS "Vessel unit",
  CASE WHEN calm THEN "Price per" ELSE '' END AS "Price per", CASE WHEN calm THEN "Status" ELSE 'ACTIVE' END AS "Status", CASE WHEN calm THEN "Price" ELSE '1.00' END AS "Price",
  CASE WHEN calm THEN "Item ID" ELSE 'n' || cast(row_number AS varchar) END AS "Item ID") FROM (SELECT *, supplier_slug <> 'shop1' AS calm FROM {_FEED} c0) c1)"""
_ERRORS = """(CASE WHEN "Order by" NOT IN ('vessel', 'kg') THEN 1 ELSE 0 END + CASE WHEN "Vessel unit" NOT IN ('l', 'dl', 'cl', 'ml', 'kg', 'g', 'quantity', '') THEN 1 ELSE 0 END
  + CASE WHEN "Price per" NOT IN ('vessel', 'l', 'kg', '100g', '') THEN 1 ELSE 0 END + CASE WHEN "Status" NOT IN ('ACTIVE', 'INACTIVE', 'OUT_OF_STOCK') THEN 1 ELSE 0 END
  + CASE WHEN regexp_matches("Price", '[CHF€$]') THEN 1 ELSE 0 END)"""
_COUNTED = f"""SELECT supplier_slug, count(*) AS row_count, cast(sum(errors) AS bigint) AS e, count(DISTINCT CASE WHEN "Item ID" <> '' AND copies > 1 THEN "Item ID" END) AS repeated
  FROM (SELECT *, {_ERRORS} AS errors, count(*) OVER (PARTITION BY supplier_slug, "Item ID") AS copies FROM {_CALM} r) s GROUP BY 1"""
_GATE = f"""SELECT supplier_slug, row_count, e + d AS error_count, e + d = 0 AS is_valid, CASE WHEN e + d = 0 THEN row_count ELSE 0 END AS passed_row_count
  FROM (SELECT *, CASE WHEN repeated > 0 THEN 1 ELSE 0 END AS d FROM ({_COUNTED}) t) u"""


def _checksum_sql(rows: str) -> str:
    return f"""SELECT supplier_slug, count(*) AS product_count, sha1(cast(count(*) AS varchar) || ':' || cast(sum(cast(cast('0x' || substr(sha1(
  '{{"Price":"' || "Price" || '","Status":"' || "Status" || '"}}'), 1, 15) AS bigint) AS hugeint)) AS varchar)) AS checksum FROM {rows} q GROUP BY 1"""


_SUMMARY = f"""SELECT supplier_slug, product_count, failure_count, product_count + raw_failures AS raw_record_count, discovered AS discovered_product_url_count, covered AS covered_product_url_count,
  error_count, is_valid, checksum, CASE WHEN is_valid THEN created ELSE 0 END AS created_products, is_valid AS sync_performed,
  CASE WHEN is_valid THEN '' ELSE 'validation_errors' END AS sync_reason, cast(least(e + repeated, 20) AS int) AS errors,
  'failed_urls: ' || cast(failure_count AS varchar) AS failed, covered < discovered AS uncovered, images = 0 AS bare
FROM (SELECT g.*, t.e, t.repeated, c.product_count, c.checksum, f.*  EXCLUDE (supplier_slug), CASE WHEN g.is_valid THEN 7 ELSE g.row_count + f.failure_count END AS covered
  FROM ({_GATE}) g JOIN ({_COUNTED}) t USING (supplier_slug) JOIN ({_checksum_sql(_CALM)}) c USING (supplier_slug) JOIN (
    SELECT supplier_slug, count(*) FILTER (WHERE row_number % 10 = 0) AS failure_count, count(*) FILTER (WHERE row_number % 20 = 10) AS raw_failures,
      count(DISTINCT row_number % 50) AS discovered, count(DISTINCT "Item ID") AS created, count(*) FILTER (WHERE "Image" <> '') AS images FROM {_CALM} h GROUP BY 1) f USING (supplier_slug)) x"""

ORACLES = {
    "clean_suppliers": f"""SELECT supplier_slug, row_number, "Item ID" AS item_id, "Price" AS price, "Vessel unit" AS vessel_unit FROM ({oracle_clean.clean_oracle(_FEED + ' feed', 'supplier_slug')}) c""",
    "supplier_gate": _GATE,
    "supplier_checksum": _checksum_sql(_FEED),
    "supplier_summary": f"""SELECT * EXCLUDE (failed, uncovered, bare), array_to_string(list_filter([CASE WHEN uncovered THEN 'not_fully_covered: ' || cast(covered_product_url_count AS varchar) || ' of '
  || cast(discovered_product_url_count AS varchar) END, CASE WHEN failure_count > 0 THEN failed END, CASE WHEN bare THEN 'no_images' END], lambda w: w IS NOT NULL), '|') AS warnings,
  '/out/products.csv/supplier_slug=' || supplier_slug AS csv, raw_record_count AS scraped, NOT is_valid AS aborted,
  cast(CASE WHEN uncovered THEN 1 ELSE 0 END + CASE WHEN failure_count > 0 THEN 1 ELSE 0 END + CASE WHEN bare THEN 1 ELSE 0 END AS bigint) AS warned FROM ({_SUMMARY}) y""",
}
