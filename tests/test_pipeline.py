from pyspark.sql import functions as F

from shelfspark.operators.skew import scratch_folder
from shelfspark.plans.derived import products, remote_products
from shelfspark.plans.pipeline import run_catalog
from shelfspark.sources import readers


def run(spark, sf_dir, records, **options):
    failures = spark.createDataFrame([], "stage string, url string, reason string")
    discovered = records.select(F.col("product_url").alias("url"))
    remote_categories = spark.createDataFrame([], "id string, name string, ordinal int")
    folder = scratch_folder(spark, "run")
    tables = run_catalog(records, failures, discovered, remote_products(spark, sf_dir), remote_categories, folder, "2024-01-01", **options)
    return tables, folder


def test_blocked_run_has_no_plan(spark, sf_dir):
    tables, _ = run(spark, sf_dir, products(spark, sf_dir).filter("supplier_slug = 'hub'"))
    assert not tables["gate"].first()["is_valid"] and "plan" not in tables
    assert (tables["summary"].first()["sync_aborted"], tables["summary"].first()["sync_reason"]) == (True, "validation_errors")
    assert tables["summary"].first()["sync_performed"] is False


def test_valid_run_and_sync_from_its_export(spark, sf_dir):
    # records without packaging text cannot contradict it
    calm = products(spark, sf_dir).filter("supplier_slug = 'hub'").withColumns(
        {c: F.lit("") for c in ("raw_spec_piece_text", "raw_detail_price_unit_text", "raw_fill_text", "raw_bundle_text", "description")})
    tables, folder = run(spark, sf_dir, calm)
    summary = tables["summary"].first()
    assert summary["is_valid"] and summary["product_count"] == calm.count()
    assert summary["created_products"] == tables["cleaned"].count() and summary["inactivated_products"] > 0
    exported = readers.read_products_jsonl(spark, f"{folder}/products_raw.jsonl")
    again, _ = run(spark, sf_dir, exported.withColumns(
        {"supplier_slug": F.lit("hub"), "ordinal": F.monotonically_increasing_id()}), mode="sync_from_export", skip_inactivate=True)
    prices = lambda t: sorted(r[0] for r in t["cleaned"].select("Price").collect())
    assert prices(again) == prices(tables)
    assert again["summary"].first()["inactivated_products"] == 0


def test_suppliers_in_one_run_equal_runs_alone(spark, sf_dir):
    """Two suppliers pass, one is blocked; ids, numbers, plan and artifacts are those of each alone."""
    import json

    from shelfspark.plans.pipeline import run_suppliers
    from shelfspark.schema import IMPORT_COLUMNS

    texts = ("raw_spec_piece_text", "raw_detail_price_unit_text", "raw_fill_text", "raw_bundle_text", "description")
    several = products(spark, sf_dir).filter("supplier_slug in ('shop2', 'shop1', 'hub')")
    several = several.withColumns({c: F.when(F.col("supplier_slug") == "hub", F.col(c)).otherwise("") for c in texts})
    # an id that two suppliers share
    several = several.withColumn("sku", F.when(F.col("ordinal") % 9 == 0, F.lit("SAME")).otherwise(F.col("sku")))
    failures = spark.createDataFrame([("shop2", "detail", "u", "broken")], "supplier_slug string, stage string, url string, reason string")
    diagnostics = spark.createDataFrame([("shop2", "1", "30"), ("shop1", "1", "12")], "supplier_slug string, page string, cards string")
    found = several.select("supplier_slug", F.col("product_url").alias("url"))
    categories = spark.createDataFrame([], "id string, name string, ordinal int")
    remote, folder = remote_products(spark, sf_dir), scratch_folder(spark, "suppliers")
    tables = run_suppliers(several, failures, found, remote, categories, folder, "2024-01-01", diagnostics=diagnostics)
    gate = {r["supplier_slug"]: r["is_valid"] for r in tables["gate"].collect()}
    assert gate == {"shop2": True, "shop1": True, "hub": False}
    summary = {r["supplier_slug"]: r for r in tables["summary"].collect()}
    assert not tables["plan"].filter("supplier_slug = 'hub'").count() and summary["hub"]["sync_reason"] == "validation_errors" and summary["hub"]["errors"]
    assert summary["shop2"]["warnings"] == ["failed_urls: 1"] and summary["shop2"]["stages"]["scrape"]["raw_record_count"] == summary["shop2"]["product_count"] + 1
    for slug in ("shop2", "hub"):
        alone, _ = run(spark, sf_dir, several.filter(F.col("supplier_slug") == slug))
        rows = lambda t: sorted(map(str, t["cleaned"].select("row_number", *IMPORT_COLUMNS).filter(tag).collect()))
        tag = F.lit(True)
        mine = rows(alone)
        tag = F.col("supplier_slug") == slug
        assert rows(tables) == mine
        assert alone["summary"].first()["checksum"] == summary[slug]["checksum"] and alone["gate"].first()["error_count"] == summary[slug]["error_count"]
        if slug == "shop2":
            plan = lambda t: sorted(map(str, t["plan"].filter("supplier_slug = 'shop2'").select("id", "action", "payload").collect()))
            assert plan(tables) == plan(alone) and alone["summary"].first()["inactivated_products"] == summary["shop2"]["inactivated_products"] > 0
    # artifacts: one folder per supplier; a later run of one supplier replaces its own only
    before = spark.read.json(f"{folder}/run_summary.json/supplier_slug=shop1").first()["product_count"]
    again = several.filter("supplier_slug = 'shop2'").limit(5)
    run_suppliers(again, failures.limit(0), found.filter("supplier_slug = 'shop2'"), remote, categories, folder, "2024-01-02", skip_inactivate=True, diagnostics=diagnostics.filter("supplier_slug = 'shop2'"))
    summaries = {r["supplier_slug"]: r for r in spark.read.json(f"{folder}/run_summary.json").collect()}
    assert summaries["shop2"]["product_count"] == 5 and summaries["shop1"]["product_count"] == before > 5
    assert spark.read.option("header", True).csv(f"{folder}/products.csv/supplier_slug=shop2").count() == 5
    assert {json.loads(r["value"])["cards"] for r in spark.read.text(f"{folder}/listing_diagnostics.jsonl").collect()} == {"30", "12"}
    states = readers.read_states(spark, f"{folder}/state.json")
    assert sorted((r["supplier_slug"], r["generated_at"]) for r in states.collect()) == sorted([("shop2", "2024-01-01"), ("shop2", "2024-01-02"), ("shop1", "2024-01-01")])
