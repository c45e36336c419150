"""One catalogue run of a supplier: products -> artifacts, change plan and summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.operators import categories, clean, diff, identity, operations, packaging, validate
from shelfspark.operators.importrows import to_import_rows
from shelfspark.operators.skew import landed, with_sequence
from shelfspark.schema import IMPORT_COLUMNS
from shelfspark.sources import writers

# Suppliers of a run that are sent to every task; more are joined.
SUPPLIERS_SENT = 10_000


def run_catalog(
    products: DataFrame, failures: DataFrame, discovered: DataFrame, remote: DataFrame, remote_categories: DataFrame,
    folder: str, generated_at: str, mode: str = "scrape_and_sync", dry_run: bool = False,
    skip_inactivate: Column | bool = False, limit: int | None = None, supplier: str = "",
) -> dict[str, DataFrame]:
    """Export, clean, validate and diff the product records of one supplier.

    `products` carries supplier_slug and ordinal.  The decisions, the cleaned rows and the
    plan are landed once; every artifact below reads those tables.  There is no plan when
    validation finds an error or in `scrape_only` mode.  With `supplier` the artifacts go to
    that supplier's own folder.
    """
    order = [F.col("category_path"), F.col("item_name"),
             F.coalesce(F.nullif("sku", F.lit("")), "canonical_url"), F.col("ordinal")]
    products = landed(products, "products")  # extraction output feeds ids, numbering and records
    numbered = with_sequence(identity.with_item_ids(products), order, "row_number", start=2)
    decided = landed(packaging.decide_packaging(numbered), "decided")
    interpreted = packaging.apply_decisions(decided)

    cleaned_rows, corrections = clean.clean_both(to_import_rows(interpreted, keep=["row_number"]))
    cleaned, corrections = landed(cleaned_rows, "cleaned"), landed(corrections, "corrections")
    findings = landed(
        validate.row_findings(cleaned).unionByName(validate.packaging_findings(cleaned, interpreted))
        .unionByName(validate.schema_errors(cleaned)), "findings")
    gate = landed(validate.validation_gate(cleaned, findings, validate.duplicate_ids(cleaned)), "gate")

    tables = {"products": interpreted, "cleaned": cleaned, "corrections": corrections, "findings": findings, "gate": gate,
              "warnings": validate.coverage(cleaned, discovered, failures)}
    counts = None
    if mode != "scrape_only" and gate.first()["is_valid"]:
        supplied = cleaned.join(interpreted.select("row_number", "supplier_slug"), "row_number")
        names = categories.category_names(supplied, path="Category name")
        reconciled = landed(categories.reconcile_categories(names, remote_categories), "categories")
        local = categories.remap_categories(diff.payload_from_rows(supplied), reconciled)
        plan = landed(diff.catalog_plan(local, remote, skip_inactivate=skip_inactivate, limit=limit), "plan")
        changes = landed(categories.category_changes(reconciled), "category-changes")
        counts = diff.plan_summary(plan, changes)
        tables |= {"plan": plan, "categories": changes}
    tables["summary"] = operations.run_summary(
        interpreted, failures, discovered, gate, corrections, counts, mode, generated_at, dry_run, supplier,
        identity.checksum(cleaned, IMPORT_COLUMNS), tables["warnings"], remote)
    folder = f"{folder.rstrip('/')}/{supplier}" if supplier else folder

    path = lambda artifact: writers.artifact_path(folder, artifact)
    writers.write_import_csv(cleaned.orderBy("row_number"), path("csv"))
    writers.write_corrections(corrections, path("corrections"))
    writers.write_audit(packaging.audit_of(decided), path("audit"))
    writers.write_jsonl(interpreted.drop("supplier_slug", "ordinal", "row_number", "item_id"), path("raw"))
    writers.write_jsonl(failures, path("failures"))
    writers.write_jsonl(tables["summary"], path("summary"))
    if counts is not None:
        writers.write_jsonl(tables["plan"], path("report"))
        writers.write_jsonl(remote, path("remote_products"))
        writers.write_jsonl(remote_categories, path("remote_categories"))
        writers.append_state(tables["summary"], path("state"), folder)
    elif mode != "scrape_only":  # a blocked run reports why
        writers.write_jsonl(tables["summary"].select("supplier_slug", "sync_aborted", "sync_reason", "error_count"), path("report"))
    return tables


def run_suppliers(
    products: DataFrame, failures: DataFrame, discovered: DataFrame, remote: DataFrame, remote_categories: DataFrame,
    folder: str, generated_at: str, mode: str = "scrape_and_sync", dry_run: bool = False,
    skip_inactivate: Column | bool = False, limit: int | None = None, diagnostics: DataFrame | None = None,
    covered: DataFrame | None = None, supplier: str = "supplier_slug",
) -> dict[str, DataFrame]:
    """One run of any number of suppliers in one plan; every table and artifact is keyed by the supplier.

    Row numbers, item ids, repeated ids, findings, the gate, the product limit, the checksum and the summary are those of
    each supplier, as if it had run alone.  A supplier that fails validation keeps its artifacts and gets no
    plan; the others are not held up.  Artifacts of suppliers outside the run stay.  States are appended
    last, so a run that stops before has not advanced any supplier.
    """
    order = [F.col("category_path"), F.col("item_name"), F.coalesce(F.nullif("sku", F.lit("")), "canonical_url"), F.col("ordinal")]
    products = landed(products, "products")
    numbered = with_sequence(identity.with_item_ids(products, supplier), order, "row_number", within=[supplier], start=2)
    decided = landed(packaging.decide_packaging(numbered), "decided")
    interpreted = packaging.apply_decisions(decided)
    rows, corrections = clean.clean_both(to_import_rows(interpreted, keep=[supplier, "row_number"]), within=supplier)
    cleaned, corrections = landed(rows, "cleaned"), landed(corrections, "corrections")
    findings = landed(validate.row_findings(cleaned, supplier).unionByName(validate.packaging_findings(cleaned, interpreted, within=supplier)), "findings")
    duplicates = landed(validate.duplicate_ids(cleaned, [supplier]), "duplicates")
    gate = landed(validate.supplier_gate(cleaned, findings, duplicates, supplier), "gate")
    messages = landed(operations.finding_messages(findings, duplicates, supplier), "messages")
    tables = {"products": interpreted, "cleaned": cleaned, "corrections": corrections, "findings": findings, "gate": gate, "messages": messages}

    counts = None
    if mode != "scrape_only":
        passed = gate.filter("is_valid").select(supplier)
        supplied = cleaned.join(F.broadcast(passed) if passed.count() <= SUPPLIERS_SENT else passed, supplier, "left_semi")
        names = categories.category_names(supplied, path="Category name")
        reconciled = landed(categories.reconcile_categories(names, remote_categories), "categories")
        local = diff.payload_from_rows(supplied, supplier, order="row_number")
        local = categories.remap_categories(local, reconciled)
        plan = landed(diff.catalog_plan(local, remote, supplier, skip_inactivate=skip_inactivate, limit=limit, suppliers=passed, order="row_number"), "plan")
        changes = landed(categories.category_changes(reconciled), "category-changes")
        counts = landed(diff.plan_summary(plan, changes), "counts")
        tables |= {"plan": plan, "categories": changes}

    path = lambda artifact: writers.artifact_path(folder, artifact)
    written = ["csv", "corrections", "audit", "raw", "failures", "messages", *(["diagnostics"] if diagnostics is not None else []), *(["report"] if counts is not None else [])]
    owned = remote.filter(F.col("id").contains("__")).withColumn(supplier, F.substring_index("id", "__", 1))
    tables["summary"] = landed(operations.supplier_summary(
        interpreted, failures, discovered, gate, corrections, messages, counts, mode, generated_at, dry_run,
        identity.checksum(cleaned, IMPORT_COLUMNS, [supplier]), cleaned, owned.join(gate.select(supplier), supplier, "left_semi"), covered,
        {artifact: path(artifact) for artifact in written}, supplier), "summary")
    writers.write_import_csv(cleaned.repartitionByRange(supplier, "row_number").sortWithinPartitions(supplier, "row_number"), path("csv"), supplier)
    writers.write_corrections(corrections, path("corrections"), supplier)
    writers.write_audit(packaging.audit_of(decided, keep=[supplier]), path("audit"), supplier)
    writers.write_jsonl(interpreted.drop("ordinal", "row_number", "item_id"), path("raw"), supplier)
    writers.write_jsonl(failures, path("failures"), supplier)
    writers.write_jsonl(messages, path("messages"), supplier)
    if diagnostics is not None:
        writers.write_jsonl(diagnostics, path("diagnostics"), supplier)
    if counts is not None:
        writers.write_jsonl(tables["plan"], path("report"), supplier)
    writers.write_jsonl(tables["summary"], path("summary"), supplier)
    if counts is not None:
        writers.append_state(tables["summary"].filter("sync_performed"), path("state"), folder)
    return tables
