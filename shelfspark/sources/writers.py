"""Writers: one folder per artifact, partitioned by supplier where suppliers share a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.schema import CORRECTION_COLUMNS, IMPORT_COLUMNS, PACKAGING_AUDIT_COLUMNS, STATE_SCHEMA

# Artifact names within a supplier's output folder.
ARTIFACTS = {
    "csv": "products.csv", "corrections": "corrections.csv", "audit": "packaging_audit.csv", "raw": "products_raw.jsonl",
    "failures": "products_failures.jsonl", "diagnostics": "listing_diagnostics.jsonl", "summary": "run_summary.json",
    "report": "sync_report.json", "state": "state.json", "remote_products": "remote_products.json",
    "remote_categories": "remote_categories.json", "messages": "validation_messages.jsonl",
}


def artifact_path(root: str, artifact: str) -> str:
    return f"{root.rstrip('/')}/{ARTIFACTS[artifact]}"


def _of_supplier(writer, supplier: str):
    """One folder per supplier; an overwrite replaces those of the run's suppliers and leaves all others."""
    return writer.partitionBy(supplier).option("partitionOverwriteMode", "dynamic")


def _csv(df: DataFrame, path: str, columns: list[str], supplier: str | None) -> None:
    kept = df.select(*([supplier] if supplier else []), *columns)
    writer = (
        kept.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    )
    (_of_supplier(writer, supplier) if supplier else writer).csv(path)


def write_import_csv(rows: DataFrame, path: str, supplier: str | None = None) -> None:
    _csv(rows, path, IMPORT_COLUMNS, supplier)


def write_corrections(corrections: DataFrame, path: str, supplier: str | None = None) -> None:
    _csv(corrections, path, CORRECTION_COLUMNS, supplier)


def write_audit(audit: DataFrame, path: str, supplier: str | None = None) -> None:
    _csv(audit, path, PACKAGING_AUDIT_COLUMNS, supplier)


def write_jsonl(df: DataFrame, path: str, supplier: str | None = None, append: bool = False) -> None:
    """One object per line, empty fields kept, text unescaped."""
    writer = df.write.mode("append" if append else "overwrite").option("ignoreNullFields", False)
    (_of_supplier(writer, supplier) if supplier else writer).json(path)


def write_page_bundles(pages: DataFrame, path: str) -> None:
    """Page snapshots (snapshot_name, html), many to a file, one JSON object each."""
    pages.select("snapshot_name", "html").write.mode("append").json(path)


def write_log_bundles(lines: DataFrame, path: str) -> None:
    """Logs (job_id, ord, line) as a collector ships them: each file holds the whole logs of many jobs.

    A job's lines follow each other by `ord`, each behind its job and a tab.  So there are as many files as
    tasks that write, not as many as jobs.
    """
    files = lines.repartition("job_id").sortWithinPartitions("job_id", "ord")
    job = F.coalesce(F.col("job_id").cast("string"), F.lit(""))
    files.select(F.concat(job, F.lit("\t"), F.coalesce("line", F.lit(""))).alias("value")).write.mode("append").text(path)


def append_state(summary: DataFrame, path: str, export_folder: str = "") -> None:
    """Append the run state of suppliers whose run was no dry run and had no sync error."""
    good = summary.filter(~F.col("dry_run") & F.col("sync_performed") & F.col("is_valid"))
    names = [field.split()[0] for field in STATE_SCHEMA.split(", ")]
    good.withColumn("export_folder", F.lit(export_folder)).select(*names).write.mode("append").json(path)
