"""Validation findings: errors block a sync, warnings do not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import units as U
from shelfspark.functions.text import has_text
from shelfspark.operators.skew import side_by_side
from shelfspark.schema import IMPORT_COLUMNS

DUPLICATES_REPORTED = 20


def schema_findings(rows: DataFrame) -> list[str]:
    """Check of the columns of a file of import rows, extra ones included; metadata only, no job."""
    present = [c for c in rows.columns if c not in ("row_number", "supplier_slug")]
    return [] if present == IMPORT_COLUMNS else ["columns do not match the required order"]


def schema_errors(rows: DataFrame) -> DataFrame:
    """The column order check as findings, so that a fault blocks the gate."""
    return rows.sparkSession.createDataFrame(
        [("error", "schema", None, fault) for fault in schema_findings(rows)], "severity string, rule string, item_id string, value string")


def duplicate_ids(rows: DataFrame, within: list[str] | None = None) -> DataFrame:
    """Non-empty item ids used more than once."""
    return (
        rows.filter(has_text(F.col("Item ID"))).groupBy(*(within or []), F.col("Item ID").alias("item_id"))
        .agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    )


def reported_duplicates(rows: DataFrame) -> DataFrame:
    """The first ids of the report line, in id order."""
    return duplicate_ids(rows).orderBy("item_id").limit(DUPLICATES_REPORTED)


def _findings(df: DataFrame, checks: list[tuple[str, Column, Column]], within: str | None = None) -> DataFrame:
    own = [within] if within else []
    candidates = F.array(*[
        F.when(bad, F.struct(F.lit(rule).alias("rule"), value.alias("value"))) for rule, bad, value in checks
    ])
    return (
        df.select(*own, F.col("Item ID").alias("item_id"), F.explode(candidates).alias("f"))
        .filter("f IS NOT NULL")
        .select(*own, F.lit("error").alias("severity"), "f.rule", "item_id", "f.value")
    )


def row_findings(rows: DataFrame, within: str | None = None) -> DataFrame:
    """One error per row and broken field rule.

    The currency test looks for single characters, so any C, H or F in a price counts.
    """
    member = [
        ("order_by", "Order by", U.ORDER_BY),
        ("vessel_unit", "Vessel unit", [*U.VESSEL_UNITS, ""]),
        ("price_per", "Price per", [*U.PRICE_PER, ""]),
        ("status", "Status", U.STATUS),
    ]
    checks = [(rule, ~F.col(c).isin(allowed), F.col(c)) for rule, c, allowed in member]
    checks.append(("currency_in_price", F.col("Price").rlike("[CHF€$]"), F.col("Price")))
    return _findings(rows, checks, within)


def packaging_findings(rows: DataFrame, products: DataFrame, on: str = "row_number", within: str | None = None) -> DataFrame:
    """Rows whose bundle fields contradict the interpretation mode of their product."""
    keys = [*([within] if within else []), on]
    modes = products.select(*keys, "packaging_mode", "packaging_evidence", F.col("price").alias("_product_price"))
    joined = rows.join(modes, keys)
    mode, bundle = F.col("packaging_mode"), F.col("Bundle size")
    divided = mode == "preserve_inner_unit_divide_price"
    evidence, none = F.col("packaging_evidence"), F.lit("")
    return _findings(joined, [
        ("contaminated_packaging", mode == "suspected_contaminated_bundle", evidence),
        ("unresolved_multipack", mode == "unresolved_named_multipack", evidence),
        ("missing_bundle_size", divided & (bundle == ""), none),
        ("bundle_price_not_divided", divided & (bundle == "") & (F.col("Price") == F.col("_product_price")), none),
        ("flattened_pack_has_bundle", (mode == "flatten_piece_pack") & (bundle != ""), none),
    ], within)


def coverage(rows: DataFrame, discovered: DataFrame, failures: DataFrame) -> DataFrame:
    """Coverage and image warnings, one row per warning that applies."""
    exported = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(has_text(F.col("Image"))).alias("images"))
    failed = failures.agg(F.count(F.lit(1)).alias("failures"))
    found = discovered.agg(F.count_distinct("url").alias("discovered"))
    covered = F.col("rows") + F.col("failures")
    warnings = F.array(
        F.when(covered < F.col("discovered"), F.lit("not_fully_covered")),
        F.when(F.col("failures") > 0, F.lit("failed_urls")),
        F.when(F.col("images") == 0, F.lit("no_images")),
    )
    return (
        side_by_side(exported, failed, found).select(covered.alias("covered"), "discovered", "failures", F.explode(warnings).alias("rule"))
        .filter("rule IS NOT NULL")
        .select(F.lit("warning").alias("severity"), "rule", "covered", "discovered", "failures")
    )


def validation_gate(rows: DataFrame, findings: DataFrame, duplicates: DataFrame) -> DataFrame:
    """All rows pass or none does."""
    errors = findings.agg(F.count(F.lit(1)).alias("row_errors"))
    repeated = duplicates.agg(F.when(F.count(F.lit(1)) > 0, 1).otherwise(0).alias("duplicate_errors"))
    counted = rows.agg(F.count(F.lit(1)).alias("row_count"))
    error_count = F.col("row_errors") + F.col("duplicate_errors")
    return side_by_side(counted, errors, repeated).select(
        "row_count", error_count.alias("error_count"), (error_count == 0).alias("is_valid"),
        F.when(error_count == 0, F.col("row_count")).otherwise(0).alias("passed_row_count"),
    )


def supplier_gate(rows: DataFrame, findings: DataFrame, duplicates: DataFrame, supplier: str) -> DataFrame:
    """The gate of every supplier that has a row or a finding: its rows pass all together or not at all.

    The three inputs are stacked and summed once, map side first, so a hot supplier is one row a task.
    """
    def part(df: DataFrame, row: int, error: int, repeated: int) -> DataFrame:
        return df.select(supplier, F.lit(row).alias("row"), F.lit(error).alias("error"), F.lit(repeated).alias("repeated"))

    stacked = part(rows, 1, 0, 0).unionByName(part(findings, 0, 1, 0)).unionByName(part(duplicates, 0, 0, 1))
    errors = F.col("row_errors") + F.col("duplicate_errors")
    return stacked.groupBy(supplier).agg(
        F.sum("row").alias("row_count"), F.sum("error").alias("row_errors"), F.max("repeated").alias("duplicate_errors")).select(
        supplier, "row_count", errors.cast("bigint").alias("error_count"), (errors == 0).alias("is_valid"),
        F.when(errors == 0, F.col("row_count")).otherwise(0).alias("passed_row_count"))
