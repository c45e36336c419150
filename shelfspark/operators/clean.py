"""Catalogue cleaning: import rows -> cleaned rows and a field-level correction report.

The rules form a short ladder of projections.  Each projection reads only earlier
columns, so Catalyst evaluates every text scan once; the before/after pairs needed by
the correction report are ordinary columns and are pruned when only the rows are used.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import units as U
from shelfspark.functions.numbers import (
    as_double, digits_only, feed_number, is_integral, six_significant, two_decimals,
)
from shelfspark.functions.text import UNICODE_CI, blank_to_null, has_text, join_non_empty, strip, text
from shelfspark.operators.skew import BROADCAST_ROWS, join_checked, landed, salted_join
from shelfspark.schema import CORRECTION_COLUMNS, IMPORT_COLUMNS

# Rows that share a text, on average, from which texts are read once each.
SHARED_BY = 4
# Patterns of the import format.
NUMBER = r"[-+]?\d+(?:[.,]\d+)?"
SIZE_UNITS = "l|liter|litre|dl|cl|ml|kg|kilo|g|gramm|stück|stk|pcs?|pieces?|piece|quantity"
MULTIPACK = rf"(\d+)\s*[xX]\s*(\d+(?:[.,]\d+)?)\s*({SIZE_UNITS})\b"
SINGLE_SIZE = rf"(\d+(?:[.,]\d+)?)\s*({SIZE_UNITS})\b"
BUNDLE_WORDS = (
    "karton|carton|box|pack|package|paket|paquet|confezione|tray|plateau|vassoio|palette|pallet|"
    "rolle|rouleau|rotolo|beutel|sachet|sacchetto|eimer|seau|secchio|kiste|caisse|cassa|"
    "dispokarton|dispenserbox"
)
BUNDLE_COUNT = rf"(\d+)\s*(?:x|stück|stk\.?|pieces?|pcs?)\s*/?\s*({BUNDLE_WORDS})\b"
CURRENCY = r"(?i)chf|eur|usd|sfr|€|\$"
NUMERIC_FIELDS = [
    "Vessel size", "Bundle size", "Length", "Width", "Height", "Diameter",
    "Net weight", "Total weight",
]
ENUM_DEFAULTS = {
    "Order by": (U.ORDER_BY, "vessel"),
    "Price per": (U.PRICE_PER, "vessel"),
    "Status": (U.STATUS, "ACTIVE"),
}


@dataclass(frozen=True)
class Step:
    """One correction candidate: a field whose value moved from `before` to `after`."""

    field: str
    reason: str
    before: str
    after: str


def _tag(field: str) -> str:
    return field.lower().replace(" ", "_").replace("-", "_")


def sanitize_id(c: Column) -> Column:
    """Runs of slashes, whitespace, dashes and characters outside the id alphabet become single dashes."""
    return F.regexp_replace(strip(text(c)), r"[^a-zA-Z0-9.~_%]+", "-")


def row_tag(row_number: Column) -> Column:
    """'row' plus the row number padded to five digits (never cut)."""
    digits = row_number.cast("string")
    return F.concat(F.lit("row"), F.when(F.length(digits) < 5, F.lpad(digits, 5, "0")).otherwise(digits))


def with_unique_ids(rows: DataFrame, row_number: str = "row_number", within: str | None = None) -> DataFrame:
    """Add `clean_id` (sanitised) and `final_id` (sanitised, later repeats suffixed).

    With `within` (a supplier column) ids and row numbers are those of each supplier's own file.

    Only (row number, id) travels through the repeat search: first row numbers per id are
    map-side aggregates, so an id shared by a third of the rows costs one buffer entry per
    task.  The wide rows meet the resulting rename table on the unique row number, without
    a shuffle when few ids repeat and unsorted otherwise.
    """
    return _with_final_ids(landed(_with_clean_ids(rows, row_number), "rows"), row_number, within)


def _with_clean_ids(rows: DataFrame, row_number: str) -> DataFrame:
    return rows.withColumn("clean_id", sanitize_id(F.col("Item ID"))).withColumn(
        "clean_id", F.when(F.col("clean_id") == "", row_tag(F.col(row_number))).otherwise(F.col("clean_id")))


def _with_final_ids(tagged: DataFrame, row_number: str, within: str | None) -> DataFrame:
    """`tagged` is landed: what made the rows (numbering, sanitised ids) runs once for both sides of the join."""
    keys = [*([within] if within else []), row_number]
    renamed = _renamed_ids(tagged.select(*keys, "clean_id"), row_number, within)
    return join_checked(tagged, renamed, keys, unsorted=True).withColumn(
        "final_id", F.coalesce("renamed_id", "clean_id")).drop("renamed_id")


def _renamed_ids(ids: DataFrame, n: str, within: str | None = None) -> DataFrame:
    own = [within] if within else []
    names_of = [*own, "clean_id"]
    counted = landed(ids.groupBy(*names_of).agg(F.min(n).alias("first_row"), F.count(F.lit(1)).alias("_rows")), "id-counts")
    repeated = counted.filter("_rows > 1").select(*names_of, "first_row")
    suffixed = F.concat_ws("-", "clean_id", row_tag(F.col(n)))
    renames = (
        salted_join(ids, repeated, names_of, F.col(n), counted=counted.select(*names_of, "_rows"))
        .filter(F.col(n) > F.col("first_row"))
        .select(*own, n, suffixed.alias("renamed_id"))
    )
    # A raw id may already look like the suffixed name an earlier row has just been given, and
    # so on for names built on such an id.  Every round adds one suffix, so the rounds end.
    lookalikes = landed(ids.filter(F.col("clean_id").rlike(r"-row\d{5,}$")), "lookalikes")
    taken = renames = landed(renames, "renames")
    while lookalikes.take(1):
        names = taken.select(*own, F.col("renamed_id").alias("clean_id"), F.col(n).alias("taken_row"))
        taken = landed(
            lookalikes.join(names, names_of).filter(F.col("taken_row") < F.col(n))
            .select(*own, n, suffixed.alias("renamed_id")).distinct(), "renames")
        if not taken.take(1):
            break
        renames = renames.unionByName(taken)
    return renames.dropDuplicates([*own, n])


def _first_number(c: Column) -> Column:
    return feed_number(F.regexp_extract(c, NUMBER, 0))


def _read_texts(rows: DataFrame) -> DataFrame:
    """Sizes, counts and types that the column `evidence` names, beside the columns there are."""
    # One scan of the long text per pattern; groups are read from the short match below.
    scanned = rows.select("*", *[
        F.regexp_extract("evidence", UNICODE_CI + pattern, 0).alias(name)
        for name, pattern in [("multi", MULTIPACK), ("single", SINGLE_SIZE), ("counted", BUNDLE_COUNT)]
    ])

    def group(match: str, pattern: str, index: int) -> Column:
        return F.regexp_extract(match, UNICODE_CI + pattern, index)

    grouped = scanned.select(
        *rows.columns,
        feed_number(group("multi", MULTIPACK, 1)).alias("multi_count"),
        feed_number(group("multi", MULTIPACK, 2)).alias("multi_size"),
        U.unit_code(group("multi", MULTIPACK, 3)).alias("multi_unit"),
        feed_number(group("single", SINGLE_SIZE, 1)).alias("single_size"),
        U.unit_code(group("single", SINGLE_SIZE, 2)).alias("single_unit"),
        group("counted", BUNDLE_COUNT, 1).alias("text_count"),
        U.type_code(group("counted", BUNDLE_COUNT, 2), allow_pallet=True).alias("text_type"),
    )
    pieces = (F.col("multi_unit") == "quantity") & has_text(F.col("multi_count")) & has_text(F.col("multi_size"))
    total = six_significant(as_double(F.col("multi_count")) * as_double(F.col("multi_size")))
    return grouped.select(
        "*",
        F.when(pieces, total).otherwise(F.col("multi_count")).alias("pack_count"),
        F.when(pieces, "1").otherwise(F.col("multi_size")).alias("pack_size"),
    ).drop("multi_count", "multi_size")


def _with_texts_read(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """`_read_texts` of the rows, whose landed `texts` hold the same `evidence`.

    Offers of one product repeat its texts.  Where at least `SHARED_BY` rows share a text on average and all texts fit a
    broadcast, each text is read once and looked up; otherwise every row reads its own.
    """
    n, distinct = texts.agg(F.count(F.lit(1)), F.approx_count_distinct("evidence")).first()
    if distinct * SHARED_BY > n or distinct > BROADCAST_ROWS:
        return _read_texts(rows)
    return join_checked(rows, _read_texts(texts.select("evidence").distinct()), "evidence")


def clean_steps(rows: DataFrame, row_number: str = "row_number", within: str | None = None) -> tuple[DataFrame, dict[str, str], list[Step]]:
    """Apply every rule; returns the staged frame, the final column per field, the steps."""
    final: dict[str, str] = {}
    steps: list[Step] = []

    own = [*([within] if within else []), row_number]
    evidence = join_non_empty(
        " ", *[F.col(c) for c in ("Item name", "Description", "Category name", "Material")]
    )
    tagged = _with_clean_ids(rows.select(*own, *[F.col(c) for c in IMPORT_COLUMNS], evidence.alias("evidence")), row_number)
    tagged = landed(tagged, "rows")
    staged = _with_final_ids(tagged, row_number, within)
    steps.append(Step("Item ID", "sanitize_item_id", "raw_item_id", "clean_id"))
    steps.append(Step("Item ID", "deduplicate_sanitized_item_id", "clean_id", "final_id"))

    stage = [*[F.col(c) for c in own], F.col("clean_id"), F.col("final_id"), F.col("evidence")]
    for name in IMPORT_COLUMNS:
        tag = _tag(name)
        source = "final_id" if name == "Item ID" else name
        keep_na = name in ("Vessel type", "Bundle type")
        stage.append(F.expr(f"coalesce(`{name}`, '') AS raw_{tag}"))
        stage.append(F.expr(f"{U.drop_sentinel_sql(source, keep_na)} AS n_{tag}"))
        before = "final_id" if name == "Item ID" else f"raw_{tag}"
        steps.append(Step(name, "normalize_empty_value", before, f"n_{tag}"))
        final[name] = f"n_{tag}"
    staged = staged.select(*stage)

    def put(field: str, reason: str, column: Column, before: str | None = None, name: str | None = None):
        target = name or f"{reason}_{_tag(field)}"
        steps.append(Step(field, reason, before or final[field], target))
        final[field] = target
        return column.alias(target)

    def now(field: str) -> Column:
        return F.col(final[field])

    # Independent field rules.
    stage = [put("Category name", "default_uncategorized",
                 F.when(now("Category name") == "", "Uncategorized").otherwise(now("Category name")))]
    for field, (allowed, default) in ENUM_DEFAULTS.items():
        stage.append(put(field, "normalize_enum", F.when(now(field).isin(allowed), now(field)).otherwise(default)))
    price = as_double(_first_number(F.regexp_replace(now("Price"), CURRENCY, "")))
    stage.append(put("Price", "normalize_price", text(two_decimals(price))))
    vat = feed_number(now("VAT"))
    stage.append(put("VAT", "normalize_vat", F.when(vat.isin(U.VAT_VALUES), vat).otherwise("")))
    stage.append(put("Labels", "normalize_labels", _labels(now("Labels"))))
    for field in ("Image", "Product Sheet"):
        stage.append(put(field, "normalize_url", F.when(now(field).rlike("^https?://"), now(field)).otherwise("")))
    for field in NUMERIC_FIELDS:
        stage.append(put(field, "normalize_numeric_field", _first_number(now(field))))
    staged = _with_texts_read(staged, tagged).select("*", *stage)
    unit = F.coalesce(
        blank_to_null(U.unit_code(now("Vessel unit"))),
        blank_to_null(F.col("multi_unit")),
        blank_to_null(F.col("single_unit")),
        F.lit("quantity"),
    )
    staged = staged.select("*", put("Vessel unit", "normalize_vessel_unit", unit))
    size = F.coalesce(
        blank_to_null(now("Vessel size")),
        blank_to_null(F.col("pack_size")),
        F.when(now("Vessel unit") != "quantity", blank_to_null(F.col("single_size"))),
        F.when(now("Vessel unit") == "quantity", F.lit("1")),
        F.lit(""),
    )
    staged = staged.select("*", put("Vessel size", "normalize_vessel_size", size))

    fractional = (
        (now("Vessel unit") == "g") & has_text(now("Vessel size"))
        & ~is_integral(as_double(now("Vessel size")))
    )
    own_type = U.type_code(now("Vessel type"), allow_pallet=False)
    stage = [
        put("Vessel size", "fractional_gram_vessel_to_quantity",
            F.when(fractional, "1").otherwise(now("Vessel size")), name="gram_size"),
        put("Vessel unit", "fractional_gram_vessel_to_quantity",
            F.when(fractional, "quantity").otherwise(now("Vessel unit")), name="gram_unit"),
        put("Vessel type", "normalize_vessel_type",
            F.coalesce(blank_to_null(own_type), U.vessel_hint(now("Item name")))),
        U.type_code(now("Bundle type"), allow_pallet=True).alias("own_bundle_type"),
    ]
    staged = staged.select("*", *stage)

    flattened = (
        (now("Vessel unit") == "quantity") & ~now("Vessel size").isin("", "1") & (now("Bundle size") == "")
    )
    size_before = final["Bundle size"]
    from_text = F.when(~flattened, F.coalesce(blank_to_null(F.col("pack_count")), blank_to_null(F.col("text_count"))))
    staged = staged.select(
        "*",
        put("Bundle size", "normalize_bundle_size",
            F.coalesce(blank_to_null(now("Bundle size")), from_text, F.lit(""))),
    )
    bundled = ~now("Bundle size").isin("", "1")
    typed = F.coalesce(blank_to_null(F.col("own_bundle_type")), blank_to_null(F.col("text_type")), F.lit("PK"))
    staged = staged.select(
        "*",
        put("Bundle type", "normalize_bundle_type", F.when(bundled, typed).otherwise("")),
        put("Bundle size", "clear_bundle_size_one_or_invalid",
            F.when(bundled, now("Bundle size")).otherwise(""), before=size_before),
    )
    number = as_double(now("Bundle size"))
    valid = is_integral(number) & (number >= 2)
    stage = [
        put("Bundle type", "fallback_bundle_type",
            F.when(has_text(now("Bundle size")) & (now("Bundle type") == ""), "PK")
            .otherwise(now("Bundle type"))),
        put("Bundle size", "invalid_bundle_size", F.when(valid, now("Bundle size")).otherwise("")),
        put("Bundle GTIN", "clear_duplicate_bundle_gtin",
            F.when(now("Bundle GTIN") == now("GTIN"), "").otherwise(now("Bundle GTIN"))),
    ]
    staged = staged.select("*", *stage)

    def barcode(field: str) -> Column:
        digits = digits_only(now(field))
        return F.when(F.length(digits).between(8, 14), digits).otherwise("")

    stage = [
        put("Bundle type", "clear_bundle_type_for_invalid_bundle_size",
            F.when(has_text(now("Bundle size")), now("Bundle type")).otherwise("")),
        put("GTIN", "normalize_gtin", barcode("GTIN")),
        put("Bundle GTIN", "normalize_gtin", barcode("Bundle GTIN")),
        put("Vessel unit", "fallback_vessel_unit",
            F.when(now("Vessel unit").isin(U.VESSEL_UNITS), now("Vessel unit")).otherwise("quantity")),
        put("Vessel type", "invalid_vessel_type",
            F.when(now("Vessel type").isin("", *U.VESSEL_TYPES), now("Vessel type")).otherwise("")),
    ]
    staged = staged.select("*", *stage)
    fallback = F.when(has_text(now("Bundle size")), "PK").otherwise("")
    staged = staged.select(
        "*",
        put("Bundle type", "invalid_bundle_type",
            F.when(now("Bundle type").isin("", *U.BUNDLE_TYPES), now("Bundle type")).otherwise(fallback)),
    )
    return staged, final, steps


def _labels(c: Column) -> Column:
    parts = F.transform(F.split(c, ","), lambda x: F.upper(strip(x)))
    kept = F.array_distinct(F.filter(parts, lambda x: x.isin(U.LABELS)))
    return F.array_join(kept, ",")


def clean_catalog(rows: DataFrame, row_number: str = "row_number", within: str | None = None) -> DataFrame:
    """Cleaned import rows: the supplier, if there is one, row number and the 46 columns in file order."""
    staged, final, _ = clean_steps(rows, row_number, within)
    return staged.select(*([within] if within else []), row_number, *[F.col(final[c]).alias(c) for c in IMPORT_COLUMNS])


def clean_corrections(rows: DataFrame, row_number: str = "row_number", within: str | None = None) -> DataFrame:
    """One row per changed field and rule."""
    staged, _, steps = clean_steps(rows, row_number, within)
    return _corrections(staged, steps, row_number, within)


def _corrections(staged: DataFrame, steps: list[Step], row_number: str, within: str | None = None) -> DataFrame:
    def candidate(step: Step) -> str:
        id_after = "clean_id" if step.reason == "sanitize_item_id" else "final_id"
        return (
            f"named_struct('field', '{step.field}', 'value_before', {step.before}, 'value_after', {step.after}, "
            f"'reason', '{step.reason}', 'item_id_after', {id_after})"
        )

    # Candidates are expanded and filtered inside the generator's code stage; unchanged
    # ones never leave it.
    return (
        staged.select(
            *([within] if within else []), F.col(row_number).cast("string").alias("row_number"),
            F.col("raw_item_id").alias("item_id_before"),
            F.expr(f"inline(array({', '.join(candidate(s) for s in steps)}))"),
        )
        .filter("value_before <> value_after")
        .select(*([within] if within else []), *CORRECTION_COLUMNS)
    )


def clean_both(rows: DataFrame, row_number: str = "row_number", within: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Cleaned rows and corrections; the rules run once, and both outputs read what they left."""
    staged, final, steps = clean_steps(rows, row_number, within)
    own = [within] if within else []
    needed = dict.fromkeys([*own, row_number, "raw_item_id", "clean_id", "final_id", *(final[c] for c in IMPORT_COLUMNS),
                            *(c for s in steps for c in (s.before, s.after))])
    staged = landed(staged.select(*needed), "cleaning")
    cleaned = staged.select(*own, row_number, *[F.col(final[c]).alias(c) for c in IMPORT_COLUMNS])
    return cleaned, _corrections(staged, steps, row_number, within)


def corrections_by_reason(corrections: DataFrame) -> DataFrame:
    return corrections.groupBy("field", "reason").agg(F.count(F.lit(1)).alias("corrections"))
