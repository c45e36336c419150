"""DuckDB statement of the cleaning rules, used only to check the Spark job."""

from __future__ import annotations

from shelfspark.functions import units as U
from shelfspark.operators.clean import BUNDLE_COUNT, MULTIPACK, NUMERIC_FIELDS, SINGLE_SIZE
from shelfspark.plans.derived import duck
from shelfspark.schema import IMPORT_COLUMNS


def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def q(name: str) -> str:
    return f'"{name}"'


def tag(field: str) -> str:
    return field.lower().replace(" ", "_").replace("-", "_")


def strip(e: str) -> str:
    return rf"regexp_replace({e}, '^\s+|\s+$', '', 'g')"


def empty(e: str, keep_na: bool = False) -> str:
    words = U.EMPTY_SENTINELS if keep_na else [*U.EMPTY_SENTINELS, "na"]
    return f"CASE WHEN lower({strip(e)}) IN {_in(words)} THEN '' ELSE {strip(e)} END"


def dec(e: str) -> str:
    return rf"regexp_replace(replace(replace(replace({e}, chr(39), ''), ' ', ''), ',', '.'), '\.0$', '')"


def first_number(e: str) -> str:
    return dec(rf"regexp_extract({e}, '[-+]?\d+(?:[.,]\d+)?', 0)")


def mapping(e: str, table: dict[str, str]) -> str:
    pairs = ", ".join(f"'{k}': '{v}'" for k, v in table.items())
    return f"coalesce(map_extract_value(MAP {{{pairs}}}, {e}), '')"


def unit(e: str) -> str:
    return mapping(rf"regexp_replace(lower({strip(e)}), '\.+$', '')", U.UNIT_SYNONYMS)


def type_code(e: str, pallet: bool) -> str:
    v = empty(e, True)
    token = (
        rf"list_filter(string_split_regex(lower(replace({v}, '.', '')), '[\s/_,-]+'), "
        f"lambda t: t IN {_in(U.TYPE_SYNONYMS)})[1]"
    )
    code = f"CASE WHEN upper({v}) IN {_in(U.BUNDLE_TYPES)} THEN upper({v}) ELSE {mapping(token, U.TYPE_SYNONYMS)} END"
    return code if pallet else f"replace({code}, 'PX', '')"


def hint(e: str) -> str:
    return "CASE " + " ".join(f"WHEN contains(lower({e}), '{n}') THEN '{c}'" for n, c in U.VESSEL_HINTS) + " ELSE '' END"


def or_else(*es: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({e}, '')" for e in es) + ", '')"


def rownum_tag() -> str:
    return "'row' || CASE WHEN length(cast(row_number AS varchar)) < 5 THEN lpad(cast(row_number AS varchar), 5, '0') ELSE cast(row_number AS varchar) END"


def is_int(e: str) -> str:
    return f"coalesce(try_cast({e} AS double) = floor(try_cast({e} AS double)), false)"


def clean_ctes(source: str, within: str = "") -> str:
    sanitized = (
        r"regexp_replace(regexp_replace(regexp_replace(replace(replace("
        + strip('"Item ID"') + r", '/', '-'), chr(92), '-'), '\s+', '-', 'g'), '[^a-zA-Z0-9.~_%-]+', '-', 'g'), '-{2,}', '-', 'g')"
    )
    empties = ", ".join(
        f"{empty('final_id' if c == 'Item ID' else q(c), c in ('Vessel type', 'Bundle type'))} AS n_{tag(c)}"
        for c in IMPORT_COLUMNS
    )
    enums = {"Order by": (U.ORDER_BY, "vessel"), "Price per": (U.PRICE_PER, "vessel"), "Status": (U.STATUS, "ACTIVE")}
    enum_sql = ", ".join(
        f"CASE WHEN n_{tag(f)} IN {_in(a)} THEN n_{tag(f)} ELSE '{d}' END AS e_{tag(f)}" for f, (a, d) in enums.items()
    )
    numeric = ", ".join(f"{first_number('n_' + tag(f))} AS num_{tag(f)}" for f in NUMERIC_FIELDS)
    price = first_number(r"regexp_replace(n_price, 'chf|eur|usd|sfr|€|\$', '', 'gi')")
    # ordered-distinct labels: drop an entry seen earlier in the list
    labels = (
        "coalesce((WITH l AS (SELECT list_filter(list_transform(string_split(n_labels, ','), lambda x: upper(trim(x))), "
        f"lambda x: x IN {_in(U.LABELS)}) AS a) SELECT array_to_string(list_filter(a, lambda x, i: list_position(a, x) = i), ',') FROM l), '')"
    )

    def grab(pattern: str, group: int) -> str:
        return f"regexp_extract(evidence, '{pattern}', {group}, 'i')"

    product = "try_cast(m_count AS double) * try_cast(m_size AS double)"
    own, own_b, same = (f"{within}, ", f"b.{within}, ", f" AND a.{within} = b.{within}") if within else ("", "", "")
    return f"""
s1 AS (SELECT *, CASE WHEN {sanitized} = '' THEN {rownum_tag()} ELSE {sanitized} END AS clean_id FROM {source}),
s2 AS (SELECT *, row_number > min(row_number) OVER (PARTITION BY {own}clean_id) AS repeated, clean_id || '-' || {rownum_tag()} AS suffixed FROM s1),
d AS (SELECT {own}row_number, suffixed FROM s2 WHERE repeated
      UNION SELECT {own_b}b.row_number, b.suffixed FROM s2 b JOIN d a ON a.suffixed = b.clean_id AND a.row_number < b.row_number{same}),
s3 AS (SELECT *, CASE WHEN row_number IN (SELECT row_number FROM d) THEN suffixed ELSE clean_id END AS final_id FROM s2),
s4 AS (SELECT *, concat_ws(' ', nullif("Item name", ''), nullif("Description", ''), nullif("Category name", ''), nullif("Material", '')) AS evidence, {empties} FROM s3),
s5 AS (SELECT *, CASE WHEN n_category_name = '' THEN 'Uncategorized' ELSE n_category_name END AS e_category, {enum_sql},
       coalesce(printf('%.2f', try_cast({price} AS double)), '') AS e_price,
       CASE WHEN {dec('n_vat')} IN {_in(U.VAT_VALUES)} THEN {dec('n_vat')} ELSE '' END AS e_vat,
       {labels} AS e_labels,
       CASE WHEN regexp_matches(n_image, '^https?://') THEN n_image ELSE '' END AS e_image,
       CASE WHEN regexp_matches(n_product_sheet, '^https?://') THEN n_product_sheet ELSE '' END AS e_sheet,
       {numeric},
       {dec(grab(MULTIPACK, 1))} AS m_count, {dec(grab(MULTIPACK, 2))} AS m_size, {unit(grab(MULTIPACK, 3))} AS m_unit,
       {dec(grab(SINGLE_SIZE, 1))} AS g_size, {unit(grab(SINGLE_SIZE, 2))} AS g_unit,
       {grab(BUNDLE_COUNT, 1)} AS t_count, {type_code(grab(BUNDLE_COUNT, 2), True)} AS t_type FROM s4),
s6 AS (SELECT *, CASE WHEN m_unit = 'quantity' THEN CASE WHEN {product} = floor({product}) THEN cast(cast({product} AS bigint) AS varchar) ELSE printf('%g', {product}) END ELSE m_count END AS pack_count,
       CASE WHEN m_unit = 'quantity' THEN '1' ELSE m_size END AS pack_size,
       coalesce(nullif({unit('n_vessel_unit')}, ''), nullif(m_unit, ''), nullif(g_unit, ''), 'quantity') AS u1 FROM s5),
s7 AS (SELECT *, {or_else('num_vessel_size', 'pack_size', "(CASE WHEN u1 <> 'quantity' THEN g_size ELSE '1' END)")} AS z1 FROM s6),
s8 AS (SELECT *, (u1 = 'g' AND z1 <> '' AND NOT {is_int('z1')}) AS frac_g FROM s7),
s9 AS (SELECT *, CASE WHEN frac_g THEN '1' ELSE z1 END AS z2, CASE WHEN frac_g THEN 'quantity' ELSE u1 END AS u2,
       {or_else(type_code('n_vessel_type', False), hint('n_item_name'))} AS vt, {type_code('n_bundle_type', True)} AS bt0 FROM s8),
s10 AS (SELECT *, (u2 = 'quantity' AND z2 NOT IN ('', '1') AND num_bundle_size = '') AS flat FROM s9),
s11 AS (SELECT *, CASE WHEN num_bundle_size <> '' THEN num_bundle_size WHEN flat THEN '' ELSE {or_else('pack_count', 't_count')} END AS b1 FROM s10),
s12 AS (SELECT *, CASE WHEN b1 IN ('', '1') THEN '' ELSE b1 END AS b2, CASE WHEN b1 IN ('', '1') THEN '' ELSE coalesce(nullif(bt0, ''), nullif(t_type, ''), 'PK') END AS bt1 FROM s11),
s13 AS (SELECT *, CASE WHEN {is_int('b2')} AND try_cast(b2 AS double) >= 2 THEN b2 ELSE '' END AS b3,
       CASE WHEN n_bundle_gtin = n_gtin THEN '' ELSE n_bundle_gtin END AS bg1 FROM s12),
cleaned AS (SELECT *, CASE WHEN b3 = '' THEN '' ELSE bt1 END AS bt3,
       CASE WHEN length(regexp_replace(n_gtin, '\\D', '', 'g')) BETWEEN 8 AND 14 THEN regexp_replace(n_gtin, '\\D', '', 'g') ELSE '' END AS gtin2,
       CASE WHEN length(regexp_replace(bg1, '\\D', '', 'g')) BETWEEN 8 AND 14 THEN regexp_replace(bg1, '\\D', '', 'g') ELSE '' END AS bg2 FROM s13)"""


FINAL = {
    "Category name": "e_category", "Order by": "e_order_by", "Price per": "e_price_per", "Status": "e_status",
    "Price": "e_price", "VAT": "e_vat", "Labels": "e_labels", "Image": "e_image", "Product Sheet": "e_sheet",
    "Vessel size": "z2", "Vessel unit": "u2", "Vessel type": "vt", "Bundle size": "b3", "Bundle type": "bt3",
    "GTIN": "gtin2", "Bundle GTIN": "bg2",
    **{f: f"num_{tag(f)}" for f in NUMERIC_FIELDS if f not in ("Vessel size", "Bundle size")},
}


def clean_oracle(source: str | None = None, within: str = "") -> str:
    cols = ", ".join(f"{FINAL.get(c, 'n_' + tag(c))} AS {q(c)}" for c in IMPORT_COLUMNS)
    return f"WITH RECURSIVE {clean_ctes(source or duck('feed') + ' feed', within)} SELECT {within + ', ' if within else ''}row_number, {cols} FROM cleaned"


def cleaned_subquery(source: str | None = None) -> str:
    return f"({clean_oracle(source)})"


def _steps() -> list[tuple[str, str, str, str, str]]:
    """(field, reason, before, after, id after)"""
    steps = [("Item ID", "sanitize_item_id", q("Item ID"), "clean_id", "clean_id"),
             ("Item ID", "deduplicate_sanitized_item_id", "clean_id", "final_id", "final_id")]

    def add(field, reason, before, after):
        steps.append((field, reason, before, after, "final_id"))

    for c in IMPORT_COLUMNS:
        add(c, "normalize_empty_value", "final_id" if c == "Item ID" else q(c), f"n_{tag(c)}")
    add("Category name", "default_uncategorized", "n_category_name", "e_category")
    for f in ("Order by", "Price per", "Status"):
        add(f, "normalize_enum", f"n_{tag(f)}", f"e_{tag(f)}")
    add("Price", "normalize_price", "n_price", "e_price")
    add("VAT", "normalize_vat", "n_vat", "e_vat")
    add("Labels", "normalize_labels", "n_labels", "e_labels")
    add("Image", "normalize_url", "n_image", "e_image")
    add("Product Sheet", "normalize_url", "n_product_sheet", "e_sheet")
    for f in NUMERIC_FIELDS:
        add(f, "normalize_numeric_field", f"n_{tag(f)}", f"num_{tag(f)}")
    add("Vessel unit", "normalize_vessel_unit", "n_vessel_unit", "u1")
    add("Vessel size", "normalize_vessel_size", "num_vessel_size", "z1")
    add("Vessel size", "fractional_gram_vessel_to_quantity", "z1", "z2")
    add("Vessel unit", "fractional_gram_vessel_to_quantity", "u1", "u2")
    add("Vessel type", "normalize_vessel_type", "n_vessel_type", "vt")
    add("Bundle size", "normalize_bundle_size", "num_bundle_size", "b1")
    add("Bundle type", "normalize_bundle_type", "n_bundle_type", "bt1")
    add("Bundle size", "clear_bundle_size_one_or_invalid", "num_bundle_size", "b2")
    add("Bundle size", "invalid_bundle_size", "b2", "b3")
    add("Bundle type", "clear_bundle_type_for_invalid_bundle_size", "bt1", "bt3")
    add("Bundle GTIN", "clear_duplicate_bundle_gtin", "n_bundle_gtin", "bg1")
    add("GTIN", "normalize_gtin", "n_gtin", "gtin2")
    add("Bundle GTIN", "normalize_gtin", "bg1", "bg2")
    return steps


def corrections_oracle(source: str | None = None) -> str:
    parts = " UNION ALL ".join(
        f"SELECT cast(row_number AS varchar) AS row_number, \"Item ID\" AS item_id_before, {id_after} AS item_id_after, "
        f"'{field}' AS field, {before} AS value_before, {after} AS value_after, '{reason}' AS reason FROM cleaned WHERE {before} <> {after}"
        for field, reason, before, after, id_after in _steps()
    )
    return f"WITH RECURSIVE {clean_ctes(source or duck('feed') + ' feed')} {parts}"
