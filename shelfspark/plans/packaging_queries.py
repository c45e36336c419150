"""Registered queries of the packaging interpretation and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.operators import packaging, validate
from shelfspark.operators.clean import clean_catalog
from shelfspark.operators.importrows import to_import_rows
from shelfspark.operators.packaging import PATTERNS
from shelfspark.operators.skew import landed
from shelfspark.plans import oracle_clean
from shelfspark.plans.derived import duck, products

FIELDS = [*packaging.DECIDED, *packaging.EVIDENCE]


def _decide(spark, sf):
    return packaging.decide_packaging(products(spark, sf)).select("ordinal", *[F.col(f"decision.{f}").alias(f) for f in FIELDS])


def _audit(spark, sf):
    return packaging.packaging_audit(products(spark, sf).withColumn("item_id", F.concat(F.lit("i"), F.col("ordinal"))))


def _import_rows(spark, sf):
    numbered = products(spark, sf).withColumn("item_id", F.concat(F.lit("i-"), F.col("ordinal")))
    interpreted = packaging.interpret_packaging(numbered)
    return interpreted, to_import_rows(interpreted, keep=["ordinal"])


def _validate_packaging(spark, sf):
    numbered = products(spark, sf).withColumns({
        "item_id": F.concat(F.lit("i-"), F.col("ordinal")), "row_number": F.col("ordinal") + 2})
    interpreted = landed(packaging.interpret_packaging(numbered))
    cleaned = landed(clean_catalog(to_import_rows(interpreted, keep=["row_number"])))
    return validate.packaging_findings(cleaned, interpreted)


def _sync_from_export(spark, sf):
    """Interpreting an export again changes nothing: a price is divided once."""
    once = landed(packaging.interpret_packaging(products(spark, sf)))
    twice = packaging.interpret_packaging(once)
    return twice.select("ordinal", "vessel_size", "bundle_size", "price")


QUERIES = {
    "packaging_decide": _decide,
    "packaging_audit": _audit,
    "packaging_mode_counts": lambda spark, sf: packaging.mode_counts(products(spark, sf)),
    "import_rows": lambda spark, sf: _import_rows(spark, sf)[1].drop("ordinal"),
    "validate_packaging": _validate_packaging,
    "sync_from_export": _sync_from_export,
}


# ---------------------------------------------------------------------------
# DuckDB statement of the decision ladder.
# ---------------------------------------------------------------------------
def _sql(text: str) -> str:
    return text.replace("'", "''")


def _hit(column: str, name: str) -> str:
    return f"regexp_extract({column}, '{_sql(PATTERNS[name])}', 0, 'i')"


def _cap(hit: str, name: str, group: int) -> str:
    return f"regexp_extract({hit}, '{_sql(PATTERNS[name])}', {group}, 'i')"


def _num(e: str) -> str:
    return rf"regexp_replace(replace(replace(replace({e}, chr(39), ''), ' ', ''), ',', '.'), '\.0$', '')"


def _case(e: str, table: dict[str, str], default: str) -> str:
    return f"CASE {e} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + f" ELSE {default} END"


def _singular(e: str) -> str:
    plain = rf"regexp_replace(replace(replace(replace(lower({e}), 'ä', 'ae'), 'ö', 'oe'), 'ü', 'ue'), '\.$', '')"
    return _case(plain, packaging.SINGULAR, plain)


def _vessel(e: str) -> str:
    return _case(_singular(e), packaging.NAMED_UNIT_VESSELS, "''")


def _measure(e: str) -> str:
    return _case(f"lower({e})", {"liter": "l", "litre": "l", "kilo": "kg", "gramm": "g"}, f"lower({e})")


def _title(e: str) -> str:
    return _case(f"lower({e})", packaging.CONTAINER_TITLES, e)


def _first(*es: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({e}, '')" for e in es) + ", '')"


T = ["t_spec", "t_desc", "t_detail", "t_fill", "t_name"]
ND = [t for t in T if t != "t_detail"]
LABEL = dict(zip(T, packaging.SOURCES))
NAMED_SQL = "(" + ", ".join(f"'{u}'" for u in packaging.NAMED_UNIT_VESSELS) + ")"
PIECE_SQL = "('stück', 'stueck', 'stk', 'piece', 'pieces', 'pcs', 'blatt')"


def _src(name: str) -> str:
    whens = " ".join(f"WHEN {_hit(t, name)} <> '' THEN '{LABEL[t]}'" for t in T)
    return f"CASE {whens} ELSE '' END"


def _src_text(source: str) -> str:
    return f"CASE {source} " + " ".join(f"WHEN '{LABEL[t]}' THEN {t}" for t in T) + " ELSE '' END"


_R1, _R2, _R3, _R4, _R5, _R6 = "nested_count nested_named physical physical_count leading_named simple".split()
_CTX = "CASE " + " ".join(f"WHEN contains(ctx, '{n}') THEN '{v}'" for n, v in packaging.CONTEXT_VESSELS) + " ELSE '' END"


def decision_sql(source: str) -> str:
    ladder = packaging.LADDER
    hits = ", ".join(f"{_first(*[_hit(t, p) for t in T])} AS h_{p}, {_src(p)} AS s_{p}" for p in ladder)
    fill = _first(*[_hit(t, "fill") for t in ["t_explicit", *ND, "t_detail"]])
    return f"""
WITH a AS (SELECT *, raw_spec_piece_text AS t_spec, description AS t_desc, {_first('raw_detail_price_unit_text', 'raw_bundle_text')} AS t_detail,
  {_first('raw_fill_text', 'spec_inhalt')} AS t_fill, item_name AS t_name, raw_fill_text AS t_explicit, {_first('raw_spec_piece_text', 'spec_anzahl')} AS t_piece FROM {source}),
b AS (SELECT *, lower(concat_ws(' ', item_name, product_name, nullif(t_explicit, ''), nullif(t_spec, ''))) AS ctx,
  lower(concat_ws(' ', item_name, product_name, nullif(category_path, ''), nullif(t_piece, ''))) AS pctx,
  {hits}, {fill} AS h_fill, {_first(*[_hit(t, 'measure') for t in ND])} AS h_measure,
  {_hit('t_detail', 'simple')} AS h_detail, {_hit(_first('t_spec', 't_desc'), 'simple')} AS h_spec FROM a),
c AS (SELECT *, CASE WHEN h_fill <> '' THEN {_num(_cap('h_fill', 'fill', 1))} ELSE {_num(_cap('h_measure', 'measure', 1))} END AS fsize,
  CASE WHEN h_fill <> '' THEN {_measure(_cap('h_fill', 'fill', 2))} ELSE {_measure(_cap('h_measure', 'measure', 2))} END AS funit,
  {_vessel(_cap('h_fill', 'fill', 3))} AS fves, {_CTX} AS cves,
  CASE WHEN contains(pctx, 'deckel') THEN 'lid' WHEN contains(pctx, 'gn-behälter') OR contains(pctx, 'gn-behaelter') THEN 'container'
    WHEN contains(pctx, 'eimer') OR contains(pctx, 'bucket') THEN 'bucket' ELSE '' END AS pves,
  regexp_matches(lower(trim(t_piece)), '\\b1\\s*(stück|stueck|stk\\.?)(\\b|$)') AS one,
  {_num(_cap('h_detail', 'simple', 1))} AS dcount, {_singular(_cap('h_detail', 'simple', 2))} AS dunit,
  {_num(_cap('h_spec', 'simple', 1))} AS scount, {_singular(_cap('h_spec', 'simple', 2))} AS sunit,
  {_num(_cap('h_simple', 'simple', 1))} AS n, {_singular(_cap('h_simple', 'simple', 2))} AS u, {_title(_cap('h_simple', 'simple', 3))} AS box FROM b),
d AS (SELECT *, coalesce(nullif(fves, ''), cves) AS kves, fsize <> '' AND funit <> '' AS filled, one AND pves <> '' AS descr FROM c),
e AS (SELECT *, CASE
  WHEN h_detail <> '' AND h_spec <> '' AND dunit IN ('pack', 'box') AND sunit IN {PIECE_SQL} AND dcount = scount AND scount NOT IN ('', '1') AND NOT contains(ctx, dunit) THEN 5
  WHEN h_detail <> '' AND h_spec <> '' AND dunit IN {NAMED_SQL} AND sunit IN {PIECE_SQL} AND scount = '1' AND NOT contains(ctx, dunit) THEN 6
  WHEN h_detail <> '' AND h_spec <> '' AND dcount = '1' AND scount NOT IN ('', '1') AND filled AND kves IN ('bag', 'bottle', 'can', 'canister') THEN 7
  WHEN h_physical <> '' THEN 8 WHEN h_physical_count <> '' THEN 9 WHEN h_nested_named <> '' THEN 10 WHEN h_leading_named <> '' THEN 11 WHEN h_nested_count <> '' THEN 12
  WHEN h_simple <> '' AND n = '1' THEN CASE WHEN descr THEN 131 WHEN filled THEN 132 ELSE 133 END
  WHEN h_simple <> '' AND u IN {PIECE_SQL} THEN CASE WHEN box = 'Rolle' AND kves IN ('', 'roll', 'bag') THEN 14
     WHEN box IN ('Beutel', 'Box', 'Pack') AND kves IN ('roll', 'bag', 'box', 'pack') THEN 14 WHEN kves IN ('bottle', 'roll', 'bag', 'can', 'canister') THEN 15 ELSE 16 END
  WHEN h_simple <> '' AND u IN {NAMED_SQL} THEN CASE WHEN NOT contains(ctx, u) THEN 171 WHEN u IN ('pack', 'box') AND NOT filled THEN 172 ELSE 173 END
  WHEN descr THEN 181 WHEN filled AND vessel_unit IN ('', 'quantity') THEN 182 ELSE 183 END AS r FROM d),
f AS (SELECT *, CASE r WHEN 8 THEN {_num(_cap('h_physical', 'physical', 1))} WHEN 9 THEN {_num(_cap('h_physical_count', 'physical_count', 1))}
  WHEN 10 THEN {_num(_cap('h_nested_named', 'nested_named', 1))} WHEN 11 THEN {_num(_cap('h_leading_named', 'leading_named', 4))} WHEN 15 THEN n WHEN 173 THEN n ELSE '' END AS dv,
  CASE r WHEN 5 THEN scount WHEN 7 THEN fsize WHEN 132 THEN fsize WHEN 182 THEN fsize WHEN 8 THEN {_num(_cap('h_physical', 'physical', 2))} WHEN 9 THEN {_num(_cap('h_physical_count', 'physical_count', 2))}
  WHEN 10 THEN {_num(_cap('h_nested_named', 'nested_named', 3))} WHEN 11 THEN {_num(_cap('h_leading_named', 'leading_named', 2))}
  WHEN 12 THEN cast(cast({_num(_cap('h_nested_count', 'nested_count', 1))} AS bigint) * cast({_num(_cap('h_nested_count', 'nested_count', 2))} AS bigint) AS varchar)
  WHEN 131 THEN '1' WHEN 181 THEN '1' WHEN 14 THEN n WHEN 16 THEN n WHEN 172 THEN n WHEN 15 THEN {_first('fsize', 'vessel_size', "'1'")} WHEN 173 THEN {_first('fsize', 'vessel_size', "'1'")} ELSE vessel_size END AS vs,
  CASE WHEN r IN (7, 132, 182) THEN funit WHEN r = 8 THEN {_measure(_cap('h_physical', 'physical', 3))} WHEN r = 9 THEN {_measure(_cap('h_physical_count', 'physical_count', 3))}
  WHEN r IN (5, 10, 11, 12, 131, 181, 14, 16, 172) THEN 'quantity' WHEN r IN (15, 173) THEN {_first('funit', 'vessel_unit', "'quantity'")} ELSE vessel_unit END AS vu,
  CASE WHEN r IN (7, 132, 182, 9) THEN {_first('kves', 'vessel_type')} WHEN r = 8 THEN {_first(_vessel(_cap('h_physical', 'physical', 4)), 'fves', 'vessel_type')}
  WHEN r = 10 THEN {_vessel(_cap('h_nested_named', 'nested_named', 2))} WHEN r = 11 THEN {_first(_vessel(_cap('h_leading_named', 'leading_named', 1)), 'cves')}
  WHEN r IN (131, 181) THEN {_first('pves', 'vessel_type')} WHEN r = 14 THEN {_first('kves', _vessel('box'))} WHEN r = 15 THEN kves
  WHEN r = 173 THEN {_first(_vessel('u'), 'fves', 'vessel_type')} ELSE vessel_type END AS vt,
  CASE WHEN r = 8 THEN {_title(_first(_cap('h_physical', 'physical', 5), "'Karton'"))} WHEN r = 9 THEN {_title(_first(_cap('h_physical_count', 'physical_count', 4), 'bundle_type', "'Karton'"))}
  WHEN r = 10 THEN {_title(_first(_cap('h_nested_named', 'nested_named', 5), 'bundle_type', "'Karton'"))} WHEN r = 11 THEN {_title(_first(_cap('h_leading_named', 'leading_named', 6), 'bundle_type', "'Karton'"))}
  WHEN r = 15 THEN {_first('box', _title(_first('bundle_type', "'Pack'")))} WHEN r = 173 THEN {_first('box', _title(_first('bundle_type', "'Karton'")))} ELSE bundle_type END AS bt FROM e),
g AS (SELECT *, dv NOT IN ('', '1') AS split, CASE WHEN r IN (6, 171, 182, 183) THEN bundle_size WHEN dv NOT IN ('', '1') THEN dv ELSE '' END AS bs,
  CASE WHEN r IN (5, 181) THEN 'spec_stueckzahl' WHEN r IN (6, 7) THEN 'detail_price_unit' WHEN r = 8 THEN s_physical WHEN r = 9 THEN s_physical_count WHEN r = 10 THEN s_nested_named
  WHEN r = 11 THEN s_leading_named WHEN r = 12 THEN s_nested_count WHEN r IN (131, 132, 14, 15, 16, 171, 172, 173) THEN s_simple WHEN r = 182 THEN 'spec_fill' ELSE '' END AS src,
  (2 * cast(replace(price, '.', '') AS bigint) + try_cast(dv AS bigint)) // (2 * try_cast(dv AS bigint)) AS q FROM f)
SELECT ordinal, item_name, vessel_size AS o_vs, vessel_unit AS o_vu, vessel_type AS o_vt, bundle_size AS o_bs, bundle_type AS o_bt, price AS o_price,
  category_path, product_name, brand, country, image_url, gtin, labels_text, description,
  {_first('vs', 'vessel_size')} AS vessel_size, {_first('vu', 'vessel_unit')} AS vessel_unit, {_first('vt', 'vessel_type')} AS vessel_type, bs AS bundle_size,
  CASE WHEN bs = '' THEN '' ELSE bt END AS bundle_type,
  CASE WHEN split THEN cast(q // 100 AS varchar) || '.' || lpad(cast(q % 100 AS varchar), 2, '0') ELSE price END AS price,
  CASE WHEN r IN (5, 12, 16, 172) THEN '{packaging.FLATTEN}' WHEN r IN (6, 171) THEN '{packaging.CONTAMINATED}' WHEN r IN (7, 132, 182) THEN '{packaging.SINGLE}'
  WHEN r IN (8, 9, 10, 15, 173) AND split THEN '{packaging.DIVIDE}' WHEN r = 11 THEN CASE WHEN split THEN '{packaging.DIVIDE}' ELSE '{packaging.FLATTEN}' END
  WHEN r IN (131, 181) THEN '{packaging.DESCRIPTIVE}' WHEN r = 14 THEN '{packaging.PIECE_COUNT}' ELSE '' END AS packaging_mode,
  CASE WHEN r = 5 THEN t_spec WHEN r IN (6, 7) THEN t_detail WHEN r = 181 THEN t_piece WHEN r = 182 THEN t_explicit ELSE {_src_text('src')} END AS packaging_evidence,
  src AS packaging_source FROM g"""


_D = decision_sql(duck("products") + " p")
_CHANGED = " OR ".join(f"o_{s} <> {f}" for s, f in zip(["vs", "vu", "vt", "bs", "bt", "price"], packaging.DECIDED))
_ROW = {
    "Category name": "coalesce(nullif(category_path, ''), 'Uncategorized')", "Item ID": "'i-' || cast(ordinal AS varchar)",
    "Item name": "item_name", "Order by": "'vessel'", "Vessel size": "vessel_size", "Vessel unit": "vessel_unit",
    "Vessel type": "vessel_type", "Bundle size": "bundle_size", "Bundle type": "bundle_type", "Price": "price",
    "Price per": "'vessel'", "Minimum order count": "'1'", "Status": "'ACTIVE'", "Image": "image_url", "GTIN": "gtin",
    "Labels": "labels_text", "Description": "description", "Brand": "brand", "Country": "country",
}
_ROWS = ", ".join(f"{_ROW.get(c, chr(39) * 2)} AS \"{c}\"" for c in oracle_clean.IMPORT_COLUMNS)
_ROWS_SQL = f"(SELECT ordinal + 2 AS row_number, {_ROWS} FROM ({_D}) d)"

ORACLES = {
    "packaging_decide": f"SELECT ordinal, {', '.join(FIELDS)} FROM ({_D}) d",
    "packaging_audit": f"""SELECT 'i' || cast(ordinal AS varchar) AS "Item ID", item_name AS "Item name", o_vs AS "Old vessel size", o_vu AS "Old vessel unit", o_vt AS "Old vessel type",
  o_bs AS "Old bundle size", o_bt AS "Old bundle type", o_price AS "Old price", vessel_size AS "New vessel size", vessel_unit AS "New vessel unit", vessel_type AS "New vessel type",
  bundle_size AS "New bundle size", bundle_type AS "New bundle type", price AS "New price", packaging_mode AS "Interpretation mode", packaging_evidence AS "Evidence text",
  packaging_source AS "Parser source used" FROM ({_D}) d WHERE packaging_mode <> '' OR {_CHANGED}""",
    "packaging_mode_counts": f"SELECT packaging_mode, count(*) AS products FROM ({_D}) d GROUP BY 1",
    "import_rows": f"SELECT {_ROWS} FROM ({_D}) d",
    "sync_from_export": f"SELECT ordinal, vessel_size, bundle_size, price FROM ({_D}) d",
    "validate_packaging": f"""WITH cl AS (SELECT * FROM {oracle_clean.cleaned_subquery(_ROWS_SQL + ' rr')} cc), j AS (SELECT cl."Item ID" AS item_id, cl."Bundle size" AS b, cl."Price" AS pr, d.packaging_mode AS m, d.packaging_evidence AS ev, d.price AS dp
    FROM cl JOIN ({_D}) d ON d.ordinal + 2 = cl.row_number)
  SELECT 'error' AS severity, 'contaminated_packaging' AS rule, item_id, ev AS value FROM j WHERE m = '{packaging.CONTAMINATED}'
  UNION ALL SELECT 'error', 'missing_bundle_size', item_id, '' FROM j WHERE m = '{packaging.DIVIDE}' AND b = ''
  UNION ALL SELECT 'error', 'bundle_price_not_divided', item_id, '' FROM j WHERE m = '{packaging.DIVIDE}' AND b = '' AND pr = dp
  UNION ALL SELECT 'error', 'flattened_pack_has_bundle', item_id, '' FROM j WHERE m = '{packaging.FLATTEN}' AND b <> ''""",
}
