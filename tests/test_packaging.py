"""Packaging cases: texts in, decided fields out ('-' where a case does not say)."""

from pyspark.sql import functions as F

from shelfspark.operators import packaging as P
from shelfspark.schema import PRODUCT_TEXT_DEFAULTS, product_schema

DIVIDE, FLATTEN, SINGLE = P.DIVIDE, P.FLATTEN, P.SINGLE
# name, product fields, expected (mode, size, unit, type, bundle size, bundle type, price)
CASES = [
    ("straw", dict(item_name="Trinkhalm", raw_spec_piece_text="100 Stk. / Pack", raw_detail_price_unit_text="100 Stück / Pack", price="4.25"),
     (FLATTEN, "100", "quantity", "-", "", "-", "4.25")),
    ("dispenser", dict(item_name="Seife Spender-Flasche", raw_spec_piece_text="6 Flaschen", raw_detail_price_unit_text="6 Flaschen / Karton", raw_fill_text="500 ml / Flasche", price="96.25"),
     (DIVIDE, "500", "ml", "bottle", "6", "Karton", "16.04")),
    ("film", dict(item_name="Folie Rolle", raw_spec_piece_text="4 Rollen / Karton", raw_detail_price_unit_text="4 Rollen / Karton", price="41.40"),
     (DIVIDE, "1", "quantity", "roll", "4", "-", "10.35")),
    ("till rolls", dict(item_name="Kassenrollen", raw_spec_piece_text="50 Stück / Pack", raw_detail_price_unit_text="50 Stück / Pack", price="84.50"),
     (P.PIECE_COUNT, "50", "quantity", "roll", "", "", "84.50")),
    ("bags on rolls", dict(item_name="Abfallsack", raw_spec_piece_text="10 Rollen à 10 Stk. / Karton", price="171.90"),
     (DIVIDE, "10", "quantity", "roll", "10", "Karton", "17.19")),
    ("paper", dict(item_name="Kopierpapier", raw_spec_piece_text="5 Pack x 250 Blatt", price="211.90"),
     (DIVIDE, "250", "quantity", "pack", "5", "Karton", "42.38")),
    ("brush", dict(item_name="Bürste", raw_spec_piece_text="1 Stk.", raw_detail_price_unit_text="12 Flaschen / Karton", price="8.90"),
     (P.CONTAMINATED, "-", "-", "-", "-", "-", "8.90")),
    ("skewers", dict(item_name="Spiess", raw_detail_price_unit_text="100 Pack / Karton", description="Holz 100 Stk. / Karton", price="3.95"),
     (FLATTEN, "100", "quantity", "-", "", "-", "3.95")),
    ("powder", dict(item_name="Pulver Sack", raw_spec_piece_text="1 Sack", raw_detail_price_unit_text="14.25 kg / Sack", raw_fill_text="14,25 kg / Sack", price="50"),
     (SINGLE, "14.25", "kg", "-", "", "", "50")),
    ("spray", dict(item_name="Spray", raw_spec_piece_text="1 Einzelflasche", raw_detail_price_unit_text="0.5 Liter / Flasche", raw_fill_text="500 ml / Flasche", price="5"),
     (SINGLE, "500", "ml", "-", "", "", "5")),
    ("bags per roll", dict(item_name="Abfallsack Rolle", raw_spec_piece_text="10 Stk. / Rolle", raw_detail_price_unit_text="10 Stk. / Rolle", raw_fill_text="110 Liter", price="18.90"),
     (P.PIECE_COUNT, "10", "quantity", "roll", "", "-", "18.90")),
    ("leading roll", dict(item_name="Abfallsack", raw_spec_piece_text="Rolle à 10 Säcke, 20 Rollen / Karton", price="104.10"),
     (DIVIDE, "10", "quantity", "roll", "20", "Karton", "5.21")),
    ("gn container", dict(item_name="GN-Behälter 1/4", raw_spec_piece_text="1 Stück", raw_detail_price_unit_text="1 Stück", raw_fill_text="2.5 Liter", price="29.20"),
     (P.DESCRIPTIVE, "1", "quantity", "container", "", "-", "29.20")),
    ("soap", dict(item_name="Seife", raw_spec_piece_text="8 x 1'000 ml / Karton", raw_fill_text="1'000 ml", price="26.40"),
     (DIVIDE, "1000", "ml", "-", "8", "Karton", "3.30")),
    ("bag in box single", dict(item_name="Seife bag-in-box", raw_detail_price_unit_text="1 Stück", raw_spec_piece_text="6 Stück / Karton", raw_fill_text="1000 ml", price="8.45"),
     (SINGLE, "1000", "ml", "bag", "", "-", "8.45")),
    ("bag in box carton", dict(item_name="Seife bag-in-box", raw_detail_price_unit_text="12 Stück / Karton", raw_spec_piece_text="6 Stück / Karton", raw_fill_text="1000 ml", price="94.00"),
     (DIVIDE, "1000", "ml", "bag", "6", "Karton", "15.67")),
]


def records(spark, rows):
    full = [{**PRODUCT_TEXT_DEFAULTS, "variant_options": {}, "specs": {}, "labels": [], **r} for r in rows]
    return spark.createDataFrame(full, product_schema())


def test_cases(spark):
    rows = [{**fields, "sku": name, "product_name": fields["item_name"]} for name, fields, _ in CASES]
    got = {r["sku"]: r["decision"] for r in P.decide_packaging(records(spark, rows)).collect()}
    fields = ["packaging_mode", "vessel_size", "vessel_unit", "vessel_type", "bundle_size", "bundle_type", "price"]
    for name, _, expected in CASES:
        for field, value in zip(fields, expected):
            if value != "-":
                assert got[name][field] == value, (name, field, got[name])


def test_a_price_is_divided_once(spark):
    rows = [{**fields, "sku": name, "product_name": fields["item_name"]} for name, fields, _ in CASES]
    once = P.interpret_packaging(records(spark, rows))
    first = {r["sku"]: r["price"] for r in once.collect()}
    again = spark.createDataFrame(once.collect(), once.schema)
    assert {r["sku"]: r["price"] for r in P.interpret_packaging(again).collect()} == first


def test_audit_lists_changes_only(spark):
    rows = [dict(sku="a", item_name="x", product_name="x", price="1"), dict(sku="b", item_name="x", product_name="x", raw_spec_piece_text="3 x 4 Stk", price="1")]
    audit = P.packaging_audit(records(spark, rows).withColumn("item_id", F.col("sku"))).collect()
    assert [(r["Item ID"], r["New vessel size"], r["Interpretation mode"]) for r in audit] == [("b", "12", FLATTEN)]
