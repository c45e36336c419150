"""Packaging interpretation: free packaging text -> vessel, bundle and unit price.

Four projections: (1) the texts that may speak about packaging, (2) which text each
pattern matches first, (3) the captured values, (4) the first rule that applies.  The
decision fields are then read off the rule.  Every long text is scanned once per pattern;
captures are taken from the short matched piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.numbers import divide_half_up, multiply_text, plain_number
from shelfspark.functions.text import (
    UNICODE_CI, contains_any, first_non_empty, has_text, join_non_empty, keyword_value, lookup, strip, text,
)
from shelfspark.functions.units import measure_unit
from shelfspark.operators.skew import keep_where

# ---------------------------------------------------------------------------
# Vocabulary and patterns of packaging texts.
# ---------------------------------------------------------------------------
NUM = r"(\d[\d'.,]*)"
MEASURES = "ml|cl|dl|l|liter|litre|kg|kilo|g|gramm"
CONTAINERS = "karton|pack|box|palette|pallet|umsack|beutel|rolle"
PIECES = r"stück|stueck|stk\.?|pieces?|pcs?|blätter|blaetter|blatt"
NAMED = (
    "einzelflaschen?|einzelrollen?|einzelbeutel|einzeldosen?|einzelkanister|einzelsack|spender-?flaschen?|"
    "schwedenflaschen?|flaschen?|rollen?|beutel|dosen?|kanister|packs?|boxen?|sack|säcke|saecke"
)
IN_CONTAINER = rf"\s*(?:/\s*({CONTAINERS}))?"
PATTERNS = {
    "measure": rf"{NUM}\s*({MEASURES})\b",
    "fill": rf"{NUM}\s*({MEASURES})\s*/\s*(spender-?flasche|schwedenflasche|flasche|rolle|beutel|dose|kanister)\b",
    "simple": rf"{NUM}\s*({NAMED}|{PIECES}){IN_CONTAINER}",
    "nested_count": rf"{NUM}\s*[xX]\s*{NUM}\s*({PIECES}|rollen?|beutel|säcke|saecke){IN_CONTAINER}",
    "nested_named": rf"{NUM}\s*({NAMED})\s*(?:à|[xX])\s*{NUM}\s*({PIECES}|beutel|säcke|saecke|rollen?){IN_CONTAINER}",
    "physical": rf"{NUM}\s*[xX]\s*{NUM}\s*({MEASURES})\s*(spender-?flasche|schwedenflasche|flasche|beutel|dose|kanister){IN_CONTAINER}",
    "physical_count": rf"{NUM}\s*[xX]\s*{NUM}\s*({MEASURES}){IN_CONTAINER}",
    "leading_named": (
        rf"(rolle|pack|box|beutel)\s*(?:à|[xX])\s*{NUM}\s*({PIECES}|beutel|säcke|saecke|rollen?)\s*,\s*"
        rf"{NUM}\s*({NAMED}){IN_CONTAINER}"
    ),
}
SINGLE_PIECE = r"\b1\s*(stück|stueck|stk\.?)\b"
NAMED_UNIT_VESSELS = {
    "einzelflasche": "bottle", "einzelrolle": "roll", "einzelbeutel": "bag", "einzeldose": "can",
    "einzelkanister": "canister", "einzelsack": "bag", "spender-flasche": "bottle",
    "spenderflasche": "bottle", "schwedenflasche": "bottle", "flasche": "bottle", "rolle": "roll",
    "beutel": "bag", "dose": "can", "kanister": "canister", "pack": "pack", "box": "box", "sack": "bag",
}
PIECE_UNITS = ["stück", "stueck", "stk", "piece", "pieces", "pcs", "blatt"]
SINGULAR = {
    "flaschen": "flasche", "einzelflaschen": "einzelflasche", "rollen": "rolle", "einzelrollen": "einzelrolle",
    "dosen": "dose", "einzeldosen": "einzeldose", "packs": "pack", "boxen": "box", "saecke": "sack",
    "blaetter": "blatt",
}
CONTAINER_TITLES = {
    "karton": "Karton", "pack": "Pack", "box": "Box", "palette": "Palette", "pallet": "Palette",
    "umsack": "Pack", "beutel": "Beutel", "rolle": "Rolle",
}
CONTEXT_VESSELS = [
    ("bag-in-box", "bag"), ("rolle", "roll"), ("flasche", "bottle"), ("beutel", "bag"),
    ("kanister", "canister"), ("dose", "can"), ("dosen", "can"),
]
# Decision modes.
DIVIDE = "preserve_inner_unit_divide_price"
FLATTEN = "flatten_piece_pack"
SINGLE = "preserve_single_named_unit"
PIECE_COUNT = "piece_count_in_named_unit"
DESCRIPTIVE = "piece_unit_capacity_descriptive"
CONTAMINATED = "suspected_contaminated_bundle"

SOURCES = ["spec_stueckzahl", "description", "detail_price_unit", "spec_fill", "item_name"]
DECIDED = ["vessel_size", "vessel_unit", "vessel_type", "bundle_size", "bundle_type", "price"]
EVIDENCE = ["packaging_mode", "packaging_evidence", "packaging_source"]


def singular(token: Column) -> Column:
    """Lower case, umlauts spelled out, trailing dot dropped, known plurals to singular."""
    plain = F.lower(strip(token))
    for umlaut, spelled in (("ä", "ae"), ("ö", "oe"), ("ü", "ue")):
        plain = F.replace(plain, F.lit(umlaut), F.lit(spelled))
    plain = F.regexp_replace(plain, r"\.$", "")
    return F.coalesce(lookup(SINGULAR, plain), plain)


def vessel_of(token: Column) -> Column:
    return lookup(NAMED_UNIT_VESSELS, singular(token), "")


def container_title(token: Column) -> Column:
    return F.coalesce(lookup(CONTAINER_TITLES, F.lower(strip(token))), F.initcap(strip(token)))


def _pattern(name: str) -> str:
    return UNICODE_CI + PATTERNS[name]


def _spec(name: str) -> Column:
    return text(F.try_element_at("specs", F.lit(name)))


def _texts(products: DataFrame) -> DataFrame:
    spec = first_non_empty(F.col("raw_spec_piece_text"), _spec("Stückzahl"))
    fill = first_non_empty(F.col("raw_fill_text"), _spec("Füllmenge"))
    staged = products.select(
        "*",
        spec.alias("_spec_stueckzahl"),
        text(F.col("description")).alias("_description"),
        first_non_empty(F.col("raw_detail_price_unit_text"), F.col("raw_bundle_text")).alias("_detail_price_unit"),
        first_non_empty(F.col("raw_fill_text"), _spec("Füllmenge"), _spec("Inhalt")).alias("_spec_fill"),
        text(F.col("item_name")).alias("_item_name"),
        fill.alias("_fill_text"),
        first_non_empty(F.col("raw_spec_piece_text"), _spec("Stückzahl"), _spec("Anzahl")).alias("_piece_text"),
    )
    names = [F.lower("item_name"), F.lower("product_name")]
    return staged.select(
        "*",
        join_non_empty(" ", *names, F.lower("_fill_text"), F.lower("_spec_stueckzahl")).alias("_context"),
        join_non_empty(" ", *names, F.lower("raw_fill_text"), F.lower("_spec_stueckzahl")).alias("_unit_context"),
        join_non_empty(" ", *names, F.lower("category_path"), F.lower("_piece_text")).alias("_piece_context"),
    )


LADDER = ["nested_count", "nested_named", "physical", "physical_count", "leading_named", "simple"]
NOT_DETAIL = [s for s in SOURCES if s != "detail_price_unit"]
# capture groups per pattern
GROUPS = {"measure": 2, "fill": 3, "simple": 3, "nested_count": 4, "nested_named": 5, "physical": 5,
          "physical_count": 4, "leading_named": 6}


def _texts_array(names: list[str]) -> Column:
    """The non-empty texts among the named ones, in order, each with its name."""
    pairs = ", ".join(f"named_struct('name', '{n}', 'text', _{n})" for n in names)
    return F.expr(f"filter(array({pairs}), t -> t.text <> '')")


def _first_text(texts: str, name: str) -> Column:
    """First text the pattern occurs in, as (name, text); null when in none."""
    return F.try_element_at(F.filter(texts, lambda t: t["text"].rlike(_pattern(name))), F.lit(1))


def _matches(texts: DataFrame) -> DataFrame:
    fill_order = ["fill_text", *NOT_DETAIL, "detail_price_unit"]
    sourced = texts.select(
        "*", _texts_array(SOURCES).alias("_texts"), _texts_array(NOT_DETAIL).alias("_other_texts"),
        # the fill text itself speaks first, then the other texts, the price block last
        _texts_array(fill_order).alias("_fill_texts"),
    )
    found = sourced.select(
        "*",
        *[_first_text("_texts", p).alias(f"_first_{p}") for p in LADDER],
        _first_text("_fill_texts", "fill").alias("_first_fill"),
        _first_text("_other_texts", "measure").alias("_first_measure"),
    )

    def captured(hit: Column, pattern: str) -> Column:
        """Captures of the matched piece; the piece itself is cut out of the long text once."""
        groups = F.sequence(F.lit(1), F.lit(GROUPS[pattern]))
        return F.transform(groups, lambda i: F.call_function("regexp_extract", hit, F.lit(_pattern(pattern)), i))

    spec_or_description = first_non_empty(F.col("_spec_stueckzahl"), F.col("_description"))
    hits = {p: (F.col(f"_first_{p}.text"), p) for p in [*LADDER, "fill", "measure"]}
    hits |= {"detail": (F.col("_detail_price_unit"), "simple"), "spec": (spec_or_description, "simple")}
    cut = found.select("*", *[
        F.regexp_extract(text(source), _pattern(p), 0).alias(f"_hit_{name}") for name, (source, p) in hits.items()
    ])
    return cut.select("*", *[captured(F.col(f"_hit_{name}"), p).alias(f"{name}_cap") for name, (_, p) in hits.items()])


def _captures(found: DataFrame) -> DataFrame:
    def cap(hit: str, pattern: str, index: int) -> Column:
        return F.col(f"{hit}_cap")[index - 1]

    def number(hit: str, index: int, pattern: str | None = None) -> Column:
        return plain_number(cap(hit, pattern or hit, index))

    measured = F.col("_hit_fill") != ""
    found = found.select(
        "*",
        F.when(measured, number("fill", 1)).otherwise(number("measure", 1)).alias("fill_size"),
        F.when(measured, measure_unit(cap("fill", "fill", 2))).otherwise(measure_unit(cap("measure", "measure", 2)))
        .alias("fill_unit"),
        vessel_of(cap("fill", "fill", 3)).alias("fill_vessel"),
        keyword_value(F.col("_context"), CONTEXT_VESSELS).alias("context_vessel"),
        F.when(contains_any(F.col("_piece_context"), ["deckel"]), "lid")
        .when(contains_any(F.col("_piece_context"), ["gn-behälter", "gn-behaelter"]), "container")
        .when(contains_any(F.col("_piece_context"), ["eimer", "bucket"]), "bucket").otherwise("").alias("piece_vessel"),
        F.lower(strip(F.col("_piece_text"))).rlike(UNICODE_CI + SINGLE_PIECE).alias("one_piece"),
        number("detail", 1, "simple").alias("detail_count"), singular(cap("detail", "simple", 2)).alias("detail_unit"),
        number("spec", 1, "simple").alias("spec_count"), singular(cap("spec", "simple", 2)).alias("spec_unit"),
        number("physical", 1).alias("ph_outer"), number("physical", 2).alias("ph_size"),
        measure_unit(cap("physical", "physical", 3)).alias("ph_unit"),
        vessel_of(cap("physical", "physical", 4)).alias("ph_vessel"), cap("physical", "physical", 5).alias("ph_container"),
        number("physical_count", 1).alias("pc_outer"), number("physical_count", 2).alias("pc_size"),
        measure_unit(cap("physical_count", "physical_count", 3)).alias("pc_unit"),
        cap("physical_count", "physical_count", 4).alias("pc_container"),
        number("nested_named", 1).alias("nn_outer"), vessel_of(cap("nested_named", "nested_named", 2)).alias("nn_vessel"),
        number("nested_named", 3).alias("nn_inner"), cap("nested_named", "nested_named", 5).alias("nn_container"),
        vessel_of(cap("leading_named", "leading_named", 1)).alias("ln_vessel"), number("leading_named", 2).alias("ln_inner"),
        number("leading_named", 4).alias("ln_outer"), cap("leading_named", "leading_named", 6).alias("ln_container"),
        number("nested_count", 1).alias("nc_outer"), number("nested_count", 2).alias("nc_inner"),
        number("simple", 1).alias("si_count"), singular(cap("simple", "simple", 2)).alias("si_unit"),
        text(container_title(cap("simple", "simple", 3))).alias("si_container"),
    )
    return found.select(
        "*",
        first_non_empty(F.col("fill_vessel"), F.col("context_vessel")).alias("known_vessel"),
        (has_text(F.col("fill_size")) & has_text(F.col("fill_unit"))).alias("has_fill"),
        (F.col("one_piece") & (F.col("piece_vessel") != "")).alias("descriptive"),
    )


def _rule() -> Column:
    c = F.col
    named_unit = lambda unit: unit.isin(list(NAMED_UNIT_VESSELS))
    piece_unit = lambda unit: unit.isin(PIECE_UNITS)
    both = (c("_hit_detail") != "") & (c("_hit_spec") != "")
    detail_known = c("_unit_context").contains(c("detail_unit"))
    simple = c("_hit_simple") != ""
    box_of = c("si_container").isin("Beutel", "Box", "Pack") & c("known_vessel").isin("roll", "bag", "box", "pack")
    roll_of = (c("si_container") == "Rolle") & (
        c("known_vessel").isin("roll", "bag", "")
    )
    return (
        F.when(both & c("detail_unit").isin("pack", "box") & piece_unit(c("spec_unit"))
               & (c("detail_count") == c("spec_count")) & ~c("spec_count").isin("", "1") & ~detail_known, "equal_pack")
        .when(both & named_unit(c("detail_unit")) & piece_unit(c("spec_unit")) & (c("spec_count") == "1")
              & ~detail_known, "detail_contradicts")
        .when(both & (c("detail_count") == "1") & ~c("spec_count").isin("", "1") & c("has_fill")
              & c("known_vessel").isin("bag", "bottle", "can", "canister"), "single_filled")
        .when(c("_hit_physical") != "", "physical")
        .when(c("_hit_physical_count") != "", "physical_count")
        .when(c("_hit_nested_named") != "", "nested_named")
        .when(c("_hit_leading_named") != "", "leading_named")
        .when(c("_hit_nested_count") != "", "nested_count")
        .when(simple & (c("si_count") == "1") & c("descriptive"), "one_descriptive")
        .when(simple & (c("si_count") == "1") & c("has_fill"), "one_filled")
        .when(simple & (c("si_count") == "1"), "one_plain")
        .when(simple & piece_unit(c("si_unit")) & (roll_of | box_of), "pieces_per_unit")
        .when(simple & piece_unit(c("si_unit")) & c("known_vessel").isin("bottle", "roll", "bag", "can", "canister"),
              "pieces_divide")
        .when(simple & piece_unit(c("si_unit")), "pieces_flatten")
        .when(simple & named_unit(c("si_unit")) & ~c("_unit_context").contains(c("si_unit")), "unit_contradicts")
        .when(simple & c("si_unit").isin("pack", "box") & ~c("has_fill"), "unit_flatten")
        .when(simple & named_unit(c("si_unit")), "unit_divide")
        .when(c("descriptive"), "descriptive")
        .when(c("has_fill") & text(c("vessel_unit")).isin("quantity", ""), "filled")
        .otherwise("none")
    )


def _by_rule(values: dict[str, Column], default: Column) -> Column:
    """CASE over the rule column; keys may name several rules."""
    chain = None
    for rules, value in values.items():
        hit = F.col("rule").isin(rules.split())
        chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return chain.otherwise(default)


def _decide(captured: DataFrame) -> DataFrame:
    c = F.col
    lit = F.lit
    own = {f: text(c(f)) for f in DECIDED}
    ruled = captured.withColumn("rule", _rule())

    own_size = first_non_empty(c("fill_size"), own["vessel_size"], lit("1"))
    own_unit = first_non_empty(c("fill_unit"), own["vessel_unit"], lit("quantity"))
    spoken = first_non_empty(c("known_vessel"), own["vessel_type"])
    size = _by_rule({
        "equal_pack": c("spec_count"), "single_filled one_filled filled": c("fill_size"), "physical": c("ph_size"),
        "physical_count": c("pc_size"), "nested_named": c("nn_inner"), "leading_named": c("ln_inner"),
        "nested_count": multiply_text(c("nc_outer"), c("nc_inner")), "one_descriptive descriptive": lit("1"),
        "pieces_per_unit pieces_flatten unit_flatten": c("si_count"), "pieces_divide unit_divide": own_size,
    }, own["vessel_size"])
    unit = _by_rule({
        "single_filled one_filled filled": c("fill_unit"), "physical": c("ph_unit"), "physical_count": c("pc_unit"),
        "equal_pack nested_named leading_named nested_count one_descriptive descriptive pieces_per_unit "
        "pieces_flatten unit_flatten": lit("quantity"),
        "pieces_divide unit_divide": own_unit,
    }, own["vessel_unit"])
    vessel = _by_rule({
        "single_filled one_filled filled physical_count": spoken,
        "physical": first_non_empty(c("ph_vessel"), c("fill_vessel"), own["vessel_type"]),
        "nested_named": c("nn_vessel"), "leading_named": first_non_empty(c("ln_vessel"), c("context_vessel")),
        "one_descriptive descriptive": first_non_empty(c("piece_vessel"), own["vessel_type"]),
        "pieces_per_unit": first_non_empty(c("known_vessel"), vessel_of(c("si_container"))),
        "pieces_divide": c("known_vessel"),
        "unit_divide": first_non_empty(vessel_of(c("si_unit")), c("fill_vessel"), own["vessel_type"]),
    }, own["vessel_type"])
    outer = _by_rule({
        "physical": c("ph_outer"), "physical_count": c("pc_outer"), "nested_named": c("nn_outer"),
        "leading_named": c("ln_outer"), "pieces_divide unit_divide": c("si_count"),
    }, lit(""))
    staged = ruled.select(
        "*", size.alias("_size"), unit.alias("_unit"), vessel.alias("_vessel"), outer.alias("_outer"),
    )
    keeps_bundle = c("rule").isin("detail_contradicts", "unit_contradicts", "filled", "none")
    split = ~c("_outer").isin("", "1")
    bundle = F.when(keeps_bundle, own["bundle_size"]).when(split, c("_outer")).otherwise("")
    named_container = _by_rule({
        "physical": c("ph_container"), "physical_count": c("pc_container"), "nested_named": c("nn_container"),
        "leading_named": c("ln_container"), "pieces_divide unit_divide": c("si_container"),
    }, lit(""))
    carton = F.when(c("rule") == "pieces_divide", "Pack").otherwise("Karton")
    bundle_type = F.when(keeps_bundle, own["bundle_type"]).otherwise(container_title(first_non_empty(
        named_container, F.when(c("rule") == "physical", "").otherwise(own["bundle_type"]), carton)))
    # A record that already carries this very division must not be divided again.
    done = (
        (text(c("packaging_mode")) == DIVIDE)
        & (plain_number(own["bundle_size"]) == plain_number(c("_outer")))
        & (own["vessel_size"] == c("_size")) & (own["vessel_unit"] == c("_unit"))
        & ((c("_vessel") == "") | (own["vessel_type"] == c("_vessel")))
    )
    price = F.when(split & ~done, divide_half_up(own["price"], c("_outer"))).otherwise(own["price"])
    mode = _by_rule({
        "equal_pack nested_count pieces_flatten unit_flatten": lit(FLATTEN),
        "detail_contradicts unit_contradicts": lit(CONTAMINATED), "single_filled one_filled filled": lit(SINGLE),
        "physical physical_count nested_named": F.when(split, DIVIDE).otherwise(""),
        "leading_named": F.when(split, DIVIDE).otherwise(FLATTEN), "pieces_divide unit_divide": lit(DIVIDE),
        "one_descriptive descriptive": lit(DESCRIPTIVE), "pieces_per_unit": lit(PIECE_COUNT),
    }, lit(""))
    simple_rules = ("one_descriptive one_filled pieces_per_unit pieces_divide pieces_flatten "
                    "unit_contradicts unit_flatten unit_divide")
    source = _by_rule({
        "equal_pack descriptive": lit("spec_stueckzahl"), "detail_contradicts single_filled": lit("detail_price_unit"),
        **{p: c(f"_first_{p}.name") for p in LADDER if p != "simple"}, simple_rules: c("_first_simple.name"),
        "filled": lit("spec_fill"),
    }, lit(""))
    evidence = _by_rule({
        "equal_pack": c("_spec_stueckzahl"), "detail_contradicts single_filled": c("_detail_price_unit"),
        "descriptive": c("_piece_text"), "filled": c("_fill_text"),
        **{p: c(f"_first_{p}.text") for p in LADDER if p != "simple"}, simple_rules: c("_first_simple.text"),
    }, lit(""))
    return staged.select(
        "*",
        F.struct(
            first_non_empty(c("_size"), own["vessel_size"]).alias("vessel_size"),
            first_non_empty(c("_unit"), own["vessel_unit"]).alias("vessel_unit"),
            first_non_empty(c("_vessel"), own["vessel_type"]).alias("vessel_type"),
            bundle.alias("bundle_size"),
            F.when(bundle == "", "").otherwise(bundle_type).alias("bundle_type"),
            first_non_empty(price, own["price"]).alias("price"),
            mode.alias("packaging_mode"), evidence.alias("packaging_evidence"), source.alias("packaging_source"),
        ).alias("decision"),
    )


def decide_packaging(products: DataFrame) -> DataFrame:
    """The input columns plus `decision`."""
    decided = _decide(_captures(_matches(_texts(products))))
    return decided.select(*products.columns, "decision")


def apply_decisions(decided: DataFrame) -> DataFrame:
    """Put the decided fields in place of the record's own."""
    replaced = [*DECIDED, *EVIDENCE]
    return decided.select(*[
        F.col(f"decision.{name}").alias(name) if name in replaced else F.col(name)
        for name in decided.columns if name != "decision"
    ])


def interpret_packaging(products: DataFrame) -> DataFrame:
    return apply_decisions(decide_packaging(products))


def audit_of(decided: DataFrame, item_id: str = "item_id", keep: list[str] | None = None) -> DataFrame:
    """Old and new values of every decided product that changed or got a mode."""
    changed = F.col("decision.packaging_mode") != ""
    for name in DECIDED:
        changed = changed | (text(F.col(name)) != F.col(f"decision.{name}"))
    label = lambda name: name.replace("_", " ")
    return keep_where(decided, changed).select(
        *(keep or []), F.col(item_id).alias("Item ID"), F.col("item_name").alias("Item name"),
        *[text(F.col(n)).alias(f"Old {label(n)}") for n in DECIDED],
        *[F.col(f"decision.{n}").alias(f"New {label(n)}") for n in DECIDED],
        F.col("decision.packaging_mode").alias("Interpretation mode"),
        F.col("decision.packaging_evidence").alias("Evidence text"),
        F.col("decision.packaging_source").alias("Parser source used"),
    )


def packaging_audit(products: DataFrame, item_id: str = "item_id") -> DataFrame:
    return audit_of(decide_packaging(products), item_id)


def mode_counts(products: DataFrame) -> DataFrame:
    decided = decide_packaging(products)
    return decided.groupBy(F.col("decision.packaging_mode").alias("packaging_mode")).agg(
        F.count(F.lit(1)).alias("products")
    )
