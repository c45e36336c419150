"""Pages and listing payloads -> product records (one projection per page family)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfspark.functions import html as H
from shelfspark.functions.numbers import digits_only, plain_number, trimmed_four_decimals
from shelfspark.functions.text import (
    UNICODE_CI, blank_to_null, collapse_space, contains_any, first_non_empty, has_text, keyword_value, split_clean, text,
)
from shelfspark.functions.units import measure_unit, piece_unit
from shelfspark.functions.urls import absolute_url, last_segment, without_query
from shelfspark.operators.skew import keep_where
from shelfspark.schema import PRODUCT_TEXT_DEFAULTS

# ---------------------------------------------------------------------------
# Patterns and keyword lists of product pages.
# ---------------------------------------------------------------------------
NUM = r"(\d[\d'.,]*)"
MEASURE = rf"{NUM}\s*(ml|cl|dl|l|liter|litre|kg|kilo|g|gramm)\b"
DIMENSIONS_3 = rf"{NUM}\s*x\s*{NUM}\s*x\s*{NUM}\s*mm"
DIMENSIONS_2 = rf"{NUM}\s*x\s*{NUM}\s*mm"
DIAMETER = rf"(?:ø|diameter)\s*{NUM}\s*mm"
FILL_PER_UNIT = r"^\s*\d[\d'.,]*\s*(?:ml|cl|dl|l|liter|litre|kg|kilo|g|gramm)\s*/\s*[A-Za-zÄÖÜäöüß]+"
BUNDLE = (
    rf"{NUM}\s*(?:x\s*\d[\d'.,]*\s*(?:ml|cl|dl|l|kg|g)\s*)?(?:[A-Za-zÄÖÜäöüß.-]+\s*)?(?:/\s*([A-Za-zÄÖÜäöüß]+))"
)
VAT = r"(\d{1,2}(?:[.,]\d+)?)\s*%"
GTIN_TEXT = r"\b(?:gtin|ean)\b[:\s]*([0-9]{8,14})"
TITLE_SIZE = r"(\d[\d.,]*)\s*(kg|g|ml|cl|dl|l|stk|st)\b"
SIMPLE_SIZE = r"(\d[\d.'’,]*)\s*(kg|g|ml|cl|dl|l)\b"
DELIVERY_SIZE = r"^(.+?)\s+à\s+(\d[\d.,]*)\s*([A-Za-zÄÖÜäöüß]+)(?:\s*\(([^)]+)\))?$"
PRODUCT_ROOT = r'(?is)\sclass="(?:[^"]*\s)?product-detail-content[\s"]|itemtype="https://schema.org/Product"'
NAMED_HEADING = r'(?is)<h1\b[^>]*\sitemprop="name"[^>]*>(.*?)</h1\s*>'
VESSEL_WORDS = [
    ("becher", "cup"), ("schale", "bowl"), ("bowl", "bowl"), ("teller", "plate"), ("platte", "plate"),
    ("flasche", "bottle"), ("kanister", "container"), ("deckel", "lid"), ("box", "box"), ("container", "container"),
    ("serviette", "napkin"), ("trinkhalm", "straw"), ("besteck", "cutlery"), ("beutel", "bag"), ("tragetasche", "bag"),
]
COLOURS = [
    ("braun", "braun"), ("schwarz", "schwarz"), ("transparent", "transparent"), ("weiss", "weiss"), ("weiß", "weiss"),
    ("rot", "rot"), ("blau", "blau"), ("grün", "grün"), ("gruen", "grün"), ("gelb", "gelb"), ("pink", "pink"),
    ("orange", "orange"), ("gold", "gold"), ("silber", "silber"),
]
MATERIALS = [
    "Palmblatt", "PLA", "PET", "Kraftpapier", "Holz", "Aluminium", "Edelstahl", "Papier", "Karton", "Bagasse",
    "Zuckerrohr", "Bambus",
]
ECO_WORDS = ["öko-line", "oeko-line", "bio", "biologisch abbaubar", "kompostierbar", "nachhaltig"]
SOLD_OUT = ["nicht verfügbar", "ausverkauft", "out of stock", "momentan nicht verfügbar"]
ENDED = ["eingestellt", "discontinued", "nicht mehr lieferbar"]
WEIGHTS, VOLUMES = ["g", "kg"], ["ml", "cl", "dl", "l"]


def _grab(c: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(c, UNICODE_CI + pattern, group)


def spec(specs: Column, name: str) -> Column:
    return text(F.try_element_at(specs, F.lit(name)))


def first_hit(pattern: str, *sources: Column) -> Column:
    """The matched piece of the first source the pattern occurs in, '' if none."""
    return F.coalesce(*[blank_to_null(_grab(s, pattern, 0)) for s in sources], F.lit(""))


# --- column rules ------------------------------------------------------------
def breadcrumb(crumbs: Column, *roots: str) -> Column:
    return F.array_join(F.filter(crumbs, lambda c: ~c.isin(list(roots))), " > ")


def vessel_type_of(name: Column) -> Column:
    return keyword_value(F.lower(name), VESSEL_WORDS)


def colour_of(name: Column, specs: Column) -> Column:
    return first_non_empty(F.lower(spec(specs, "Farbe")), keyword_value(F.lower(name), COLOURS))


def material_of(name: Column, specs: Column) -> Column:
    return first_non_empty(spec(specs, "Material"), keyword_value(F.lower(name), [(m.lower(), m) for m in MATERIALS]))


def labels_of(body: Column, badges: Column) -> Column:
    body, badges = F.lower(body), F.lower(badges)
    return F.array_compact(F.array(
        F.when(contains_any(body, ECO_WORDS), "BIO"),
        F.when(contains_any(badges, ["sale", "aktion"]) | body.contains("statt"), "DISCOUNTED"),
        F.when(contains_any(badges, ["neu", "new"]), "NEW"),
        F.when(contains_any(badges, ["saison", "season"]), "SEASONAL"),
    ))


def status_of(availability: Column) -> Column:
    lowered = F.lower(availability)
    return F.when(contains_any(lowered, SOLD_OUT), "OUT_OF_STOCK").when(contains_any(lowered, ENDED), "INACTIVE").otherwise("ACTIVE")


def gtin_of(page_text: Column, specs: Column) -> Column:
    named = F.map_filter(specs, lambda k, v: F.lower(k).isin("ean", "gtin") & F.length(digits_only(v)).between(8, 14))
    return F.coalesce(digits_only(F.try_element_at(F.map_values(named), F.lit(1))), _grab(page_text, GTIN_TEXT, 1))


def vat_of(page_text: Column) -> Column:
    return plain_number(F.regexp_extract(page_text, VAT, 1))


def bundle_of(source: Column) -> tuple[Column, Column]:
    """(size, type) of 'N unit / container'; a fill per unit or a single unit is no bundle."""
    hit = F.when(source.rlike(UNICODE_CI + FILL_PER_UNIT), "").otherwise(_grab(source, BUNDLE, 0))
    size = plain_number(_grab(hit, BUNDLE, 1))
    return F.when(size == "1", "").otherwise(size), F.when(size == "1", "").otherwise(_grab(hit, BUNDLE, 2))


def vessel_of_texts(bundle_text: Column, *sources: Column) -> tuple[Column, Column]:
    hit = first_hit(MEASURE, *sources)
    counted = has_text(bundle_text)
    size = F.when(hit != "", plain_number(_grab(hit, MEASURE, 1))).when(counted, "1").otherwise("")
    unit = F.when(hit != "", measure_unit(_grab(hit, MEASURE, 2))).when(counted, "quantity").otherwise("")
    return size, unit


def dimensions_of(*sources: Column) -> Column:
    """length, width, height, diameter: three sides, else two, else a diameter."""
    three, two, round_ = (first_hit(p, *sources) for p in (DIMENSIONS_3, DIMENSIONS_2, DIAMETER))
    side = lambda hit, p, i: plain_number(_grab(hit, p, i))
    flat = three == ""
    return F.struct(
        F.when(flat, side(two, DIMENSIONS_2, 1)).otherwise(side(three, DIMENSIONS_3, 1)).alias("length"),
        F.when(flat, side(two, DIMENSIONS_2, 2)).otherwise(side(three, DIMENSIONS_3, 2)).alias("width"),
        side(three, DIMENSIONS_3, 3).alias("height"),
        F.when(flat & (two == ""), side(round_, DIAMETER, 1)).otherwise("").alias("diameter"),
    )


def item_name_of(name: Column, options: Column) -> Column:
    """The name plus every option value it does not already contain."""
    known = F.replace(F.replace(F.lower(name), F.lit("kl.m."), F.lit("kleinmenge")), F.lit("std."), F.lit("standardmenge"))
    missing = F.filter(F.map_values(options), lambda v: (v != "") & ~F.contains(known, F.lower(v)))
    return F.when(F.size(missing) > 0, F.concat(name, F.lit(" - "), F.array_join(missing, " / "))).otherwise(name)


def title_size(title: Column) -> tuple[Column, Column]:
    """Last 'number unit' of a title; a bare trailing unit counts as one."""
    last = F.try_element_at(F.regexp_extract_all(title, F.lit(UNICODE_CI + TITLE_SIZE), F.lit(0)), F.lit(-1))
    tail = F.lower(F.regexp_extract(title, r"(\S+)\s*$", 1))
    bare = tail.isin("stk", "st", "stück", "stueck", *WEIGHTS, *VOLUMES)
    size = F.coalesce(trimmed_four_decimals(_grab(last, TITLE_SIZE, 1)), F.when(bare, "1"), F.lit(""))
    unit = F.coalesce(piece_unit(_grab(last, TITLE_SIZE, 2)), F.when(bare, piece_unit(tail)), F.lit(""))
    return size, unit


def simple_size(source: Column) -> tuple[Column, Column]:
    hit = _grab(source, SIMPLE_SIZE, 0)
    return trimmed_four_decimals(_grab(hit, SIMPLE_SIZE, 1)), F.lower(_grab(hit, SIMPLE_SIZE, 2))


def delivery_size(raw: Column) -> Column:
    """'Container à N unit (extra)' -> vessel, bundle and weights."""
    raw = collapse_space(text(raw))
    part = lambda i: F.regexp_extract(raw, DELIVERY_SIZE, i)
    value, unit = trimmed_four_decimals(part(2)), piece_unit(part(3))
    measured = unit.isin(*WEIGHTS, *VOLUMES)
    hit = F.regexp_extract(part(4), r"(?iU)(\d[\d.,]*)\s*(kg|g|ml|cl|dl|l)\b", 0)
    extra = trimmed_four_decimals(F.regexp_extract(hit, r"(\d[\d.,]*)", 1))
    extra_unit = F.lower(F.regexp_extract(hit, r"([A-Za-z]+)$", 1))
    bundled = (unit != "") & ~measured & (value != "1")
    return F.struct(
        F.when(part(2) == "", raw).otherwise(part(1)).alias("vessel_type"),
        F.when(measured, value).otherwise(extra).alias("vessel_size"),
        F.when(measured, unit).otherwise(extra_unit).alias("vessel_unit"),
        F.when(bundled, value).otherwise("").alias("bundle_size"),
        F.when(bundled, unit).otherwise("").alias("bundle_type"),
        F.when(unit.isin(WEIGHTS), value).otherwise("").alias("net_weight"),
        F.when(extra_unit.isin(WEIGHTS), extra).otherwise("").alias("total_weight"),
    )


def price_of_payload(p: str) -> Column:
    """First truthy price: current size (cents), sale or list price (cents), unit info (francs)."""
    cents = [f"{p}.current_delivery_size.regular_price", f"{p}.current_delivery_size.price",
             f"{p}.sv_rebateprice", f"{p}.sv_standardprice"]
    units = F.flatten(F.map_values(F.col(f"{p}.extfields.uinfo")))
    truthy = F.filter(
        F.flatten(F.transform(units, lambda u: F.array(u["specialprice"], u["baseprice"]))),
        lambda v: v.isNotNull() & (v != 0),
    )
    picked = F.coalesce(*[F.nullif(F.col(c), F.lit(0.0)) / 100 for c in cents], F.try_element_at(truthy, F.lit(1)))
    return F.coalesce(trimmed_four_decimals(picked.cast("string")), F.lit(""))


def barcodes_of(p: str, sku: Column) -> Column:
    """gtin: first usable code; bundle gtin: first usable code with a quantity, else the gtin."""
    codes = F.transform(F.col(f"{p}.barcodes"), lambda b: F.struct(
        digits_only(text(b["barcode"])).alias("code"), text(b["quantity_as"]).alias("quantity")))
    usable = F.filter(codes, lambda b: (F.length(b["code"]) >= 8) & (b["code"] != sku))
    packed = F.filter(usable, lambda b: ~b["quantity"].isin("", "0"))
    first = F.try_element_at(usable, F.lit(1))["code"]
    return F.struct(text(first).alias("gtin"), text(F.coalesce(F.try_element_at(packed, F.lit(1))["code"], first)).alias("bundle_gtin"))


def labels_of_payload(p: str) -> Column:
    named = F.transform(F.col(f"{p}.labels"), lambda e: collapse_space(first_non_empty(e["desc"], e["name"], e["value"])))
    diet = split_clean(F.lower(text(F.col(f"{p}.diet"))), ",")
    return F.array_distinct(F.filter(F.concat(F.coalesce(named, F.array().cast("array<string>")), diet), lambda x: x != ""))


# --- page families -----------------------------------------------------------
def shop_page(pages: DataFrame) -> DataFrame:
    """Shop pages with breadcrumb titles, a spec table and a price block."""
    h = F.col("html")
    staged = pages.select(
        "url", "html",
        # only a page with a product root has a name
        F.when(h.rlike(PRODUCT_ROOT), first_non_empty(
            H.class_text(h, "product-detail-name"), H.text_of(F.regexp_extract(h, NAMED_HEADING, 1)))).otherwise("").alias("name"),
        H.table_specs(h).alias("specs"),
        H.class_text(h, "price-unit-content").alias("detail"),
        H.body_text(h, "script", "style", "head").alias("page_text"),
        H.class_body_text(h, "product-detail-description-text", "h1", "table", ".mt-4", "script", "style").alias("description"),
        H.class_texts(h, "breadcrumb-title").alias("crumbs"),
        H.variant_options(h).alias("variant_options"),
    )
    s = F.col("specs")
    piece = first_non_empty(spec(s, "Stückzahl"), spec(s, "Anzahl"))
    fill = first_non_empty(spec(s, "Füllmenge"), spec(s, "Inhalt"))
    staged = staged.select("*", piece.alias("piece"), fill.alias("fill"), first_non_empty(F.col("detail"), piece).alias("bundle_text"))
    name, bundle_text = F.col("name"), F.col("bundle_text")
    size, unit = vessel_of_texts(bundle_text, F.col("fill"), name, spec(s, "Grösse"), spec(s, "Inhalt"), bundle_text)
    bundle_size, bundle_type = bundle_of(bundle_text)
    sides = dimensions_of(spec(s, "Grösse"), spec(s, "Größe"), name)
    price = F.trim(F.regexp_replace(H.class_text(h, "product-detail-price"), r"CHF|\*", ""))
    path = breadcrumb(F.filter("crumbs", lambda c: F.lower(c) != "home"))
    pdf = F.filter(H.links(h), lambda l: F.lower(l).contains(".pdf"))
    staged = staged.select("*", sides.alias("sides"))
    return _record(staged, {
        "canonical_url": first_non_empty(H.attribute(h, r'\srel="canonical"', "href"), F.col("url")),
        "category_path": first_non_empty(path, F.lit("Uncategorized")), "product_name": name,
        "item_name": item_name_of(name, F.col("variant_options")),
        "variant_name": F.array_join(F.filter(F.map_values("variant_options"), lambda v: v != ""), " / "),
        "sku": H.class_text(h, "product-detail-ordernumber"), "price": plain_number(price),
        "currency": F.lit("CHF"),
        "image_url": absolute_url(F.col("url"), H.meta(h, "property", "og:image")),
        "product_sheet_url": absolute_url(F.col("url"), F.try_element_at(pdf, F.lit(1))),
        "description": F.col("description"), "manufacturer": spec(s, "Hersteller"), "brand": spec(s, "Marke"),
        "region": spec(s, "Region"), "country": first_non_empty(spec(s, "Land"), spec(s, "Herkunft")),
        "vat": vat_of(F.col("page_text")), "gtin": gtin_of(F.col("page_text"), s),
        "status": status_of(H.class_text(h, "delivery-information")),
        "raw_availability_text": H.class_text(h, "delivery-information"),
        "vessel_size": size, "vessel_unit": unit, "vessel_type": vessel_type_of(name),
        "bundle_size": bundle_size, "bundle_type": bundle_type, "raw_bundle_text": bundle_text,
        "raw_detail_price_unit_text": F.col("detail"), "raw_spec_piece_text": F.col("piece"), "raw_fill_text": F.col("fill"),
        "color": colour_of(name, s), "material": material_of(name, s),
        **{side: F.col(f"sides.{side}") for side in ("length", "width", "height", "diameter")},
    }, specs=s, options=F.col("variant_options"), labels=labels_of(
        F.concat_ws(" ", name, "description", "page_text"), F.array_join(F.concat(H.class_texts(h, "product-badges"), H.class_texts(h, "badge")), " ")))


def article_page(pages: DataFrame) -> DataFrame:
    """Article pages with dt/dd specs and the package size in the title.

    Optional columns external_url / external_html carry the linked manufacturer page.
    """
    h, title = F.col("html"), H.tag_text(F.col("html"), "h1")
    specs = H.definition_specs(h)
    size, unit = title_size(title)
    crumbs = F.filter(H.tag_texts(h, "li", "breadcrumb-navigation"), lambda c: c != "Home")
    path = F.when(F.size(crumbs) > 1, F.array_join(F.slice(crumbs, 1, F.size(crumbs) - 1), " > ")).otherwise("")
    ext = text(F.col("external_html")) if "external_html" in pages.columns else F.lit("")
    ext_url = text(F.col("external_url")) if "external_url" in pages.columns else F.lit("")
    ext_title = H.tag_text(ext, "title")
    ext_image = absolute_url(ext_url, H.first_meta(ext, ("property", "og:image"), ("name", "twitter:image")))
    ext_text = first_non_empty(H.first_meta(ext, ("name", "description"), ("property", "og:description")), H.lead_text(ext))
    pdf = F.filter(H.links(ext), lambda l: l.endswith(".pdf"))
    sheet = F.when(F.lower(ext_url).endswith(".pdf"), ext_url).otherwise(absolute_url(ext_url, F.try_element_at(pdf, F.lit(1))))
    keyed = F.transform_keys(specs, lambda k, v: F.replace(F.lower(k), F.lit(" "), F.lit("_")))
    return _record(pages, {
        "canonical_url": without_query(F.col("url")), "category_path": path, "product_name": title, "item_name": title,
        "sku": spec(specs, "Artikelnummer"), "currency": F.lit("CHF"),
        "image_url": first_non_empty(absolute_url(F.col("url"), H.attribute(h, r"\ssrc=", "src", "article-image")), ext_image),
        "product_sheet_url": sheet, "description": F.concat_ws("\n\n", blank_to_null(F.array_join(
            H.tag_texts(h, "p", "accordion-body"), " ")), blank_to_null(ext_text)),
        "manufacturer": ext_title, "region": spec(specs, "Herkunft"), "country": spec(specs, "Herkunft"),
        "vessel_size": size, "vessel_unit": unit, "vessel_type": F.when(unit == "st", "piece").otherwise(""),
    }, specs=keyed, labels=split_clean(spec(specs, "Label"), r"[\n,]+"))


def wine_page(pages: DataFrame) -> DataFrame:
    """Wine pages: attribute flags, further information, sizes per variant."""
    h, title = F.col("html"), H.tag_text(F.col("html"), "h1")
    attributes = H.wine_attributes(h)
    info = H.item_pairs(h, "further-info__item", "further-info__title", "further-info__content")
    variants = H.attributed_texts(h, "a", "data-simple-product-id")
    sized = F.filter(variants, lambda v: v.rlike(UNICODE_CI + SIMPLE_SIZE))
    size, unit = simple_size(text(F.try_element_at(sized, F.lit(1))))
    origin = split_clean(spec(attributes, "Herkunft"), r"\|")
    crumbs = H.tag_texts(h, "li", "breadcrumbs")
    described = F.array_join(F.transform(F.map_entries(info), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "\n\n")
    merged = F.transform_keys(F.map_concat(attributes, info), lambda k, v: H.spec_key(k))
    return _record(pages, {
        "canonical_url": without_query(F.col("url")), "category_path": breadcrumb(crumbs, "Shop"), "product_name": title,
        "item_name": title, "sku": H.attribute(h, r"\sdata-product-sku=", "data-product-sku"),
        "price": H.attribute(h, r'\sdata-price-type="finalPrice"', "data-price-amount"),
        "image_url": absolute_url(F.col("url"), H.meta(h, "property", "og:image")),
        "description": first_non_empty(described, H.meta(h, "name", "description")),
        "manufacturer": H.class_text(h, "producer__name"), "brand": H.class_text(h, "producer__name"),
        "region": text(F.try_element_at(origin, F.lit(1))),
        "country": F.when(F.size(origin) > 1, text(F.try_element_at(origin, F.lit(-1)))).otherwise(""),
        "vessel_size": size, "vessel_unit": unit,
    }, specs=merged, labels=F.array_compact(F.array(F.try_element_at(attributes, F.lit("Typ")))))


def food_page(pages: DataFrame) -> DataFrame:
    """Food pages: package evidence in the title and the info list, article number in a badge."""
    h, title = F.col("html"), H.tag_text(F.col("html"), "h1")
    items = H.tag_texts(h, "li", "product-additional-info-list")
    size, unit = simple_size(F.concat_ws(" ", title, F.array_join(items, " ")))
    number = F.regexp_extract(H.class_text(h, "product-box-articlenumber"), r"Art-Nr\.\s*([\w.-]+)", 1)
    specs = F.transform_keys(H.table_specs(h), lambda k, v: H.spec_key(k))
    maker = H.class_text(h, "product-detail-manufacturer-link")
    return _record(pages, {
        "canonical_url": without_query(F.col("url")),
        "category_path": breadcrumb(H.class_texts(h, "breadcrumb-title"), "Shop"), "product_name": title, "item_name": title,
        "sku": first_non_empty(number, last_segment(F.col("url"))), "currency": F.lit("CHF"),
        "image_url": absolute_url(F.col("url"), first_non_empty(
            H.attribute(h, r"\sdata-full-image=", "data-full-image"), H.meta(h, "property", "og:image"))),
        "description": first_non_empty(H.class_text(h, "product-detail-description-text"), H.meta(h, "property", "og:description")),
        "manufacturer": maker, "brand": maker, "country": H.class_text(h, "product-additional-info__origin"),
        "vessel_size": size, "vessel_unit": unit,
        "vessel_type": F.regexp_extract(text(F.try_element_at(items, F.lit(2))), r"/\s*(.+)$", 1),
    }, specs=specs, labels=H.class_texts(h, "product-icon-text"))


def _record(pages: DataFrame, fields: dict[str, Column], specs=None, options=None, labels=None) -> DataFrame:
    """Product record with defaults for fields the page family does not fill."""
    empty_map = F.create_map().cast("map<string,string>")
    columns = {name: F.lit(default) for name, default in PRODUCT_TEXT_DEFAULTS.items()}
    columns["product_url"] = F.col("url")
    columns |= fields
    return pages.select(
        *[c.alias(n) for n, c in columns.items()],
        (options if options is not None else empty_map).alias("variant_options"),
        (specs if specs is not None else empty_map).alias("specs"),
        (labels if labels is not None else F.array().cast("array<string>")).alias("labels"),
    )


PAGE_FAMILIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "shop": shop_page, "article": article_page, "wine": wine_page, "food": food_page,
}


def extract_products(pages: DataFrame, family: str) -> tuple[DataFrame, DataFrame]:
    """(products, failures); a page without a product name is a failure."""
    records = PAGE_FAMILIES[family](pages)
    # a plain filter would read names below the shuffle that deals the pages, and again above it
    failed = keep_where(records, F.col("product_name") == "").select(
        F.lit("detail").alias("stage"), F.col("product_url").alias("url"), F.lit("not-a-product-page").alias("reason"))
    return keep_where(records, F.col("product_name") != ""), failed


def page_links(pages: DataFrame) -> DataFrame:
    """Distinct absolute links per page URL, of all its snapshots."""
    found = F.array_distinct(F.transform(H.links(F.col("html")), lambda href: absolute_url(F.col("url"), href)))
    return pages.select(F.col("url").alias("page_url"), F.explode(found).alias("url")).filter("url <> ''").distinct()


def listing_diagnostics(pages: DataFrame) -> DataFrame:
    h = F.col("html")
    data_url = F.regexp_extract(F.replace(h, F.lit("&quot;"), F.lit('"')), r'"dataUrl":"([^"]+)"', 1)
    return pages.select(
        "url", h.contains('data-listing="true"').cast("string").alias("has_listing_widget"),
        data_url.alias("uses_widget_data_url"), F.lower(h).contains("pagination").cast("string").alias("has_pagination"),
        F.regexp_count(h, F.lit('class="card product-box')).cast("string").alias("product_card_count"),
    )


def listing_totals(pages: DataFrame) -> DataFrame:
    """Advertised totals and page counts; 0 or 1 when the page does not say."""
    h = F.col("html")
    amount = digits_only(H.attribute(h, r"\sdata-amount=", "data-amount"))
    of = digits_only(F.regexp_extract(H.class_text(h, "toolbar-amount"), r"(?i)von\s+([\d.'’]+)", 1))
    last = F.regexp_extract(H.class_html(h, "page-last"), r'\svalue="(\d+)"', 1)
    return pages.select(
        "url", F.coalesce(amount.try_cast("bigint"), F.lit(0)).alias("advertised_by_attribute"),
        F.coalesce(of.try_cast("bigint"), F.lit(0)).alias("advertised_by_toolbar"),
        F.coalesce(last.try_cast("bigint"), F.lit(1)).alias("page_count"),
    )


def with_manufacturer_link(pages: DataFrame) -> DataFrame:
    """Add `external_url`, the link of an article page's manufacturer entry; '' if there is none."""
    return pages.withColumn("external_url", absolute_url(F.col("url"), H.link_of(F.col("html"), "article-spec-infos", "link")))


def enrich_external(products: DataFrame, external_pages: DataFrame) -> DataFrame:
    """Attach the linked manufacturer page; products without one stay.

    Products without a link take no part in the join, where they all would meet in one task.
    """
    pages = external_pages.select(F.col("url").alias("external_url"), F.col("html").alias("external_html"))
    linked = has_text(F.col("external_url"))
    without = products.filter(~F.coalesce(linked, F.lit(False))).withColumn("external_html", F.lit(None).cast("string"))
    return products.filter(linked).join(pages, "external_url", "left").unionByName(without)


# --- JSON payloads -----------------------------------------------------------
# Spec names and the payload fields they come from.
SPEC_FIELDS = {
    "article_type": "article_type", "delivery_info": "info", "delivered_conservation_method": "delivered_conservation_method",
    "diet": "diet", "ingredients": "ingredient_list", "allergens": "allergens", "traces": "traces", "intolerance": "intolerance",
    "nutrition_energy": "nutrition_info_energy", "nutrition_fat": "nutritional_value_fat",
    "nutrition_saturated_fat": "nutritional_value_saturated_fatty_acids",
    "nutrition_carbohydrates": "nutritional_value_carbohydrates", "nutrition_sugar": "nutritional_value_sugar",
    "nutrition_fiber": "nutritional_value_fiber", "nutrition_protein": "nutritional_value_protein",
    "nutrition_salt": "nutritional_value_salt", "nutrition_amount": "nutritional_value_amount",
    "nutrition_unit": "nutritional_value_unit", "delivery_size": "currentdeliverysizetext", "vendor_name": "vendorname",
    "catalog_level_3": "catalog_level_3", "minimum_delivery_date": "minimum_delivery_date",
}
_MORE_FIELDS = sorted(set(SPEC_FIELDS.values()) - {
    "article_type", "diet", "ingredient_list", "allergens", "currentdeliverysizetext", "catalog_level_3"})
PAYLOAD = (
    "struct<" + "".join(f"{name}:string," for name in _MORE_FIELDS) + "shorttext:string,extartnr:string,currentdeliverysizetext:string,mwst:string,description:string,detailtext:string,"
    "manufacturer:string,brand:string,buying_currency:string,status:int,diet:string,origin:string,origin_key:string,"
    "origin_all:map<string,struct<value:string>>,ingredient_list:string,allergens:string,article_type:string,"
    "maingroup:string,catalog_level_2:string,catalog_level_3:string,wgtext:string,product_data_sheet:string,"
    "barcodes:array<struct<barcode:string,quantity_as:string>>,labels:array<struct<desc:string,name:string,value:string>>,"
    "current_delivery_size:struct<regular_price:double,price:double>,sv_rebateprice:double,sv_standardprice:double,"
    "extfields:struct<gp_minord:string,uinfo:map<string,array<struct<specialprice:double,baseprice:double>>>>>"
)
COMPONENTS = f"map<string,struct<constructor_type:string,props:struct<product:{PAYLOAD},catalog:struct<children:array<struct<name:string,tag_name:string,children:array<struct<catid:string,name:string,link:string,tag_name:string>>>>>>>>"
DETAIL_COMPONENT = "react_components/detail/detail-intro$default"
MENU_COMPONENT = "react_components/catalog_menu$default"
def embedded_components(pages: DataFrame) -> DataFrame:
    """Component map of the page's JSON scripts; unreadable scripts are skipped."""
    scripts = F.regexp_extract_all(
        F.col("html"), F.lit(r'(?is)<script\b[^>]*data-store="react-components"[^>]*>(.*?)</script>'), F.lit(1))
    return pages.select("*", F.explode_outer(scripts).alias("_script")).select(
        *pages.columns, F.from_json("_script", COMPONENTS).alias("components")).filter("components IS NOT NULL")


def _component(kind: str) -> Column:
    return F.try_element_at(F.filter(F.map_values("components"), lambda c: c["constructor_type"] == kind), F.lit(1))


def payload_page(pages: DataFrame) -> DataFrame:
    """Pages whose product is embedded as JSON."""
    staged = embedded_components(pages).select("url", "html", _component(DETAIL_COMPONENT)["props"]["product"].alias("p"))
    staged = staged.filter("p IS NOT NULL").select(
        "*", barcodes_of("p", collapse_space(text(F.col("p.extartnr")))).alias("codes"),
        delivery_size(F.col("p.currentdeliverysizetext")).alias("pack"))
    crumbs = F.filter(H.class_texts(F.col("html"), "breadcrumb__item"), lambda c: c != "Zurück")
    name = collapse_space(text(F.col("p.shorttext")))
    crumbs = F.when(F.try_element_at(crumbs, F.lit(1)) == "Katalog", F.slice(crumbs, F.lit(2), F.size(crumbs))).otherwise(crumbs)
    crumbs = F.when(F.try_element_at(crumbs, F.lit(-1)) == name, F.slice(crumbs, 1, F.greatest(F.size(crumbs) - 1, F.lit(0)))).otherwise(crumbs)
    groups = F.array(*[collapse_space(text(F.col(f"p.{g}"))) for g in ("maingroup", "catalog_level_2", "catalog_level_3", "wgtext")])
    path = first_non_empty(F.array_join(crumbs, " > "), F.array_join(F.array_distinct(F.filter(groups, lambda g: g != "")), " > "))
    h = F.col("html")
    ld = F.regexp_extract(h, r'(?is)<script\b[^>]*type="application/ld\+json"[^>]*>(.*?)</script>', 1)
    spec_map = H.plain_values(F.create_map(*[x for k, f in SPEC_FIELDS.items() for x in (F.lit(k), F.col(f"p.{f}"))]))
    origin = F.try_element_at(F.col("p.origin_all"), F.trim(text(F.col("p.origin_key"))))["value"]
    return _record(staged, {
        "canonical_url": without_query(F.col("url")), "product_url": without_query(F.col("url")), "category_path": path,
        "product_name": name, "item_name": name, "sku": collapse_space(text(F.col("p.extartnr"))),
        "gtin": F.col("codes.gtin"), "bundle_gtin": F.col("codes.bundle_gtin"), "price": price_of_payload("p"),
        "currency": first_non_empty(collapse_space(text(F.col("p.buying_currency"))), F.lit("CHF")),
        "vat": trimmed_four_decimals(text(F.col("p.mwst"))),
        "min_order_count": first_non_empty(trimmed_four_decimals(text(F.col("p.extfields.gp_minord"))), F.lit("1")),
        "status": F.when(F.coalesce("p.status", F.lit(0)) > 0, "ACTIVE").otherwise("INACTIVE"),
        "image_url": first_non_empty(text(F.get_json_object(ld, "$.image")), H.attribute(h, r'\sclass="detailpicture"', "src")),
        "product_sheet_url": absolute_url(F.col("url"), F.col("p.product_data_sheet")),
        "description": H.text_of(H.unescape(first_non_empty(F.col("p.description"), F.col("p.detailtext")))),
        "manufacturer": collapse_space(text(F.col("p.manufacturer"))), "brand": collapse_space(text(F.col("p.brand"))),
        "country": first_non_empty(collapse_space(text(origin)), H.text_of(text(F.col("p.origin")))),
        **{f: F.col(f"pack.{f}") for f in ("vessel_type", "vessel_size", "vessel_unit", "bundle_size", "bundle_type", "net_weight", "total_weight")},
        "raw_bundle_text": collapse_space(text(F.col("p.currentdeliverysizetext"))),
        "raw_fill_text": collapse_space(text(F.col("p.currentdeliverysizetext"))),
        "raw_availability_text": F.when(h.contains("auf Anfr."), "auf Anfr.").otherwise(""),
    }, specs=spec_map, labels=labels_of_payload("p"))


def category_tree(pages: DataFrame) -> DataFrame:
    """Second-level categories of the embedded menu; tagged nodes are skipped."""
    menu = embedded_components(pages).select("url", _component(MENU_COMPONENT)["props"]["catalog"]["children"].alias("nodes"))
    main = menu.select("url", F.explode("nodes").alias("m")).filter("m.tag_name IS NULL")
    child = main.select("url", collapse_space(text(F.col("m.name"))).alias("parent_category_name"), F.explode("m.children").alias("c"))
    return child.filter("c.tag_name IS NULL AND c.link <> ''").select(
        text(F.col("c.catid")).alias("category_id"), collapse_space(text(F.col("c.name"))).alias("category_name"),
        absolute_url(F.col("url"), F.col("c.link")).alias("category_url"), "parent_category_name")


TRANSLATED = "translated:struct<name:string,description:string,packUnit:string,breadcrumb:array<string>>"
CATEGORY = "struct<breadcrumb:array<string>,translated:struct<breadcrumb:array<string>>>"
LISTING_ELEMENT = (
    f"struct<id:string,productNumber:string,name:string,description:string,packUnit:string,{TRANSLATED},active:boolean,"
    "available:boolean,ean:string,stock:double,weight:double,calculatedPrice:struct<unitPrice:double>,tax:struct<taxRate:double>,"
    "cover:struct<media:struct<url:string>>,media:array<struct<media:struct<url:string>>>,"
    f"seoCategory:{CATEGORY},categories:array<{CATEGORY}>,properties:array<struct<name:string,translated:struct<name:string>>>,"
    "manufacturer:struct<name:string,translated:struct<name:string>>,customFields:map<string,string>,"
    "extensions:struct<teaProductExtension:string>>"  # an open object, kept as JSON
)
TEA_EXTENSION = f"struct<googleLink:string,displayCategory:{CATEGORY}>"
# Keys of the tea extension that are no specification.
TEA_NO_SPECS = ("translated", "displayCategory", "apiAlias", "createdAt", "updatedAt")
LISTING_PAGE = f"struct<total:bigint,page:bigint,elements:array<{LISTING_ELEMENT}>>"
GRAM_FIELD = "product_detail_custom_fields_weight_in_gram"


def _named_specs(fields: Column, prefix: str) -> Column:
    """Text, number and boolean fields that are not empty, with prefixed names; objects and lists are left out."""
    known = F.map_filter(F.coalesce(fields, F.create_map().cast("map<string,string>")),
                         lambda _, v: F.coalesce((collapse_space(v) != "") & ~F.ltrim(v).rlike(r"^[\[{]"), F.lit(False)))
    return F.transform_values(F.transform_keys(known, lambda k, _: F.concat(F.lit(prefix), k)), lambda _, v: collapse_space(v))


def listing_products(payloads: DataFrame, base_url: str, root_crumb: str, brand: str, fallback_category: str) -> DataFrame:
    """Listing API pages (page_index, json) -> one record per product id, the last page wins."""
    pages = payloads.select("page_index", F.from_json("json", LISTING_PAGE).alias("l"))
    elements = pages.select("page_index", F.posexplode("l.elements").alias("pos", "e")).filter("e.id <> ''")
    latest = elements.groupBy(F.col("e.id").alias("id")).agg(F.max_by("e", F.struct("page_index", "pos")).alias("e"))

    def translated(node: Column, field: str) -> Column:
        return collapse_space(first_non_empty(node["translated"][field], node[field]))

    e = F.col("e")
    extension = e["extensions"]["teaProductExtension"]
    tea = F.from_json(extension, TEA_EXTENSION)
    tea_fields = F.map_filter(F.from_json(extension, "map<string,string>"), lambda k, _: ~k.isin(*TEA_NO_SPECS))
    crumb_lists = F.array_compact(F.concat(
        F.array(e["seoCategory"]), F.coalesce(e["categories"], F.array()), F.array(tea["displayCategory"])))
    paths = F.transform(crumb_lists, lambda c: F.filter(
        F.transform(F.coalesce(c["translated"]["breadcrumb"], c["breadcrumb"], F.array()), collapse_space), lambda x: x != ""))
    paths = F.transform(paths, lambda p: F.when(F.try_element_at(p, F.lit(1)) == root_crumb, F.slice(p, F.lit(2), F.size(p))).otherwise(p))
    path = F.array_join(F.try_element_at(F.filter(paths, lambda p: F.size(p) > 0), F.lit(1)), " > ")
    images = F.filter(F.concat(F.array(e["cover"]["media"]["url"]), F.coalesce(F.transform(e["media"], lambda m: m["media"]["url"]), F.array())),
                      lambda u: text(u) != "")
    pack = translated(e, "packUnit")
    hit = _grab(pack, TITLE_SIZE, 0)  # the first size counts
    size, unit = trimmed_four_decimals(_grab(hit, TITLE_SIZE, 1)), piece_unit(_grab(hit, TITLE_SIZE, 2))
    packed = pack.rlike(UNICODE_CI + TITLE_SIZE)
    grams = F.try_element_at(e["customFields"], F.lit(GRAM_FIELD))
    weight = F.nullif(e["weight"], F.lit(0.0))
    number = lambda c: F.coalesce(trimmed_four_decimals(c.cast("string")), F.lit(""))
    region = collapse_space(text(tea["googleLink"]))
    url = F.concat(F.lit(f"{base_url.rstrip('/')}/shop/detail/"), F.col("id"))
    vessel_unit = F.when(packed, unit).when(has_text(grams), "g").when(weight.isNotNull(), "kg").otherwise("")
    staged = latest.withColumn("url", url)
    return _record(staged, {
        "canonical_url": url, "category_path": first_non_empty(path, F.lit(fallback_category)),
        "product_name": translated(e, "name"), "item_name": translated(e, "name"), "sku": collapse_space(text(e["productNumber"])),
        "gtin": collapse_space(text(e["ean"])), "bundle_gtin": collapse_space(text(e["ean"])),
        "price": number(e["calculatedPrice"]["unitPrice"]), "currency": F.lit("CHF"), "vat": number(e["tax"]["taxRate"]),
        "status": F.when(F.coalesce(e["active"], F.lit(True)) & F.coalesce(e["available"], F.lit(True)), "ACTIVE").otherwise("INACTIVE"),
        "image_url": text(F.try_element_at(images, F.lit(1))), "description": H.text_of(H.unescape(translated(e, "description"))),
        "manufacturer": translated(e["manufacturer"], "name"), "brand": F.lit(brand), "region": region,
        "country": F.substring_index(region, " / ", 1),
        "vessel_size": F.when(packed, size).when(has_text(grams), number(grams)).otherwise(number(weight)),
        "vessel_unit": vessel_unit, "vessel_type": F.when(vessel_unit == "st", "piece").otherwise(""),
        "raw_bundle_text": pack, "total_weight": number(e["weight"]),
    }, specs=F.map_concat(
        _named_specs(tea_fields, "tea_"), _named_specs(e["customFields"], "custom_"),
        F.create_map(F.lit("product_id"), F.col("id"), F.lit("stock"), number(e["stock"]))),
        labels=F.array_distinct(F.filter(F.transform(F.coalesce(e["properties"], F.array()), lambda p: collapse_space(
            first_non_empty(p["translated"]["name"], p["name"]))), lambda x: x != ""))).filter("product_name <> ''")
