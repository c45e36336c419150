"""Job inputs derived from the star-schema tables, in SQL both engines read alike.

`@name` stands for a base table or another derived view.  Money and sizes are built from
integers so that no engine prints a floating-point number.
"""

from __future__ import annotations

import re
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.functions.ids import category_id
from shelfspark.operators.skew import with_sequence
from shelfspark.schema import IMPORT_COLUMNS, PRODUCT_TEXT_DEFAULTS

BASE_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Supplier of a catalogue line: one supplier owns a third of everything.
_SLUG = "CASE WHEN k % 3 = 0 THEN 'hub' ELSE 'shop' || cast(k % 7 AS string) END"
_CENTS = "cast(floor(price_unit * 100 + 0.5) AS bigint)"

# Packaging texts by product; each entry is (spec text, detail text, fill text).
_PACK_TEXTS = [
    ("100 Stk. / Pack", "100 Stk. / Pack", ""),
    ("6 Flaschen", "6 Flaschen / Karton", "500 ml / Flasche"),
    ("4 Rollen / Karton", "4 Rollen / Karton", ""),
    ("10 Rollen à 10 Stk. / Karton", "", ""),
    ("5 Pack x 250 Blatt", "", ""),
    ("1 Stk.", "12 Flaschen / Karton", ""),
    ("Rolle à 10 Säcke, 20 Rollen / Karton", "", ""),
    ("8 x 1000 ml / Karton", "", "1000 ml"),
    ("12 x 0.75 l Flasche / Karton", "", ""),
    ("1 Sack", "14.25 kg / Sack", "14,25 kg / Sack"),
    ("6 Stk. / Karton", "1 Stk.", "1000 ml"),
    ("50 Stk. / Rolle", "50 Stk. / Rolle", "110 Liter"),
    ("3 x 40 Stk. / Box", "", ""),
    ("1 Stk.", "1 Stk.", "2.5 Liter"),
    ("", "", "750 ml"),
    ("", "", ""),
    ("24 Dosen / Palette", "24 Dosen / Palette", "330 ml"),
    ("10 Pack / Karton", "10 Pack / Karton", ""),
    ("100 Stk. / Karton", "100 Pack / Karton", ""),
]


def _pack_case(index: int) -> str:
    whens = " ".join(
        f"WHEN {i} THEN '{texts[index]}'" for i, texts in enumerate(_PACK_TEXTS)
    )
    return f"CASE cast(v % {len(_PACK_TEXTS)} AS int) {whens} END"


_NAME_TEXT = (
    "noun || CASE cast(v % 8 AS int) WHEN 0 THEN ' Flasche' WHEN 1 THEN ' Rolle' WHEN 2 THEN ' Becher' "
    "WHEN 3 THEN ' GN-Behälter' WHEN 4 THEN ' bag-in-box' WHEN 5 THEN ' Dose' WHEN 6 THEN '' ELSE ' Beutel' END"
)
_FEED_SIZE_TEXT = (
    "CASE cast(v % 10 AS int) WHEN 0 THEN ' 8 x 250 Stk' WHEN 1 THEN ' 6 x 0.75 l' WHEN 2 THEN ' 500 ml' "
    "WHEN 3 THEN ' 24 Stk / Karton' WHEN 4 THEN ' 1,5 kg' WHEN 5 THEN '' WHEN 6 THEN ' 16.6 g' "
    "WHEN 7 THEN ' 12x330ml Dose' WHEN 8 THEN ' 100 pieces/box' ELSE ' extra' END"
)

# Column rules of the raw import feed; every other import column is empty.
FEED_COLUMNS = {
    "Category name": "CASE WHEN v % 9 = 0 THEN '' WHEN v % 9 = 1 THEN 'n/a' ELSE 'Gastro > ' || kind || ' > ' || noun END",
    "Item ID": (
        "CASE WHEN k % 3 = 0 AND v % 2 = 0 THEN brand || '/' || kind "
        "WHEN v % 23 = 1 THEN '  ' WHEN v % 23 = 2 THEN 'null' "
        "WHEN v % 23 = 3 THEN brand || chr(92) || cast(k AS string) || ' (neu)' "
        "WHEN v % 23 = 4 THEN 'Brand-1-ECONOMY-row' || lpad(cast(k - 3 AS string), 5, '0') "
        "ELSE brand || '-' || cast(k AS string) END"
    ),
    "Item name": "noun || CASE WHEN v % 6 = 0 THEN ' Becher' WHEN v % 6 = 1 THEN ' Flasche' WHEN v % 6 = 2 THEN ' Menübox' ELSE '' END || " + _FEED_SIZE_TEXT,
    "Order by": "CASE cast(v % 4 AS int) WHEN 0 THEN 'vessel' WHEN 1 THEN 'kg' WHEN 2 THEN 'invalid' ELSE '-' END",
    "Vessel size": "CASE cast(v % 11 AS int) WHEN 0 THEN '' WHEN 1 THEN '500' WHEN 2 THEN '0,45' WHEN 3 THEN '16.6' WHEN 4 THEN '1.0' WHEN 5 THEN 'ca. 2 Liter' WHEN 6 THEN 'N/A' WHEN 7 THEN '250' ELSE '' END",
    "Vessel unit": "CASE cast(v % 13 AS int) WHEN 0 THEN 'ml' WHEN 1 THEN 'Liter' WHEN 2 THEN 'g' WHEN 3 THEN 'Stk.' WHEN 4 THEN 'kilo' WHEN 5 THEN 'unknown' WHEN 6 THEN 'G' ELSE '' END",
    "Vessel type": "CASE cast(v % 14 AS int) WHEN 0 THEN 'cup' WHEN 1 THEN 'bo' WHEN 2 THEN 'NA' WHEN 3 THEN 'PX' WHEN 4 THEN 'Kaffee-Becher' WHEN 5 THEN 'grosse Flasche' WHEN 6 THEN 'palette' WHEN 7 THEN 'xyz' ELSE '' END",
    "Bundle size": "CASE cast(v % 17 AS int) WHEN 0 THEN '6' WHEN 1 THEN '1' WHEN 2 THEN '0.45' WHEN 3 THEN '24 Stk' WHEN 4 THEN '-' WHEN 5 THEN '12.0' ELSE '' END",
    "Bundle type": "CASE cast(v % 19 AS int) WHEN 0 THEN 'Karton' WHEN 1 THEN 'PK' WHEN 2 THEN 'pallet' WHEN 3 THEN 'unbekannt' WHEN 4 THEN 'na' WHEN 5 THEN 'Pack/Karton' ELSE '' END",
    "Bundle GTIN": "CASE WHEN v % 5 = 0 THEN '76' || lpad(cast(k AS string), 9, '0') WHEN v % 5 = 1 THEN '123' ELSE '' END",
    "Price": (
        "CASE cast(v % 7 AS int) WHEN 0 THEN 'CHF ' || cast(whole AS string) || ',' || frac || '/Box' "
        "WHEN 1 THEN cast(whole AS string) || '.' || frac WHEN 2 THEN 'auf Anfrage' WHEN 3 THEN '€ ' || cast(whole AS string) "
        "WHEN 4 THEN cast(whole AS string) || '.' || frac || '5' WHEN 5 THEN 'none' ELSE '-' || cast(whole AS string) END"
    ),
    "Price per": "CASE cast(v % 3 AS int) WHEN 0 THEN 'vessel' WHEN 1 THEN '100g' ELSE 'box' END",
    "Minimum order count": "CASE WHEN v % 4 = 0 THEN '2' ELSE '1' END",
    "Status": "CASE cast(v % 5 AS int) WHEN 0 THEN 'INACTIVE' WHEN 1 THEN 'wrong' WHEN 2 THEN 'OUT_OF_STOCK' ELSE 'ACTIVE' END",
    "Image": "CASE cast(v % 4 AS int) WHEN 0 THEN 'https://img.example.com/' || cast(k AS string) || '.jpg' WHEN 1 THEN '/media/' || cast(k AS string) || '.jpg' ELSE 'null' END",
    "GTIN": "CASE WHEN v % 10 = 0 THEN '76' || lpad(cast(k AS string), 9, '0') WHEN v % 10 = 1 THEN 'EAN 40-' || lpad(cast(k AS string), 8, '0') WHEN v % 10 = 2 THEN '12' ELSE '' END",
    "Labels": "CASE cast(v % 6 AS int) WHEN 0 THEN 'BIO,foo,DISCOUNTED' WHEN 1 THEN ' bio , BIO,new' WHEN 2 THEN 'none' WHEN 3 THEN 'SEASONAL' ELSE '' END",
    "Description": "CASE WHEN v % 4 = 0 THEN 'Inhalt' || " + _FEED_SIZE_TEXT + " || ' pro Lieferung' WHEN v % 4 = 1 THEN ' - ' WHEN v % 4 = 2 THEN '  ' || noun || ' 3 x 40 pcs  ' ELSE '' END",
    "Manufacturer": "CASE WHEN v % 8 = 0 THEN 'null' ELSE brand END",
    "Brand": "brand",
    "Country": "CASE cast(v % 4 AS int) WHEN 0 THEN 'ch' WHEN 1 THEN 'Japan' WHEN 2 THEN ' DE ' ELSE '' END",
    "Region": "CASE WHEN v % 5 = 0 THEN 'Alpen' ELSE '' END",
    "Material": "CASE WHEN v % 12 = 0 THEN '2 x 5 l' WHEN v % 12 = 1 THEN 'na' ELSE '' END",
    "Length": "CASE WHEN v % 6 = 0 THEN cast(size AS string) || ',5 mm' WHEN v % 6 = 1 THEN 'lang' ELSE '' END",
    "Net weight": "CASE WHEN v % 7 = 0 THEN cast(size AS string) || '.0' ELSE '' END",
    "VAT": "CASE cast(v % 6 AS int) WHEN 0 THEN '2,6' WHEN 1 THEN '8.1' WHEN 2 THEN '40.05' WHEN 3 THEN ' 7.7 ' ELSE '' END",
    "Allergens": "CASE WHEN v % 5 = 0 THEN 'Soja, Gluten,,' ELSE '' END",
    "Product Sheet": "CASE WHEN v % 6 = 0 THEN 'http://docs.example.com/' || cast(k AS string) || '.pdf' WHEN v % 6 = 1 THEN 'sheet.pdf' ELSE '' END",
}


_EMPTY = "''"


def _feed_columns(quote: str) -> list[str]:
    return [f"{_SLUG} AS supplier_slug"] + [
        f"{FEED_COLUMNS.get(c, _EMPTY)} AS {quote}{c}{quote}" for c in IMPORT_COLUMNS
    ]


# Shared shape of a catalogue line; `v` mixes the key so that rules are independent of order.
_LINES = (
    "SELECT {keys}, k, k * 7919 % 1000003 AS v, brand, kind, noun, size, "
    f"cast(floor({_CENTS} / 100) AS bigint) AS whole, "
    f"lpad(cast({_CENTS} % 100 AS string), 2, '0') AS frac FROM ({{source}}) src"
)
_PART_SOURCE = (
    "SELECT p_partkey AS k, p_brand AS brand, p_type AS kind, p_name AS noun, "
    "p_size AS size, p_retailprice AS price_unit FROM @part"
)
OFFER_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_OFFER_SOURCE = (
    f"SELECT {', '.join(OFFER_KEYS)}, l_orderkey * 8 + l_linenumber AS k, p_brand AS brand, p_type AS kind, "
    "p_name AS noun, p_size AS size, l_extendedprice AS price_unit FROM @lineitem JOIN @part ON l_partkey = p_partkey"
)

# Product records: same lines, before packaging interpretation.
PRODUCT_COLUMNS = {
    "ordinal": "k",
    "supplier_slug": _SLUG,
    "product_url": "'https://shop.example.com/' || lower(kind) || '/' || replace(noun, ' ', '-') || '-' || cast(CASE WHEN v % 5 = 0 THEN k - k % 20 ELSE k END AS string) || '.html'",
    "canonical_url": "'https://shop.example.com/' || lower(kind) || '/' || replace(noun, ' ', '-') || '-' || cast(k - k % 20 AS string) || '.html'",
    "category_path": "CASE WHEN v % 11 = 0 THEN '' WHEN v % 11 = 1 THEN 'Gastro & Bar > ' || noun WHEN v % 11 = 2 THEN 'Sehr lange Kategorie fuer Lagerung und Transport von ' || kind || ' Artikeln > Unterkategorie mit ausgesprochen langem Namen und noch mehr Text ' || noun WHEN v % 11 = 3 THEN kind || ' > ' || noun WHEN v % 11 = 4 THEN brand || ' > ' || kind || ' > ' || noun ELSE 'Katalog > ' || kind || ' > ' || brand END",
    "product_name": "noun",
    "item_name": _NAME_TEXT,
    "sku": "CASE WHEN v % 4 = 0 THEN '' WHEN v % 10 = 1 THEN 'SKU/' || cast(k % 50 AS string) ELSE 'SKU/' || cast(k AS string) END",
    "opt_colour": "CASE cast(v % 3 AS int) WHEN 0 THEN 'rot' WHEN 1 THEN 'blau' ELSE '' END",
    "price": "cast(whole AS string) || '.' || frac",
    "raw_spec_piece_text": _pack_case(0),
    "raw_detail_price_unit_text": _pack_case(1),
    "raw_fill_text": _pack_case(2),
    "raw_bundle_text": "CASE WHEN v % 29 = 0 THEN '12 Stk. / Karton' ELSE '' END",
    "description": "CASE WHEN v % 31 = 0 THEN noun || ' 100 Stk. / Karton' WHEN v % 31 = 1 THEN 'Inhalt 0,5 l / Flasche' ELSE '' END",
    "spec_anzahl": "CASE WHEN v % 37 = 0 THEN '1 Stk.' ELSE '' END",
    "spec_inhalt": "CASE WHEN v % 41 = 0 THEN '5 l' ELSE '' END",
    "vessel_size": "CASE cast(v % 5 AS int) WHEN 0 THEN '1' WHEN 1 THEN '' ELSE '2' END",
    "vessel_unit": "CASE cast(v % 5 AS int) WHEN 0 THEN 'quantity' WHEN 1 THEN '' ELSE 'l' END",
    "vessel_type": "CASE cast(v % 6 AS int) WHEN 0 THEN 'bottle' WHEN 1 THEN 'box' WHEN 2 THEN 'cup' ELSE '' END",
    "bundle_size": "CASE WHEN v % 43 = 0 THEN '6' ELSE '' END",
    "bundle_type": "CASE WHEN v % 43 = 0 THEN 'Karton' ELSE '' END",
    "labels_text": "CASE cast(v % 3 AS int) WHEN 0 THEN 'VEGAN,BIO,other' WHEN 1 THEN 'NEW' ELSE '' END",
    "brand": "brand",
    "country": "CASE cast(v % 4 AS int) WHEN 0 THEN 'ch' WHEN 1 THEN 'Japan' WHEN 2 THEN 'D1' ELSE '' END",
    "image_url": "CASE WHEN v % 3 = 0 THEN '' ELSE 'https://img.example.com/' || cast(k AS string) || '.jpg' END",
    "gtin": "CASE WHEN v % 6 = 0 THEN '76' || lpad(cast(k AS string), 9, '0') ELSE '' END",
}

# Cleaned import rows of a catalogue whose item ids carry the supplier prefix.
ITEM_COLUMNS = {
    "Category name": "CASE WHEN v % 11 = 0 THEN '' ELSE 'Katalog > ' || kind || ' > ' || brand END",
    "Item ID": _SLUG.replace("'hub'", "'hub__item-'").replace("'shop'", "'shop'") + " || CASE WHEN k % 3 = 0 THEN '' ELSE '__item-' END || cast(k AS string)",
    "Item name": "noun || '  ' || kind || ' mit einem ausgesprochen langen Namen fuer die Kuerzung auf 64'",
    "Order by": "CASE WHEN v % 5 = 0 THEN '' ELSE 'vessel' END",
    "Vessel size": "CASE cast(v % 4 AS int) WHEN 0 THEN '0.75' WHEN 1 THEN '16.5' WHEN 2 THEN '' ELSE '500' END",
    "Vessel unit": "CASE cast(v % 4 AS int) WHEN 0 THEN 'l' WHEN 1 THEN 'g' WHEN 2 THEN 'quantity' ELSE 'ml' END",
    "Vessel type": "CASE WHEN v % 3 = 0 THEN '' ELSE 'BO' END",
    "Bundle size": "CASE cast(v % 4 AS int) WHEN 0 THEN '6' WHEN 1 THEN '1' WHEN 2 THEN '2.5' ELSE '' END",
    "Bundle type": "CASE cast(v % 4 AS int) WHEN 0 THEN 'CT' WHEN 1 THEN 'PK' WHEN 2 THEN 'PK' ELSE '' END",
    "Price": "CASE WHEN v % 13 = 0 THEN '' ELSE cast(whole AS string) || '.' || frac END",
    "Price per": "'vessel'",
    "Minimum order count": "CASE WHEN v % 7 = 0 THEN '2' ELSE '1' END",
    "Status": "CASE WHEN v % 19 = 0 THEN 'OUT_OF_STOCK' ELSE 'ACTIVE' END",
    "Image": "CASE WHEN v % 3 = 0 THEN '' ELSE 'https://img.example.com/' || cast(k AS string) || '.jpg' END",
    "GTIN": "CASE WHEN v % 6 = 0 THEN '76' || lpad(cast(k AS string), 9, '0') ELSE '' END",
    "Labels": "CASE cast(v % 3 AS int) WHEN 0 THEN 'NEW,BIO' WHEN 1 THEN 'SEASONAL' ELSE '' END",
    "Allergens": "CASE WHEN v % 5 = 0 THEN 'Soja, Gluten,,' ELSE '' END",
    "Brand": "CASE WHEN v % 17 = 0 THEN '' ELSE brand END",
    "Country": "CASE cast(v % 4 AS int) WHEN 0 THEN ' ch' WHEN 1 THEN 'Japan' ELSE '' END",
    "Description": "CASE WHEN v % 8 = 0 THEN noun ELSE '' END",
}


def _projection(columns: dict[str, str], quote: str = "") -> str:
    return ", ".join(f"{sql} AS {quote}{name}{quote}" for name, sql in columns.items())


_ITEM_ALL = {c: ITEM_COLUMNS.get(c, _EMPTY) for c in IMPORT_COLUMNS}
# Remote side: most items as last synced, some changed, some gone from the feed, some foreign.
_REMOTE = (
    "SELECT k, CASE WHEN k % 16 = 5 THEN replace(iid, 'item-', 'gone-') WHEN k % 16 = 6 THEN 'foreign-' || iid ELSE iid END AS id, "
    "CASE WHEN k % 32 = 5 THEN 'INACTIVE' ELSE status END AS status, slug, cat, "
    "CASE WHEN k % 8 = 2 THEN name || ' alt' ELSE name END AS name, order_by, vsize, vunit, vtype, bsize, btype, "
    "CASE WHEN k % 8 = 1 THEN price + 5 ELSE price END AS price, moq, image, gtin, "
    "CASE WHEN k % 8 = 3 AND labels = 'NEW,BIO' THEN 'BIO,NEW' ELSE labels END AS labels, allergens, brand, country, description "
    "FROM (SELECT k, {iid} AS iid, {slug} AS slug, {status} AS status, {cat} AS cat, "
    "substr(noun || ' ' || kind || ' mit einem ausgesprochen langen Namen fuer die Kuerzung auf 64', 1, 64) AS name, "
    "'vessel' AS order_by, "
    "CASE cast(v % 4 AS int) WHEN 0 THEN 750 WHEN 3 THEN 500000 ELSE NULL END AS vsize, "
    "CASE cast(v % 4 AS int) WHEN 0 THEN 'l' WHEN 3 THEN 'ml' ELSE '' END AS vunit, "
    "CASE WHEN v % 3 = 0 THEN 'NA' ELSE 'BO' END AS vtype, "
    "CASE WHEN v % 4 = 0 THEN 6 ELSE NULL END AS bsize, CASE WHEN v % 4 = 0 THEN 'CT' ELSE '' END AS btype, "
    "CASE WHEN v % 13 = 0 THEN NULL ELSE whole * 100 + cast(frac AS bigint) END AS price, "
    "CASE WHEN v % 7 = 0 THEN 2 ELSE 1 END AS moq, {image} AS image, {gtin} AS gtin, {labels} AS labels, "
    "CASE WHEN v % 5 = 0 THEN 'Soja,Gluten' ELSE '' END AS allergens, {brand} AS brand, "
    "CASE WHEN v % 4 = 0 THEN 'CH' ELSE '' END AS country, {description} AS description FROM @lines WHERE k % 8 <> 0) src"
).format(
    iid=ITEM_COLUMNS["Item ID"], slug=_SLUG, status=ITEM_COLUMNS["Status"], cat=ITEM_COLUMNS["Category name"],
    image=ITEM_COLUMNS["Image"], gtin=ITEM_COLUMNS["GTIN"], labels=ITEM_COLUMNS["Labels"],
    brand=ITEM_COLUMNS["Brand"], description=ITEM_COLUMNS["Description"],
)

# HTML and JSON renderings of the same lines, for the extraction jobs.
_TITLE = "noun || ' Becher ' || CASE cast(v % 4 AS int) WHEN 0 THEN '500 ml rot' WHEN 1 THEN '120 x 80 x 30 mm' WHEN 2 THEN 'ø 90 mm Papier' ELSE '60x40 mm' END"
PAGE_COLUMNS = {
    "k": "k", "v": "v", "kind": "kind", "noun": "noun", "brand": "brand", "whole": "whole", "frac": "frac", "size": "size",
    "title": _TITLE,
    "url": "'https://shop.example.com/de/' || lower(kind) || '/artikel-' || cast(k AS string) || '.html?ref=' || cast(v AS string)",
    "detail": _pack_case(1), "piece": _pack_case(0),
}
SHOP_HTML = (
    "'<html><head><title>x</title><link rel=\"canonical\" href=\"https://shop.example.com/p/' || cast(k AS string) || '\">"
    "<meta property=\"og:image\" content=\"/media/' || cast(k AS string) || '.jpg\"></head><body>"
    "<nav class=\"breadcrumb\"><span class=\"breadcrumb-title\">Home</span><span class=\"breadcrumb-title\">' || kind || '</span>"
    "<span class=\"small breadcrumb-title\">' || brand || ' &amp; Co</span></nav>"
    "<div class=\"' || CASE WHEN v % 10 = 9 THEN 'other' ELSE 'product-detail-content' END || '\"><h1 class=\"product-detail-name\">  ' || title || ' </h1>"
    "<span class=\"badge\">' || CASE WHEN v % 3 = 0 THEN 'NEU' ELSE 'Saison' END || '</span>"
    "' || CASE WHEN v % 5 = 0 THEN '<div class=\"product-badges\"><i>Aktion</i></div>' ELSE '' END || '<p class=\"product-detail-price\">CHF ' || cast(whole AS string) || '.' || frac || '*</p><span class=\"price-unit-content\">' || detail || '</span>"
    "<span class=\"product-detail-ordernumber\">A-' || cast(k AS string) || '</span><p class=\"delivery-information\">' || "
    "CASE WHEN v % 7 = 0 THEN 'Leider ausverkauft' WHEN v % 7 = 1 THEN 'Produkt eingestellt' ELSE 'Lieferzeit 2 Tage' END || '</p>"
    "<fieldset class=\"product-detail-configurator-group\"><legend>Form auswählen</legend><input type=\"radio\" id=\"f\"><label for=\"f\">rund</label></fieldset>"
    "<fieldset class=\"product-detail-configurator-group\"><legend>Farbe auswählen</legend><input type=\"radio\" id=\"c\"><label for=\"c\">gelb</label>"
    "<input type=\"radio\" id=\"a\" checked><label for=\"a\">' || CASE WHEN v % 2 = 0 THEN 'rot' ELSE 'blau' END || '</label></fieldset>"
    "<section class=\"product-detail-description-text\"><script>var a=1;</script><div class=\"small mt-4\">Hinweis <div>innen</div></div>Aus <b>' || noun || '</b>&nbsp;&nbsp;<section>nachhaltig</section>, MwSt 8,1 &#37; &ndash; &#xE4;</section>"
    "<table><tr><td>Stückzahl:</td><td>' || piece || '</td></tr><tr><td>Material</td><td>' || CASE WHEN v % 5 = 0 THEN 'Holz' ELSE '' END || '</td></tr>"
    "<tr><th>EAN</th><td>76 ' || lpad(cast(k AS string), 9, '0') || '</td></tr><tr><td>Land</td><td>Schweiz</td></tr></table>"
    "<a href=\"/docs/' || cast(k AS string) || '.PDF\">Blatt</a></div></body></html>'"
)
ARTICLE_HTML = (
    "'<html><body><div class=\"opc-breadcrumb\"><ul class=\"breadcrumb-navigation\"><li>Home</li><li>' || kind || '</li><li>' || brand || '</li><li>x</li></ul></div>"
    "<h1>' || noun || ' ' || CASE cast(v % 4 AS int) WHEN 0 THEN '6 x 500 g' WHEN 1 THEN '1,50 kg' WHEN 2 THEN 'Stück' ELSE 'lose' END || '</h1>"
    "<div class=\"article-image\"><img alt=\"a\" src=\"../bild/' || cast(k AS string) || '.png\"></div>"
    "<dl class=\"article-spec-infos\"><dt>Artikelnummer:</dt><dd>' || cast(k AS string) || '</dd><dt>Herkunft</dt><dd>Schweiz</dd>"
    "<dt>Label</dt><dd>Bio, Fair</dd>' || CASE WHEN v % 3 = 0 THEN '<dt>Link</dt><dd>none</dd>' ELSE '<dt>Link</dt><dd><a href=//maker.example.org/a/' || cast(k AS string) || '>x</a></dd>' END || '</dl><div class=\"progressbar-wrapper\" data-amount=\"1''' || lpad(cast(v % 1000 AS string), 3, '0') || '\"></div>"
    "<div class=\"toolbar-amount\">Artikel 1-30 von 2''' || lpad(cast(k % 1000 AS string), 3, '0') || '</div><li class=\"page-item page-last\"><input name=\"p\" value=\"' || cast(v % 9 + 1 AS string) || '\"></li>"
    "<div data-listing=\"true\" data-x=\"{&quot;dataUrl&quot;:&quot;/widgets/' || cast(k AS string) || '&quot;}\"></div><div class=\"card product-box\"></div><div class=\"card product-box\"></div></body></html>'"
)
EXTERNAL_HTML = (
    "'<html><head><title>Hersteller ' || brand || '</title><meta ' || CASE WHEN v % 2 = 0 THEN 'name=\"description\"' ELSE 'property=\"og:description\"' END || ' content=\"Text &amp; Bild ' || cast(k AS string) || '\">"
    "<meta property=\"og:image\" content=\"/i/' || cast(k AS string) || '.jpg\"></head><body><a href=\"/pdf/' || cast(k AS string) || '.pdf\">PDF</a></body></html>'"
)
WINE_HTML = (
    "'<html><head><meta name=\"description\" content=\"Wein\"><meta property=\"og:image\" content=\"/w/' || cast(k AS string) || '.jpg\"></head><body>"
    "<ul class=\"breadcrumbs\"><li>Shop</li><li>' || kind || '</li></ul><h1>' || noun || '</h1><span class=\"producer__name\">' || brand || '</span>"
    "<form data-product-sku=\"W' || cast(k AS string) || '\"></form><span data-price-type=\"finalPrice\" data-price-amount=\"' || cast(whole AS string) || '.' || frac || '\"></span>"
    "<a data-simple-product-id=\"1\">Magnum</a><a data-simple-product-id=\"2\">' || CASE WHEN v % 2 = 0 THEN '75,0 cl' ELSE '1.5 l' END || '</a>"
    "<div class=\"product-detail__attributes\"><ul><li><div class=\"overlay-flag\"><span>Trauben</span></div><span class=\"content\">Merlot</span><span class=\"content\">Syrah</span></li>"
    "<li><div class=\"overlay-flag\"><span>Herkunft</span></div><svg><path/></svg> Toskana | Italien</li><li><div class=\"overlay-flag\"><span>Typ</span></div><span class=\"content\">Rot</span></li></ul></div>"
    "<div class=\"further-info__item\"><b class=\"further-info__title\">Leer</b></div>"
    "<div class=\"further-info__item\"><b class=\"further-info__title\">Ausbau</b><i class=\"further-info__content\">' || cast(size AS string) || ' Monate</i></div></body></html>'"
)
FOOD_HTML = (
    "'<nav class=\"breadcrumb\"><span class=\"breadcrumb-title\">Shop</span><span class=\"breadcrumb-title\">' || kind || ' &amp; mehr</span></nav><h1>' || noun || '</h1>"
    "<ul class=\"product-additional-info-list\"><li>' || cast(size AS string) || '.000 kg/l</li><li>1 / Flasche</li></ul><b class=\"product-additional-info__origin\">Japan</b>"
    "<span class=\"product-box-articlenumber\">' || CASE WHEN v % 3 = 0 THEN '' ELSE 'Art-Nr. ' || cast(k AS string) END || '</span>"
    "<div class=\"product-detail-description-text\">Sauce ' || brand || '</div><table><tr><td>Allergene A</td><td>Soja</td></tr></table>"
    "<img class=\"gallery-slider-image\" data-full-image=\"/m/' || cast(k AS string) || '.jpg\">'"
)
EMBEDDED_HTML = (
    "'<html><body><span class=\"breadcrumb__item\">Zurück</span>' || CASE WHEN v % 2 = 0 THEN '<span class=\"breadcrumb__item\">Katalog</span><span class=\"breadcrumb__item\">' || kind || '</span><span class=\"breadcrumb__item\">' || noun || '</span>' ELSE '' END || "
    "'<script data-store=\"react-components\">not json</script><script data-store=\"react-components\">{\"a\": {\"constructor_type\": \"react_components/catalog_menu$default\", \"props\": {\"catalog\": {\"children\": ["
    "{\"name\": \"' || kind || '\", \"children\": [{\"catid\": \"' || cast(k AS string) || '\", \"name\": \" ' || brand || ' \", \"link\": \"/c/' || cast(k AS string) || '\"}, {\"catid\": \"t\", \"name\": \"t\", \"link\": \"/t\", \"tag_name\": \"x\"}]},"
    "{\"name\": \"n\", \"tag_name\": \"x\", \"children\": []}]}}}, \"b\": {\"constructor_type\": \"react_components/detail/detail-intro$default\", \"props\": {\"product\": {\"shorttext\": \"' || noun || '\", \"extartnr\": \"' || cast(k AS string) || '\", "
    "\"currentdeliverysizetext\": \"' || CASE cast(v % 4 AS int) WHEN 0 THEN 'Karton à 6 Stk (3,5 kg)' WHEN 1 THEN 'Beutel à 2,50 kg' WHEN 2 THEN 'Kiste' ELSE 'Sack à 1 Bund' END || '\", \"traces\": \"&lt;b&gt;Soja&lt;/b&gt; ' || cast(v % 5 AS string) || '\", \"nutritional_value_salt\": 0.5, \"minimum_delivery_date\": \"\", \"mwst\": 2.60, \"description\": \"<p>Gut &amp;amp; frisch</p>\", "
    "\"status\": ' || cast(v % 2 AS string) || ', \"diet\": \"vegan, bio,vegan\", \"origin\": \"<b>CH</b>\", \"maingroup\": \"' || kind || '\", \"catalog_level_2\": \"' || brand || '\", \"catalog_level_3\": \"' || kind || '\", "
    "\"barcodes\": [{\"barcode\": \"12\"}, {\"barcode\": \"76-' || lpad(cast(k AS string), 9, '0') || '\"}, {\"barcode\": \"99' || lpad(cast(k AS string), 9, '0') || '\", \"quantity_as\": ' || cast(v % 2 AS string) || '}], "
    "\"labels\": [{\"desc\": \"\", \"name\": \"Fair\"}], \"product_data_sheet\": \"/s/' || cast(k AS string) || '.pdf\", "
    "' || CASE cast(v % 3 AS int) WHEN 0 THEN '\"current_delivery_size\": {\"regular_price\": ' || cast(whole AS string) || frac || '}' WHEN 1 THEN '\"current_delivery_size\": {\"regular_price\": 0}, \"sv_standardprice\": ' || cast(whole AS string) || frac ELSE '\"extfields\": {\"uinfo\": {\"u\": [{\"specialprice\": 0, \"baseprice\": ' || cast(whole AS string) || '.' || frac || '}]}}' END || "
    "'}}}}</script></body></html>'"
)
# Listing pages of twenty elements; ids repeat on a later page with another price.
LISTING_ELEMENT = (
    "'{\"id\": \"t' || cast(k - k % 2 AS string) || '\", \"productNumber\": \"N' || cast(k AS string) || '\", \"name\": \"' || noun || '\", \"translated\": {\"name\": \"' || CASE WHEN v % 2 = 0 THEN noun || ' (dt)' ELSE '' END || '\", \"packUnit\": \"' || "
    "CASE cast(v % 3 AS int) WHEN 0 THEN '100 g Beutel / 2 kg' WHEN 1 THEN '12 Stk à 5 g' ELSE '' END || '\"}, \"active\": true, \"available\": ' || CASE WHEN v % 4 = 0 THEN 'false' ELSE 'true' END || ', \"calculatedPrice\": {\"unitPrice\": ' || cast(whole AS string) || '.' || frac || '}, "
    "\"tax\": {\"taxRate\": 2.6}, \"weight\": ' || CASE WHEN v % 5 = 0 THEN '0' ELSE '0.25' END || ', \"cover\": {\"media\": {\"url\": \"https://img.example.com/t' || cast(k AS string) || '\"}}, \"categories\": [{\"breadcrumb\": [\"Root\", \"' || kind || '\", \"' || brand || '\"]}], "
    "\"properties\": [{\"name\": \"Bio\"}, {\"name\": \"x\", \"translated\": {\"name\": \"Bio\"}}, {\"name\": \"Fair\"}], \"stock\": ' || cast(v % 50 AS string) || ', \"customFields\": {\"steep\": \"' || CASE WHEN v % 4 = 0 THEN ' ' ELSE cast(v % 9 AS string) || ' min' END || '\", \"nested\": {\"a\": 1}}, "
    "\"extensions\": {\"teaProductExtension\": {\"googleLink\": \"Japan / ' || brand || '\", \"harvest\": ' || cast(v % 4 + 2020 AS string) || ', \"garden\": \"' || CASE WHEN v % 2 = 0 THEN '' ELSE '  Hill  ' || noun END || '\", \"apiAlias\": \"x\", \"translated\": {\"a\": \"b\"}}}}'"
)

# Crawl, job and log inputs.
_VALUE = "cast(replace(replace(props, '{\"k\": ', ''), '}', '') AS bigint)"
LISTING_COLUMNS = {
    "supplier_slug": "CASE WHEN l_suppkey % 3 = 0 THEN 'hub' ELSE 'shop' || cast(l_suppkey % 7 AS string) END",
    "category": "'/de/' || l_returnflag || l_linestatus || '/'",
    "page_index": "cast(floor(l_orderkey / 50) AS bigint) + 1",
    "url": "'https://shop.example.com/de/' || l_returnflag || '/' || CASE WHEN l_partkey % 10 = 0 THEN 'p' || cast(l_partkey AS string) ELSE 'artikel-' || cast(l_partkey AS string) || '.html' END",
}
FETCH_COLUMNS = {
    "ord": "event_id", "url": "'https://shop.example.com/p/' || cast(user_id AS string)",
    "status_code": "CASE WHEN event_type = 'error' THEN 500 ELSE 200 END",
    "kind": "'html'", "snapshot_path": "'s' || cast(event_id AS string)",
}
JOB_COLUMNS = {
    "id": "event_id", "supplier_slug": "'supplier' || cast(user_id AS string)",
    "job_type": "CASE event_type WHEN 'click' THEN 'scrape' WHEN 'view' THEN 'sync' ELSE 'scrape_and_sync' END",
    "status": "CASE cast(event_id % 9 AS int) WHEN 0 THEN 'running' WHEN 1 THEN 'queued' WHEN 2 THEN 'failed' WHEN 3 THEN 'stopped' ELSE 'succeeded' END",
    "requested_by": "CASE WHEN event_id % 3 = 0 THEN 'panel' ELSE 'scheduler' END",
    "error_message": "CASE WHEN event_id % 5 = 0 THEN 'boom ' || cast(k AS string) ELSE '' END",
    "stop_requested_at": "CASE WHEN event_id % 4 = 0 THEN '2024-01-01T00:00:00+00:00' ELSE '' END",
    "exit_code": "CASE WHEN event_id % 8 = 0 THEN 3 ELSE NULL END",
    "sync_error": "CASE WHEN event_id % 11 = 0 THEN 'api ' || cast(k AS string) ELSE '' END",
    "failure_count": "k % 30", "raw_record_count": "k * 3",
    "minimum_failures": "CASE WHEN event_id % 6 = 0 THEN 4 ELSE 0 END",
    "failure_rate_percent": "CASE WHEN event_id % 6 = 1 THEN 12.5 ELSE 0.0 END",
}
LOG_COLUMNS = {
    "job_id": "user_id", "ord": "event_id",
    "line": (
        "CASE event_type WHEN 'view' THEN '2024 INFO PROGRESS phase=p' || cast(k % 3 AS string) || ' found=' || cast(k AS string) || CASE WHEN event_id % 2 = 0 THEN ' processed=' || cast(k * 2 AS string) || ' total=500 found=' || cast(k + 1 AS string) ELSE ' scraped=' || cast(k * 3 AS string) END "
        "WHEN 'click' THEN 'Parsed product ' || cast(k AS string) WHEN 'error' THEN CASE WHEN k % 3 = 0 THEN 'ERROR fetch ' || cast(k % 12 AS string) || '  ' WHEN k % 3 = 1 THEN 'Traceback (most recent call last):' ELSE 'request failed ' || cast(k AS string) END "
        "WHEN 'signup' THEN 'RESULT_RUN_SUMMARY ' || CASE WHEN k % 4 = 0 THEN '{broken}' ELSE '{\"product_count\":' || cast(k AS string) || '}' END ELSE '   ' END"
    ),
}
CONFIG_COLUMNS = {
    "supplier_slug": "'supplier' || cast(s_suppkey AS string)", "enabled": "s_suppkey % 2 = 0",
    "scraper_adapter": "CASE WHEN s_suppkey % 5 = 0 THEN 'generic' ELSE 'shop' END",
    "archived": "s_suppkey % 10 = 9", "base_url": "'https://' || lower(replace(s_name, '#', '-')) || '.example.com'",
    "catalog_update_policy": "CASE WHEN s_suppkey % 4 = 0 THEN ' Keep_Existing ' ELSE 'delete_missing' END",
}
_EVENT_SOURCE = "(SELECT *, " + _VALUE + " AS k FROM @events) ev"


def _events(columns: dict[str, str]) -> str:
    return f"SELECT {_projection(columns)} FROM {_EVENT_SOURCE}"


DERIVED = {
    "lines": _LINES.format(keys="k + 2 AS row_number", source=_PART_SOURCE),
    "offer_lines": _LINES.format(keys=", ".join(OFFER_KEYS), source=_OFFER_SOURCE),
    "feed": f"SELECT row_number, {', '.join(_feed_columns('{q}'))} FROM @lines",
    "products": f"SELECT {_projection(PRODUCT_COLUMNS)} FROM @lines",
    "items": f"SELECT row_number, {_SLUG} AS supplier_slug, {_projection(_ITEM_ALL, '{q}')} FROM @lines",
    "remote": _REMOTE,
    "listing": f"SELECT {_projection(LISTING_COLUMNS)} FROM @lineitem",
    "fetches": _events(FETCH_COLUMNS),
    "jobs": _events(JOB_COLUMNS),
    "log_lines": _events(LOG_COLUMNS),
    "configs": f"SELECT {_projection(CONFIG_COLUMNS)} FROM @supplier",
    "page_lines": f"SELECT {_projection(PAGE_COLUMNS)} FROM @lines",
    "shop_pages": f"SELECT *, {SHOP_HTML} AS html FROM @page_lines",
    "article_pages": f"SELECT *, {ARTICLE_HTML} AS html FROM @page_lines",
    "external_pages": f"SELECT 'https://maker.example.org/a/' || cast(k AS string) AS url, {EXTERNAL_HTML} AS html FROM @page_lines WHERE v % 3 = 1",
    "wine_pages": f"SELECT *, {WINE_HTML} AS html FROM @page_lines",
    "food_pages": f"SELECT *, {FOOD_HTML} AS html FROM @page_lines",
    "embedded_pages": f"SELECT *, {EMBEDDED_HTML} AS html FROM @page_lines",
    "listing_elements": f"SELECT *, {LISTING_ELEMENT} AS element FROM @page_lines",
    "offer_feed": (
        f"SELECT 1 + row_number() OVER (ORDER BY {', '.join(OFFER_KEYS)}) AS row_number, "
        f"{', '.join(_feed_columns('{q}'))} FROM @offer_lines"
    ),
}


# Inputs of jobs with expensive per-row rules.
HEAVY = {"feed", "products", "items", "remote", "listing", "shop_pages", "article_pages", "wine_pages", "food_pages", "embedded_pages"}


def sql_text(name: str, resolve, quote: str) -> str:
    """SQL of a derived view with every @reference resolved."""
    body = DERIVED[name].replace("{q}", quote)

    def replace(match: re.Match) -> str:
        ref = match.group(1)
        return f"({sql_text(ref, resolve, quote)}) {ref}" if ref in DERIVED else resolve(ref)

    return re.sub(r"@(\w+)", replace, body)


def duck(name: str) -> str:
    """The view as a parenthesised DuckDB subquery."""
    return f"({sql_text(name, lambda t: t, chr(34))})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The view as a Spark DataFrame over the parquet tables."""
    source = spread_table if name in HEAVY else lambda _, folder, t: f"parquet.`{folder}/{t}.parquet`"
    return spark.sql(sql_text(name, lambda t: f"{source(spark, sf_dir, t)} {t}", "`"))


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Name of a base table's rows dealt to every core, before anything is derived from them.

    A file may be one row group, which one task reads whole, in whatever splits it is planned; so
    splits are not looked at.  A table of at least as many files as cores is left alone.
    """
    rows = table(spark, sf_dir, name)
    cores = spark.sparkContext.defaultParallelism
    if len(rows.inputFiles()) < cores:
        rows = rows.repartition(max(cores, rows.rdd.getNumPartitions()))
    called = f"spread_{name}_{zlib.crc32(sf_dir.encode()):08x}"
    rows.createOrReplaceTempView(called)
    return called


def offer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large feed: one row per order line, numbered in key order across all tasks."""
    lines = view(spark, sf_dir, "offer_lines")
    numbered = with_sequence(lines, [F.col(c) for c in OFFER_KEYS], "row_number", start=2)
    return numbered.selectExpr("row_number", *_feed_columns("`"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product records with their maps and arrays in place."""
    df = view(spark, sf_dir, "products")
    specs = F.map_filter(
        F.create_map(F.lit("Anzahl"), F.col("spec_anzahl"), F.lit("Inhalt"), F.col("spec_inhalt")), lambda k, v: v != ""
    )
    options = F.when(F.col("opt_colour") == "", F.create_map().cast("map<string,string>")).otherwise(
        F.create_map(F.lit("Farbe"), F.col("opt_colour"), F.lit("Art"), F.col("opt_colour"))
    )
    df = df.withColumns({
        "variant_options": options, "specs": specs, "labels": F.filter(F.split("labels_text", ","), lambda x: x != ""),
    }).drop("opt_colour", "spec_anzahl", "spec_inhalt", "labels_text")
    missing = {c: F.lit(d) for c, d in PRODUCT_TEXT_DEFAULTS.items() if c not in df.columns}
    return df.withColumns(missing)


def remote_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remote catalogue as nested products."""
    r = view(spark, sf_dir, "remote")
    bundle = F.when(F.col("bsize").isNotNull(), F.array(F.struct(
        F.concat("id", F.lit("__bundle")).alias("id"), F.col("btype").alias("type"), F.col("bsize").cast("bigint").alias("size"))))
    vessel = F.when(F.col("vsize").isNotNull(), F.struct(
        F.concat("id", F.lit("__vessel")).alias("id"), (F.col("vsize") / 1000).alias("size"),
        F.col("vunit").alias("unit"), F.col("vtype").alias("type")))
    split = lambda c: F.filter(F.split(c, ","), lambda x: x != "")
    blank = F.lit("")
    properties = F.struct(
        blank.alias("manufacturer"), "brand", blank.alias("region"), "description", blank.alias("ingredients"),
        split("allergens").alias("allergens"), blank.alias("color"), blank.alias("storage_advice"),
        split("labels").alias("labels"), "country")
    return r.select(
        "id", "status", category_id(F.col("cat"), F.col("slug")).alias("category"), "name", "order_by",
        vessel.alias("vessel"), bundle.alias("bundles"), F.col("price").cast("bigint").alias("price"),
        F.lit("vessel").alias("price_per"), F.col("moq").cast("double").alias("min_order_count"), "gtin",
        properties.alias("custom_properties"), F.struct(F.col("image").alias("url")).alias("image"),
    )


def remote_categories(spark: SparkSession, sf_dir: str, names: DataFrame) -> DataFrame:
    """Remote category list: every third by id (some renamed), every third by name only."""
    n = F.pmod(F.conv(F.substring(F.sha1("path"), 1, 4), 16, 10).cast("int"), F.lit(6))
    return names.withColumn("n", n).filter("n < 4").select(
        F.when(F.col("n") < 2, F.col("id")).otherwise(F.concat(F.lit("ext-"), F.sha1("id"))).alias("id"),
        F.when(F.col("n") == 1, F.concat("name", F.lit(" alt"))).when(F.col("n") >= 2, F.upper("name"))
        .otherwise(F.col("name")).alias("name"),
        F.sha1("id").alias("ordinal"),
    )


def events(spark: SparkSession, sf_dir: str, columns: dict[str, str]) -> DataFrame:
    """The events table with derived columns."""
    return table(spark, sf_dir, "events").selectExpr("*", f"{_VALUE} AS k").selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])
