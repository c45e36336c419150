"""Registered queries of the extraction jobs.

Pages rendered from the catalogue lines must give back the values they were rendered from;
the `pages` table is read with the same rules in both engines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfspark.functions import html as H
from shelfspark.functions import urls
from shelfspark.operators import extract
from shelfspark.plans.derived import duck, table, view


def _shop(spark, sf):
    return extract.extract_products(view(spark, sf, "shop_pages"), "shop")[0]


def _payload(spark, sf):
    return extract.payload_page(view(spark, sf, "embedded_pages"))


def _enriched(spark, sf):
    joined = extract.enrich_external(extract.with_manufacturer_link(view(spark, sf, "article_pages")), view(spark, sf, "external_pages"))
    return extract.article_page(joined)


def _page_text(spark, sf):
    body = H.body_text(F.col("html"), "h1", "table", "script", "style", "head")
    return table(spark, sf, "pages").select("page_id", body.alias("body_text"))


def _page_titles(spark, sf):
    h = F.col("html")
    title = F.coalesce(F.nullif(H.tag_text(h, "h1"), F.lit("")), H.tag_text(h, "title"))
    return table(spark, sf, "pages").select("page_id", title.alias("title"))


def _listing(spark, sf):
    elements = view(spark, sf, "listing_elements").select((F.floor(F.col("k") / 20)).cast("bigint").alias("page_index"), "k", "element")
    pages = elements.groupBy("page_index").agg(F.array_sort(F.collect_list(F.struct("k", "element"))).alias("e")).select(
        "page_index", F.concat(F.lit('{"total": 1, "elements": ['), F.array_join(F.transform("e", lambda x: x["element"]), ","), F.lit("]}")).alias("json"))
    out = extract.listing_products(pages, "https://tea.example.com/", "Root", "Teahouse", "Tee")
    return out.select("product_url", "sku", "product_name", "price", "vat", "status", "category_path", "image_url", "vessel_size",
                      "vessel_unit", "vessel_type", "country", "region", F.array_join("labels", "|").alias("labels"),
                      *[F.col("specs")[name].alias(name) for name in ("stock", "tea_harvest", "tea_garden", "tea_googleLink", "custom_steep")],
                      F.array_join(F.array_sort(F.map_keys("specs")), "|").alias("spec_names"))


def _diagnostics(spark, sf):
    pages = view(spark, sf, "article_pages")
    return extract.listing_totals(pages).join(extract.listing_diagnostics(pages), "url")


def _wine(spark, sf):
    return extract.wine_page(view(spark, sf, "wine_pages")).select(
        "sku", "category_path", "product_name", "price", "image_url", "description", "manufacturer", "region", "country",
        "vessel_size", "vessel_unit", F.array_join("labels", "|").alias("labels"), F.col("specs")["ausbau"].alias("ausbau"))


def _food(spark, sf):
    return extract.food_page(view(spark, sf, "food_pages")).select(
        "product_url", "sku", "category_path", "image_url", "description", "country", "vessel_size", "vessel_unit", "vessel_type",
        F.col("specs")["allergene_a"].alias("allergens"))


QUERIES = {
    "page_titles": _page_titles,
    "page_text": _page_text,
    "page_links": lambda spark, sf: extract.page_links(table(spark, sf, "pages")),
    "page_meta": lambda spark, sf: _shop(spark, sf).select("sku", "canonical_url", "image_url", "product_sheet_url", "price", "currency"),
    "page_specs": lambda spark, sf: _shop(spark, sf).select("sku", F.explode("specs").alias("spec_key", "spec_value")),
    "category_path": lambda spark, sf: _shop(spark, sf).select("sku", "category_path"),
    "item_name": lambda spark, sf: _shop(spark, sf).select("sku", "product_name", "item_name", "variant_name"),
    "dimensions": lambda spark, sf: _shop(spark, sf).select("sku", "length", "width", "height", "diameter", "vessel_size", "vessel_unit", "bundle_size", "bundle_type"),
    "keyword_infer": lambda spark, sf: _shop(spark, sf).select("sku", "color", "material", "vessel_type", "status", F.array_join("labels", "|").alias("labels")),
    "gtin_pick": lambda spark, sf: _shop(spark, sf).select("sku", "gtin", "vat"),
    "extract_pages": lambda spark, sf: _shop(spark, sf).select("sku", "description", "raw_availability_text", "country", "raw_spec_piece_text", "raw_detail_price_unit_text"),
    "extract_failures": lambda spark, sf: extract.extract_products(view(spark, sf, "shop_pages"), "shop")[1],
    "listing_totals": _diagnostics,
    "title_packaging": lambda spark, sf: extract.article_page(view(spark, sf, "article_pages").drop("external_url")).select(
        "sku", "product_name", "category_path", "vessel_size", "vessel_unit", "vessel_type", "image_url", F.array_join("labels", "|").alias("labels")),
    "external_enrich": lambda spark, sf: _enriched(spark, sf).select("sku", "manufacturer", "description", "product_sheet_url"),
    "wine_pages": _wine,
    "food_pages": _food,
    "embedded_payload": lambda spark, sf: _payload(spark, sf).select("sku", "product_name", "category_path", "status", "vat", "description", "country", "product_sheet_url", "min_order_count",
        F.col("specs")["traces"].alias("traces"), F.col("specs")["nutrition_salt"].alias("salt"), F.col("specs")["minimum_delivery_date"].alias("earliest")),
    "category_tree": lambda spark, sf: extract.category_tree(view(spark, sf, "embedded_pages")),
    "price_fallback": lambda spark, sf: _payload(spark, sf).select("sku", "price"),
    "barcode_pick": lambda spark, sf: _payload(spark, sf).select("sku", "gtin", "bundle_gtin"),
    "labels_union": lambda spark, sf: _payload(spark, sf).select("sku", F.array_join("labels", "|").alias("labels")),
    "delivery_size": lambda spark, sf: _payload(spark, sf).select("sku", "vessel_type", "vessel_size", "vessel_unit", "bundle_size", "bundle_type", "net_weight", "total_weight"),
    "listing_explode": _listing,
}

_SHOP = f"(SELECT *, 'A-' || cast(k AS varchar) AS sku FROM {duck('page_lines')} pl WHERE v % 10 <> 9) s"
_OPT = "CASE WHEN v % 2 = 0 THEN 'rot' ELSE 'blau' END"
_ENT = {"&nbsp;": " ", "&quot;": '"', "&#39;": "''", "&apos;": "''", "&lt;": "<", "&gt;": ">", "&auml;": "ä", "&ouml;": "ö", "&uuml;": "ü",
        "&Auml;": "Ä", "&Ouml;": "Ö", "&Uuml;": "Ü", "&szlig;": "ß", "&eacute;": "é", "&egrave;": "è", "&agrave;": "à", "&copy;": "©", "&middot;": "·", "&amp;": "&"}


def _text(e: str) -> str:
    e = f"regexp_replace({e}, '(?s)<!--.*?-->|<[^>]*>', ' ', 'g')"
    for name, char in _ENT.items():
        e = f"replace({e}, '{name}', '{char}')"
    return rf"trim(regexp_replace({e}, '[\s\x{{a0}}]+', ' ', 'g'))"


def _drop(e: str) -> str:
    for tag in ("h1", "table", "script", "style", "head"):
        e = rf"regexp_replace({e}, '(?is)<{tag}\b[^>]*>.*?</{tag}\s*>', ' ', 'g')"
    return e


def _money(e_whole: str = "whole", e_frac: str = "frac") -> str:
    return rf"regexp_replace(regexp_replace(cast({e_whole} AS varchar) || '.' || {e_frac}, '0+$', ''), '\.$', '')"


_ORIGIN = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"
_PC = duck("page_lines") + " pl"
_BARE = "'https://shop.example.com/de/' || lower(kind) || '/artikel-' || cast(k AS varchar) || '.html'"
_COLOUR = " ".join(f"WHEN contains(lower(title), '{w}') THEN '{c}'" for w, c in extract.COLOURS)
_MATERIAL = " ".join(f"WHEN contains(lower(title), '{m.lower()}') THEN '{m}'" for m in extract.MATERIALS)
ORACLES = {
    "page_titles": rf"SELECT page_id, coalesce(nullif({_text('regexp_extract(html, ' + chr(39) + r'(?is)<h1\b[^>]*>(.*?)</h1\s*>' + chr(39) + ', 1)')}, ''), {_text('regexp_extract(html, ' + chr(39) + r'(?is)<title\b[^>]*>(.*?)</title\s*>' + chr(39) + ', 1)')}) AS title FROM pages",
    "page_text": f"SELECT page_id, {_text(_drop('html'))} AS body_text FROM pages",
    "page_links": f"""SELECT DISTINCT page_url, CASE WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href ELSE {_ORIGIN} || href END AS url FROM (
  SELECT url, url AS page_url, unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*?\\shref="([^"]*)"', 1)) AS href FROM pages) h WHERE href <> ''""",
    "page_meta": f"SELECT sku, 'https://shop.example.com/p/' || cast(k AS varchar) AS canonical_url, 'https://shop.example.com/media/' || cast(k AS varchar) || '.jpg' AS image_url, 'https://shop.example.com/docs/' || cast(k AS varchar) || '.PDF' AS product_sheet_url, cast(whole AS varchar) || CASE WHEN frac = '0' THEN '' ELSE '.' || frac END AS price, 'CHF' AS currency FROM {_SHOP}",
    "page_specs": f"""SELECT sku, 'Stückzahl' AS spec_key, piece AS spec_value FROM {_SHOP} WHERE piece <> '' UNION ALL SELECT sku, 'Material', 'Holz' FROM {_SHOP} WHERE v % 5 = 0
  UNION ALL SELECT sku, 'EAN', '76 ' || lpad(cast(k AS varchar), 9, '0') FROM {_SHOP} UNION ALL SELECT sku, 'Land', 'Schweiz' FROM {_SHOP}""",
    "category_path": f"SELECT sku, kind || ' > ' || brand || ' & Co' AS category_path FROM {_SHOP}",
    "item_name": f"SELECT sku, title AS product_name, CASE WHEN contains(lower(title), {_OPT}) THEN title ELSE title || ' - ' || {_OPT} END AS item_name, {_OPT} AS variant_name FROM {_SHOP}",
    "keyword_infer": f"""SELECT sku, CASE {_COLOUR} ELSE '' END AS color, CASE WHEN v % 5 = 0 THEN 'Holz' {_MATERIAL} ELSE '' END AS material, 'cup' AS vessel_type,
  CASE WHEN v % 7 = 0 THEN 'OUT_OF_STOCK' WHEN v % 7 = 1 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status, CASE WHEN v % 5 = 0 THEN 'BIO|DISCOUNTED|' ELSE 'BIO|' END || CASE WHEN v % 3 = 0 THEN 'NEW' ELSE 'SEASONAL' END AS labels FROM {_SHOP}""",
    "gtin_pick": f"SELECT sku, '76' || lpad(cast(k AS varchar), 9, '0') AS gtin, '8.1' AS vat FROM {_SHOP}",
    "extract_pages": f"SELECT sku, 'Aus ' || noun || ' nachhaltig , MwSt 8,1 % – ä' AS description, CASE WHEN v % 7 = 0 THEN 'Leider ausverkauft' WHEN v % 7 = 1 THEN 'Produkt eingestellt' ELSE 'Lieferzeit 2 Tage' END AS raw_availability_text, 'Schweiz' AS country, piece AS raw_spec_piece_text, detail AS raw_detail_price_unit_text FROM {_SHOP}",
    "extract_failures": f"SELECT 'detail' AS stage, url, 'not-a-product-page' AS reason FROM {_PC} WHERE v % 10 = 9",
    "listing_totals": f"""SELECT url, 1000 + v % 1000 AS advertised_by_attribute, 2000 + k % 1000 AS advertised_by_toolbar, v % 9 + 1 AS page_count, 'true' AS has_listing_widget,
  '/widgets/' || cast(k AS varchar) AS uses_widget_data_url, 'false' AS has_pagination, '2' AS product_card_count FROM {_PC}""",
    "title_packaging": f"""SELECT cast(k AS varchar) AS sku, noun || ' ' || CASE v % 4 WHEN 0 THEN '6 x 500 g' WHEN 1 THEN '1,50 kg' WHEN 2 THEN 'Stück' ELSE 'lose' END AS product_name, kind || ' > ' || brand AS category_path,
  CASE v % 4 WHEN 0 THEN '500' WHEN 1 THEN '1.5' WHEN 2 THEN '1' ELSE '' END AS vessel_size, CASE v % 4 WHEN 0 THEN 'g' WHEN 1 THEN 'kg' WHEN 2 THEN 'st' ELSE '' END AS vessel_unit,
  CASE WHEN v % 4 = 2 THEN 'piece' ELSE '' END AS vessel_type, 'https://shop.example.com/de/bild/' || cast(k AS varchar) || '.png' AS image_url, 'Bio|Fair' AS labels FROM {_PC}""",
    "external_enrich": f"""SELECT cast(k AS varchar) AS sku, CASE WHEN v % 3 = 1 THEN 'Hersteller ' || brand ELSE '' END AS manufacturer, CASE WHEN v % 3 = 1 THEN 'Text & Bild ' || cast(k AS varchar) ELSE '' END AS description,
  CASE WHEN v % 3 = 1 THEN 'https://maker.example.org/pdf/' || cast(k AS varchar) || '.pdf' ELSE '' END AS product_sheet_url FROM {_PC}""",
    "wine_pages": f"""SELECT 'W' || cast(k AS varchar) AS sku, kind AS category_path, noun AS product_name, cast(whole AS varchar) || '.' || frac AS price, 'https://shop.example.com/w/' || cast(k AS varchar) || '.jpg' AS image_url,
  'Ausbau: ' || cast(size AS varchar) || ' Monate' AS description, brand AS manufacturer, 'Toskana' AS region, 'Italien' AS country, CASE WHEN v % 2 = 0 THEN '75' ELSE '1.5' END AS vessel_size,
  CASE WHEN v % 2 = 0 THEN 'cl' ELSE 'l' END AS vessel_unit, 'Rot' AS labels, cast(size AS varchar) || ' Monate' AS ausbau FROM {_PC}""",
    "food_pages": f"""SELECT url AS product_url, CASE WHEN v % 3 = 0 THEN 'artikel-' || cast(k AS varchar) || '.html' ELSE cast(k AS varchar) END AS sku, kind || ' & mehr' AS category_path, 'https://shop.example.com/m/' || cast(k AS varchar) || '.jpg' AS image_url,
  'Sauce ' || brand AS description, 'Japan' AS country, cast(size AS varchar) AS vessel_size, 'kg' AS vessel_unit, 'Flasche' AS vessel_type, 'Soja' AS allergens FROM {_PC}""",
    "embedded_payload": f"""SELECT cast(k AS varchar) AS sku, noun AS product_name, CASE WHEN v % 2 = 0 THEN kind ELSE kind || ' > ' || brand END AS category_path, CASE WHEN v % 2 = 1 THEN 'ACTIVE' ELSE 'INACTIVE' END AS status, '2.6' AS vat,
  'Gut & frisch' AS description, 'CH' AS country, 'https://shop.example.com/s/' || cast(k AS varchar) || '.pdf' AS product_sheet_url, '1' AS min_order_count,
  'Soja ' || cast(v % 5 AS varchar) AS traces, '0.5' AS salt, cast(NULL AS varchar) AS earliest FROM {_PC}""",
    "category_tree": f"SELECT cast(k AS varchar) AS category_id, brand AS category_name, 'https://shop.example.com/c/' || cast(k AS varchar) AS category_url, kind AS parent_category_name FROM {_PC}",
    "price_fallback": f"SELECT cast(k AS varchar) AS sku, {_money()} AS price FROM {_PC}",
    "barcode_pick": f"SELECT cast(k AS varchar) AS sku, '76' || lpad(cast(k AS varchar), 9, '0') AS gtin, CASE WHEN v % 2 = 1 THEN '99' ELSE '76' END || lpad(cast(k AS varchar), 9, '0') AS bundle_gtin FROM {_PC}",
    "labels_union": f"SELECT cast(k AS varchar) AS sku, 'Fair|vegan|bio' AS labels FROM {_PC}",
    "delivery_size": f"""SELECT cast(k AS varchar) AS sku, CASE v % 4 WHEN 0 THEN 'Karton' WHEN 1 THEN 'Beutel' WHEN 2 THEN 'Kiste' ELSE 'Sack' END AS vessel_type, CASE v % 4 WHEN 0 THEN '3.5' WHEN 1 THEN '2.5' ELSE '' END AS vessel_size,
  CASE WHEN v % 4 < 2 THEN 'kg' ELSE '' END AS vessel_unit, CASE WHEN v % 4 = 0 THEN '6' ELSE '' END AS bundle_size, CASE WHEN v % 4 = 0 THEN 'st' ELSE '' END AS bundle_type,
  CASE WHEN v % 4 = 1 THEN '2.5' ELSE '' END AS net_weight, CASE WHEN v % 4 = 0 THEN '3.5' ELSE '' END AS total_weight FROM {_PC}""",
    "listing_explode": f"""SELECT 'https://tea.example.com/shop/detail/t' || cast(k - k % 2 AS varchar) AS product_url, 'N' || cast(k AS varchar) AS sku, noun || CASE WHEN v % 2 = 0 THEN ' (dt)' ELSE '' END AS product_name, {_money()} AS price, '2.6' AS vat,
  CASE WHEN v % 4 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status, kind || ' > ' || brand AS category_path, 'https://img.example.com/t' || cast(k AS varchar) AS image_url,
  CASE v % 3 WHEN 0 THEN '100' WHEN 1 THEN '12' ELSE CASE WHEN v % 5 = 0 THEN '' ELSE '0.25' END END AS vessel_size, CASE v % 3 WHEN 0 THEN 'g' WHEN 1 THEN 'st' ELSE CASE WHEN v % 5 = 0 THEN '' ELSE 'kg' END END AS vessel_unit,
  CASE WHEN v % 3 = 1 THEN 'piece' ELSE '' END AS vessel_type, 'Japan' AS country, 'Japan / ' || brand AS region, 'Bio|Fair' AS labels, cast(v % 50 AS varchar) AS stock,
  cast(v % 4 + 2020 AS varchar) AS tea_harvest, CASE WHEN v % 2 <> 0 THEN 'Hill ' || noun END AS tea_garden, 'Japan / ' || brand AS "tea_googleLink", CASE WHEN v % 4 <> 0 THEN cast(v % 9 AS varchar) || ' min' END AS custom_steep,
  CASE WHEN v % 4 <> 0 THEN 'custom_steep|' ELSE '' END || 'product_id|stock|' || CASE WHEN v % 2 <> 0 THEN 'tea_garden|' ELSE '' END || 'tea_googleLink|tea_harvest' AS spec_names
  FROM (SELECT *, row_number() OVER (PARTITION BY k - k % 2 ORDER BY k DESC) AS rn FROM {_PC}) x WHERE rn = 1""",
    "dimensions": f"""SELECT sku, CASE v % 4 WHEN 1 THEN '120' WHEN 3 THEN '60' ELSE '' END AS length, CASE v % 4 WHEN 1 THEN '80' WHEN 3 THEN '40' ELSE '' END AS width, CASE WHEN v % 4 = 1 THEN '30' ELSE '' END AS height,
  CASE WHEN v % 4 = 2 THEN '90' ELSE '' END AS diameter,
  CASE WHEN hit0 <> '' THEN regexp_replace(replace(regexp_extract(hit0, '^[\\d.,]+'), ',', '.'), '\\.0$', '') WHEN bt <> '' THEN '1' ELSE '' END AS vessel_size,
  CASE WHEN hit0 <> '' THEN CASE lower(regexp_extract(hit0, '[A-Za-z]+$')) WHEN 'liter' THEN 'l' ELSE lower(regexp_extract(hit0, '[A-Za-z]+$')) END WHEN bt <> '' THEN 'quantity' ELSE '' END AS vessel_unit,
  CASE WHEN bs = '1' THEN '' ELSE bs END AS bundle_size, CASE WHEN bs = '1' THEN '' ELSE bb END AS bundle_type FROM (SELECT *, regexp_replace(replace(replace(regexp_extract(hit, '{extract.BUNDLE.replace(chr(39), chr(39) * 2)}', 1, 'i'), chr(39), ''), ',', '.'), '\\.0$', '') AS bs,
    regexp_extract(hit, '{extract.BUNDLE.replace(chr(39), chr(39) * 2)}', 2, 'i') AS bb FROM (SELECT *, CASE WHEN regexp_matches(bt, '{extract.FILL_PER_UNIT.replace(chr(39), chr(39) * 2)}', 'i') THEN '' ELSE bt END AS hit,
    coalesce(nullif(regexp_extract(title, '{extract.MEASURE.replace(chr(39), chr(39) * 2)}', 0, 'i'), ''), regexp_extract(bt, '{extract.MEASURE.replace(chr(39), chr(39) * 2)}', 0, 'i')) AS hit0
    FROM (SELECT *, coalesce(nullif(detail, ''), piece) AS bt FROM {_SHOP}) a) b) c""",
}
