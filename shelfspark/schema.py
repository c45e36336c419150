"""Record layouts shared by every job.

All business fields are text and an empty string means "missing"; jobs add typed
helper columns internally and return to text at the edges.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The import file has exactly these columns in exactly this order.
# ---------------------------------------------------------------------------
IMPORT_COLUMNS = [
    "Category name", "Category ID", "Item ID", "Item name", "Order by",
    "Vessel size", "Vessel unit", "Vessel type", "Bundle size", "Bundle type",
    "Bundle GTIN", "Price", "Price per", "Minimum order count", "Status",
    "Image", "GTIN", "Labels", "Description", "Manufacturer", "Brand", "Region",
    "Country", "Vintage", "Ingredients", "Allergens", "Storage advice",
    "Nutritional values", "Dietary labels", "Alcohol content", "Color",
    "Grape variety", "Wine-making", "Material", "Fishing method", "Length",
    "Width", "Height", "Diameter", "Net weight", "Total weight", "VAT",
    "Product Sheet", "Name FR", "Name IT", "Name EN",
]

# Correction report and packaging audit file layouts.
CORRECTION_COLUMNS = [
    "row_number", "item_id_before", "item_id_after", "field",
    "value_before", "value_after", "reason",
]
PACKAGING_AUDIT_COLUMNS = [
    "Item ID", "Item name",
    "Old vessel size", "Old vessel unit", "Old vessel type",
    "Old bundle size", "Old bundle type", "Old price",
    "New vessel size", "New vessel unit", "New vessel type",
    "New bundle size", "New bundle type", "New price",
    "Interpretation mode", "Evidence text", "Parser source used",
]

# Product record: text fields, with their defaults, in file order.  The three
# fields holding collections are listed separately below.
PRODUCT_TEXT_DEFAULTS = {
    "product_url": "", "canonical_url": "", "category_path": "", "product_name": "",
    "item_name": "", "sku": "", "variant_name": "", "gtin": "", "bundle_gtin": "",
    "price": "", "currency": "", "vat": "", "price_per": "vessel",
    "order_by": "vessel", "min_order_count": "1", "status": "ACTIVE",
    "image_url": "", "product_sheet_url": "", "description": "",
    "manufacturer": "", "brand": "", "region": "", "country": "",
    "vessel_size": "", "vessel_unit": "", "vessel_type": "", "bundle_size": "",
    "bundle_type": "", "raw_bundle_text": "", "raw_detail_price_unit_text": "",
    "raw_spec_piece_text": "", "raw_fill_text": "", "packaging_mode": "",
    "packaging_evidence": "", "packaging_source": "", "color": "", "material": "",
    "length": "", "width": "", "height": "", "diameter": "", "net_weight": "",
    "total_weight": "", "raw_availability_text": "",
}
PRODUCT_MAPS = ["variant_options", "specs"]
PRODUCT_ARRAYS = ["labels"]

TEXT_MAP = T.MapType(T.StringType(), T.StringType())
TEXT_ARRAY = T.ArrayType(T.StringType())


def import_row_schema() -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in IMPORT_COLUMNS])


def product_schema() -> T.StructType:
    fields = [T.StructField(c, T.StringType()) for c in PRODUCT_TEXT_DEFAULTS]
    fields += [T.StructField(c, TEXT_MAP) for c in PRODUCT_MAPS]
    fields += [T.StructField(c, TEXT_ARRAY) for c in PRODUCT_ARRAYS]
    return T.StructType(fields)


VESSEL_STRUCT = "struct<id:string,size:double,unit:string,type:string>"
BUNDLE_STRUCT = "struct<id:string,type:string,size:bigint>"
PROPERTIES_STRUCT = (
    "struct<manufacturer:string,brand:string,region:string,description:string,"
    "ingredients:string,allergens:array<string>,color:string,storage_advice:string,"
    "labels:array<string>,country:string>"
)
# Remote catalogue product, also the shape of a local change payload.
REMOTE_PRODUCT_STRUCT = (
    "struct<id:string,status:string,category:string,name:string,order_by:string,"
    f"vessel:{VESSEL_STRUCT},bundles:array<{BUNDLE_STRUCT}>,price:bigint,price_per:string,"
    f"min_order_count:double,gtin:string,custom_properties:{PROPERTIES_STRUCT},"
    "image:struct<url:string>>"
)
REMOTE_PAGE_SCHEMA = f"products array<{REMOTE_PRODUCT_STRUCT}>, cursor string"
REMOTE_CATEGORY_SCHEMA = "id string, name string"

FAILURE_SCHEMA = "stage string, url string, reason string"
PAGE_BUNDLE_SCHEMA = "snapshot_name string, html string"
MANIFEST_SCHEMA = (
    "fetched_at timestamp, kind string, status_code int, snapshot_path string, "
    "url string, final_url string"
)
LOG_EVENT_SCHEMA = "job_id string, timestamp timestamp, sequence bigint, message string"
SUPPLIER_CONFIG_STRUCT = (
    "struct<supplier_slug:string,enabled:boolean,scraper_adapter:string,base_url:string,"
    "output_dir:string,catalog_update_policy:string,schedule:map<string,string>,"
    "scrape_settings:map<string,string>,archived:boolean,alert_settings:map<string,string>>"
)

# What later runs need to know of a good run.
STATE_SCHEMA = (
    "supplier_slug string, generated_at string, checksum string, product_count bigint, created_products bigint, "
    "updated_products bigint, unchanged_products bigint, inactivated_products bigint, export_folder string"
)
