"""Product records -> import rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.functions.text import first_non_empty, text
from shelfspark.schema import IMPORT_COLUMNS

# Import column -> product field.
_FIELDS = {
    "Item name": "item_name", "Vessel size": "vessel_size", "Vessel unit": "vessel_unit", "Vessel type": "vessel_type",
    "Bundle size": "bundle_size", "Bundle GTIN": "bundle_gtin", "Price": "price", "Status": "status",
    "Image": "image_url", "GTIN": "gtin", "Description": "description", "Manufacturer": "manufacturer",
    "Brand": "brand", "Region": "region", "Country": "country", "Color": "color", "Material": "material",
    "Length": "length", "Width": "width", "Height": "height", "Diameter": "diameter", "Net weight": "net_weight",
    "Total weight": "total_weight", "VAT": "vat", "Product Sheet": "product_sheet_url",
}
_DEFAULTED = {
    "Category name": ("category_path", "Uncategorized"), "Order by": ("order_by", "vessel"),
    "Price per": ("price_per", "vessel"), "Minimum order count": ("min_order_count", "1"),
}


def to_import_rows(products: DataFrame, item_id: str = "item_id", keep: list[str] | None = None) -> DataFrame:
    """The 46 import columns in file order, after any columns to `keep`."""
    columns = {name: text(F.col(field)) for name, field in _FIELDS.items()}
    columns |= {name: first_non_empty(F.col(field), F.lit(value)) for name, (field, value) in _DEFAULTED.items()}
    columns["Item ID"] = F.col(item_id)
    columns["Bundle type"] = F.when(text(F.col("bundle_size")) == "", "").otherwise(text(F.col("bundle_type")))
    columns["Labels"] = F.array_join("labels", ",")
    return products.select(*(keep or []), *[columns.get(c, F.lit("")).alias(c) for c in IMPORT_COLUMNS])
