"""Unit and packaging-type vocabularies, as lookups usable inside expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions.text import WHITESPACE, keyword_value, lookup, strip, text

# ---------------------------------------------------------------------------
# Fixed values of the import format: enums, type codes and vocabularies.
# ---------------------------------------------------------------------------
ORDER_BY = ["vessel", "kg"]
VESSEL_UNITS = ["l", "dl", "cl", "ml", "kg", "g", "quantity"]
PRICE_PER = ["vessel", "l", "kg", "100g"]
STATUS = ["ACTIVE", "INACTIVE", "OUT_OF_STOCK"]
LABELS = ["NEW", "BIO", "SEASONAL", "DISCOUNTED"]
VAT_VALUES = ["2.6", "3.8", "7.7", "8.1"]
EMPTY_SENTINELS = ["", "-", "n/a", "null", "none"]
BUNDLE_TYPES = [
    "3A", "6H", "AC", "BA", "BC", "BG", "BH", "BI", "BJ", "BK", "BM", "BO", "BX",
    "CI", "CT", "CU", "CY", "DH", "DN", "DR", "GR", "JR", "KG", "PA", "PC", "PK",
    "PT", "PR", "PU", "RD", "RO", "SA", "TU", "TY", "WA", "NA", "ZZ", "PX",
]
VESSEL_TYPES = [code for code in BUNDLE_TYPES if code != "PX"]

# Word -> packaging type code.
TYPE_SYNONYMS = {
    "bottle": "BO", "flasche": "BO", "bouteille": "BO", "bottiglia": "BO",
    "glass": "GR", "glas": "GR", "verre": "GR", "bicchiere": "GR",
    "jar": "JR", "pot": "JR", "barattolo": "JR",
    "carton": "CT", "karton": "CT", "cartone": "CT", "dispokarton": "CT",
    "box": "BX", "kiste": "BX", "caisse": "BX", "cassa": "BX", "dispenserbox": "BX",
    "pack": "PK", "package": "PK", "paket": "PK", "paquet": "PK", "confezione": "PK",
    "tray": "PU", "plateau": "PU", "vassoio": "PU",
    "pallet": "PX", "palette": "PX",
    "bag": "BG", "beutel": "BG", "sachet": "BG", "sacchetto": "BG",
    "sack": "SA", "sac": "SA", "sacco": "SA",
    "can": "BI", "dose": "BI", "canette": "BI", "lattina": "BI",
    "canister": "CI", "kanister": "CI", "bidon": "CI", "bidone": "CI", "jerrican": "3A",
    "cup": "CU", "becher": "CU", "gobelet": "CU",
    "bucket": "BJ", "eimer": "BJ", "seau": "BJ", "secchio": "BJ",
    "basket": "BK", "korb": "BK", "panier": "BK", "cesto": "BK",
    "barrel": "BA", "fass": "BA", "baril": "BA", "barile": "BA",
    "keg": "KG", "fût": "KG", "fusto": "KG",
    "drum": "DR", "trommel": "DR", "tambour": "DR",
    "roll": "RO", "rolle": "RO", "rouleau": "RO", "rotolo": "RO",
    "tube": "TU", "tubo": "TU",
    "dispenser": "DN", "spender": "DN", "distributeur": "DN", "distributore": "DN",
    "foil": "PR", "folie": "PR", "film": "PR", "pellicola": "PR",
    "pieces": "NA", "piece": "NA", "stück": "NA", "stk": "NA", "pièces": "NA", "pezzi": "NA",
    "single": "ZZ", "singles": "ZZ", "einzeln": "ZZ",
    "bowl": "BM", "schale": "BM", "plate": "PU", "teller": "PU", "container": "WA",
    "lid": "NA", "deckel": "NA", "straw": "NA", "trinkhalm": "NA",
    "napkin": "NA", "serviette": "NA",
}

# Name keywords in priority order.
VESSEL_HINTS = [
    ("kaffeebecher", "CU"), ("suppenbecher", "CU"), ("becher", "CU"), ("gobelet", "CU"),
    ("cup", "CU"), ("schale", "BM"), ("bowl", "BM"), ("teller", "PU"), ("platte", "PU"),
    ("plate", "PU"), ("flasche", "BO"), ("bottle", "BO"), ("glas", "GR"), ("glass", "GR"),
    ("jar", "JR"), ("kanister", "CI"), ("canister", "CI"), ("container", "WA"),
    ("deckel", "NA"), ("lid", "NA"), ("menübox", "BX"), ("menuebox", "BX"), ("box", "BX"),
    ("serviette", "NA"), ("napkin", "NA"), ("trinkhalm", "NA"), ("straw", "NA"),
    ("beutel", "BG"), ("tragetasche", "BG"), ("bag", "BG"),
]

UNIT_SYNONYMS = {
    "liter": "l", "litre": "l", "l": "l", "dl": "dl", "cl": "cl", "ml": "ml",
    "kilogram": "kg", "kilo": "kg", "kg": "kg", "gram": "g", "gramm": "g", "g": "g",
    "pcs": "quantity", "pc": "quantity", "piece": "quantity", "pieces": "quantity",
    "stück": "quantity", "stk": "quantity", "quantity": "quantity",
}

MEASURE_SYNONYMS = {"liter": "l", "litre": "l", "kilo": "kg", "gramm": "g"}
PIECE_SYNONYMS = {"stk": "st", "stück": "st", "stueck": "st"}

# Codes used by change payloads built directly from product records.
PAYLOAD_VESSEL_CODES = {
    "bag": "BG", "bottle": "BO", "bowl": "BM", "can": "BI", "canister": "CI", "box": "BX",
    "container": "WA", "cup": "CU", "cutlery": "NA", "lid": "NA", "napkin": "NA",
    "pack": "PK", "plate": "PU", "roll": "RO", "straw": "NA",
}
PAYLOAD_BUNDLE_CODES = {
    "beutel": "BG", "box": "BX", "karton": "CT", "pack": "PK", "rolle": "RO", "set": "PK",
}
PAYLOAD_LABELS = ["NEW", "BIO", "SEASONAL", "DISCOUNTED", "VEGAN", "VEGETARIAN", "GLUTEN_FREE"]


def drop_sentinel(c: Column, keep_na: bool = False) -> Column:
    """Trim; texts that only mean "nothing" become ''.  'NA' is also a type code."""
    trimmed = strip(text(c))
    sentinels = EMPTY_SENTINELS if keep_na else [*EMPTY_SENTINELS, "na"]
    return F.when(F.lower(trimmed).isin(sentinels), "").otherwise(trimmed)


def drop_sentinel_sql(name: str, keep_na: bool = False) -> str:
    """drop_sentinel of a named column as one SQL expression (cheap to build many times)."""
    trimmed = f"trim(BOTH '{WHITESPACE}' FROM coalesce(`{name}`, ''))"
    sentinels = EMPTY_SENTINELS if keep_na else [*EMPTY_SENTINELS, "na"]
    listed = ", ".join(f"'{word}'" for word in sentinels)
    return f"if(lower({trimmed}) IN ({listed}), '', {trimmed})"


def unit_code(c: Column) -> Column:
    """Import unit of a unit word, '' when unknown."""
    word = F.regexp_replace(F.lower(drop_sentinel(c)), r"\.+$", "")
    return lookup(UNIT_SYNONYMS, word, "")


def measure_unit(c: Column) -> Column:
    word = F.lower(c)
    return F.coalesce(lookup(MEASURE_SYNONYMS, word), word)


def piece_unit(c: Column) -> Column:
    return F.coalesce(lookup(PIECE_SYNONYMS, F.lower(c)), F.lower(c))


_TYPE_TOKEN = (
    r"(?:^|[\s/_,-])("
    + "|".join(sorted(TYPE_SYNONYMS, key=len, reverse=True))
    + r")(?=[\s/_,-]|$)"
)


def type_code(c: Column, allow_pallet: bool) -> Column:
    """A valid code itself, else the code of the first known word in the text."""
    value = drop_sentinel(c, keep_na=True)
    upper = F.upper(value)
    word = F.regexp_extract(F.replace(F.lower(value), F.lit("."), F.lit("")), "(?U)" + _TYPE_TOKEN, 1)
    code = F.when(upper.isin(BUNDLE_TYPES), upper).otherwise(lookup(TYPE_SYNONYMS, word, ""))
    return code if allow_pallet else F.when(code == "PX", "").otherwise(code)


def vessel_hint(name: Column) -> Column:
    return keyword_value(F.lower(name), VESSEL_HINTS)


def payload_vessel_code(c: Column) -> Column:
    return lookup(PAYLOAD_VESSEL_CODES, F.lower(text(c)), "NA")


def payload_bundle_code(c: Column) -> Column:
    return lookup(PAYLOAD_BUNDLE_CODES, F.lower(strip(text(c))), "PK")


