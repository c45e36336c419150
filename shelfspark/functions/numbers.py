"""Number text rules.  Casts are guarded: ANSI mode is on and inputs are free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions.text import collapse_space, strip

PLAIN_NUMBER = r"^[-+]?(\d+(\.\d*)?|\.\d+)$"


def plain_number(c: Column) -> Column:
    """Thousands marks and blanks removed, comma to point, one trailing '.0' dropped."""
    return F.regexp_replace(F.translate(c, ",'’ ", "."), r"\.0$", "")


def feed_number(c: Column) -> Column:
    """As plain_number, but the typographic apostrophe is kept (import-file rule)."""
    return F.regexp_replace(F.translate(c, ",' ", "."), r"\.0$", "")


def as_double(c: Column) -> Column:
    return F.when(c.rlike(PLAIN_NUMBER), c.try_cast("double"))


def as_decimal(c: Column) -> Column:
    return F.when(c.rlike(PLAIN_NUMBER), c.try_cast("decimal(20,6)"))


def two_decimals(value: Column) -> Column:
    """Fixed two decimals of a double, without grouping commas."""
    return F.replace(F.format_number(value, 2), F.lit(","), F.lit(""))


def trimmed_four_decimals(c: Column) -> Column:
    """Numeric text to at most four decimals, zeros stripped; other text is unchanged."""
    cleaned = F.translate(collapse_space(c), ",'’", ".")
    value = as_double(cleaned)
    fixed = F.replace(F.format_number(value, 4), F.lit(","), F.lit(""))
    return F.when(value.isNull(), cleaned).otherwise(
        F.regexp_replace(F.regexp_replace(fixed, "0+$", ""), r"\.$", "")
    )


def is_integral(value: Column) -> Column:
    return F.coalesce(value == F.floor(value), F.lit(False))


def payload_number(c: Column) -> Column:
    """Number of a payload field: apostrophes dropped, comma to point."""
    return as_double(strip(F.translate(c, ",'", ".")))


def cents(c: Column) -> Column:
    """Price text to integer cents, half up."""
    value = as_decimal(strip(F.translate(c, ",'", ".")))
    return F.round(value * F.lit(100).cast("decimal(3,0)"), 0).cast("bigint")


def divide_half_up(price: Column, divisor: Column) -> Column:
    """price / divisor at two decimals half up; the price text unchanged when impossible."""
    quotient = F.try_divide(as_decimal(plain_number(price)), as_decimal(plain_number(divisor)))
    return F.coalesce(F.round(quotient, 2).cast("decimal(24,2)").cast("string"), price)


def multiply_text(left: Column, right: Column) -> Column:
    """Decimal product as text without a trailing fraction; '' when not numeric."""
    product = as_decimal(plain_number(left)) * as_decimal(plain_number(right))
    trimmed = F.regexp_replace(product.cast("string"), r"\.?0+$", "")
    whole = F.floor(product)
    return F.when(product.isNull(), "").when(product == whole, whole.cast("string")).otherwise(trimmed)


def six_significant(value: Column) -> Column:
    """Shortest six-significant-digit form of a double; integers without a fraction."""
    general = F.format_string("%.6g", value)
    general = F.regexp_replace(general, r"(\.\d*?)0+(?=e|$)", "$1")
    general = F.regexp_replace(general, r"\.(?=e|$)", "")
    return F.when(is_integral(value), value.cast("decimal(38,0)").cast("string")).otherwise(general)


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")
