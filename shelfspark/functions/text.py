"""Text rules as native Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source texts are Unicode, so classes such as \s and \b must be Unicode-aware.
UNICODE = "(?U)"
UNICODE_CI = "(?iU)"
# Characters that count as whitespace at the ends of a text.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def text(c: Column) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(c, F.lit(""))


def first_non_empty(*cols: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols], F.lit(""))


def has_text(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def strip(c: Column) -> Column:
    """Trim every kind of Unicode whitespace (a plain character trim, no regex)."""
    return F.trim(c, F.lit(WHITESPACE))


def collapse_space(c: Column) -> Column:
    """Any whitespace run (including NBSP) becomes one space; ends are trimmed."""
    return F.trim(F.regexp_replace(c, UNICODE + r"\s+", " "))


def join_non_empty(sep: str, *cols: Column) -> Column:
    return F.concat_ws(sep, *[blank_to_null(c) for c in cols])


def keyword_value(haystack: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Value of the first listed keyword contained in the haystack, else ''."""
    chain = None
    for needle, value in pairs:
        hit = haystack.contains(needle)
        chain = F.when(hit, F.lit(value)) if chain is None else chain.when(hit, F.lit(value))
    return chain.otherwise(F.lit(""))


def contains_any(haystack: Column, needles: Iterable[str]) -> Column:
    cond = F.lit(False)
    for needle in needles:
        cond = cond | haystack.contains(needle)
    return cond


def lookup(mapping: dict[str, str], key: Column, default: str | None = None) -> Column:
    """Literal-map lookup; null (or the default) for an unknown key."""
    pairs = ", ".join(f"'{k}', '{v}'" for k, v in mapping.items())
    hit = F.try_element_at(F.expr(f"map({pairs})"), key)
    return hit if default is None else F.coalesce(hit, F.lit(default))


def split_clean(c: Column, pattern: str) -> Column:
    """Split on a pattern, collapse space, drop empties."""
    parts = F.transform(F.split(c, pattern), collapse_space)
    return F.filter(parts, lambda x: x != "")


def sorted_json_map(m: Column) -> Column:
    """Key-sorted JSON text of a map, with a space after ':' and ','."""
    entries = F.array_sort(F.map_entries(m))

    def quoted(c: Column) -> Column:
        # one-field JSON object renders the escapes; keep only the string literal
        return F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)

    body = F.array_join(
        F.transform(entries, lambda e: F.concat(quoted(e["key"]), F.lit(": "), quoted(e["value"]))),
        ", ",
    )
    return F.concat(F.lit("{"), body, F.lit("}"))
