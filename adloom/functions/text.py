"""Text helpers shared by the extractors. Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as a browser trims it: the regex class plus NBSP and BOM.
_WS = r"[\s\x{00A0}\x{FEFF}]"


def strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, f"^{_WS}+|{_WS}+$", "")


def squeeze_ws(c: Column) -> Column:
    return F.regexp_replace(c, f"{_WS}+", " ")


def null_if_blank(c: Column) -> Column:
    return F.when(strip_ws(c) != "", c)


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_nonempty(*cols: Column) -> Column:
    """First value that is neither NULL nor the empty string."""
    return F.coalesce(*[null_if_empty(c) for c in cols])


def grab(c: Column, pattern: str | Column, group: int = 1) -> Column:
    """Regex group as text, NULL when nothing matches."""
    p = pattern if isinstance(pattern, Column) else F.lit(pattern)
    return null_if_empty(F.call_function("regexp_extract", c, p, F.lit(group)))


def let(value: Column, body) -> Column:
    """Evaluate `value` once per row and hand it to `body`; keeps nested lambdas linear.

    A fold over nothing, which hands its start to the last step: unlike `transform`, it does not copy what `body` returns.
    """
    return F.aggregate(F.expr("array()"), value, lambda acc, _: acc, body)


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_array(values) -> Column:
    """Constant array; one parsed literal instead of one JVM call per element."""
    return F.expr(f"array({', '.join(map(_quoted, values))})")


def text_map(table: dict[str, str]) -> Column:
    """Constant map."""
    return F.expr(f"map({', '.join(_quoted(x) for pair in table.items() for x in pair)})")


def one_of(c: Column, words) -> Column:
    """Is the text one of some plain words?"""
    return c.rlike(f"^(?:{'|'.join(words)})$")


def first_where(arr: Column, pred) -> Column:
    return F.get(F.filter(arr, pred), F.lit(0))


def last_where(arr: Column, pred) -> Column:
    return F.try_element_at(F.filter(arr, pred), F.lit(-1))


def short_hash(c: Column) -> Column:
    return F.left(F.sha2(c, 256), F.lit(16))


def truncate_text(c: Column, limit: int = 120) -> Column:
    text = F.coalesce(c, F.lit(""))
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit("…"))).otherwise(text)


def slugify(c: Column) -> Column:
    dashed = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "-")
    return F.regexp_replace(dashed, "^-+|-+$", "")


def amenity_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"\s+", "_")


def label_key(c: Column) -> Column:
    """Key form of a label: other characters become one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(strip_ws(c)), "[^a-z0-9]+", "_"), "^_|_$", "")


def is_missing(c: Column) -> Column:
    return F.coalesce(strip_ws(c).isin("", "not_found"), F.lit(True))


def present(c: Column) -> Column:
    """The value, or NULL if it is one of the three missing markers."""
    return F.when(~is_missing(c), c)
