"""Column expressions for text output (sort keys, escaping, formatting)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def district_sort_key(col: Column | str) -> Column:
    """Accent-aware order that ignores spaces and punctuation.

    Letters and digits only, compared under the ``UNICODE`` (ICU root)
    collation: "Stanford" sorts before "St. Anne Quay", and "Pier-10" before "Pier 9".  Callers add the raw value as a
    tie-break so equal keys still order deterministically.
    """
    return F.collate(F.regexp_replace(_c(col), r"[^\p{L}\p{N}]", ""), "UNICODE")


def xml_text(col: Column | str) -> Column:
    """Escape a value for XML element content (&, <, >)."""
    c = _c(col).cast("string")
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def xml_escape_py(value: str, attribute: bool = False) -> str:
    out = value.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    return out.replace('"', "&quot;") if attribute else out
