"""Predicates over one field. Every one is two-valued: an absent field gives true or false, never NULL."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions.coerce import col_or_null, go_str, kind_of, to_int

#: A reference to another field inside a text value.
INJECTED = re.compile(r"\$\((\w+)\)")


def _sure(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def injected(df: DataFrame, text: str) -> Column:
    """text with each $(field) replaced by that field's text ('' where absent)."""
    parts, at = [], 0
    for m in INJECTED.finditer(text):
        parts += [F.lit(text[at : m.start()]), F.coalesce(go_str(df, m[1]), F.lit(""))]
        at = m.end()
    return F.concat(*parts, F.lit(text[at:]))


def equal(df: DataFrame, field: str, value, as_text: bool = False) -> Column:
    """Same type and value; as text where as_text holds or the value refers to other fields."""
    if isinstance(value, str) and INJECTED.search(value):
        return _sure(go_str(df, field) == injected(df, value))
    if as_text:
        return _sure(go_str(df, field) == F.lit(str(value)))
    if isinstance(value, str) != isinstance(kind_of(df, field), T.StringType):
        return F.lit(False)
    return _sure(col_or_null(df, field) == F.lit(value))


def not_equal(df: DataFrame, field: str, value, as_text: bool = False) -> Column:
    """The negation of equal, so true where the field is absent."""
    return ~equal(df, field, value, as_text)


def compare(df: DataFrame, field: str, operator: str, value: int) -> Column:
    """Integer comparison (= != < > <= >=) of the truncated value; false where absent or not a number."""
    c, v = to_int(df, field), F.lit(int(value))
    found = {"=": c == v, "!=": c != v, "<": c < v, ">": c > v, "<=": c <= v, ">=": c >= v}
    return _sure(found[operator])


def matches(df: DataFrame, field: str, regex: str) -> Column:
    """The regular expression is found in the field's text; false where absent."""
    return _sure(go_str(df, field).rlike(regex))


def not_matches(df: DataFrame, field: str, regex: str) -> Column:
    return ~matches(df, field, regex)


def present(df: DataFrame, field: str) -> Column:
    return col_or_null(df, field).isNotNull()


def absent(df: DataFrame, field: str) -> Column:
    return col_or_null(df, field).isNull()
