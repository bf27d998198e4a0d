"""Type coercion rules. NULL stands for an absent field; an empty string is present."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kind_of(df: DataFrame, name: str) -> T.DataType:
    """The column's type; NullType for a column that df lacks."""
    return df.schema[name].dataType if name in df.columns else T.NullType()


def col_or_null(df: DataFrame, name: str) -> Column:
    """The column, or NULL where df has no such column: a rule on a missing field sees it absent everywhere."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until no column of df has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        out.append(n)
    return out


def is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def _plain(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        whole = (c == F.floor(c)) & (F.abs(c) < 1e18)
        plain = F.regexp_replace(c.cast("decimal(38,12)").cast("string"), r"\.?0+$", "")
        return F.when(whole, c.cast("bigint").cast("string")).otherwise(F.coalesce(plain, c.cast("string")))
    return c.cast("string")


def go_str(df: DataFrame, name: str) -> Column:
    """Text of a value: floats in plain decimal without a trailing .0, lists as ``[a b]``."""
    kind, c = kind_of(df, name), col_or_null(df, name)
    if isinstance(kind, T.ArrayType):
        return F.when(c.isNotNull(), F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: _plain(x, kind.elementType)), " "), F.lit("]")))
    return _plain(c, kind)


def to_double(df: DataFrame, name: str) -> Column:
    """Any number or numeric text; NULL otherwise."""
    c = col_or_null(df, name)
    return c.cast("double") if is_number(kind_of(df, name)) else c.cast("string").try_cast("double")


def to_int(df: DataFrame, name: str) -> Column:
    """Numbers are truncated; text must be a whole number; NULL otherwise."""
    c = col_or_null(df, name)
    if is_number(kind_of(df, name)):
        return c.try_cast("bigint")
    return F.when(c.cast("string").rlike(r"^[+-]?\d+$"), c.cast("string").try_cast("bigint"))


def to_bool(df: DataFrame, name: str) -> Column:
    """Booleans, the usual texts for them, and the numbers 0 and 1; NULL otherwise."""
    kind, c = kind_of(df, name), col_or_null(df, name)
    if isinstance(kind, T.BooleanType):
        return c
    text = go_str(df, name)
    return F.when(text.isin("1", "t", "T", "TRUE", "true", "True"), True).when(text.isin("0", "f", "F", "FALSE", "false", "False"), False)
