"""Projections: rename, project and scale columns by rules that all read the original row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowloom.functions.coerce import col_or_null, is_number, kind_of

POLICIES = ("replace_keys", "preserve_original_keys", "")


def generic(df: DataFrame, rules: list[dict], policy: str = "") -> DataFrame:
    """rules: {input, output, multiplier?}. ``replace_keys`` keeps the outputs alone; otherwise they are added.

    A rule whose input is absent leaves an existing output column as it was. A multiplier scales numbers
    in their own type; on other columns the output is not set. 0 is a plain copy.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}")
    out: dict = {}
    for rule in rules:
        name, kind = rule["input"], kind_of(df, rule["input"])
        value, factor = col_or_null(df, name), rule.get("multiplier", 0)
        if factor:
            value = (value * F.lit(factor)).cast(kind) if is_number(kind) else F.lit(None)
        before = out.get(rule["output"])
        if before is None and policy != "replace_keys" and rule["output"] in df.columns:
            before = F.col(f"`{rule['output']}`")
        out[rule["output"]] = value if before is None else F.coalesce(value, before)
    if policy == "replace_keys":
        return df.select(*[c.alias(n) for n, c in out.items()])
    return df.withColumns(out)
