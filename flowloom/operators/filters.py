"""Filter rules: keep and remove rows, sample, derive fields and labels.

``transform_filter`` applies keep rules first, whatever their place in the list, then all others in
order on the evolving row.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.coerce import col_or_null, go_str, is_number, kind_of, to_int
from flowloom.plans.query_text import column_of


def _draw(n: int, salt: int, key: list[str] | Column | None) -> Column:
    """One row in n: at random, or by the rows' key (columns to hash, or a whole number) so that runs agree."""
    if isinstance(key, Column):
        return F.pmod(key + F.lit(salt), F.lit(n)) == 0
    return F.pmod(F.xxhash64(*key, F.lit(salt)), F.lit(n)) == 0 if key else F.rand(salt) < 1.0 / n


def keep(df: DataFrame, rules: list[dict], sampling_key: list[str] | Column | None = None, sampling_field: str | None = None) -> DataFrame:
    """Rows that any rule accepts. rules: {query, sampling?}; a match that sampling drops falls to the next rule.

    ``sampling_field`` receives the rate of the rule that kept the row, or is multiplied by it.
    """
    accepted = [column_of(df, r["query"]) for r in rules]
    rates = [int(r.get("sampling") or 0) for r in rules]
    chosen = F.lit(None).cast("int")
    for i in reversed(range(len(rules))):
        drawn = accepted[i] & (_draw(rates[i], i, sampling_key) if rates[i] > 1 else F.lit(True))
        chosen = F.when(drawn, F.lit(i)).otherwise(chosen)
    out = df.withColumn("_rule", chosen).filter("_rule is not null")
    if sampling_field and any(r > 1 for r in rates):
        rate = F.get(F.array(*[F.lit(max(1, r)) for r in rates]), F.col("_rule")).cast("bigint")
        old = col_or_null(df, sampling_field)
        if sampling_field not in df.columns:
            new = F.when(rate > 1, rate)
        elif is_number(kind_of(df, sampling_field)):
            whole = to_int(df, sampling_field)
            new = F.when(rate > 1, F.coalesce(F.when(whole == 0, F.lit(1)).otherwise(whole), F.lit(1)) * rate).otherwise(whole)
        else:
            new = old
        out = out.withColumn(sampling_field, new)
    return out.drop("_rule")


def dropped_by(df: DataFrame, rule: dict) -> Column:
    """Whether a remove rule drops the row. An absent field is never compared, so such rows stay."""
    kind, c = rule["type"], col_or_null(df, rule["input"])
    if kind == "remove_entry_if_exists":
        return c.isNotNull()
    if kind == "remove_entry_if_doesnt_exist":
        return c.isNull()
    value = int(rule["value"]) if rule.get("cast_int") else rule["value"]
    same = F.lit(False) if isinstance(value, str) != (kind_of(df, rule["input"]).typeName() == "string") else c == F.lit(value)
    if kind == "remove_entry_if_equal":
        return F.coalesce(same, F.lit(False))
    if kind == "remove_entry_if_not_equal":
        return F.coalesce(~same & c.isNotNull(), F.lit(False))
    raise ValueError(f"unknown remove rule {kind!r}")


def all_of(df: DataFrame, rules: list[dict]) -> Column:
    """Every sub-rule would drop the row (an empty list drops all)."""
    return reduce(lambda a, b: a & b, [dropped_by(df, r) for r in rules], F.lit(True))


def conditional_sampling(df: DataFrame, rules: list[dict], key: list[str] | Column | None = None) -> DataFrame:
    """The first condition whose sub-rules all hold keeps one row in ``value``; rows under none stay."""
    stays = F.lit(True)
    for i, r in reversed(list(enumerate(rules))):
        stays = F.when(all_of(df, r["rules"]), _draw(r["value"], i, key) if r["value"] > 1 else F.lit(True)).otherwise(stays)
    return df.filter(stays)


_PARAMETERS = re.compile(r"^\s*(==|!=|<=|>=|<|>)\s*(-?\d+(?:\.\d+)?)\s*$")


def holds(df: DataFrame, name: str, parameters: str) -> Column:
    """``value <parameters>``, such as ">10" or "==1"; false where it cannot be evaluated."""
    m = _PARAMETERS.match(parameters)
    if not m:
        return F.lit(False)
    c, v = col_or_null(df, name).try_cast("double"), F.lit(float(m[2]))
    found = {"==": c == v, "!=": c != v, "<": c < v, ">": c > v, "<=": c <= v, ">=": c >= v}[m[1]]
    return F.coalesce(found, F.lit(False))


def _set(df: DataFrame, name: str, when: Column, value: Column) -> DataFrame:
    old = col_or_null(df, name)
    kind = value if name not in df.columns else value.cast(kind_of(df, name))
    return df.withColumn(name, F.when(when, kind).otherwise(old))


def _matched(df: DataFrame, rule: dict) -> Column:
    try:
        re.compile(rule["parameters"])
    except re.error:
        return F.lit(False)
    return F.coalesce(go_str(df, rule["input"]), F.lit("<nil>")).rlike(rule["parameters"])


def apply_rule(df: DataFrame, rule: dict, key: list[str] | Column | None = None) -> DataFrame:
    """One rule by its type."""
    kind = rule["type"]
    if kind == "remove_field":
        return df.drop(rule["input"])
    if kind.startswith("remove_entry_if"):
        return df.filter(~dropped_by(df, rule))
    if kind == "remove_entry_all_satisfied":
        return df.filter(~all_of(df, rule["rules"]))
    if kind == "conditional_sampling":
        return conditional_sampling(df, rule["rules"], key)
    if kind == "add_field":
        return df.withColumn(rule["input"], F.lit(rule["value"]))
    if kind == "add_field_if_doesnt_exist":
        return df.withColumn(rule["input"], F.coalesce(col_or_null(df, rule["input"]), F.lit(rule["value"])))
    if kind == "add_regex_if":
        hit, out = _matched(df, rule), rule["output"]
        df = _set(df, out, hit, col_or_null(df, rule["input"]))
        return _set(df, f"{out}_Matched", hit, F.lit(True))
    if kind == "add_field_if":
        hit, out = holds(df, rule["input"], rule["parameters"]), rule["output"]
        df = _set(df, out, hit, F.lit(rule["assignee"]) if rule.get("assignee") else col_or_null(df, rule["input"]))
        return _set(df, f"{out}_Evaluate", hit, F.lit(True))
    if kind in ("add_label", "add_label_if"):
        hit = F.lit(True) if kind == "add_label" else holds(df, rule["input"], rule["parameters"])
        name, value = (rule["input"], rule["value"]) if kind == "add_label" else (rule["output"], rule["assignee"])
        old = df["_labels"] if "_labels" in df.columns else F.create_map().cast("map<string,string>")
        new = F.map_concat(F.map_filter(old, lambda k, _: k != name), F.create_map(F.lit(name), F.lit(str(value))))
        return df.withColumn("_labels", F.when(hit, new).otherwise(old))
    raise ValueError(f"unknown rule {kind!r}")


def transform_filter(df: DataFrame, rules: list[dict], sampling_key: list[str] | Column | None = None, sampling_field: str | None = None) -> DataFrame:
    """All rules: keep rules first, the others in order; labels end in one ``labels`` column, by key."""
    first = [r for r in rules if r["type"] == "keep_entry_query"]
    if first:
        df = keep(df, first, sampling_key, sampling_field)
    for r in rules:
        if r["type"] != "keep_entry_query":
            df = apply_rule(df, r, sampling_key)
    if "_labels" in df.columns:
        pairs = F.transform(F.array_sort(F.map_entries("_labels")), lambda e: F.concat_ws("=", e["key"], e["value"]))
        df = df.withColumn("labels", F.when(F.size("_labels") > 0, F.array_join(pairs, ","))).drop("_labels")
    return df
