"""Dimension lookups for addresses and ports: subnet labels, services, locations, Kubernetes objects."""

from __future__ import annotations

import ipaddress

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowloom.functions.coerce import free_names, go_str
from flowloom.functions.net import ip_to_hex, ip_to_long
from flowloom.functions.storage import staged
from flowloom.operators.asof import ROWS_PER_RANGE, _long, as_of
from flowloom.operators.intervals import BROADCAST_SEGMENTS, disjoint, locate, searched, swept
from flowloom.operators.inventory import validity

#: Label ranges of a family up to this number are compared one after the other in the plan; more are searched.
FEW_RANGES = 200
#: Rows and bytes of a dimension table up to which it is broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 128_000_000
#: Fixed value: the hex digits before an IPv4 address in an IPv6 address.
MAPPED = "0" * 20 + "ffff"


def fits(df: DataFrame, rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> bool:
    """df has at most so many rows, and bytes as text."""
    seen = df.limit(rows + 1).select(F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).cast("long").alias("n")).agg(F.count("*").alias("rows"), F.sum("n").alias("bytes")).first()
    return seen["rows"] <= rows and (seen["bytes"] or 0) <= most_bytes


def _known_small(df: DataFrame, rows: int, most_bytes: int) -> bool:
    """The plan alone says that df has at most so many rows and bytes, as that of a literal table does."""
    plan = df._jdf.queryExecution().optimizedPlan()
    most = plan.maxRows()
    return most.isDefined() and most.get() <= rows and int(plan.stats().sizeInBytes().toString()) <= most_bytes


def small(df: DataFrame, rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint where it is small; beyond, Spark shuffles it. What df is derived from is run once: the
    table is written, and both the check and the join read that."""
    if _known_small(df, rows, most_bytes):
        return F.broadcast(df)
    held = staged(df, "dimension")
    return F.broadcast(held) if fits(held, rows, most_bytes) else held


def networks(labels: list[dict]) -> list[tuple[int, int, int, str]]:
    """(version, first address, last address, name) of labels [{name, cidrs}], in the given order."""
    found = [(ipaddress.ip_network(c, strict=False), label["name"]) for label in labels for c in label["cidrs"]]
    return [(net.version, int(net[0]), int(net[-1]), name) for net, name in found]


def v4_number(ip: Column, digits: Column) -> Column:
    """The IPv4 address as number, also where it is written as an IPv6 address, of ``digits``; else NULL."""
    return F.coalesce(ip_to_long(ip), F.when(digits.startswith(MAPPED), F.conv(F.right(digits, F.lit(8)), 16, 10).cast("bigint")))


def range_lookup(df: DataFrame, ranges: DataFrame, ip_col: str, columns: list[str], order: Column, most: int = BROADCAST_SEGMENTS) -> DataFrame:
    """df with the columns of the range (ip_from, ip_to) that holds its IPv4 address (the least by ``order``, then by its
    first address; NULL where none does).

    Ranges are made disjoint first, so however many lie around an address, it takes one binary search among at most
    twice their number of bounds; beyond ``most`` segments flows meet them in an as-of join.
    """
    number, digits, found = free_names(df, "_number", "_digits", "_range")
    held = ranges.select(F.col("ip_from").cast("long").alias("low"), (F.col("ip_to").cast("long") + 1).alias("high"), order.alias("by"), F.struct(*columns).alias(found))
    held = staged(held, "ranges")  # counted and swept
    segments = disjoint(held.withColumn("from", F.col("low")), [], ["by", "from"], found)
    ip = F.col(f"`{ip_col}`")
    rows = df.withColumn(digits, ip_to_hex(ip)).withColumn(number, v4_number(ip, F.col(digits)))
    out = locate(rows, F.col(number), segments, found, most)
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns], *[F.col(found)[c].alias(c) for c in columns])


def _segments(nets: list[tuple[int, int, int, str]], bound) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(low bounds, exclusive high bounds, names) of networks, of which the first counts."""
    found = list(swept(sorted((low, high + 1, (i,), name) for i, (_, low, high, name) in enumerate(nets))))
    return np.array([bound(a) for a, _, _ in found]), np.array([bound(b) for _, b, _ in found]), [n for _, _, n in found]


def add_subnet_label(df: DataFrame, ip_col: str, out_col: str, labels: list[dict], few: int = FEW_RANGES) -> DataFrame:
    """The first label, in the given order, with a CIDR that holds the address, of either family. Up to ``few`` CIDRs of a
    family are compared in the plan; more are made disjoint here and found by binary search. Flows are never shuffled."""
    nets = networks(labels)
    v4, v6 = ([n for n in nets if n[0] == version] for version in (4, 6))
    number, digits = free_names(df, "_number", "_digits")
    ip, spark, names = F.col(f"`{ip_col}`"), df.sparkSession, []
    rows = df.withColumn(digits, ip_to_hex(ip)).withColumn(number, v4_number(ip, F.col(digits)))
    rows = rows.withColumn(digits, F.when(~F.col(digits).startswith(MAPPED), F.col(digits)))
    if len(v4) > few:
        names.append(searched(F.col(number), *_segments(v4, int)[:2], spark, _segments(v4, int)[2]))
    else:
        names += [F.when((F.col(number) >= low) & (F.col(number) <= high), F.lit(name)) for _, low, high, name in v4]
    if len(v6) > few:  # one more digit, for the bound after the last address
        low, high, found = _segments(v6, lambda x: f"{x:033x}".encode())
        names.append(searched(F.concat(F.lit("0"), F.col(digits)), low, high, spark, found))
    else:
        names += [F.when((F.col(digits) >= f"{low:032x}") & (F.col(digits) <= f"{high:032x}"), F.lit(name)) for _, low, high, name in v6]
    kept = [c for c in df.columns if c != out_col]
    return rows.select(*[F.col(f"`{c}`") for c in kept], F.coalesce(*names, F.lit(None).cast("string")).alias(out_col))


def add_location(df: DataFrame, ip_col: str, prefix: str, ranges: DataFrame) -> DataFrame:
    """Country, region, city and coordinates of the address, from (ip_from, ip_to, country_short, country_long, region, city, latitude, longitude)."""
    named = ranges.select(
        "ip_from", "ip_to", F.col("country_short").alias(f"{prefix}_CountryName"), F.col("country_long").alias(f"{prefix}_CountryLongName"), F.col("region").alias(f"{prefix}_RegionName"),
        F.col("city").alias(f"{prefix}_CityName"), F.format_string("%f", F.col("latitude").cast("double")).alias(f"{prefix}_Latitude"), F.format_string("%f", F.col("longitude").cast("double")).alias(f"{prefix}_Longitude"),
    )
    return range_lookup(df, named, ip_col, named.columns[2:], F.col("ip_to") - F.col("ip_from"))


# ---- services


def parse_protocols(lines: DataFrame) -> DataFrame:
    """(name, number) from ``name number alias... # comment`` lines, aliases too."""
    w = F.split(F.trim(F.regexp_replace("value", "#.*$", "")), r"\s+")
    listed = lines.select(w.alias("w")).filter(F.size("w") >= 2)
    return listed.select(F.explode(F.array_append(F.slice("w", 3, F.size("w")), F.col("w")[0])).alias("name"), F.col("w")[1].cast("int").alias("number")).filter("number is not null")


def parse_services(lines: DataFrame) -> DataFrame:
    """(name, port, protocol, ord) from ``name port/protocol alias...`` lines; ord is the line's place."""
    w = F.split(F.trim(F.regexp_replace("value", "#.*$", "")), r"\s+")
    listed = lines.withColumn("ord", F.monotonically_increasing_id()).select("ord", w.alias("w")).filter(F.size("w") >= 2)
    return listed.select(F.col("w")[0].alias("name"), F.split_part(F.col("w")[1], F.lit("/"), F.lit(1)).try_cast("int").alias("port"), F.split_part(F.col("w")[1], F.lit("/"), F.lit(2)).alias("protocol"), "ord").filter("port is not null")


def add_service(df: DataFrame, port_col: str, protocol_col: str, out_col: str, protocols: DataFrame, services: DataFrame) -> DataFrame:
    """The service on the port: that of the protocol where the protocol (number, name or alias) is known, any on
    that port (the last listed) where it is not. No hit gives '' for a numeric protocol and NULL for a named one."""
    names = protocols.select(F.col("name").alias("_key"), "number").unionByName(protocols.select(F.col("number").cast("string").alias("_key"), "number")).distinct()
    canonical = protocols.groupBy("number").agg(F.collect_set("name").alias("_names"))
    known = names.join(canonical, "number").groupBy("_key").agg(F.first("_names").alias("_names"))
    exact = services.groupBy("port", "protocol").agg(F.max_by("name", "ord").alias("name"), F.max("ord").alias("ord"))
    ports = exact.groupBy(F.col("port").alias("_port")).agg(F.map_from_entries(F.collect_list(F.struct("protocol", "name"))).alias("_by"), F.max_by("name", "ord").alias("_any"))
    p, k, port, key, by, any_, held = free_names(df, "_p", "_k", "_port", "_key", "_by", "_any", "_names")
    known, ports = known.withColumnsRenamed({"_key": key, "_names": held}), ports.withColumnsRenamed({"_port": port, "_by": by, "_any": any_})
    out = df.withColumns({p: go_str(df, port_col).try_cast("int"), k: go_str(df, protocol_col)})
    out = out.join(small(known), F.col(k) == F.col(key), "left").join(small(ports), F.col(p) == F.col(port), "left")
    hit = F.get(F.filter(F.transform(held, lambda n: F.try_element_at(F.col(by), n)), lambda x: x.isNotNull()), F.lit(0))
    found = F.when(F.col(key).isNull(), F.col(any_)).otherwise(hit)
    value = F.coalesce(found, F.when(F.col(k).rlike(r"^\d+$") & F.col(p).isNotNull(), F.lit("")))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != out_col], value.alias(out_col))


# ---- Kubernetes


FIELDS = ["namespace", "name", "kind", "owner_name", "owner_kind", "network_name", "host_ip", "host_name", "zone", "labels", "annotations", "secondary_net_names"]


def _object(inventory: DataFrame) -> Column:
    """An inventory row as one value; what the inventory lacks is NULL."""
    none = lambda f: F.lit(None).cast("map<string,string>" if f in ("labels", "annotations", "secondary_net_names") else "string").alias(f)
    known = {f.name for f in inventory.schema if f.dataType.typeName() != "void"}  # void can't be written
    return F.struct(*[F.col(f) if f in known else none(f) for f in FIELDS])


def _rank() -> Column:
    return F.when(F.col("kind") == "Pod", 0).when(F.col("kind") == "Node", 1).otherwise(2)


def _shown(o: Column, out: str, zone: bool, labels_prefix: str | None, label_rules: dict | None, annotations_prefix: str | None, annotation_rules: dict | None) -> dict[str, Column]:
    """The columns that an object gives to a flow."""
    add = {
        "Namespace": F.nullif(o["namespace"], F.lit("")), "Name": o["name"], "Type": o["kind"], "OwnerName": o["owner_name"], "OwnerType": o["owner_kind"],
        "NetworkName": o["network_name"], "HostIP": F.nullif(o["host_ip"], F.lit("")), "HostName": F.when(o["host_ip"] != "", F.nullif(o["host_name"], F.lit(""))),
    }
    if zone:
        add["Zone"] = o["zone"]
    new = {f"{out}_{k}": v for k, v in add.items()}
    for what, prefix, rules in (("labels", labels_prefix, label_rules), ("annotations", annotations_prefix, annotation_rules)):
        if prefix is not None:
            new[f"{out}_{what}"] = filter_labels(o[what], prefix=prefix, **(rules or {}))
    return new


def first_known(df: DataFrame, list_col: str, out_col: str, keys: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with the first element of a list of texts that is among ``keys`` (one column), NULL where none is.

    Up to ``most`` keys go to the workers as a set, and each list is looked through where it lies. Beyond that, each
    distinct list is taken apart once, its elements meet the keys, and the first position wins; flows then meet their list.
    """
    held = staged(keys.select(F.col(keys.columns[0]).cast("string").alias("key")).filter("key IS NOT NULL").distinct(), "keys")
    if fits(held, most):
        sent = df.sparkSession.sparkContext.broadcast({r["key"] for r in held.toLocalIterator()})

        @F.pandas_udf("string")
        def first(lists: pd.Series) -> pd.Series:
            known = sent.value
            return pd.Series([None if x is None else next((k for k in x if k in known), None) for x in lists], dtype=object)

        return df.withColumn(out_col, first(F.col(f"`{list_col}`").cast("array<string>")))
    lists = df.select(F.col(f"`{list_col}`").cast("array<string>").alias("list")).filter("size(list) > 0").distinct()
    found = lists.select("list", F.posexplode("list").alias("at", "key")).join(held, "key").groupBy("list").agg(F.min_by("key", "at").alias("first"))
    (at,) = free_names(df, "_list")
    found = found.withColumnsRenamed({"list": at, "first": f"{at}_first"})
    out = df.join(found, F.col(f"`{list_col}`").cast("array<string>") == F.col(at), "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != out_col], F.col(f"{at}_first").alias(out_col))


def add_kubernetes(df: DataFrame, ip_col: str, out: str, inventory: DataFrame, key_cols: list[str] | None = None, labels_prefix: str | None = None, zone: bool = False, label_rules: dict | None = None, annotations_prefix: str | None = None, annotation_rules: dict | None = None) -> DataFrame:
    """Namespace, name, kind, owner, network, host (and zone, labels, annotations) of the object at the address.

    Secondary keys (``key_cols``, in order; a column may hold a list of keys, of any length) come before the address, and
    name the network too; of two objects with one key the later version counts. At one address a Pod comes before a Node
    before a Service, and of one kind the earlier version. The rules {include, exclude, most} are those of filter_labels.
    inventory: see flowloom.operators.inventory; without a column version all objects came at once, in the order of names.
    """
    version = F.col("version") if "version" in inventory.columns else F.lit(0)
    came, found = F.struct(version.alias("version"), "name"), _object(inventory)
    at, key, object_, keyed = free_names(df, "_at", "_key", "_object", "_keyed")
    by_ip = inventory.select(F.explode(F.array_distinct("ips")).alias(at), _rank().alias("rank"), came.alias("came"), found.alias("o")).groupBy(at).agg(F.min_by("o", F.struct("rank", "came")).alias(object_))
    joined, hits = df, []
    if key_cols:
        by_key = inventory.select(F.explode("secondary_net_keys").alias(key), came.alias("came"), found.alias("o")).groupBy(key).agg(F.max_by("o", "came").alias(keyed))
        by_key = small(by_key.withColumn(keyed, F.col(keyed).withField("network_name", F.coalesce(F.try_element_at(F.col(keyed)["secondary_net_names"], F.col(key)), F.lit("")))))
    for i, c in enumerate(key_cols or []):
        (name, k, o), mine = free_names(df, f"_one{i}", f"_key{i}", f"_keyed{i}"), F.col(f"`{c}`")
        if isinstance(df.schema[c].dataType, T.ArrayType):
            joined, mine = first_known(joined, c, name, by_key.select(key)), F.col(name)
        joined = joined.join(by_key.withColumnsRenamed({key: k, keyed: o}), mine == F.col(k), "left")
        hits.append(F.col(o))
    joined = joined.join(small(by_ip), F.col(f"`{ip_col}`") == F.col(at), "left")
    o = F.when(F.col(f"`{ip_col}`").isNotNull(), F.coalesce(*hits, F.col(object_)))
    new = _shown(o, out, zone, labels_prefix, label_rules, annotations_prefix, annotation_rules)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c not in new], *[v.alias(k) for k, v in new.items()])


def add_kubernetes_as_of(df: DataFrame, ip_col: str, time_col: str, out: str, changes: DataFrame, labels_prefix: str | None = None, zone: bool = False, label_rules: dict | None = None, annotations_prefix: str | None = None, annotation_rules: dict | None = None, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """What ``add_kubernetes`` says of the inventory as it was at each flow's time.

    changes: the columns of an inventory and op, version (the time of the change, of time_col's kind). See
    operators.inventory.validity for what counts when; flows meet it in an as-of join by address and range of time.
    """
    at, held, when = free_names(df, "_ip", "_valid", "_when")
    numbered = df.withColumns({at: F.col(f"`{ip_col}`").cast("string"), when: _long(df, time_col)})
    segments = staged(validity(changes.withColumn("version", _long(changes, "version")), _object(changes), _rank()), "segments")  # counted, cut into ranges and joined
    right = segments.select(F.col("address").alias(at), F.col("low").alias("t"), F.struct(F.col("high"), F.col("object")).alias("held"))
    found = as_of(numbered, right, [at], when, "t", {held: "held"}, rows_per_range=rows_per_range)
    o = F.when(F.col(when) < F.col(held)["high"], F.col(held)["object"])
    new = _shown(o, out, zone, labels_prefix, label_rules, annotations_prefix, annotation_rules)
    return found.select(*[F.col(f"`{c}`") for c in df.columns if c not in new], *[v.alias(k) for k, v in new.items()])


#: Dotted attribute names of the alternative naming.
OTEL_NAMES = {"Namespace": "k8s.namespace.name", "Name": "k8s.name", "Type": "k8s.type", "OwnerName": "k8s.owner.name", "OwnerType": "k8s.owner.type", "NetworkName": "k8s.net.name", "HostIP": "k8s.host.ip", "HostName": "k8s.host.name", "Zone": "k8s.zone"}


def otel_names(df: DataFrame, out: str, prefix: str) -> DataFrame:
    """add_kubernetes' columns under dotted names, and ``k8s.<kind>.name`` by the object's kind."""
    kind, name = F.lower(F.col(f"{out}_Type")), F.col(f"{out}_Name")
    for k in ("pod", "node", "service"):
        df = df.withColumn(f"{prefix}k8s.{k}.name", F.when(kind == k, name))
    return df.withColumnsRenamed({f"{out}_{k}": f"{prefix}{v}" for k, v in OTEL_NAMES.items() if f"{out}_{k}" in df.columns})


def filter_labels(labels: Column, include: list[str] | None = None, exclude: list[str] | None = None, prefix: str = "", most: int | None = None) -> Column:
    """Map entries that are included (none given: all) and not excluded, under prefix_key, values cut to ``most`` characters."""
    kept = F.map_filter(labels, lambda k, _: (k.isin(include) if include else F.lit(True)) & (~k.isin(exclude) if exclude else F.lit(True)))
    if prefix:
        kept = F.transform_keys(kept, lambda k, _: F.concat(F.lit(f"{prefix}_"), k))
    if most is None:
        return kept
    short = (lambda v: F.lit("..."[: max(0, most)])) if most <= 3 else (lambda v: F.concat(F.left(v, F.lit(most - 3)), F.lit("...")))
    return F.transform_values(kept, lambda _, v: F.when(F.char_length(v) > most, short(v)).otherwise(v))
