"""Building the Kubernetes inventory: one row an object with its addresses, owner, host and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.net import ip_to_long, is_ip, let
from flowloom.functions.storage import staged
from flowloom.operators.asof import as_of
from flowloom.operators.intervals import disjoint

ZONE = "topology.kubernetes.io/zone"
HOPS = 3
_EVER = 2**63 - 1


def latest(changes: DataFrame) -> DataFrame:
    """Current objects from a change table (op: snapshot, add, update, delete; version): the last change of each
    (kind, namespace, name) since the last snapshot, unless it is a deletion."""
    since = changes.agg(F.max(F.when(F.col("op") == "snapshot", F.col("version"))).alias("v")).first()["v"]
    live = changes if since is None else changes.filter(F.col("version") >= since)
    rest = [c for c in changes.columns if c not in ("kind", "namespace", "name")]
    last = live.groupBy("kind", "namespace", "name").agg(F.max_by(F.struct(*rest), "version").alias("r")).select("kind", "namespace", "name", *[F.col(f"r.{c}").alias(c) for c in rest])
    return last.filter("op <> 'delete'")


def validity(changes: DataFrame, held: Column, rank: Column) -> DataFrame:
    """(address, low, high, object): which object counts at an address from low until before high (versions, as long).

    A change of an object (kind, namespace, name) holds until the object's next change or the next snapshot; a deletion
    gives nothing. Of one object's changes of one version the last operation by name counts. Where several objects
    hold an address at once, the least by rank, then by version and name counts, as in ``add_kubernetes`` over ``latest``.
    Changes without a version or name are left out. An object's own changes are one window; addresses are swept by range.
    Changes, and what each holds, are written once each.
    """
    rows = changes.select("kind", F.coalesce("namespace", F.lit("")).alias("namespace"), "name", F.col("version").cast("long").alias("version"), "op", "ips", held.alias("object"), rank.alias("rank")).dropna(subset=["kind", "name", "version"])
    rows = rows.groupBy("kind", "namespace", "name", "version").agg(F.max_by(F.struct("op", "ips", "object", "rank"), F.struct("op", F.xxhash64("ips"))).alias("r")).select("kind", "namespace", "name", "version", "r.*")
    rows = staged(rows, "changes")  # read by each step of the join
    # the first snapshot after a change: an as-of join backwards in time, with one key for all
    shots = rows.filter("op = 'snapshot'").select((-F.col("version")).alias("back"), F.col("version").alias("shot")).distinct()
    rows = as_of(rows.withColumn("back", -F.col("version") - 1), shots, [], "back", "back", {"shot": "shot"})
    own = Window.partitionBy("kind", "namespace", "name").orderBy("version")
    rows = rows.withColumn("high", F.least(F.lead("version").over(own), F.col("shot"), F.lit(_EVER))).filter("op <> 'delete'")
    spans = rows.select(F.explode(F.array_distinct("ips")).alias("address"), F.col("version").alias("low"), "high", "rank", F.col("version").alias("came"), "name", "object").filter("address IS NOT NULL")
    return disjoint(staged(spans, "spans"), ["address"], ["rank", "came", "name"], "object")


def pods(df: DataFrame) -> DataFrame:
    """Pods' own addresses (not the host's) and first owner, or themselves."""
    owner = F.get("owner_refs", F.lit(0))
    return df.withColumn("ips", F.filter("pod_ips", lambda x: x != F.coalesce(F.col("host_ip"), F.lit("")))).withColumn("owner_kind", F.coalesce(owner["kind"], F.lit("Pod"))).withColumn("owner_name", F.coalesce(owner["name"], F.col("name")))


def nodes(df: DataFrame) -> DataFrame:
    """Nodes' addresses that are IPs, the first as host address, and the overlay's management address: the default
    subnet (JSON text or list in an annotation) with 2 added to the fourth octet."""
    listed = F.filter("addresses", is_ip)
    raw = F.col("annotations")["k8s.ovn.org/node-subnets"]
    one = F.from_json(raw, "default string")["default"]
    many = F.get(F.from_json(raw, "default array<string>")["default"], F.lit(0))
    cidr = F.when(one.startswith("["), many).otherwise(one)
    base = F.split_part(F.coalesce(cidr, many), F.lit("/"), F.lit(1))
    octets = F.split(base, r"\.")
    mp0 = F.when(ip_to_long(base).isNotNull(), F.concat_ws(".", F.get(octets, F.lit(0)), F.get(octets, F.lit(1)), F.get(octets, F.lit(2)), (F.get(octets, F.lit(3)).try_cast("int") + 2).cast("string")))
    return df.withColumn("ips", F.filter(F.array_append(listed, mp0), lambda x: x.isNotNull())).withColumn("host_ip", F.get(listed, F.lit(0)))


def services(df: DataFrame) -> DataFrame:
    """Services' cluster addresses."""
    return df.withColumn("ips", F.filter("cluster_ips", lambda x: (x != "") & (x != "None")))


def with_hosts(inventory: DataFrame) -> DataFrame:
    """host_name of pods without one from the node at their host address; zones of nodes, and of pods by their node."""
    node = inventory.filter("kind = 'Node'")
    by_ip = node.select(F.explode("ips").alias("_ip"), F.col("name").alias("_by_ip")).groupBy("_ip").agg(F.min("_by_ip").alias("_by_ip"))
    zones = node.select(F.col("name").alias("_node"), F.col("labels")[ZONE].alias("_zone")).groupBy("_node").agg(F.max("_zone").alias("_zone"))
    found = inventory.join(by_ip, (F.col("kind") == "Pod") & (F.col("host_ip") == F.col("_ip")), "left").withColumn("host_name", F.coalesce(F.nullif("host_name", F.lit("")), "_by_ip"))
    found = found.join(zones, (F.col("kind") == "Pod") & (F.col("host_name") == F.col("_node")), "left")
    zone = F.when(F.col("kind") == "Node", F.col("labels")[ZONE]).when(F.col("kind") == "Pod", F.col("_zone"))
    return found.withColumn("zone", zone).drop("_ip", "_by_ip", "_node", "_zone")


def climb_owners(df: DataFrame, owners: DataFrame, tracked: list[str] | None = None) -> DataFrame:
    """owner_kind and owner_name after climbing the chain of owners (kind, namespace, name, owner_kind, owner_name).

    Without tracked kinds a ReplicaSet gives way to its owner. With them the climb takes three hops at
    most; from an owner of a tracked kind it goes on only to a parent that is tracked too.
    """
    up = owners.select(F.col("kind").alias("_k"), F.col("namespace").alias("_ns"), F.col("name").alias("_n"), F.col("owner_kind").alias("_pk"), F.col("owner_name").alias("_pn"))
    up = up.groupBy("_k", "_ns", "_n").agg(F.min(F.struct("_pk", "_pn")).alias("_p"))
    for _ in range(HOPS if tracked else 1):
        df = df.join(up, (F.col("owner_kind") == F.col("_k")) & (F.col("namespace") == F.col("_ns")) & (F.col("owner_name") == F.col("_n")), "left")
        parent = F.col("_p._pk").isNotNull()
        if tracked:
            climbs = parent & (~F.col("owner_kind").isin(tracked) | F.col("_p._pk").isin(tracked))
        else:
            climbs = parent & (F.col("owner_kind") == "ReplicaSet")
        df = df.withColumn("_new", F.when(climbs, F.col("_p")).otherwise(F.struct(F.col("owner_kind").alias("_pk"), F.col("owner_name").alias("_pn"))))
        df = df.withColumns({"owner_kind": F.col("_new._pk"), "owner_name": F.col("_new._pn")}).drop("_new", "_k", "_ns", "_n", "_p")
    return df


def multus_networks(annotation: Column, indexes: list[list[str]]) -> Column:
    """Map of secondary key to network name from a network-status annotation, but for the default network.

    Each index names the parts of its keys: interface, ip, mac. A key is ``interface~ip~mac`` with the parts that are
    not named left empty, one for each address; a network without a named part has no key.
    """
    nets = F.from_json(annotation, "array<struct<name:string,interface:string,ips:array<string>,mac:string,default:boolean>>")
    held = F.filter(nets, lambda n: ~F.coalesce(n["default"], F.lit(False)))
    text = lambda named, v: F.coalesce(v, F.lit("")) if named else F.lit("")

    def of(n: Column, parts: list[str]) -> Column:
        ips = F.coalesce(n["ips"], F.array().cast("array<string>")) if "ip" in parts else F.array(F.lit(""))
        whole = F.lit(True)
        for p in ("interface", "mac"):
            if p in parts:
                whole = whole & (F.coalesce(n[p], F.lit("")) != "")
        key = lambda ip: F.concat(text("interface" in parts, n["interface"]), F.lit("~"), ip, F.lit("~"), F.lower(text("mac" in parts, n["mac"])))
        return F.when(whole, F.transform(ips, lambda ip: F.struct(key(ip).alias("key"), F.coalesce(n["name"], F.lit("")).alias("value")))).otherwise(F.array().cast("array<struct<key:string,value:string>>"))

    entries = F.flatten(F.transform(held, lambda n: F.concat(*[of(n, parts) for parts in indexes])))
    return F.map_from_entries(_last_of_key(entries))


def _last_of_key(entries: Column) -> Column:
    """Entries without those whose key comes again later. The entries and their keys are made once a row."""

    def last(x: Column) -> Column:
        return F.filter(x["entries"], lambda e, i: ~F.array_contains(F.slice(x["keys"], i + 2, F.greatest(F.size(x["keys"]), F.lit(1))), e["key"]))

    return let(let(entries, lambda x: F.struct(x.alias("entries"), x["key"].alias("keys"))), last)


def multus_keys(annotation: Column, parts: list[str]) -> Column:
    """The secondary keys of one index."""
    return F.map_keys(multus_networks(annotation, [parts]))


def multus_flow_keys(parts: list[str], ip: Column | None = None, mac: Column | None = None, interfaces: Column | None = None) -> Column:
    """A flow side's keys for an index, one for each interface; NULL where a part that the index names is absent."""
    use = lambda part, c: c if part in parts and c is not None else None
    ip, mac, interfaces = use("ip", ip), use("mac", mac), use("interface", interfaces)
    given = [c.isNotNull() for c in (ip, mac, interfaces) if c is not None]
    if not given:
        return F.lit(None).cast("array<string>")
    there, some = F.lit(True), F.lit(False)
    for c in given:
        there = there & c
    for c in (ip, mac):
        some = some | (c != "") if c is not None else some
    some = some | (F.size(interfaces) > 0) if interfaces is not None else some
    end = F.concat(F.lit("~"), ip if ip is not None else F.lit(""), F.lit("~"), F.lower(mac) if mac is not None else F.lit(""))
    keys = F.array(end) if interfaces is None else F.transform(interfaces, lambda i: F.concat(i, end))
    return F.when(there & some, keys)


def udn_networks(annotation: Column, namespaced: list[str] | None = None, cluster: list[str] | None = None) -> Column:
    """Map of secondary key to network name from a pod-networks annotation: network~address without its prefix length;
    the default network is left out. A network ``namespace/name`` that is not among the ``namespaced`` ones, but whose
    name is among the ``cluster`` ones, goes by that name."""
    nets = F.from_json(annotation, "map<string,struct<ip_address:string,role:string>>")
    kept = F.filter(F.map_entries(nets), lambda e: (e["key"] != "default") & e["value"]["ip_address"].isNotNull())

    def label(name: Column) -> Column:
        rest = F.regexp_extract(name, "^[^/]*/(.*)$", 1)
        renamed = name.contains("/") & ~name.isin(namespaced or [""]) & rest.isin(cluster or [])
        return F.when(renamed, rest).otherwise(name) if cluster else name

    entry = lambda e: F.struct(F.concat_ws("~", label(e["key"]), F.split_part(e["value"]["ip_address"], F.lit("/"), F.lit(1))).alias("key"), label(e["key"]).alias("value"))
    return F.map_from_entries(_last_of_key(F.transform(kept, entry)))


def udn_keys(annotation: Column, namespaced: list[str] | None = None, cluster: list[str] | None = None) -> Column:
    """The secondary keys of a pod-networks annotation."""
    return F.map_keys(udn_networks(annotation, namespaced, cluster))


def flow_keys(networks: Column, ip: Column) -> Column:
    """A flow side's keys network~address for its networks, without empty and default ones."""
    return F.transform(F.filter(networks, lambda n: (n != "") & (n != "default")), lambda n: F.concat_ws("~", n, ip))
