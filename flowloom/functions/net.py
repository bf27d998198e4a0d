"""Addresses, subnets, TCP flags and flow direction as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_V4 = r"^(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(\.(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)){3}$"
#: Names of the TCP flag bits, in bit order.
TCP_FLAGS = {"FIN": 1, "SYN": 2, "RST": 4, "PSH": 8, "ACK": 16, "URG": 32, "ECE": 64, "CWR": 128, "SYN_ACK": 256, "FIN_ACK": 512, "RST_ACK": 1024}


def ip_to_long(ip: Column) -> Column:
    """The IPv4 address as number; NULL for anything else."""
    parts = F.split(ip, r"\.")
    part = lambda i: F.get(parts, F.lit(i)).try_cast("int").cast("bigint")
    # the pattern's NULL joins the sum: within a CASE the text would be made and split again for each part
    return part(0) * 16777216 + part(1) * 65536 + part(2) * 256 + part(3) + F.when(ip.rlike(_V4), F.lit(0).cast("bigint"))


def let(value: Column, use) -> Column:
    """use(value) with value evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def ip_to_hex(ip: Column) -> Column:
    """The IPv6 address as 32 lower-case hex digits; NULL for anything else. A dotted end counts as the last two groups."""
    none = F.array().cast("array<string>")
    group = lambda n: F.lower(F.hex(n))
    groups = lambda t: F.when(t == "", none).otherwise(F.split(t, ":", -1))

    def undotted(text: Column, n: Column) -> Column:
        return F.when(n.isNull(), text).otherwise(F.concat(F.regexp_extract(text, r"^.*:", 0), group(F.shiftright(n, 16)), F.lit(":"), group(F.pmod(n, F.lit(65536)))))

    def filled(h: Column) -> Column:
        return F.struct(h["n"].alias("n"), (8 - F.size(h["head"]) - F.size(h["rest"])).alias("missing"), F.concat(h["head"], F.array_repeat(F.lit("0"), F.greatest(8 - F.size(h["head"]) - F.size(h["rest"]), F.lit(0))), h["rest"]).alias("whole"))

    def digits(f: Column) -> Column:
        fits = F.when(f["n"] == 1, f["missing"] == 0).otherwise((f["n"] == 2) & (f["missing"] >= 1))
        right = fits & F.forall(f["whole"], lambda g: g.rlike("^[0-9a-f]{1,4}$"))
        return F.when(right, F.array_join(F.transform(f["whole"], lambda g: F.lpad(g, 4, "0")), ""))

    parts = lambda h: F.struct(F.size(h).alias("n"), groups(F.get(h, F.lit(0))).alias("head"), F.coalesce(groups(F.get(h, F.lit(1))), none).alias("rest"))
    of = lambda text: let(let(let(F.split(text, "::", -1), parts), filled), digits)
    dotted = lambda text: let(F.struct(text.alias("t"), ip_to_long(F.regexp_extract(text, r"[^:]*$", 0)).alias("n")), lambda x: undotted(x["t"], x["n"]))
    return F.when(ip.contains(":"), of(F.when(ip.contains("."), dotted(F.lower(ip))).otherwise(F.lower(ip))))


def is_ip(ip: Column) -> Column:
    """The text is an IPv4 or IPv6 address."""
    return F.coalesce(ip.rlike(_V4), F.lit(False)) | ip_to_hex(ip).isNotNull()


def long_to_ip(n: Column) -> Column:
    return F.concat_ws(".", *[F.pmod(F.shiftright(n.cast("bigint"), s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)])


def hex_to_ip6(digits: Column) -> Column:
    """32 hex digits as IPv6 text: the first of the longest runs of two or more zero groups is left out, and an IPv4
    address within stays dotted."""
    short = lambda g: F.coalesce(F.nullif(F.ltrim(g, F.lit("0")), F.lit("")), F.lit("0"))
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(29), F.lit(4)), lambda i: short(F.substring(digits, i, F.lit(4)))), ":")

    zero = F.concat(*[F.when(F.substring(digits, i, 4) == "0000", "0").otherwise("1") for i in range(1, 30, 4)])

    upto = lambda text, n: F.call_function("substring_index", text, F.lit(":"), n)

    def shortened(t: Column) -> Column:
        """t: the text, and where its longest run of zero groups begins (from 0) and how long it is; none: length 0."""
        cut = F.concat(upto(t["text"], t["at"]["begin"]), F.lit("::"), upto(t["text"], t["at"]["begin"] + t["at"]["n"] - 8))
        return F.when(t["at"]["n"] == 0, t["text"]).otherwise(cut)

    def longest(z: Column) -> Column:
        out = F.struct(F.lit(0).alias("begin"), F.lit(0).alias("n"))
        for n in range(2, 9):  # the longest is tried first
            out = F.when(z.contains("0" * n), F.struct((F.instr(z, "0" * n) - 1).alias("begin"), F.lit(n).alias("n"))).otherwise(out)
        return out

    dotted = F.concat(F.lit("::ffff:"), long_to_ip(F.conv(F.right(digits, F.lit(8)), 16, 10)))
    return F.when(digits.startswith("0" * 20 + "ffff"), dotted).when(digits.isNotNull(), let(F.struct(text.alias("text"), let(zero, longest).alias("at")), shortened))


def _subnet_v6(ip: Column, prefix: int) -> Column:
    """The IPv6 network of the address: its digits with those after the prefix zero."""

    def masked(h: Column) -> Column:
        whole, bits = divmod(prefix, 4)
        kept = F.substring(h, 1, whole)
        if bits:
            digit = F.conv(F.substring(h, whole + 1, 1), 16, 10).cast("int").bitwiseAND(F.lit(16 - (1 << 4 - bits)))
            kept = F.concat(kept, F.lower(F.hex(digit)))
        return F.rpad(kept, 32, "0")

    return F.concat(let(let(ip_to_hex(ip), masked), hex_to_ip6), F.lit(f"/{prefix}"))


def subnet(ip: Column, prefix: int, v6: bool = False) -> Column:
    """The network of the address, as text ``a.b.c.d/prefix``; NULL where the address cannot be read.

    ``v6`` also reads IPv6 addresses; both are expressions.
    """
    known = ip.rlike(_V4)
    whole, bits = divmod(min(prefix, 32), 8)
    kept = [F.substring_index(ip, ".", whole)] if whole else []
    if bits:
        octet = F.split_part(ip, F.lit("."), F.lit(whole + 1)).try_cast("int")
        kept.append((octet - octet % (1 << 8 - bits)).cast("string"))
    zeros = [F.lit("0")] * (4 - whole - bool(bits))
    v4 = F.concat(F.concat_ws(".", *kept, *zeros), F.lit(f"/{prefix}")) if prefix <= 32 else F.lit(None)
    if not v6:
        return F.when(known, v4)
    return F.when(known, v4).when(ip.contains(":"), _subnet_v6(ip, prefix))


def decode_tcp_flags(flags: Column) -> Column:
    """Names of the bits that are set, in bit order; NULL for NULL."""
    named = F.array(*[F.when(flags.cast("bigint").bitwiseAND(F.lit(b)) != 0, F.lit(n)) for n, b in TCP_FLAGS.items()])
    return F.when(flags.isNotNull(), F.filter(named, lambda x: x.isNotNull()))


def encode_tcp_flags(names: Column) -> Column:
    """The bits of the names; unknown names count nothing."""
    bits = F.create_map(*[x for n, b in TCP_FLAGS.items() for x in (F.lit(n), F.lit(b).cast("bigint"))])
    return F.aggregate(names, F.lit(0).cast("bigint"), lambda a, f: a.bitwiseOR(F.coalesce(F.try_element_at(bits, f), F.lit(0).cast("bigint"))))


def reinterpret_direction(reporter: Column, source: Column, target: Column, old: Column) -> Column:
    """1 (egress) where the source host reports, 0 (ingress) where the target does, 2 where both are one host; else old."""
    r, s, t = (F.coalesce(c, F.lit("")) for c in (reporter, source, target))
    return F.when(r == "", old).when((s == t) & (s != ""), F.lit(2)).when((r == s) & (s != t), F.lit(1)).when((r == t) & (s != t), F.lit(0)).otherwise(old)


def infra_or_app(pairs: list[tuple[Column, Column]], prefixes: list[str], references: list[tuple[str, str]]) -> Column:
    """'app' where any (namespace, name) is neither in an infrastructure namespace nor among the references; else 'infra'."""
    app = F.lit(False)
    for namespace, name in pairs:
        known = F.lit(False)
        for p in prefixes:
            known = known | F.coalesce(namespace.startswith(p), F.lit(False))
        for ns, n in references:
            known = known | F.coalesce((namespace == ns) & (name == n), F.lit(False))
        app = app | (F.coalesce(namespace != "", F.lit(False)) & ~known)
    return F.when(app, F.lit("app")).otherwise(F.lit("infra"))
