"""Address lookups: longest-prefix match as an equi-join, ASN tables, two-tier positions.

A probe address has at most 33 (IPv4) or 129 (IPv6) enclosing networks, so it
is exploded into those for which the table has a mask length at all, joined on
(network, mask length), and the longest match kept.  Catalyst then picks a
hash join; there is no range condition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geotide import codes

#: Lookup tables up to this many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000
_V4 = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})/(\d{1,2})$"


def v4_network(cidr: Column) -> Column:
    """struct(net, last: longs, len int) of an IPv4 CIDR: its first and last address; null if it isn't one."""
    part = [F.regexp_extract(cidr, _V4, i).try_cast("long") for i in range(1, 6)]
    ok = cidr.rlike(_V4) & (part[4] <= 32)
    for p in part[:4]:
        ok &= p <= 255
    addr = part[0] * 2**24 + part[1] * 2**16 + part[2] * 2**8 + part[3]
    size = _v4_size(F.when(ok, part[4]))
    net = addr - F.pmod(addr, size)
    return F.when(ok, F.struct(net.alias("net"), (net + size - 1).alias("last"), part[4].cast("int").alias("len")))


def _v4_size(bits: Column) -> Column:
    """How many addresses a network of so many bits has."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (32 - bits).cast("int"))


def v6_network(cidr: Column) -> Column:
    """struct(net, last: 32 hex digits each, len int) of an IPv6 CIDR: its first and last address; null if it isn't one."""
    address, length = F.lower(F.get(F.split(cidr, "/"), F.lit(0))), F.get(F.split(cidr, "/"), F.lit(1))
    tail = r"^(.*:)(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$"
    part = [F.regexp_extract(address, tail, i).try_cast("int") for i in range(2, 6)]
    dotted = F.when((part[0] <= 255) & (part[1] <= 255) & (part[2] <= 255) & (part[3] <= 255), F.concat(F.regexp_extract(address, tail, 1), F.hex(part[0] * 256 + part[1]), F.lit(":"), F.hex(part[2] * 256 + part[3])))
    halves = F.split(F.lower(F.when(address.rlike(tail), dotted).otherwise(address)), "::")
    groups = lambda i: F.when(F.coalesce(F.get(halves, F.lit(i)), F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(F.get(halves, F.lit(i)), ":"))
    left, right = groups(0), groups(1)
    n = F.size(left) + F.size(right)
    whole = F.concat(left, F.array_repeat(F.lit("0"), 8 - n), right)
    ok = ((F.size(halves) == 1) & (n == 8) | (F.size(halves) == 2) & (n <= 7)) & F.forall(whole, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
    ok &= cidr.rlike(r"^[^/]+/\d{1,3}$") & (length.try_cast("int") <= 128)
    digits = F.array_join(F.transform(whole, lambda g: F.lpad(g, 4, "0")), "")
    size = length.try_cast("int")
    return F.when(ok, F.struct(_v6_bound(digits, size, "0").alias("net"), _v6_bound(digits, size, "f").alias("last"), size.alias("len")))


def _v6_bound(digits: Column, size: Column, fill: str) -> Column:
    """The first ('0') or last ('f') address of the network of ``size`` bits around an address."""
    whole, kept = (size / 4).cast("int"), F.pmod(size, F.lit(4))
    host = F.call_function("shiftleft", F.lit(1), (4 - kept).cast("int"))
    nibble = F.conv(F.substr(digits, whole + 1, F.lit(1)), 16, 10).try_cast("int")
    nibble = nibble - F.pmod(nibble, host) + (host - 1 if fill == "f" else 0)
    head = F.substr(digits, F.lit(1), whole)
    return F.when(kept == 0, F.rpad(head, 32, fill)).otherwise(F.rpad(F.concat(head, F.lower(F.hex(nibble))), 32, fill))


def small(df: DataFrame) -> DataFrame:
    """Hints a broadcast only after counting: a table beyond the bound is left to the planner."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def longest_match(probes: DataFrame, table: DataFrame, prefix: str = "prefix", network: str = "network", known: DataFrame | None = None) -> DataFrame:
    """``probes`` left-joined with the columns of the most specific IPv4 network that holds each prefix's network address.

    A network more specific than the probe prefix counts if it holds the
    address.  Probes that aren't CIDRs, and misses, get nulls.  ``known``: rows
    that have all of the probes' prefixes and cost less to read again.
    """
    cols = [c for c in table.columns if c != network]
    nets = table.withColumn("_n", v4_network(F.col(network))).filter("_n is not null").select(F.col("_n.net").alias("_net"), F.col("_n.len").alias("_len"), F.struct(*cols).alias("_hit"))
    nets = nets.groupBy("_net", "_len").agg(F.max("_hit").alias("_hit"))
    keys = (probes if known is None else known).select(prefix).distinct().withColumn("_a", v4_network(F.col(prefix))).filter("_a is not null")
    lens = sorted(r["_len"] for r in nets.select("_len").distinct().collect())  # at most 33 rows
    keys = keys.withColumn("_len", F.explode(F.array(*[F.lit(x) for x in lens]) if lens else F.array().cast("array<int>")))
    size = F.call_function("shiftleft", F.lit(1).cast("long"), (32 - F.col("_len")).cast("int"))
    keys = keys.withColumn("_net", F.col("_a.net") - F.pmod(F.col("_a.net"), size)).drop("_a")
    best = keys.join(small(nets), ["_net", "_len"]).groupBy(prefix).agg(F.max_by("_hit", "_len").alias("_hit"))
    return probes.join(best, prefix, "left").select(*probes.columns, *[F.col(f"_hit.{c}").alias(c) for c in cols])


def longest_match_v6(probes: DataFrame, table: DataFrame, prefix: str = "prefix", network: str = "network", known: DataFrame | None = None) -> DataFrame:
    """The IPv6 twin: networks as hex strings, candidate masks only of lengths that the table has."""
    cols = [c for c in table.columns if c != network]
    nets = table.withColumn("_n", v6_network(F.col(network))).filter("_n is not null").select(F.col("_n.net").alias("_net"), F.col("_n.len").alias("_len"), F.struct(*cols).alias("_hit"))
    lengths = nets.select(F.col("_len").alias("_l")).distinct()  # at most 129 rows
    keys = (probes if known is None else known).select(prefix).distinct().withColumn("_a", v6_network(F.col(prefix))).filter("_a is not null")
    lens = sorted(r["_l"] for r in lengths.collect())
    keys = keys.withColumn("_len", F.explode(F.array(*[F.lit(x) for x in lens]) if lens else F.array().cast("array<int>")))
    keys = keys.withColumn("_net", _v6_bound(F.col("_a.net"), F.col("_len"), "0")).drop("_a")
    best = keys.join(small(nets), ["_net", "_len"]).groupBy(prefix).agg(F.max_by("_hit", "_len").alias("_hit"))
    return probes.join(best, prefix, "left").select(*probes.columns, *[F.col(f"_hit.{c}").alias(c) for c in cols])


def city(probes: DataFrame, table: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """city_lat, city_lon of each prefix; (0, 0) in the table is a miss."""
    hit = longest_match(probes, table.select("network", F.col("lat").alias("city_lat"), F.col("lon").alias("city_lon")), known=known)
    miss = (F.col("city_lat") == 0) & (F.col("city_lon") == 0)
    return hit.select(*probes.columns, F.when(~miss, F.col("city_lat")).alias("city_lat"), F.when(~miss, F.col("city_lon")).alias("city_lon"))


def holder(probes: DataFrame, table: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """prefix_as, prefix_org of each prefix, 0 and '' on a miss; a row without number or name is a miss."""
    hit = longest_match(probes, table.select("network", F.col("asn").alias("_as"), F.col("org").alias("_org")), known=known)
    ok = F.coalesce((F.col("_as") != 0) & (F.col("_org") != ""), F.lit(False))
    return hit.select(*probes.columns, F.when(ok, F.col("_as")).otherwise(0).cast("long").alias("prefix_as"), F.when(ok, F.col("_org")).otherwise("").alias("prefix_org"))


def hijack_divergence(events: DataFrame) -> DataFrame:
    """Hijacks whose announcer isn't the registered holder."""
    return events.filter((F.col("category") == "hijack") & (F.col("prefix_as") != 0) & (F.col("prefix_as") != F.col("origin_as")))


def positions(systems: DataFrame, centroids: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """(asn, cc, asn_lat, asn_lon) of a registry of systems (asn, cc): those of countries with a known centroid."""
    places = [(k, *v) for k, v in (centroids or codes.CENTROIDS).items()]
    return systems.join(small(systems.sparkSession.createDataFrame(places, "cc string, asn_lat double, asn_lon double")), "cc").select("asn", "cc", "asn_lat", "asn_lon")


def seed_positions(spark, seeds: dict[int, str] | None = None, centroids: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """``positions`` of the systems that are known without a registry."""
    return positions(spark.createDataFrame(list((seeds or codes.SEED_ASNS).items()), "asn long, cc string"), centroids)
