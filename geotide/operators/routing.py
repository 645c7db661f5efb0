"""Routing events: path functions, per-prefix classification, positions.

What a prefix's state says is settled by the previous operation on it (known
with origin X exactly if that was an announcement by X), so classification is
``lag`` over the prefix's operations in arrival order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geotide import codes
from geotide.functions import cells, scalar
from geotide.operators import lookup
from geotide.operators.segments import segment

_U32 = 2**32 - 1


def flat_path(path: Column) -> Column:
    """array<string> of numbers and of JSON arrays of numbers, in order, as array<long>; other elements drop."""
    inner = lambda x: F.when(F.trim(x).startswith("["), F.from_json(x, "array<long>")).otherwise(F.array(x.try_cast("long")))
    flat = F.flatten(F.transform(path, lambda x: F.coalesce(inner(x), F.array().cast("array<long>"))))
    return F.coalesce(F.filter(flat, lambda x: x.between(0, _U32)), F.array().cast("array<long>"))


def origin(path: Column) -> Column:
    """The announcing system: the last of the path; null if it is empty."""
    return F.try_element_at(path, F.lit(-1))


def leaks(path: Column) -> Column:
    """A default-free-zone provider stands behind one that isn't."""
    tier1 = lambda x: x.isin(codes.TIER1_ASNS)
    first_other = F.array_position(F.transform(path, lambda x: ~tier1(x)), True)
    rest = F.slice(path, F.greatest(first_other, F.lit(1)).cast("int"), F.greatest(F.size(path), F.lit(1)))
    return F.coalesce((first_other > 0) & F.exists(rest, tier1), F.lit(False))


def operations(messages: DataFrame) -> DataFrame:
    """One row a prefix operation: (message columns..., prefix, op, a_no, p_no), announcements before withdrawals.

    ``messages`` has announcements array<struct<prefixes: array<string>>>,
    withdrawals array<string> and as_path array<long>; messages without a path
    announce nothing.
    """
    keep = [c for c in messages.columns if c not in ("announcements", "withdrawals")]
    ann = messages.filter(F.size("as_path") > 0).select(*keep, F.posexplode("announcements").alias("a_no", "a")).select(*keep, "a_no", F.posexplode("a.prefixes").alias("p_no", "prefix"))
    wd = messages.select(*keep, F.lit(0).alias("a_no"), F.posexplode("withdrawals").alias("p_no", "prefix"))
    return ann.withColumn("op", F.lit("A")).unionByName(wd.withColumn("op", F.lit("W")))


def classify(ops: DataFrame, order: list[str]) -> DataFrame:
    """Operations that are events, with ``category``; needs prefix, op ('A' or 'W'), origin_as, is_leak.

    Leaks are events however often they repeat; an announcement is a hijack if
    the prefix was last announced by another system, is new if it was unknown
    or withdrawn, and else isn't an event; a withdrawal is one if the prefix
    was known.  ``order`` is the arrival order; 'A' sorts before 'W' in it.

    A prefix may have any share of the rows: its operations are dealt in
    ranges of the first order column (a number or a time), and each range
    begins with the last operation of the one before it.
    """
    ops = ops.withColumn("_segment", segment(ops, order[0]))
    last = ops.groupBy("prefix", "_segment").agg(F.max_by(F.struct("op", "origin_as"), F.struct(*order)).alias("_l"))
    begins = Window.partitionBy("prefix").orderBy("_segment")
    carried = last.withColumn("_l", F.lag("_l").over(begins)).filter("_l is not null").select("prefix", "_segment", "_l.*", F.lit(True).alias("_carried"))
    w = Window.partitionBy("prefix", "_segment").orderBy(F.col("_carried").asc_nulls_last(), *order)
    both = ops.unionByName(carried, allowMissingColumns=True)
    both = both.withColumn("_op", F.lag("op").over(w)).withColumn("_origin", F.lag("origin_as").over(w)).filter("_carried is null")
    known = F.coalesce(F.col("_op") == "A", F.lit(False))
    category = (
        F.when(F.col("op") == "W", F.when(known, "withdrawal"))
        .when(F.col("is_leak"), "leak")
        .when(known & (F.col("_origin") != F.col("origin_as")), "hijack")
        .when(~known, "announcement")
    )
    return both.withColumn("category", category).filter("category is not null").drop("_op", "_origin", "_segment", "_carried")


#: Position tables up to this many systems go into the plan; larger ones are joined.
PLAN_ROWS = 500


def _by_number(positions: DataFrame) -> DataFrame:
    """One position a system: of several the one furthest south, then west."""
    return positions.filter("asn is not null").groupBy("asn").agg(F.min(F.struct("asn_lat", "asn_lon")).alias("_p")).select("asn", "_p.*")


def _in_plan(positions: DataFrame) -> Callable[[Column], Column] | None:
    """A function from a system's number to its position, if the table is small: arrays by remainder, so that a look-up compares a few numbers."""
    rows = positions.select("asn", "asn_lat", "asn_lon").limit(PLAN_ROWS + 1).collect()
    if len(rows) > PLAN_ROWS:
        return None
    null_first = lambda r: [(v is not None, v or 0) for v in r]
    rows = list({r["asn"]: r for r in sorted(rows, key=null_first, reverse=True) if r["asn"] is not None}.values())  # as _by_number
    kind = "array<array<struct<asn: bigint, asn_lat: double, asn_lon: double>>>"
    buckets = [[F.struct(*[F.lit(v) for v in r]) for r in rows if r["asn"] % len(rows) == k] for k in range(len(rows))]
    table = F.array(*[F.array(*b) for b in buckets]).cast(kind) if rows else F.array().cast(kind)
    return lambda x: F.try_element_at(F.filter(F.try_element_at(table, F.pmod(x, F.lit(max(1, len(rows)))).cast("int") + 1), lambda r: r["asn"] == x), F.lit(1))


def _places(path: Column, place: Callable[[Column], Column]) -> Column:
    """Positions of the hops that are known, in path order."""
    return F.filter(F.transform(path, place), lambda x: x.isNotNull())


def path_coords(events: DataFrame, positions: DataFrame, key: str) -> DataFrame:
    """Adds path_coords: scaled lat, lon of each hop that is known, in path order.

    ``key`` identifies an event; it matters only where the position table is
    too large for the plan and hops are joined with it.
    """
    both = lambda x: F.array(scalar.scale_degrees(x["asn_lat"]), scalar.scale_degrees(x["asn_lon"]))
    none = F.array().cast("array<int>")
    if (table := _in_plan(positions)) is not None:
        return events.withColumn("path_coords", F.coalesce(F.flatten(F.transform(_places(F.col("as_path"), table), both)), none))
    hops = events.select(key, F.posexplode("as_path").alias("_i", "asn")).join(lookup.small(_by_number(positions)), "asn")
    got = hops.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_i", both(F.struct("asn_lat", "asn_lon")).alias("c")))).alias("_h"))
    out = events.join(got, key, "left")
    return out.withColumn("path_coords", F.coalesce(F.flatten(F.col("_h.c")), none)).drop("_h")


def locate(events: DataFrame, cities: DataFrame, positions: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """Adds lat_deg, lon_deg: the prefix's city, else the last path hop (withdrawals: the peer) with a known position; drops the rest.

    ``positions`` is the ASN table of this module's seeds or a refreshed one;
    ``key`` identifies an event (see ``path_coords``), ``known`` is as in
    ``lookup.longest_match``.
    """
    hops = F.when(F.col("op") == "W", F.array("origin_as")).otherwise(F.col("as_path"))
    if (table := _in_plan(positions)) is not None:
        out = lookup.city(events.withColumn("_hop", F.try_element_at(_places(hops, table), F.lit(-1))), cities, known)
    else:
        hop = events.select(key, F.posexplode(hops).alias("_i", "asn")).join(lookup.small(_by_number(positions)), "asn")
        last = hop.groupBy(key).agg(F.max_by(F.struct("asn_lat", "asn_lon"), "_i").alias("_hop"))
        out = lookup.city(events, cities, known).join(last, key, "left")
    out = out.withColumn("lat_deg", F.coalesce("city_lat", "_hop.asn_lat")).withColumn("lon_deg", F.coalesce("city_lon", "_hop.asn_lon"))
    return out.filter(F.col("lat_deg").isNotNull()).drop("city_lat", "city_lon", "_hop")


def build(events: DataFrame, source: str) -> DataFrame:
    """The canonical routing event: id, scaled position, cell."""
    out = events.withColumn("event_id", scalar.routing_event_id(F.unix_millis("event_time"), F.col("prefix"), F.col("category"), F.col("origin_as")))
    out = out.withColumn("lat", scalar.scale_degrees(F.col("lat_deg"))).withColumn("lon", scalar.scale_degrees(F.col("lon_deg")))
    out = out.withColumn("h3_cell", F.coalesce(cells.cell(F.col("lat_deg"), F.col("lon_deg")), F.lit(0).cast("long"))).withColumn("source", F.lit(source))
    return out.withColumn("as_path", F.when(F.col("op") == "W", F.array().cast("array<long>")).otherwise(F.col("as_path")))


def prune(state: DataFrame, limit: int = codes.MAX_PREFIXES, keep_share: float = 0.75) -> DataFrame:
    """The (prefix, last_seen) state cut to the newest share of ``limit`` if it holds more than that."""
    return state if state.limit(limit + 1).count() <= limit else state.orderBy(F.col("last_seen").desc(), "prefix").limit(int(limit * keep_share))
