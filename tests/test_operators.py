import ipaddress
import json
import random

import pytest
from pyspark.sql import functions as F

from geotide.operators import broadcast, density, dims, latest, lookup, reads, routing, segments, validate
from geotide.sources import feeds


def test_latest_merges_in_any_order(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), str(rng.randrange(5)), i, rng.randrange(20), rng.choice(["", "x", "y"])) for i in range(300)]
    df = spark.createDataFrame(rows, "asset_type string, asset_id string, n int, t int, v string").withColumn("event_time", F.timestamp_seconds("t"))
    direct = latest.partial(df, ["v"], "n").orderBy("asset_type", "asset_id").collect()
    parts = [latest.partial(df.filter(F.col("n") % 3 == k), ["v"], "n") for k in (2, 0, 1)]
    assert latest.merge(dims.union_all(*parts), "n").orderBy("asset_type", "asset_id").collect() == direct
    want = {}
    for a, i, n, t, v in rows:
        want[a, i] = max(want.get((a, i), (-1, -1, "")), (t, n, v))
    assert {(r["asset_type"], r["asset_id"]): r["payload"]["v"] for r in direct} == {k: v[2] for k, v in want.items()}


def test_density_merge(spark):
    df = spark.range(1000).select(F.timestamp_seconds(F.col("id") * 7).alias("event_time"), (F.col("id") % 3).alias("h3_cell"), F.lit("a").alias("asset_type"))
    key = ["time_bucket", "h3_cell"]
    whole = density.density(df).orderBy(*key).collect()
    assert density.merge(density.density(df.filter("event_time < timestamp '1970-01-01 00:31:00'")).unionByName(density.density(df.filter("event_time >= timestamp '1970-01-01 00:31:00'")))).orderBy(*key).collect() == whole


@pytest.mark.parametrize(
    ("change", "reason"),
    [({}, None), ({"asset_id": ""}, "empty asset_id"), ({"asset_type": None}, "empty asset_type"), ({"source": ""}, "empty source"), ({"lat": 0, "lon": 0}, "null island coordinates (0,0)"),
     ({"lat": 900000001}, "latitude out of range"), ({"lon": -1800000001}, "longitude out of range"), ({"ms": 0}, "invalid timestamp"), ({"asset_id": "", "source": ""}, "empty asset_id")],
)
def test_validation(spark, change, reason):
    row = {"asset_id": "1", "asset_type": "aircraft", "source": "s", "lat": 1, "lon": 1, "ms": 5} | change
    df = spark.createDataFrame([tuple(row.values())], "asset_id string, asset_type string, source string, lat long, lon long, ms long")
    assert df.select(validate.telemetry_reason(F.col("ms"))).first()[0] == reason


def test_dims(spark):
    old = spark.createDataFrame([("a", "img", 1), ("b", "", 1)], "k string, url string, updated_at int")
    new = spark.createDataFrame([("a", "", 2), ("c", "own", 2)], "k string, url string, updated_at int")
    assert sorted(map(tuple, dims.carry_forward(new, old, "k", ["url"]).select("k", "url").collect())) == [("a", "img"), ("c", "own")]
    assert sorted(map(tuple, dims.upsert(old, new, ["k"]).collect())) == [("a", "", 2), ("b", "", 1), ("c", "own", 2)]
    assert sorted(map(tuple, dims.overlay(old.drop("updated_at"), new.drop("updated_at"), ["k"]).collect())) == [("a", ""), ("b", ""), ("c", "own")]


def test_longest_match(spark):
    nets = ["0.0.0.0/0", "10.0.0.0/8", "10.1.0.0/16", "10.1.2.0/24", "192.168.1.128/25"]
    table = spark.createDataFrame([(n, n) for n in nets], "network string, hit string")
    probes = ["10.1.2.0/23", "10.1.3.0/24", "10.200.0.0/16", "8.8.8.0/24", "192.168.1.200/25", "192.168.1.0/24", "not-a-prefix", "", "999.999.999.0/24", "1.2.3.4", "1.2.3.4/33", None]
    got = {r["prefix"]: r["hit"] for r in lookup.longest_match(spark.createDataFrame([(p,) for p in probes], "prefix string"), table).collect()}

    def want(p):
        try:
            addr = ipaddress.ip_network(p, strict=False).network_address if "/" in p else None
        except (ValueError, TypeError):
            addr = None
        fits = [n for n in nets if addr is not None and addr in ipaddress.ip_network(n)]
        return max(fits, key=lambda n: int(n.split("/")[1]), default=None)

    assert got == {p: want(p) if p else None for p in probes}


def test_longest_match_v6(spark):
    nets = ["2001:db8::/32", "2001:db8:1::/47", "2001:db8:1:2::/64", "::/1"]
    table = spark.createDataFrame([(n, n) for n in nets], "network string, hit string")
    probes = ["2001:db8:1:2::1/64", "2001:db8:1:3::/64", "2001:db8:ffff::/48", "fe80::/10", "10.0.0.0/8", "::1", "zz::/8", None]
    got = {r["prefix"]: r["hit"] for r in lookup.longest_match_v6(spark.createDataFrame([(p,) for p in probes], "prefix string"), table).collect()}
    assert got == {probes[0]: nets[2], probes[1]: nets[1], probes[2]: nets[0], probes[3]: None, probes[4]: None, probes[5]: None, probes[6]: None, None: None}


@pytest.mark.parametrize("wide", [False, True])
def test_longest_match_in_nested_networks(spark, wide):
    """Random networks within one another and side by side, and no Python in the plan."""
    rng = random.Random(8)
    kind, bits = (ipaddress.IPv6Network, 128) if wide else (ipaddress.IPv4Network, 32)
    space = lambda: rng.choice([0, 2 ** (bits - 1), 2**bits - 2**20]) + rng.randrange(2**20)
    nets = sorted({str(kind((space(), bits - rng.randrange(0, 21)), strict=False)) for _ in range(300)} | {str(kind((0, 1)))})
    probes = sorted({str(kind((space(), bits))) for _ in range(500)} | set(nets[:50]))
    table = spark.createDataFrame([(n, n) for n in nets], "network string, hit string").repartition(3)
    match = lookup.longest_match_v6 if wide else lookup.longest_match
    out = match(spark.createDataFrame([(p,) for p in [*probes, *probes[:20]]], "prefix string"), table)
    known = [kind(n) for n in nets]
    want = {p: max((n for n in known if kind(p).network_address in n), key=lambda n: n.prefixlen, default=None) for p in probes}
    got = out.collect()
    assert len(got) == len(probes) + 20 and all(r["hit"] == (str(want[r["prefix"]]) if want[r["prefix"]] else None) for r in got)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert match(spark.createDataFrame([(probes[0],)], "prefix string"), table.limit(0)).first()["hit"] is None


def test_v6_text(spark):
    good = ["::/0", "::1/128", "1::/16", "1:2:3:4:5:6:7:8/64", "2001:DB8::F/33", "::ffff:1.2.3.4/120", "1:2:3:4:5:6:7::/112", "::2:3:4:5:6:7:8/128", "fe80::1:2/127", "1:2:3:4:5:6:9.8.7.6/125"]
    bad = ["1:2:3:4:5:6:7:8:9/64", "1:2:3:4:5:6:7/64", "::1::/64", ":::1/64", "12345::/16", "g::/16", "::/129", "::", "1.2.3.4/8", "::ffff:1.2.3.400/120", "", None, "::1/1/2", "1:2:3:4:5:6:7:8::/64"]
    df = spark.createDataFrame([(t,) for t in good + bad], "t string").withColumn("n", lookup.v6_network(F.col("t")))
    for r in df.collect():
        if r["t"] in good:
            net = ipaddress.IPv6Network(r["t"], strict=False)
            assert tuple(r["n"]) == (f"{int(net.network_address):032x}", f"{int(net.broadcast_address):032x}", net.prefixlen), r
        else:
            assert r["n"] is None, r


def test_paths(spark):
    rows = [(["14061", "174", "[15169,13335]"],), (["174", "x", "64500"],), ([],), (["64500", "4294967296", "-1"],), (None,)]
    df = spark.createDataFrame(rows, "p array<string>").select(routing.flat_path(F.col("p")).alias("f"))
    got = df.select("f", routing.origin(F.col("f")), routing.leaks(F.col("f"))).collect()
    assert [tuple(r) for r in got] == [([14061, 174, 15169, 13335], 13335, True), ([174, 64500], 64500, False), ([], None, False), ([64500], 64500, False), ([], None, False)]


def reference_classes(ops):
    state, out = {}, []
    for seq, prefix, op, origin, leak in ops:
        known, prev = prefix in state, state.get(prefix)
        if op == "W":
            state.pop(prefix, None)
            kind = "withdrawal" if known else None
        else:
            state[prefix] = origin
            kind = "leak" if leak else "hijack" if known and prev != origin else None if known else "announcement"
        if kind:
            out.append((seq, prefix, kind))
    return out


def test_classify_against_replay(spark):
    rng = random.Random(9)
    ops = [(i, f"p{rng.randrange(40)}", rng.choice("AAAW"), rng.randrange(3), rng.random() < 0.1) for i in range(3000)]
    ops = [(i, p, o, a, leak and o == "A") for i, p, o, a, leak in ops]
    df = spark.createDataFrame(ops, "seq long, prefix string, op string, origin_as long, is_leak boolean")
    got = sorted(map(tuple, routing.classify(df, ["seq"]).select("seq", "prefix", "category").collect()))
    assert got == sorted(reference_classes(ops))


@pytest.mark.parametrize("kind", ["long", "timestamp"])
def test_classify_a_hot_prefix(spark, kind):
    """One prefix on half of the rows: the same as replay, and its rows are dealt over all tasks."""
    rng = random.Random(5)
    ops = [(i, "hot" if rng.random() < 0.5 else f"p{rng.randrange(300)}", rng.choice("AAAW"), rng.randrange(3), False) for i in range(12_000)]
    df = spark.createDataFrame(ops, "seq long, prefix string, op string, origin_as long, is_leak boolean").repartition(4)
    if kind == "timestamp":
        df = df.withColumn("at", F.timestamp_seconds("seq"))
    out = routing.classify(df, ["at" if kind == "timestamp" else "seq"])
    assert sorted(map(tuple, out.select("seq", "prefix", "category").collect())) == sorted(reference_classes(ops))
    dealt = df.withColumn("s", segments.segment(df, "at" if kind == "timestamp" else "seq"))
    assert dealt.select("s").distinct().count() == segments.SEGMENTS * 4
    sizes = sorted(r["count"] for r in dealt.repartition(4, "prefix", "s").groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 4 and sizes[-1] < 2 * (sizes[1] + sizes[2]) / 2


def test_classify_without_rows_or_order(spark):
    schema = "seq long, prefix string, op string, origin_as long, is_leak boolean"
    assert routing.classify(spark.createDataFrame([], schema), ["seq"]).count() == 0
    one = [(None, "p", "A", 1, False), (3, "p", "A", 2, False), (3, "q", "A", 1, False)]
    assert sorted((r["prefix"], r["category"]) for r in routing.classify(spark.createDataFrame(one, schema), ["seq"]).collect()) == [("p", "announcement"), ("p", "hijack"), ("q", "announcement")]


def update(ts, host="rrc00", path=(), ann=(), wd=(), peer="3356", kind="UPDATE"):
    data = {"timestamp": ts, "peer_asn": peer, "host": host, "type": kind, "path": list(path), "announcements": [{"next_hop": "1.1.1.1", "prefixes": list(ann)}] if ann else None, "withdrawals": list(wd)}
    return json.dumps({"type": "ris_message", "data": data})


def test_updates_to_events(spark):
    bodies = [
        update(1712345678.5, path=[15169], ann=["8.8.8.0/24"]), update(1712345679, path=[15169], ann=["8.8.8.0/24"]), update(1712345680, path=[13335], ann=["8.8.8.0/24"]),
        update(1712345681, wd=["8.8.8.0/24", "9.9.9.0/24"]), update(1712345682, path=[14061, 174, 15169], ann=["1.0.0.0/24"]), update(1712345683, path=[14061, 174, [15169, 13335]], ann=["2.0.0.0/24"]),
        update(1712345684, path=[64500], ann=["3.0.0.0/24"]), update(1712345685, kind="OPEN", path=[15169], ann=["4.0.0.0/24"]), '{"type":"ris_error"}', "{",
    ]
    df = spark.createDataFrame(list(enumerate(bodies)), "seq long, body string")
    ev = routing.classify(feeds.ris_operations(df, ["seq"]), ["seq", "op", "a_no", "p_no"]).withColumn("event_no", F.concat_ws("/", "seq", "prefix"))
    cities = spark.createDataFrame([("8.8.8.0/24", 0.0, 0.0)], "network string, lat double, lon double")
    pos = lookup.seed_positions(spark)
    out = routing.build(routing.path_coords(routing.locate(ev, cities, pos, "event_no"), pos, "event_no"), "ris")
    got = {(r["seq"], r["category"]): r for r in out.collect()}
    assert set(got) == {(0, "announcement"), (2, "hijack"), (3, "withdrawal"), (4, "leak"), (5, "leak")}
    first = got[0, "announcement"]
    assert first["origin_as"] == 15169 and len(first["path_coords"]) == 2 and first["event_id"].startswith("bgp-")
    assert got[3, "withdrawal"]["origin_as"] == 3356 and got[3, "withdrawal"]["as_path"] == [] and len(got[4, "leak"]["path_coords"]) == 6
    assert got[5, "leak"]["origin_as"] == 13335 and len(got[5, "leak"]["path_coords"]) == 8
    assert out.filter("seq = 0").select(F.unix_millis("event_time")).first()[0] == 1712345678500


def test_prune(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("prefix"), F.timestamp_seconds("id").alias("last_seen"))
    assert routing.prune(df, 100).count() == 100
    kept = routing.prune(df, 80)
    assert kept.count() == 60 and kept.agg(F.min("last_seen")).collect() == df.filter("id = 40").select("last_seen").collect()


def test_fan_out(spark):
    from geotide.functions import cells

    df = spark.createDataFrame([(1, 51.5, -0.1), (2, 95.0, 0.0)], "id int, lat double, lon double").withColumn("h3_cell", cells.cell(F.col("lat"), F.col("lon")))
    got = broadcast.telemetry(df.select("id", "h3_cell")).collect()
    assert sorted(r["res"] for r in got) == [2, 3, 4, 5, 6, 7] and len({r["stream"] for r in got}) == 6
    assert [r["stream"][:4] for r in broadcast.bgp(df.select("id", "h3_cell")).collect()] == ["bgp:"]


def test_viewport_and_recency(spark):
    from geotide.functions import cells

    df = spark.range(1000).select("id", F.timestamp_seconds(F.col("id") * 60).alias("event_time"), cells.cell(F.col("id") % 80, F.col("id") % 170).alias("h3_cell"))
    now = F.timestamp_seconds(F.lit(999 * 60))
    assert [r["id"] for r in reads.recent(df, now, 15, 5, ("id",)).collect()] == [999, 998, 997, 996, 995]
    seen = df.filter("id = 1").select(cells.parent(F.col("h3_cell"), 2).alias("cell"))
    inside = {r["id"] for r in reads.in_viewport(df, seen, 2).collect()}
    assert 1 in inside and 0 < len(inside) < 1000


def test_seed_positions_take_other_tables(spark):
    got = lookup.seed_positions(spark, {1: "AA", 2: "BB"}, {"AA": (1.0, 2.0)}).collect()
    assert [tuple(r) for r in got] == [(1, "AA", 1.0, 2.0)]


def test_positions_in_the_plan_and_joined(spark, monkeypatch):
    rows = [(1, "A", 701, [701, 5, 13335], "8.8.8.0/24"), (2, "A", 5, [5], "9.9.9.0/24"), (3, "W", 3356, [], "7.7.7.0/24"), (4, "A", None, None, "bad"), (5, "A", 15169, [15169, 15169, 5], "8.8.8.128/25")]
    events = spark.createDataFrame(rows, "id long, op string, origin_as long, as_path array<long>, prefix string")
    cities = spark.createDataFrame([("8.8.8.128/25", 1.0, 2.0)], "network string, lat double, lon double")
    got = []
    for most in (500, 0):
        monkeypatch.setattr(routing, "PLAN_ROWS", most)
        where = lookup.seed_positions(spark)
        got.append([routing.path_coords(events, where, "id").orderBy("id").collect(), routing.locate(events, cities, where, "id").select("id", "lat_deg", "lon_deg").orderBy("id").collect()])
    assert got[0] == got[1] and [len(r["path_coords"]) for r in got[0][0]] == [4, 0, 0, 0, 4]
    assert [(r["id"], r["lat_deg"]) for r in got[0][1]] == [(1, 37.09), (3, 37.09), (5, 1.0)]
    empty = routing.path_coords(events, spark.createDataFrame([], "asn long, asn_lat double, asn_lon double"), "id")
    assert all(r["path_coords"] == [] for r in empty.collect())


def test_repeated_systems_have_one_position(spark, monkeypatch):
    events = spark.createDataFrame([(1, "A", 3, [1, 2, 3], "bad")], "id long, op string, origin_as long, as_path array<long>, prefix string")
    where = spark.createDataFrame([(1, 1.0, 1.0), (2, 5.0, 5.0), (2, 2.0, 9.0), (2, 2.0, 8.0), (3, 3.0, 3.0), (None, 7.0, 7.0)], "asn long, asn_lat double, asn_lon double")
    for most in (500, 0):
        monkeypatch.setattr(routing, "PLAN_ROWS", most)
        assert routing.path_coords(events, where, "id").first()["path_coords"] == [10**7, 10**7, 2 * 10**7, 8 * 10**7, 3 * 10**7, 3 * 10**7]
