"""The IP database reader against databases that the test writes itself."""

import ipaddress
import struct

import pytest

from geotide.operators import lookup
from geotide.sources import mmdb


def encode(x):
    def head(kind, size):
        ext = b"" if kind < 8 else bytes([kind - 7])
        top = 0 if kind >= 8 else kind << 5
        if size < 29:
            return bytes([top | size]) + ext
        if size < 285:
            return bytes([top | 29]) + ext + bytes([size - 29])
        return bytes([top | 30]) + ext + struct.pack(">H", size - 285)

    if isinstance(x, str):
        return head(2, len(x.encode())) + x.encode()
    if isinstance(x, float):
        return head(3, 8) + struct.pack(">d", x)
    if isinstance(x, bool):
        return head(14, int(x))
    if isinstance(x, int):
        raw = x.to_bytes((x.bit_length() + 7) // 8, "big")
        return head(6 if x < 2**32 else 9, len(raw)) + raw
    if isinstance(x, list):
        return head(11, len(x)) + b"".join(map(encode, x))
    return head(7, len(x)) + b"".join(encode(k) + encode(v) for k, v in x.items())


def write(path, networks, version, bits):
    wide = 128 if version == 6 else 32
    root = [None, None]
    data, at = b"", {}
    for cidr, record in networks:
        net = ipaddress.ip_network(cidr)
        address, depth = int(net.network_address), net.prefixlen
        if version == 6 and net.version == 4:
            depth += 96
        body = encode(record)
        if body not in at:
            at[body] = len(data)
            data += body
        node = root
        for d in range(depth):
            bit = address >> (wide - 1 - d) & 1
            if d == depth - 1:
                node[bit] = at[body]
            else:
                if not isinstance(node[bit], list):
                    node[bit] = [node[bit], node[bit]]
                node = node[bit]
    order, number = [root], {id(root): 0}
    for node in order:
        for c in node:
            if isinstance(c, list):
                number[id(c)] = len(order)
                order.append(c)
    n, tree = len(order), b""
    for node in order:
        l, r = (n if c is None else number[id(c)] if isinstance(c, list) else n + 16 + c for c in node)
        if bits == 28:
            tree += (l & 0xFFFFFF).to_bytes(3, "big") + bytes([(l >> 24) << 4 | r >> 24]) + (r & 0xFFFFFF).to_bytes(3, "big")
        else:
            tree += l.to_bytes(bits // 8, "big") + r.to_bytes(bits // 8, "big")
    meta = {"node_count": n, "record_size": bits, "ip_version": version, "build_epoch": 1700000000, "database_type": "t", "languages": ["en"], "more": True}
    path.write_bytes(tree + bytes(16) + data + b"\xab\xcd\xefMaxMind.com" + encode(meta))


CITIES = [("1.0.0.0/8", (10.5, 20.5)), ("1.2.0.0/16", (11.0, 21.0)), ("1.2.3.0/24", (12.0, 22.0)), ("128.0.0.0/3", (-1.0, -2.0)), ("200.1.1.1/32", (3.0, 4.0))]


@pytest.mark.parametrize(("version", "bits"), [(4, 24), (4, 28), (4, 32), (6, 24), (6, 28)])
def test_city_lookup(spark, tmp_path, version, bits):
    path = tmp_path / "city.mmdb"
    records = [(c, {"location": {"latitude": lat, "longitude": lon}, "city": {"names": {"en": "x" * 300}}}) for c, (lat, lon) in CITIES]
    if version == 6:
        records += [("2001:db8::/32", {"location": {"latitude": 7.0, "longitude": 8.0}}), ("2400::/12", {"country": "no location"})]
    write(path, records, version, bits)
    table, built = mmdb.read(spark, str(path), mmdb.CITY)
    assert built.timestamp() == 1700000000
    covered = {}
    for r in table.collect():
        net = ipaddress.ip_network(r["network"])
        assert net not in covered
        covered[net] = (r["lat"], r["lon"])
    v4 = [n for n in covered if n.version == 4]
    assert sum(n.num_addresses for n in v4) == 2**24 + 2**29 + 1  # every address once
    if version == 6:
        assert covered[ipaddress.ip_network("2001:db8::/32")] == (7.0, 8.0) and len([n for n in covered if n.version == 6]) == 1
    probes = spark.createDataFrame([(x,) for x in ("1.2.3.0/24", "1.2.9.0/24", "1.9.9.0/24", "150.0.0.0/8", "200.1.1.1/32", "9.9.9.0/24")], "prefix string")
    got = {r["prefix"]: r["city_lat"] for r in lookup.city(probes, table).collect()}
    assert got == {"1.2.3.0/24": 12.0, "1.2.9.0/24": 11.0, "1.9.9.0/24": 10.5, "150.0.0.0/8": -1.0, "200.1.1.1/32": 3.0, "9.9.9.0/24": None}


def test_holders(spark, tmp_path):
    write(tmp_path / "asn.mmdb", [("8.8.8.0/24", {"autonomous_system_number": 15169, "autonomous_system_organization": "Org"})], 4, 24)
    table, _ = mmdb.read(spark, str(tmp_path / "asn.mmdb"), mmdb.HOLDER)
    assert [tuple(r) for r in table.collect()] == [("8.8.8.0/24", 15169, "Org")]


def test_opening_fails_fast(spark, tmp_path):
    (tmp_path / "x.mmdb").write_bytes(b"not a database")
    (tmp_path / "y.mmdb").write_bytes(b"x" * 50 + b"\xab\xcd\xefMaxMind.com" + encode({"node_count": 1}))
    for path, error in (("", ValueError), (str(tmp_path / "none"), FileNotFoundError), (str(tmp_path / "x.mmdb"), ValueError), (str(tmp_path / "y.mmdb"), ValueError)):
        with pytest.raises(error):
            mmdb.read(spark, path, mmdb.CITY)
