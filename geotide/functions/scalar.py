"""Scalar column functions: coordinates, codes, times, identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geotide import codes

#: Fixed value: what 64-bit FNV-1a starts from.
_FNV_BASIS = 14695981039346656037


def scale_degrees(deg: Column) -> Column:
    """Degrees as int of 1e-7, halves away from zero; null if it doesn't fit."""
    return F.round(deg * 1e7).try_cast("int")


def truncate(x: Column) -> Column:
    """Toward zero, as int; null if it doesn't fit."""
    return x.try_cast("int")


def label(code: Column, labels: list[str], otherwise: str) -> Column:
    """``labels[code]``, or ``otherwise`` for null and codes outside."""
    inside = (code >= 0) & (code < len(labels))
    return F.coalesce(F.when(inside, F.get(F.array(*map(F.lit, labels)), code.cast("int"))), F.lit(otherwise))


def emitter_category(code: Column) -> Column:
    return label(code, codes.EMITTER_CATEGORIES, "")


def nav_status(code: Column) -> Column:
    return label(code, codes.NAV_STATES, "not_defined")


def ship_type(code: Column) -> Column:
    first, last, name = codes.SHIP_TYPES[0]
    out = F.when(code.between(first, last), name)
    for first, last, name in codes.SHIP_TYPES[1:]:
        out = out.when(code.between(first, last), name)
    for tens, name in codes.SHIP_TYPE_TENS.items():
        out = out.when(code.between(tens * 10, tens * 10 + 9), name)
    return out.otherwise("other")


def eta(month: Column, day: Column, hour: Column, minute: Column) -> Column:
    """MM-DD HH:MM, empty without month or day."""
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("int")
    text = F.format_string("%02d-%02d %02d:%02d", *map(zero, (month, day, hour, minute)))
    return F.when((month > 0) & (day > 0), text).otherwise("")


def feed_time(text: Column) -> Column:
    """RFC 3339, or ``YYYY-MM-DD hh:mm:ss[.f] +0000 UTC``; else null."""
    rfc = F.when(text.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:\d\d)$"), F.try_to_timestamp(text))
    utc = text.rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(\.\d+)? \+0000 UTC$")
    return F.coalesce(rfc, F.when(utc, F.try_to_timestamp(F.regexp_replace(text, r" \+0000 UTC$", "Z"))))


def launch_date(text: Column) -> Column:
    """``1998 Nov 20``, ``1998 Nov  5`` or ``1998-11-20``; else null."""
    flat = F.regexp_replace(F.trim(text), r"\s+", " ")
    named = F.when(flat.rlike(r"^\d{4} [A-Z][a-z]{2} \d{1,2}$"), F.to_date(F.try_to_timestamp(flat, F.lit("yyyy MMM d"))))
    iso = F.when(flat.rlike(r"^\d{4}-\d\d-\d\d$"), F.to_date(F.try_to_timestamp(flat, F.lit("yyyy-MM-dd"))))
    return F.coalesce(named, iso)


def missing(text: Column) -> Column:
    """Trimmed, with '' and '-' as null."""
    t = F.trim(text)
    return F.when((t != "") & (t != "-"), t)


def asn(text: Column) -> Column:
    """AS number as long, with or without an AS prefix in any case; null if not an unsigned 32-bit number."""
    n = F.regexp_extract(F.trim(text), r"^(?i:AS)?(\d+)$", 1).try_cast("long")
    return F.when(n.between(0, 2**32 - 1), n)


def wrap(x: Column, bits: int) -> Column:
    """As an unsigned integer of so many bits, wrapping around."""
    return F.pmod(x.cast("long"), F.lit(2**bits))


def _utf8(text: Column) -> Column:
    """The UTF-8 bytes as array<long>; ASCII text, where characters are bytes, goes the short way."""
    none, n = F.array().cast("array<bigint>"), F.octet_length(text)
    plain = F.transform(F.split(text, ""), lambda c: F.ascii(c).cast("long"))
    hexed = F.hex(F.encode(text, "utf-8"))
    coded = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.conv(F.substr(hexed, i * 2 + 1, F.lit(2)), 16, 10).cast("long"))
    return F.when(n == 0, none).when(n == F.length(text), plain).otherwise(coded)


def fnv1a(text: Column) -> Column:
    """64-bit FNV-1a of the UTF-8 bytes as decimal(20,0).

    The state is two 32-bit halves in longs.  The prime is 2**40 + 435, so a
    product mod 2**64 is both halves times 435 with a carry, and the lower
    half shifted into the upper one.
    """
    mask = F.lit(2**32 - 1).cast("long")
    shift = lambda name, c, n: F.call_function(name, c, F.lit(n))

    def step(s: Column, byte: Column) -> Column:
        low = s["lo"].bitwiseXOR(byte)
        product = low * 435
        high = s["hi"] * 435 + shift("shiftleft", low, 8) + shift("shiftright", product, 32)
        return F.struct(high.bitwiseAND(mask).alias("hi"), product.bitwiseAND(mask).alias("lo"))

    start = F.struct(F.lit(_FNV_BASIS >> 32).cast("long").alias("hi"), F.lit(_FNV_BASIS & 2**32 - 1).cast("long").alias("lo"))
    whole = lambda s: s["hi"].cast("decimal(10,0)") * F.lit(2**32).cast("decimal(10,0)") + s["lo"].cast("decimal(10,0)")
    return F.aggregate(_utf8(text), start, step, whole).cast("decimal(20,0)")


def hex64(x: Column) -> Column:
    """Unsigned 64-bit decimal as lower-case hex without padding."""
    return F.lower(F.conv(x.cast("string"), 10, 16))


def routing_event_id(ts_millis: Column, prefix: Column, category: Column, origin: Column) -> Column:
    text = F.concat_ws("|", ts_millis.cast("string"), prefix, category, origin.cast("string"))
    return F.concat(F.lit("bgp-"), hex64(fnv1a(text)))
