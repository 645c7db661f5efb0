"""Files: quoted CSV, commented TSV, element text, object listings, and the partitioned store."""

from __future__ import annotations

import datetime as dt
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geotide.functions import scalar
from geotide.schemas import struct

AIRCRAFT = {
    "icao24": "icao24", "registration": "registration", "manufacturername": "manufacturer", "model": "model", "typecode": "typecode",
    "icaoaircraftclass": "icao_class", "operator": "operator", "operatorcallsign": "operator_callsign", "operatoricao": "operator_icao",
    "operatoriata": "operator_iata", "owner": "owner", "built": "built", "status": "status", "categorydescription": "category_description",
}
SATELLITE = {
    "satcat": "satcat", "#jcat": "jcat", "jcat": "jcat", "name": "name", "plname": "name", "owner": "owner", "state": "state", "type": "objtype",
    "ldate": "ldate", "mass": "mass", "perigee": "perigee", "apogee": "apogee", "inc": "inc", "status": "status",
}


def aircraft_rows(lines: DataFrame, header: str) -> DataFrame:
    """Aircraft from data lines (column ``line``) of a single-quoted CSV whose header line is given.

    Columns are mapped by name, in any case and order; unknown ones are
    ignored.  Lines of another field count than the header, and rows without
    icao24, drop.
    """
    names = [x.strip().strip("'\"") for x in header.split(",")]
    schema = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    rows = lines.withColumn("r", F.from_csv("line", schema, {"quote": "'", "escape": "'"}))
    last = F.col(f"r.c{len(names) - 1}")
    rows = rows.filter(F.col(f"r.c{len(names)}").isNull() & (last.isNotNull() | F.col("line").rlike("(,|'')$")))
    at = {AIRCRAFT[n.lower()]: i for i, n in reversed(list(enumerate(names))) if n.lower() in AIRCRAFT}
    out = {}
    for col in dict.fromkeys(AIRCRAFT.values()):
        c = F.coalesce(F.trim(F.col(f"r.c{at[col]}")), F.lit("")) if col in at else F.lit("")
        out[col] = F.upper(c) if col == "icao24" else c
    return rows.select(*[c.alias(k) for k, c in out.items()]).filter("icao24 <> ''")


def read_aircraft(spark: SparkSession, path: str) -> DataFrame:
    """A whole CSV file or folder of files with one header line each."""
    text = spark.read.text(path)
    header = text.first()["value"]
    lines = text.filter((F.col("value") != header) & (F.trim("value") != "")).select(F.col("value").alias("line"))
    return aircraft_rows(lines, header)


def satellite_rows(lines: DataFrame, header: str) -> DataFrame:
    """Satellites from lines of a tab-separated catalogue; blank and '#' lines drop, short rows are read as far as they go.

    '' and '-' are missing.  Of two columns with the same meaning the leftmost
    with a value counts.  A row needs a catalogue name or a number.
    """
    names = [x.strip().lower() for x in header.split("\t")]
    rows = lines.filter((F.trim("line") != "") & ~F.col("line").startswith("#")).withColumn("f", F.split("line", "\t"))
    found = {}
    for col in dict.fromkeys(SATELLITE.values()):
        at = [i for i, n in enumerate(names) if SATELLITE.get(n) == col]
        found[col] = F.coalesce(*[scalar.missing(F.get("f", F.lit(i))) for i in at], F.lit(None).cast("string"))
    number = F.when(found["satcat"].rlike(r"^\d+$"), found["satcat"].try_cast("long"))
    number = F.coalesce(F.when(number < 2**32, number), F.lit(0).cast("long"))
    blank, real = (lambda k: F.coalesce(found[k], F.lit("")).alias(k)), (lambda k, to: F.coalesce(found[k].try_cast("float"), F.lit(0.0)).cast("float").alias(to))
    out = rows.select(
        number.alias("norad_cat_id"), blank("jcat"), F.coalesce(found["name"], F.lit("")).alias("object_name"), blank("owner"), blank("state"),
        blank("objtype").alias("object_type"), scalar.launch_date(found["ldate"]).alias("launch_date"), real("mass", "mass_kg"), real("perigee", "perigee_km"),
        real("apogee", "apogee_km"), real("inc", "inclination"), blank("status"), F.lit("").alias("purpose"),
    )
    return out.filter("jcat <> '' or norad_cat_id <> 0").withColumn("sat_key", F.when(F.col("norad_cat_id") != 0, F.col("norad_cat_id").cast("string")).otherwise(F.col("jcat")))


def read_satellites(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path)
    return satellite_rows(text.select(F.col("value").alias("line")), text.first()["value"])


_ELEMENTS = "name string, norad_id long, epoch_ms long, inclination double, raan double, eccentricity double, arg_perigee double, mean_anomaly double, mean_motion double, bstar double"


#: Alpha-5: a letter for the first two digits of a six-digit catalogue number, from 10 on.
ALPHA_5 = "ABCDEFGHJKLMNPQRSTUVWXYZ"
_WIDE = re.compile(r"1 ([0-9]{6,})[ A-Z].*\n2 \1 ")


def element_number(n: Column) -> Column:
    """A catalogue number as element text has it: five digits, from 100,000 Alpha-5, from 340,000 all digits."""
    alpha = F.concat(F.substr(F.lit(ALPHA_5), F.floor(n / 10_000).cast("int") - 9, F.lit(1)), F.format_string("%04d", n % 10_000))
    return F.when((n >= 100_000) & (n < 340_000), alpha).otherwise(F.format_string("%05d", n))


def _parse_number(text: str) -> int:
    lead = ALPHA_5.find(text[0])
    n = int(text) if lead < 0 else (lead + 10) * 10_000 + int(text[1:])
    if n >= 2**63 or (lead >= 0 and not text[1:].isdigit()):
        raise ValueError(f"catalogue number {text}")
    return n


def _widening(one: str, two: str) -> int:
    """Columns by which a catalogue number of more than five digits moves those behind it; both lines must have it."""
    wide = _WIDE.match(f"{one}\n{two}")
    return len(wide[1]) - 5 if wide else 0


def parse_elements(text: str) -> list[tuple]:
    """Two- and three-line element sets of a whole text, in any mixture; a bad set costs only its own lines.

    A line 1 is one that starts with '1 ' and is followed by one that starts
    with '2 ', so a name may begin with any character and a last two-line set
    counts.  Catalogue numbers are digits, of which more than five move the
    columns behind them in both lines, or Alpha-5.
    """
    lines = [x.rstrip() for x in text.replace("\r", "").split("\n") if x.strip()]
    out, i = [], 0
    is_pair = lambda k: k + 1 < len(lines) and lines[k].startswith("1 ") and lines[k + 1].startswith("2 ") and len(lines[k + 1]) >= 63 + _widening(*lines[k : k + 2])
    while i < len(lines):
        named = not is_pair(i)
        k = i + named
        if not is_pair(k):
            i += 1
            continue
        wide = _widening(*lines[k : k + 2])
        number, one, two = lines[k + 1][2 : 7 + wide], lines[k][wide:].ljust(69), lines[k + 1][wide:]
        try:
            year, day = int(one[18:20]), float(one[20:32])
            epoch = dt.datetime(2000 + year if year < 57 else 1900 + year, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(days=day - 1)
            drag = one[53:61].strip() or "00000-0"
            sign = -1 if drag[0] == "-" else 1
            drag = drag.lstrip("+-").replace(" ", "")
            bstar = sign * float(f"0.{drag[:-2]}") * 10.0 ** int(drag[-2:])
            values = [float(two[8:16]), float(two[17:25]), float("0." + two[26:33].strip()), float(two[34:42]), float(two[43:51]), float(two[52:63])]
            out.append((lines[i].removeprefix("0 ").strip() if named else "", _parse_number(number), round(epoch.timestamp() * 1000), *values, bstar))
        except ValueError:
            pass
        i = k + 2
    return out


def element_text(df: DataFrame, col: str = "value") -> DataFrame:
    """Element sets from whole texts (``spark.read.text(path, wholetext=True)``), one row a set."""

    def run(it):
        for pdf in it:
            rows = [r for text in pdf[col].dropna() for r in parse_elements(text)]
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in _ELEMENTS.split(", ")])

    return df.select(col).mapInPandas(run, struct(_ELEMENTS)).withColumn("epoch", F.timestamp_millis("epoch_ms")).drop("epoch_ms")


def object_listing(spark: SparkSession, path: str) -> DataFrame:
    """(key, size, last_modified) of an object-store listing in XML."""
    xml = spark.read.format("xml").option("rowTag", "Contents").schema("Key string, Size bigint, LastModified string").load(path)
    return xml.select(F.col("Key").alias("key"), F.col("Size").alias("size"), F.try_to_timestamp("LastModified").alias("last_modified"))


#: Events that one writing task takes.
WRITE_ROWS = 1_000_000


def append(df: DataFrame, path: str, order: list[str]) -> None:
    """Appends events, partitioned by hour and sorted within files, so time filters prune folders and key filters row groups.

    Tasks take ranges of (hour, order...), as many as the number of events
    asks for: quiet hours share a task and have one file each, a busy hour is
    split among tasks.
    """
    hour = F.date_format(F.date_trunc("hour", "event_time"), "yyyyMMddHH")
    tasks = max(int(df.sparkSession.sparkContext.defaultParallelism), -(-df.count() // WRITE_ROWS))
    ranged = df.withColumn("event_hour", hour).repartitionByRange(tasks, "event_hour", *order)
    ranged.sortWithinPartitions("event_hour", *order).write.mode("append").partitionBy("event_hour").parquet(path)


def scan(spark: SparkSession, path: str, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """Stored events of a time range; the range also becomes a predicate on the hour partitions."""
    df = spark.read.option("mergeSchema", "false").parquet(path)
    as_hour = lambda t: F.date_format(F.date_trunc("hour", t), "yyyyMMddHH").cast("int")
    if since is not None:
        df = df.filter((F.col("event_time") >= since) & (F.col("event_hour").cast("int") >= as_hour(since)))
    if until is not None:
        df = df.filter((F.col("event_time") < until) & (F.col("event_hour").cast("int") <= as_hour(until)))
    return df.drop("event_hour")
