"""Even ranges of an order, for windows over more rows than a task should hold.

A running value over sorted rows is computed range by range: each range begins
with what the one before it ended with.  Ranges come from quantiles, so no key
and no part of the order has to fit into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges for each shuffle partition.
SEGMENTS = 4


def segment(rows: DataFrame, by: str) -> Column:
    """Which of even ranges of ``by`` (a number or a time) a row is in: a binary search in quantiles over all rows."""
    x = F.unix_micros(by) if dict(rows.dtypes)[by] == "timestamp" else F.col(by).cast("long")
    n = SEGMENTS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = sorted(set(rows.agg(F.percentile_approx(x, [k / n for k in range(1, n)], 100 * n).alias("q")).first()["q"] or []))
    if not found:
        return F.lit(0)
    depth = len(found).bit_length()
    bounds = F.array(*[F.lit(v).cast("long") for v in found + [2**63 - 1] * (2**depth - 1 - len(found))])
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(depth))])
    return F.aggregate(halves, F.lit(0), lambda at, half: F.when(F.element_at(bounds, at + half) < x, at + half).otherwise(at))
