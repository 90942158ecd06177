"""Numbers and running sums over a whole table, without one task for all rows.

Rows are cut into ranges of the order; each range is summed, the few sums are
added up, and rows continue from their range's offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running(rows: DataFrame, key: list[str], order: str, value: str, out: str) -> DataFrame:
    """``rows`` with the running sum of ``value`` within ``key``, in order of ``order`` (unique within key)."""
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(out, F.sum(value).over(w))


def running_total(rows: DataFrame, order: list, value: str, out: str, ranges: int = 64) -> DataFrame:
    """``rows`` with the running sum of ``value`` over the whole table in the given order (unique).

    ``order`` holds numeric column names, a leading ``-`` for descending.  Range bounds are
    percentiles of the first; rows with an equal first value share a range.
    """
    first, sign = (order[0].lstrip("-"), -1) if order[0].startswith("-") else (order[0], 1)
    bounds = rows.agg(F.percentile_approx(F.col(first), F.array(*(F.lit(i / ranges) for i in range(1, ranges))), F.lit(10_000))).first()[0] or []
    bucket = F.lit(0)
    for x in sorted(set(bounds)):
        bucket = bucket + (F.col(first) > x).cast("int")
    cut = rows.withColumn("__r", bucket * sign)
    cols = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]
    inside = cut.withColumn("__s", F.sum(value).over(Window.partitionBy("__r").orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)))
    # At most ``ranges`` rows meet in the one task that adds them up.
    before = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut.groupBy("__r").agg(F.sum(value).alias("__t")).select("__r", F.coalesce(F.sum("__t").over(before), F.lit(0)).alias("__o"))
    return inside.join(F.broadcast(offsets), "__r").withColumn(out, F.col("__s") + F.col("__o")).drop("__r", "__s", "__o")
