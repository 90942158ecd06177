"""Intervals: band joins, sweeps, gaps, and windows over ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.operators.numbering import running


def band_join(left: DataFrame, right: DataFrame, width: int, on: tuple[str, ...] = ("key",), a: str = "a", b: str = "b", a2: str = "a2", b2: str = "b2") -> DataFrame:
    """Pairs of overlapping closed intervals [a, b] and [a2, b2] of equal ``on``.

    Both sides are dealt to the bins of ``width`` that they touch and meet by an equi-join on
    the bin; a pair counts only in the bin where its overlap starts, so that it appears
    once.  Choose a width near the usual length; no nested loop is planned.
    """
    def binned(df: DataFrame, lo: str, hi: str) -> DataFrame:
        return df.withColumn("__bin", F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width))))

    x, y = binned(left, a, b), binned(right, a2, b2)
    joined = x.join(y, [*on, "__bin"])
    meets = (F.col(a) <= F.col(b2)) & (F.col(a2) <= F.col(b))
    return joined.where(meets & (F.col("__bin") == F.floor(F.greatest(F.col(a), F.col(a2)) / width))).drop("__bin")


def covering(gaps: DataFrame, spans: DataFrame, width: int, margin: int = 0, on: tuple[str, ...] = ("key",)) -> DataFrame:
    """Gaps (a, b) that some span (a2, b2) covers with ``margin`` to spare on both sides."""
    found = band_join(gaps, spans, width, on)
    return found.where((F.col("a2") <= F.col("a") - margin) & (F.col("b2") >= F.col("b") + margin)).select(gaps.columns).distinct()


def not_overlapping(rows: DataFrame, bad: DataFrame, width: int, on: tuple[str, ...] = ("key",), id: str = "id") -> DataFrame:
    """Rows whose interval meets none of the bad ones."""
    hit = band_join(rows, bad, width, on).select(id).distinct()
    return rows.join(hit, id, "left_anti")


def coverage(spans: DataFrame, key: str = "key", a: str = "a", b: str = "b") -> DataFrame:
    """Rows (key, pos, depth): the depth from each position where it changes, ends exclusive at b."""
    ev = spans.select(F.col(key).alias("key"), F.col(a).alias("pos"), F.lit(1).alias("d")).unionByName(spans.select(F.col(key).alias("key"), F.col(b).alias("pos"), F.lit(-1).alias("d")))
    steps = ev.groupBy("key", "pos").agg(F.sum("d").alias("d"))
    return running(steps, ["key"], "pos", "d", "depth").select("key", "pos", "depth")


def modal_depth(depths: DataFrame) -> DataFrame:
    """The most frequent depth (smallest of equals), and the thresholds derived from it."""
    best = depths.where("depth > 0").groupBy("depth").count().agg(F.max_by("depth", F.struct("count", (-F.col("depth")).alias("d"))).alias("mode"))
    rep = F.greatest(F.lit(2), F.floor(F.col("mode") / F.lit(0.8))).cast("bigint")
    return best.select(F.col("mode").cast("bigint").alias("mode"), rep.alias("repeat_depth"), (F.floor(rep / 12) + 1).cast("bigint").alias("low_depth"))


def gaps(spans: DataFrame, key: str = "key", a: str = "a", b: str = "b", id: str = "id", overlap: int = 0) -> DataFrame:
    """Rows (key, after, id, gap): free length before a span that starts beyond all earlier ends, and the row with that end."""
    w = Window.partitionBy(key).orderBy(a, b, id).rowsBetween(Window.unboundedPreceding, -1)
    top = F.max(F.struct(F.col(b).alias("e"), F.col(id).alias("i"))).over(w)
    rows = spans.select(F.col(key).alias("key"), F.col(id).alias("id"), F.col(a).alias("a"), top.alias("t"))
    return rows.where(F.col("a") > F.col("t.e") - overlap).select("key", F.col("t.i").alias("after"), "id", (F.col("a") - F.col("t.e") - 1).alias("gap"))


def gap_before_after(spans: DataFrame, key: str = "key", a: str = "a", b: str = "b", id: str = "id", at_end: int = 100) -> DataFrame:
    """Distance to the neighbours before and after, ``at_end`` where there is none."""
    w = Window.partitionBy(key).orderBy(a, b, id)
    return spans.select(
        F.col(key).alias("key"),
        F.col(id).alias("id"),
        F.coalesce(F.col(a) - F.lag(b).over(w) - 1, F.lit(at_end)).alias("before"),
        F.coalesce(F.lead(a).over(w) - F.col(b) - 1, F.lit(at_end)).alias("after"),
    )


def islands(spans: DataFrame, join: Column | int = 0, key: str = "key", a: str = "a", b: str = "b", id: str = "id") -> DataFrame:
    """Spans merged where the next starts at most ``join`` beyond all earlier ends: (key, a, b, n)."""
    order = Window.partitionBy(key).orderBy(a, b, id)
    before = F.max(b).over(order.rowsBetween(Window.unboundedPreceding, -1))
    first = (before.isNull() | (F.col(a) > before + join)).cast("int")
    rows = spans.select(F.col(key).alias("key"), F.col(a).alias("a"), F.col(b).alias("b"), F.col(id).alias("id"), first.alias("f"))
    again = Window.partitionBy("key").orderBy("a", "b", "id").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("g", F.sum("f").over(again)).groupBy("key", "g").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.count("*").alias("n")).drop("g")


def near_flagged(rows: DataFrame, flag: Column, key: str, order: list[str], reach: int = 50) -> DataFrame:
    """Rows within ``reach`` rows of a flagged one."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(-reach, reach)
    return rows.withColumn("__f", F.max(flag.cast("int")).over(w)).where("__f = 1").drop("__f")


def repeated_groups(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows whose group has more than one."""
    return rows.withColumn("__n", F.count("*").over(Window.partitionBy(*by))).where("__n > 1").drop("__n")


def run_lengths(rows: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Rows (key, value, first, n): runs of equal consecutive values."""
    w = Window.partitionBy(key).orderBy(*order)
    change = (~F.col(value).eqNullSafe(F.lag(value).over(w)) | (F.row_number().over(w) == 1)).cast("int")
    rows = rows.withColumn("__c", change).withColumn("__g", F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(key, "__g", value).agg(F.min(order[0]).alias("first"), F.count("*").alias("n")).drop("__g")


def break_density(rows: DataFrame, key: str, pos: str, id: str, reach: int = 30, scale: float = 5000.0) -> DataFrame:
    """Per row the sum of exp(-distance / scale) over rows up to ``reach`` before and fewer than ``reach`` after, nearer than ``scale``."""
    w = Window.partitionBy(key).orderBy(pos, id)
    r = rows.select(key, id, F.col(pos).alias("p"), F.row_number().over(w).alias("i"))
    near = Window.partitionBy(key).orderBy("i").rowsBetween(-reach, reach - 1)
    with_near = r.withColumn("near", F.collect_list("p").over(near))
    here = F.col("p")
    terms = F.transform("near", lambda q: F.when(F.abs(q - here) < scale, F.exp(-F.abs(q - here) / scale)).otherwise(0.0))
    return with_near.select(key, id, F.aggregate(terms, F.lit(0.0), lambda s, x: s + x).alias("density"))
