"""Links between nodes that share groups, their scores, and filters on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALTS = 8


def depth_filter(hits: DataFrame, low: float = 0.05, high: float = 0.95, least: int = 1) -> DataFrame:
    """Hits of nodes whose number of hits lies between two quantiles of all nodes' numbers, and is at least ``least``.

    A node goes if fewer than a share ``low`` of nodes have at most its number, or
    a share of ``high`` or more have fewer.
    """
    per = hits.groupBy("node").agg(F.sum("n").alias("t"))
    sizes = per.groupBy("t").agg(F.count("*").alias("c"))
    # One row for each distinct number of hits.
    upto = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    cum = sizes.select("t", F.sum("c").over(upto).alias("upto"), "c").crossJoin(sizes.agg(F.sum("c").alias("all")))
    good = cum.where((F.col("upto") >= low * F.col("all")) & ((F.col("upto") - F.col("c")) < high * F.col("all")) & (F.col("t") >= least))
    kept = per.join(good.select("t"), "t").select("node")
    return hits.join(kept, "node", "left_semi")


def frequent_barcodes(reads: DataFrame, more_than: int, least: int = 100) -> DataFrame:
    """Reads (read, barcode, length) of at least ``least`` bases whose barcode has more than ``more_than`` reads of any length."""
    many = reads.groupBy("barcode").agg(F.count("*").alias("c")).where(F.col("c") > more_than).select("barcode")
    return reads.where(F.col("length") >= least).join(many, "barcode", "left_semi")


def shared_groups(hits: DataFrame) -> DataFrame:
    """Rows (a, b, shared, jaccard), a <> b, both ways: nodes that share groups.

    Each group's nodes meet by an equi-join on the group; the counting is partial before
    it is shuffled.
    """
    size = hits.groupBy("node").agg(F.countDistinct("grp").alias("m"))
    d = hits.select("node", "grp").distinct()
    x = d.select(F.col("node").alias("a"), "grp")
    pairs = x.join(d.select(F.col("node").alias("b"), "grp"), "grp").where("a < b").groupBy("a", "b").agg(F.count("*").alias("shared"))
    sized = pairs.join(size.select(F.col("node").alias("a"), F.col("m").alias("ma")), "a").join(size.select(F.col("node").alias("b"), F.col("m").alias("mb")), "b")
    one = sized.select("a", "b", "shared", (F.col("shared") / (F.col("ma") + F.col("mb") - F.col("shared"))).alias("jaccard"))
    return one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"), "shared", "jaccard"))


def scored(pairs: DataFrame, cap: float = 200.0) -> DataFrame:
    """Adds mean and sd of the node's shares, and score: -log10 of the Gaussian density, at most ``cap``."""
    w = pairs.groupBy("a").agg(F.avg("jaccard").alias("mean"), F.stddev_pop("jaccard").alias("sd"))
    z = (F.col("jaccard") - F.col("mean")) / F.col("sd")
    density = F.exp(-z * z / 2) / (F.col("sd") * F.sqrt(F.lit(2 * 3.141592653589793)))
    score = F.when(F.col("sd") > 0, F.least(F.lit(cap), F.when(density > 0, -F.log10(density)).otherwise(F.lit(cap))))
    return pairs.join(w, "a").withColumn("score", score)


def strong(links: DataFrame, least: float = 1.0) -> DataFrame:
    """Links above their node's mean (beyond rounding) with at least the score."""
    return links.where((F.col("score") >= least) & (F.col("jaccard") > F.col("mean") + 1e-12)).select("a", "b", "score")


def auto_threshold(links: DataFrame, mean_links: float = 1.25, bin: float = 1.0) -> DataFrame:
    """The smallest score bin from which on nodes have at most ``mean_links`` links in the mean."""
    nodes = links.agg(F.countDistinct("a").alias("nodes"))
    hist = links.groupBy(F.floor(F.col("score") / bin).alias("bin")).agg(F.count("*").alias("c"))
    # One row a bin.
    above = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    cum = hist.withColumn("above", F.sum("c").over(above)).crossJoin(nodes)
    return cum.where(F.col("above") <= mean_links * F.col("nodes")).agg((F.min("bin") * bin).alias("threshold"))


def top_links(links: DataFrame, best: int = 5, most: int = 20) -> DataFrame:
    """The best links of each node; nodes with more than ``most`` links have none."""
    n = links.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") <= most)
    w = Window.partitionBy("a").orderBy(F.desc("score"), "b")
    return links.join(n.select("a"), "a", "left_semi").withColumn("r", F.row_number().over(w)).where(F.col("r") <= best).drop("r")


def reciprocal(links: DataFrame, least: float) -> DataFrame:
    """Edges (a, b, score), a < b, with links both ways whose scores add up to ``least``."""
    back = links.select(F.col("a").alias("b"), F.col("b").alias("a"), F.col("score").alias("s2"))
    both = links.where("a < b").join(back, ["a", "b"])
    return both.where(F.col("score") + F.col("s2") >= least).select("a", "b", (F.col("score") + F.col("s2")).alias("score"))
