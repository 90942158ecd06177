"""Queries over filters on placements, routing, and joined or corrected reads."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from helixframe.functions import sequence as S
from helixframe.operators import intervals as I
from helixframe.operators import joining
from helixframe.operators import joins as J
from helixframe.plans import kernel_sql as K
from helixframe.plans import relations as R
from helixframe.plans.registry import query
from helixframe.sources import formats, sinks

_M = f"WITH {R.MATCHES}"


@query("F21", "D18", sql=f"{_M}, w AS (SELECT s_suppkey AS ref, 1000 + s_suppkey % 7 * 1500 + d AS a2, 2200 + s_suppkey % 7 * 1500 + d AS b2 FROM supplier, (VALUES (0), (5000)) v(d)), o AS (SELECT id, sum(least(re, b2) - greatest(rs, a2) + 1) AS n FROM matches m JOIN w ON w.ref = m.ref AND rs <= b2 AND a2 <= re GROUP BY 1) SELECT id FROM matches WHERE id NOT IN (SELECT o.id FROM o JOIN matches m ON m.id = o.id WHERE n * 2 >= re - rs + 1)")
def exclusion_window_filter(spark, sf):
    m = R.matches(spark, sf).select("id", F.col("ref").alias("key"), F.col("rs").alias("a"), F.col("re").alias("b"))
    at = 1000 + F.col("s_suppkey") % 7 * 1500
    w = R.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.explode(F.array(F.lit(0), F.lit(5000))).alias("d"), at.alias("at"))
    w = w.select("key", (F.col("at") + F.col("d")).alias("a2"), (F.col("at") + F.col("d") + 1200).alias("b2"))
    inside = I.band_join(m, w, 2000).groupBy("id").agg(F.sum(F.least("b", "b2") - F.greatest("a", "a2") + 1).alias("n"))
    bad = m.join(inside, "id").where(F.col("n") * 2 >= F.col("b") - F.col("a") + 1).select("id")
    return m.join(bad, "id", "left_anti").select("id")


@query("F22", sql="SELECT event_id FROM (SELECT event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE p IS NULL OR p <> event_type")
def duplicate_skip(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = R.table(spark, sf, "events").select("event_id", "event_type", F.lag("event_type").over(w).alias("p"))
    return rows.where("p IS NULL OR p <> event_type").select("event_id")


@query("J26", sql=f"{_M}, l AS (SELECT id, ref, rs, lag(re) OVER w AS pe FROM matches WINDOW w AS (PARTITION BY ref ORDER BY rs, re, id)) SELECT id, coalesce(rs <= pe, FALSE) AS goes_on FROM l")
def chain_continuity(spark, sf):
    w = Window.partitionBy("ref").orderBy("rs", "re", "id")
    return R.matches(spark, sf).select("id", F.coalesce(F.col("rs") <= F.lag("re").over(w), F.lit(False)).alias("goes_on"))


@query("Y9", "Y10", sql=f"WITH {R.PATHS}, u AS (SELECT DISTINCT name, unnest(string_split(regexp_replace(path, '[FR]', '', 'g'), '_'))::INTEGER AS uid FROM paths) SELECT uid, name FROM u WHERE name IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def duplicate_id_map(spark, sf):
    units = R.paths(spark, sf).select("name", F.explode(S.parse_path("path")).alias("u")).select(F.col("u.id").alias("uid"), "name").distinct()
    dup = R.table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("name"))
    return J.named(units, dup).select("uid", "name")


@query("Y22", sql=f"{_M} SELECT o_orderkey AS qry FROM orders WHERE o_orderkey NOT IN (SELECT qry FROM matches WHERE mlen * 100 > 20 * qlen AND idy > 95)")
def patch_dedupe(spark, sf):
    m = R.matches(spark, sf)
    covered = m.where((F.col("mlen") * 100 > 20 * F.col("qlen")) & (F.col("idy") > 95)).select("qry")
    return R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("qry")).join(covered, "qry", "left_anti")


@query("F18", sql=f"{_M} SELECT id FROM matches WHERE idy >= 95 AND (qry <> ref OR (abs(qs - rs) > 100 AND abs(qe - re) > 100))")
def self_hit_filter(spark, sf):
    return formats.self_hits(R.matches(spark, sf), 95).select("id")


@query("O4", "O9", "D12", sql="SELECT p_partkey, replace(p_name, 'part_', '') AS piece FROM part ORDER BY p_size DESC, p_partkey")
def multi_key_sort(spark, sf):
    part = R.table(spark, sf, "part").withColumn("piece", F.regexp_replace("p_name", "part_", ""))
    return part.orderBy(F.desc("p_size"), "p_partkey").select("p_partkey", "piece")


@query("Y1", sql=f"{_M} SELECT id, greatest(1, rs - 200) AS r_from, least(rlen, re + 200) AS r_to, greatest(1, least(qs, qe) - 200) AS q_from, least(qlen, greatest(qs, qe) + 200) AS q_to FROM matches")
def realign_windows(spark, sf):
    lo, hi = F.least("qs", "qe"), F.greatest("qs", "qe")
    one = F.lit(1)
    return R.matches(spark, sf).select("id", F.greatest(one, F.col("rs") - 200).alias("r_from"), F.least(F.col("rlen"), F.col("re") + 200).alias("r_to"), F.greatest(one, lo - 200).alias("q_from"), F.least(F.col("qlen"), hi + 200).alias("q_to"))


@query("K11", "J7", sql="SELECT DISTINCT o_orderkey AS name, l_suppkey % 8 AS batch FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def routed_reads(spark, sf):
    joins = R.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("name"), (F.col("l_suppkey") % 8).alias("batch"))
    return sinks.route_to_batches(R.table(spark, sf, "orders").select(F.col("o_orderkey").alias("name")), joins)


@query("K8", "A29", sql=K.MATES)
def mate_pair_records(spark, sf):
    pieces = S.windows(R.reads(spark, sf), 900, 2000).select(F.col("name").alias("read"), F.col("start").alias("pos"), F.col("piece").alias("seq"))
    return sinks.mate_pairs(pieces).select("read", "library", "insert", F.md5("left").alias("left"), F.md5("right").alias("right"))


@query("K7", sql=K.FRG)
def frg_records(spark, sf):
    return sinks.frg_lines(sinks.frg_windows(R.reads(spark, sf), 6000, 5000), "LR")


def _pieces(spark, sf):
    reads = R.reads(spark, sf)
    cut = S.windows(reads, 700, 900, least=200)
    return reads, cut.select(F.col("name").alias("read"), F.concat(F.lit("m"), F.expr("start div 1800")).alias("name"), "start", (F.col("start") + F.length("piece") - 1).alias("stop"), F.col("piece").alias("seq"))


@query("G15", "G16", "G17", "F30", "J10", sql=K.JOINED)
def joined_reads(spark, sf):
    reads, pieces = _pieces(spark, sf)
    v = pieces.select("read", F.col("name").alias("a")).distinct()
    v = v.select("read", "a", F.concat(F.lit("m"), (F.substr(F.col("a"), F.lit(2)).cast("int") + 1).cast("string")).alias("b"), F.lit(1).alias("verdict"))
    return joining.join_reads(reads, pieces, v, least_out=400, least=300).select("read", "part", F.length("seq").alias("n"), F.md5("seq").alias("digest"))


@query("G18", "Q17", sql=K.CORRECTED)
def corrected_reads(spark, sf):
    reads, pieces = _pieces(spark, sf)
    placed = pieces.select(F.col("read").alias("name"), "start", "stop", F.lower("seq").alias("unitig"))
    return joining.correct_reads(reads, placed, 17).select("name", F.length("seq").alias("n"), F.md5("seq").alias("digest"))
