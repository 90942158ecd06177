"""Queries over intervals and ordered rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from helixframe.operators import intervals as I
from helixframe.operators.numbering import running_total
from helixframe.plans import relations as R
from helixframe.plans.registry import query


@query("J3", "J11", "J16", sql=f"WITH {R.INTERVALS} SELECT x.id AS id1, y.id AS id2 FROM intervals x JOIN intervals y ON x.key = y.key AND x.a <= y.b AND y.a <= x.b AND x.id < y.id")
def band_join(spark, sf):
    x = R.intervals(spark, sf)
    y = x.select("key", F.col("id").alias("id2"), F.col("a").alias("a2"), F.col("b").alias("b2"))
    return I.band_join(x.withColumnRenamed("id", "id1"), y, 30).where("id1 < id2").select("id1", "id2")


@query("J11", sql=f"WITH {R.INTERVALS} SELECT id FROM intervals x WHERE NOT EXISTS (SELECT 1 FROM intervals y WHERE y.id % 5 = 0 AND x.key = y.key AND x.a <= y.b AND y.a <= x.b)")
def bad_interval_veto(spark, sf):
    x = R.intervals(spark, sf)
    bad = x.where("id % 5 = 0").select("key", F.col("a").alias("a2"), F.col("b").alias("b2"))
    return I.not_overlapping(x, bad, 30).select("id")


_GAPS = """g0 AS (SELECT key, id, a, max(struct_pack(e := b, i := id)) OVER (PARTITION BY key ORDER BY a, b, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS t FROM intervals),
gaps AS (SELECT key, t.i AS after, id, a - t.e - 1 AS gap, t.e + 1 AS ga, a - 1 AS gb FROM g0 WHERE a > t.e)"""


@query("W6", "A18", sql=f"WITH {R.INTERVALS}, {_GAPS} SELECT gap, count(*) AS n, min(after) AS first_after FROM gaps GROUP BY 1")
def gap_distribution(spark, sf):
    return I.gaps(R.intervals(spark, sf)).groupBy("gap").agg(F.count("*").alias("n"), F.min("after").alias("first_after"))


@query("J20", "J16", sql=f"WITH {R.INTERVALS}, {_GAPS} SELECT DISTINCT g.id FROM gaps g JOIN (SELECT l_partkey AS key, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) - 400 AS a2, date_diff('day', DATE '1970-01-01', l_shipdate::DATE) + 400 AS b2 FROM lineitem WHERE l_quantity > 25) s ON s.key = g.key AND a2 <= ga - 10 AND b2 >= gb + 10 AND ga <= gb")
def gap_cover_join(spark, sf):
    x = R.intervals(spark, sf)
    ends = x.select("key", F.col("id").alias("after"), F.col("b").alias("e"))
    g = I.gaps(x).join(ends, ["key", "after"]).select("key", "id", (F.col("e") + 1).alias("a"), (F.col("e") + F.col("gap")).alias("b")).where("a <= b")
    heavy = R.table(spark, sf, "lineitem").where("l_quantity > 25").select(R.item_id().alias("id"))
    spans = x.join(heavy.distinct(), "id", "left_semi").select("key", (F.col("a") - 400).alias("a2"), (F.col("a") + 400).alias("b2"))
    return I.covering(g, spans, 400, 10).select("id").distinct()


@query("W4", "W7", "W5", sql=f"WITH {R.INTERVALS} SELECT key, id, coalesce(a - lag(b) OVER w - 1, 100) AS before, coalesce(lead(a) OVER w - b - 1, 100) AS after FROM intervals WINDOW w AS (PARTITION BY key ORDER BY a, b, id)")
def gap_before_after(spark, sf):
    return I.gap_before_after(R.intervals(spark, sf))


_COV = f"""{R.INTERVALS}, ev AS (SELECT key, a AS pos, 1 AS d FROM intervals UNION ALL SELECT key, b, -1 FROM intervals),
cov AS (SELECT key, pos, sum(sum(d)) OVER (PARTITION BY key ORDER BY pos)::BIGINT AS depth FROM ev GROUP BY key, pos)"""


@query("W3", sql=f"WITH {_COV} SELECT key, pos, depth FROM cov")
def coverage_sweep(spark, sf):
    return I.coverage(R.intervals(spark, sf))


@query("A21", sql=f"WITH {_COV}, m AS (SELECT depth FROM cov WHERE depth > 0 GROUP BY 1 ORDER BY count(*) DESC, depth LIMIT 1) SELECT depth AS mode, greatest(2, floor(depth / 0.8))::BIGINT AS repeat_depth, (floor(greatest(2, floor(depth / 0.8)) / 12) + 1)::BIGINT AS low_depth FROM m")
def modal_depth(spark, sf):
    return I.modal_depth(I.coverage(R.intervals(spark, sf)))


@query("W8", "G11", sql=f"WITH {R.INTERVALS}, f AS (SELECT *, CASE WHEN a <= max(b) OVER (PARTITION BY key ORDER BY a, b, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 5 THEN 0 ELSE 1 END AS f FROM intervals), g AS (SELECT *, sum(f) OVER (PARTITION BY key ORDER BY a, b, id) AS g FROM f) SELECT key, min(a) AS a, max(b) AS b, count(*) AS n FROM g GROUP BY key, g")
def merged_islands(spark, sf):
    return I.islands(R.intervals(spark, sf), 5)


@query("W10", sql="SELECT doc_id, n_chars FROM (SELECT doc_id, n_chars, sum(n_chars) OVER (ORDER BY n_chars DESC, doc_id) AS upto FROM documents) WHERE upto < (SELECT sum(n_chars) / 2 FROM documents)")
def running_budget(spark, sf):
    docs = R.table(spark, sf, "documents").select("doc_id", "n_chars")
    half = docs.agg((F.sum("n_chars") / 2).alias("half"))
    return running_total(docs, ["-n_chars", "doc_id"], "n_chars", "upto").crossJoin(F.broadcast(half)).where("upto < half").select("doc_id", "n_chars")


@query("A25", "K13", "S21", "O5", sql="SELECT q AS share, min(n_chars) AS n FROM (SELECT n_chars, sum(n_chars) OVER (ORDER BY n_chars DESC, doc_id) AS upto, (SELECT sum(n_chars) FROM documents) AS t FROM documents), (VALUES (10), (50), (90)) v(q) WHERE (upto - n_chars) * 100 < t * q GROUP BY 1")
def n50_report(spark, sf):
    docs = R.table(spark, sf, "documents").select("doc_id", "n_chars")
    rows = running_total(docs, ["-n_chars", "doc_id"], "n_chars", "upto").crossJoin(F.broadcast(docs.agg(F.sum("n_chars").alias("t"))))
    each = rows.select("n_chars", "upto", "t", F.explode(F.array(F.lit(10), F.lit(50), F.lit(90))).alias("share"))
    return each.where((F.col("upto") - F.col("n_chars")) * 100 < F.col("t") * F.col("share")).groupBy("share").agg(F.min("n_chars").alias("n"))


@query("W11", "K9", sql="SELECT doc_id, floor((sum(n_chars) OVER (ORDER BY doc_id) - n_chars) / 100000)::BIGINT AS batch FROM documents")
def batch_by_size(spark, sf):
    docs = R.table(spark, sf, "documents").select("doc_id", "n_chars")
    return running_total(docs, ["doc_id"], "n_chars", "upto").select("doc_id", F.floor((F.col("upto") - F.col("n_chars")) / 100000).alias("batch"))


@query("W9", sql="""WITH r AS (SELECT user_id, event_id, floor(epoch(ts))::BIGINT // 60 AS p, row_number() OVER (PARTITION BY user_id ORDER BY floor(epoch(ts))::BIGINT // 60, event_id) AS i FROM events)
    SELECT x.user_id, x.event_id, round(sum(CASE WHEN abs(x.p - y.p) < 5000 THEN exp(-abs(x.p - y.p) / 5000.0) ELSE 0 END), 6) AS density FROM r x JOIN r y ON x.user_id = y.user_id AND y.i BETWEEN x.i - 30 AND x.i + 29 GROUP BY 1, 2""")
def break_density(spark, sf):
    ev = R.table(spark, sf, "events").select("user_id", "event_id", F.expr("unix_timestamp(ts) div 60").alias("p"))
    return I.break_density(ev, "user_id", "p", "event_id").withColumn("density", F.round("density", 6))


@query("W13", sql="SELECT event_id FROM (SELECT event_id, max(CASE WHEN value > 190 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS f FROM events) WHERE f = 1")
def context_rows(spark, sf):
    ev = R.table(spark, sf, "events")
    return I.near_flagged(ev, F.col("value") > 190, "user_id", ["ts", "event_id"], 5).select("event_id")


@query("W14", sql="SELECT l_orderkey, l_linenumber FROM (SELECT *, count(*) OVER (PARTITION BY l_partkey, l_suppkey) AS n FROM lineitem) WHERE n > 1")
def uniq_d_groups(spark, sf):
    return I.repeated_groups(R.table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber")


@query("W16", sql="""WITH c AS (SELECT user_id, event_id, ts, event_type, CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    g AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM c) SELECT user_id, event_type, min(floor(epoch(ts))::BIGINT) AS first, count(*) AS n FROM g GROUP BY user_id, g, event_type""")
def run_counting(spark, sf):
    ev = R.table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type")
    return I.run_lengths(ev, "user_id", ["ts", "event_id"], "event_type").withColumn("first", F.unix_timestamp("first"))


@query("W15", "W17", "Y17", sql=f"WITH {R.MATCHES} SELECT qry, ref1, ref2, edge FROM (SELECT qry, lag(ref) OVER w AS ref1, ref AS ref2, CASE WHEN qs < qe THEN rs ELSE re END AS edge FROM matches WINDOW w AS (PARTITION BY qry ORDER BY least(qs, qe), id)) WHERE ref1 <> ref2")
def breakpoints(spark, sf):
    m = R.matches(spark, sf)
    w = Window.partitionBy("qry").orderBy(F.least("qs", "qe"), "id")
    rows = m.select("qry", F.lag("ref").over(w).alias("ref1"), F.col("ref").alias("ref2"), F.when(F.col("qs") < F.col("qe"), F.col("rs")).otherwise(F.col("re")).alias("edge"))
    return rows.where("ref1 <> ref2")


@query("W18", sql="SELECT event_id, lowest FROM (SELECT event_id, value, min(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS lowest FROM events) WHERE value = lowest")
def local_minimum(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-3, 3)
    return R.table(spark, sf, "events").select("event_id", "value", F.min("value").over(w).alias("lowest")).where("value = lowest").select("event_id", "lowest")


@query("W1", "W2", sql="SELECT event_id, s, full_ FROM (SELECT event_id, sum(value) OVER w AS s0, round(sum(value) OVER w, 4) AS s, count(*) OVER w = 4 AS full_ FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))")
def sliding_sum(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-3, 0)
    return R.table(spark, sf, "events").select("event_id", F.round(F.sum("value").over(w), 4).alias("s"), (F.count("*").over(w) == 4).alias("full_"))


@query("W12", sql="SELECT l_orderkey, l_linenumber, least(2000, sum(size) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey)) AS ahead, least(2000, sum(size) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC)) AS back FROM (SELECT *, l_quantity::BIGINT * 10 AS size FROM lineitem)")
def gap_allowance(spark, sf):
    li = R.table(spark, sf, "lineitem").withColumn("size", F.col("l_quantity").cast("bigint") * 10)
    a = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    b = Window.partitionBy("l_orderkey").orderBy(F.desc("l_linenumber"), F.desc("l_partkey"))
    return li.select("l_orderkey", "l_linenumber", F.least(F.lit(2000), F.sum("size").over(a)).alias("ahead"), F.least(F.lit(2000), F.sum("size").over(b)).alias("back"))
