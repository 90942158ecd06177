"""Queries over contig pairs, repeats in paths, windows at contig ends, barcodes and two-stage filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import aggregates as A
from helixframe.operators import joins as J
from helixframe.operators import links as L
from helixframe.operators import scaffold as G
from helixframe.plans import relations as R
from helixframe.plans.registry import query

_M = f"WITH {R.MATCHES}"


@query("F16", sql=f"{_M} SELECT id FROM matches WHERE rs <= 1500 OR re >= rlen - 1500")
def slack_filter(spark, sf):
    return J.near_reference_ends(R.matches(spark, sf), 1500).select("id")


@query("F19", "A28", sql="SELECT l_orderkey AS read, l_suppkey AS barcode, l_quantity::BIGINT * 10 AS length FROM lineitem WHERE l_quantity * 10 >= 100 AND l_suppkey IN (SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING count(*) > (SELECT count(*) // count(DISTINCT l_suppkey) FROM lineitem))")
def frequent_barcodes(spark, sf):
    li = R.table(spark, sf, "lineitem")
    rows = li.select(F.col("l_orderkey").alias("read"), F.col("l_suppkey").alias("barcode"), (F.col("l_quantity").cast("bigint") * 10).alias("length"))
    mean = li.agg(F.expr("count(*) div count(DISTINCT l_suppkey)")).first()[0]
    return L.frequent_barcodes(rows, mean, 100).select("read", "barcode", "length")


@query("G38", "A7", sql=f"{_M} SELECT qry, id, ref FROM (SELECT qry, id, ref, row_number() OVER (PARTITION BY qry ORDER BY floor(mlen * idy / 100) DESC, id) AS r FROM matches WHERE mlen >= 900) WHERE r = 1")
def best_match_in_parts(spark, sf):
    return A.best_match_in_parts(R.matches(spark, sf), 8, 900)


@query(
    "G21",
    sql="""WITH p AS (SELECT l_orderkey AS path, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1 AS i, l_partkey % 40 AS ctg, CASE WHEN l_suppkey % 2 = 0 THEN 'F' ELSE 'R' END AS dir, l_linenumber * 10 AS gap FROM lineitem),
    n AS (SELECT *, lead(ctg) OVER w AS ctg2, lead(dir) OVER w AS dir2 FROM p WINDOW w AS (PARTITION BY path ORDER BY i)),
    j AS (SELECT *, ctg2 IS NOT NULL AND dir = 'F' AND dir2 = 'F' AND (ctg + ctg2) % 4 = 0 AS fits FROM n),
    u AS (SELECT path, 2 * i AS o, 'c' || ctg AS ctg, dir, CASE WHEN fits THEN ctg + 1 ELSE gap END AS gap FROM j UNION ALL SELECT path, 2 * i + 1, 'rep' || (ctg + ctg2), 'R', ctg2 + 2 FROM j WHERE fits)
    SELECT path::VARCHAR AS path, (row_number() OVER (PARTITION BY path ORDER BY o) - 1)::INTEGER AS i, ctg, dir, gap FROM u""",
)
def inserted_repeats(spark, sf):
    """A repeat goes between neighbours that it follows and precedes; the gap is split on both sides of it."""
    from pyspark.sql import Window

    name = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    c = F.col("l_partkey") % 40
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    paths = R.table(spark, sf, "lineitem").select(F.col("l_orderkey").cast("string").alias("path"), (F.row_number().over(w) - 1).alias("i"), name("c", c).alias("ctg"), F.when(F.col("l_suppkey") % 2 == 0, "F").otherwise("R").alias("dir"), (F.col("l_linenumber") * 10).alias("gap"))
    x = spark.range(1600).select(F.expr("id div 40").alias("a"), (F.col("id") % 40).alias("b")).where((F.col("a") + F.col("b")) % 4 == 0)
    bridges = x.select(name("c", F.col("a")).alias("ctg1"), F.lit("F").alias("dir1"), name("c", F.col("b")).alias("ctg2"), F.lit("F").alias("dir2"), name("rep", F.col("a") + F.col("b")).alias("repeat"), F.lit("R").alias("rdir"), (F.col("a") + 1).alias("gap1"), (F.col("b") + 2).alias("gap2"))
    return G.insert_repeats(paths, bridges)


_PAIRS = f"""WITH {R.FRAGMENTS}, n AS (SELECT max(name) + 1 AS n FROM fragments),
q AS (SELECT f.name AS i, f.name AS a, (f.name * 7 + 3) % n AS b, f.seq AS sa, g.seq AS sb, f.name % 4 AS how, f.name % 3 = 0 AS rev FROM fragments f, n JOIN fragments g ON g.name = (f.name * 7 + 3) % n),
s AS (SELECT *, CASE how WHEN 0 THEN length(sa) - 29 WHEN 1 THEN 1 WHEN 2 THEN 20 ELSE 60 END AS a1, CASE how WHEN 0 THEN length(sa) WHEN 1 THEN 30 WHEN 2 THEN 60 ELSE 70 END AS a2,
  CASE how WHEN 0 THEN 1 WHEN 1 THEN length(sb) - 29 WHEN 2 THEN 2 ELSE 60 END AS x1, CASE how WHEN 0 THEN 30 WHEN 1 THEN length(sb) WHEN 2 THEN length(sb) - 3 ELSE 70 END AS x2 FROM q)"""


@query(
    "G28",
    sql=_PAIRS
    + f""", t AS (SELECT i, a, b, sa, a1, a2, x1, x2, CASE WHEN rev THEN {R.revcomp_sql('sb')} ELSE sb END AS z FROM s WHERE a <> b),
    m AS (SELECT i, a, b, CASE WHEN length(sa) - a2 <= 9 AND x1 - 1 <= 9 AND length(z) - x2 > 9 THEN substring(sa, 1, a2) || substring(z, x2 + 1) WHEN length(z) - x2 <= 9 AND a1 - 1 <= 9 AND x1 - 1 > 9 THEN substring(z, 1, x2) || substring(sa, a2 + 1)
      WHEN x1 - 1 <= 9 AND length(z) - x2 <= 9 THEN sa WHEN a1 - 1 <= 9 AND length(sa) - a2 <= 9 THEN z END AS seq FROM t),
    l AS (SELECT list([{{'a': a, 'b': b, 'seq': seq}}] ORDER BY i) AS l FROM m WHERE seq IS NOT NULL),
    k AS (SELECT unnest(list_reduce(l, lambda acc, x: CASE WHEN len(list_filter(acc, lambda y: y.a IN (x[1].a, x[1].b) OR y.b IN (x[1].a, x[1].b))) = 0 THEN acc || x ELSE acc END, [])) AS x FROM l)
    SELECT x.a AS a, x.b AS b, md5(x.seq) AS digest FROM k""",
)
def merged_contig_pairs(spark, sf):
    """Four ways in which two contigs overlap, half of a third reversed; the fourth does not fit."""
    f = R.fragments(spark, sf)
    n = f.agg(F.max("name") + 1).first()[0]
    to = (F.col("name") * 7 + 3) % n
    q = f.select(F.col("name").alias("i"), F.col("name").alias("a"), to.alias("b"), F.length("seq").alias("na")).join(f.select(F.col("name").alias("b"), F.length("seq").alias("nb")), "b")
    how = F.col("i") % 4
    pick = lambda *x: F.when(how == 0, x[0]).when(how == 1, x[1]).when(how == 2, x[2]).otherwise(x[3])
    lit = F.lit
    s = q.select("i", "a", "b", "nb", pick(F.col("na") - 29, lit(1), lit(20), lit(60)).alias("a1"), pick(F.col("na"), lit(30), lit(60), lit(70)).alias("a2"), pick(lit(1), F.col("nb") - 29, lit(2), lit(60)).alias("x1"), pick(lit(30), F.col("nb"), F.col("nb") - 3, lit(70)).alias("x2"))
    rev = F.col("i") % 3 == 0
    turn = lambda c: F.when(rev, F.col("nb") - F.col(c) + 1).otherwise(F.col(c))
    pairs = s.select("i", "a", "b", "a1", "a2", turn("x1").alias("b1"), turn("x2").alias("b2"))
    return G.merge_pairs(pairs, f, "i", 9).select("a", "b", F.md5("seq").alias("digest"))


@query(
    "G37",
    sql="""WITH w AS (SELECT l_suppkey AS name, 1 + (l_partkey * 37 + l_linenumber) % 3000 AS a, (l_partkey * 37 + l_linenumber) % 3000 + l_quantity::BIGINT AS b FROM lineitem WHERE l_linenumber < 3),
    c AS (SELECT s_suppkey AS name, 2500 + s_suppkey * 3 AS len FROM supplier), x AS (SELECT c.name, len, a, b FROM c LEFT JOIN w ON w.name = c.name),
    e AS (SELECT name, len, 0 AS side, a, b FROM x UNION ALL SELECT name, len, 1, len - b + 1, len - a + 1 FROM x),
    f AS (SELECT name, len, side, list_reduce(list({'stop': a, 'at': b} ORDER BY a, b), lambda acc, s: CASE WHEN s.stop IS NULL OR greatest(s.stop, acc.at + 1) > acc.stop OR s.at <= acc.at THEN acc
      ELSE {'stop': acc.stop + least(s.at - greatest(s.stop, acc.at + 1) + 1, 1000 + 150 - acc.stop), 'at': s.at} END, {'stop': 1000::BIGINT, 'at': 0::BIGINT}).stop AS stop FROM e GROUP BY 1, 2, 3)
    SELECT name, max(least(stop, len)) FILTER (side = 0) AS left, max(least(stop, len)) FILTER (side = 1) AS right FROM f GROUP BY 1""",
)
def node_windows(spark, sf):
    at = (F.col("l_partkey") * 37 + F.col("l_linenumber")) % 3000
    w = R.table(spark, sf, "lineitem").where("l_linenumber < 3").select(F.col("l_suppkey").alias("name"), (at + 1).alias("start"), (at + F.col("l_quantity").cast("bigint")).alias("stop"))
    c = R.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("name"), (2500 + F.col("s_suppkey") * 3).alias("len"))
    return G.node_windows(c, w, 1000, 150)
