"""Queries over aggregates, links and reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from helixframe.functions import sequence as S
from helixframe.operators import aggregates as A
from helixframe.operators import links as L
from helixframe.operators.components import connected_components
from helixframe.plans import relations as R
from helixframe.plans.registry import query

_M = f"WITH {R.MATCHES}"


@query("A7", sql=f"{_M} SELECT qry, id, ref FROM (SELECT *, row_number() OVER (PARTITION BY qry ORDER BY mlen * idy // 100 DESC, id) AS r FROM matches) WHERE r = 1")
def best_match_per_query(spark, sf):
    return A.best_match(R.matches(spark, sf))


@query("A8", "Y15", sql=f"{_M} SELECT qry, id, ref FROM (SELECT *, row_number() OVER (PARTITION BY qry ORDER BY mlen * idy DESC, id) AS r FROM matches) WHERE r = 1")
def single_best_match(spark, sf):
    return A.best_match(R.matches(spark, sf), whole_percent=False)


@query("A5", sql="SELECT o_custkey, max_by(o_orderkey, struct_pack(t := o_totalprice, k := -o_orderkey)) AS best FROM orders GROUP BY 1")
def component_arg_max(spark, sf):
    o = R.table(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("best"))


@query("A6", "O8", sql="SELECT l_suppkey, nth FROM (SELECT l_suppkey, l_quantity AS nth, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity) AS r FROM lineitem) WHERE r = 5")
def nth_smallest(spark, sf):
    w = Window.partitionBy("l_suppkey").orderBy("l_quantity")
    return R.table(spark, sf, "lineitem").select("l_suppkey", F.col("l_quantity").alias("nth"), F.row_number().over(w).alias("r")).where("r = 5").drop("r")


@query("A19", "Y6", "Y11", sql=f"{_M} SELECT qry FROM matches GROUP BY 1 HAVING sum(mlen) * 100 > 90 * max(qlen)")
def duplicates_by_coverage(spark, sf):
    return A.duplicates_by_coverage(R.matches(spark, sf), 90)


@query("A13", sql=f"""{_M}, c AS (SELECT ref FROM matches GROUP BY 1 HAVING sum(mlen) / (max(rlen) + 1) >= 2),
    e AS (SELECT ref FROM (SELECT ref, CASE WHEN rs <= 3000 THEN 5 ELSE 3 END AS e FROM matches) GROUP BY 1 HAVING count(*) FILTER (e = 5) >= 2 AND count(*) FILTER (e = 3) >= 2) SELECT ref FROM c WHERE ref IN (SELECT ref FROM e)""")
def repeat_references(spark, sf):
    m = R.matches(spark, sf)
    return A.repeats(m, m.select("ref", F.when(F.col("rs") <= 3000, 5).otherwise(3).alias("end")))


@query("A14", "A15", "Q15", sql=f"""{_M}, p AS (SELECT qry, ref, qs < qe AS fwd, mlen, CASE WHEN qs < qe THEN rs - qs + 1 ELSE rs - (qlen - qs) END + qlen / 2.0 AS mid FROM matches),
    g AS (SELECT qry, ref, fwd, sum(mlen)::BIGINT AS matched, sum(mid * mlen * mlen) / sum(mlen * mlen) AS position FROM p GROUP BY ALL)
    SELECT qry, ref, fwd, matched, round(position, 4) AS position FROM (SELECT *, row_number() OVER (PARTITION BY qry ORDER BY matched DESC, ref, fwd DESC) AS r FROM g) WHERE r = 1""")
def weighted_mean_pos(spark, sf):
    return A.placements(R.matches(spark, sf)).withColumn("position", F.round("position", 4))


@query("A22", "Y3", "Y10", sql=f"WITH {R.PATHS}, u AS (SELECT name, len(string_split(path, '_')) AS n, unnest(string_split(path, '_')) AS u, generate_subscripts(string_split(path, '_'), 1) AS i FROM paths) SELECT regexp_replace(u, '[FR]', '')::INTEGER AS uid, count(*) FILTER (i = 1) AS starts, count(*) FILTER (i = n) AS ends, count(*) FILTER (i > 1 AND i < n) AS inside FROM u GROUP BY 1")
def path_end_counts(spark, sf):
    return A.path_ends(R.paths(spark, sf).select(S.parse_path("path").alias("p")))


@query("J15", sql=f"WITH {R.LINKS}, s AS (SELECT node, count(DISTINCT grp) AS m FROM links GROUP BY 1), p AS (SELECT x.node AS a, y.node AS b, count(*) AS shared FROM links x JOIN links y ON x.grp = y.grp AND x.node <> y.node GROUP BY 1, 2) SELECT a, b, shared, round(shared / (sa.m + sb.m - shared), 9) AS jaccard FROM p JOIN s sa ON sa.node = a JOIN s sb ON sb.node = b")
def jaccard_shared_groups(spark, sf):
    return L.shared_groups(R.links(spark, sf)).withColumn("jaccard", F.round("jaccard", 9))


_J = f"""{R.LINKS}, s AS (SELECT node, count(DISTINCT grp) AS m FROM links GROUP BY 1), p AS (SELECT x.node AS a, y.node AS b, count(*) AS shared FROM links x JOIN links y ON x.grp = y.grp AND x.node <> y.node GROUP BY 1, 2),
j AS (SELECT a, b, shared / (sa.m + sb.m - shared) AS jaccard FROM p JOIN s sa ON sa.node = a JOIN s sb ON sb.node = b),
z AS (SELECT *, avg(jaccard) OVER (PARTITION BY a) AS mean, stddev_pop(jaccard) OVER (PARTITION BY a) AS sd FROM j),
sc AS (SELECT *, CASE WHEN sd > 0 THEN least(200, CASE WHEN exp(-pow((jaccard - mean) / sd, 2) / 2) / (sd * sqrt(2 * 3.141592653589793)) > 0 THEN -log10(exp(-pow((jaccard - mean) / sd, 2) / 2) / (sd * sqrt(2 * 3.141592653589793))) ELSE 200 END) END AS score FROM z)"""


@query("A23", sql=f"WITH {_J} SELECT a, b, round(score, 5) AS score FROM sc WHERE jaccard > mean + 1e-12 AND score >= -0.5")
def jaccard_zscore(spark, sf):
    return L.strong(L.scored(L.shared_groups(R.links(spark, sf))), -0.5).withColumn("score", F.round("score", 5))


@query("G34", sql=f"WITH {_J}, k AS (SELECT a, b, score FROM sc WHERE jaccard > mean + 1e-12 AND score >= -0.9) SELECT x.a, x.b, round(x.score + y.score, 5) AS score FROM k x JOIN k y ON x.a = y.b AND x.b = y.a WHERE x.a < x.b AND x.score + y.score >= -1.5")
def reciprocal_edges(spark, sf):
    links = L.strong(L.scored(L.shared_groups(R.links(spark, sf))), -0.9)
    return L.reciprocal(links, -1.5).withColumn("score", F.round("score", 5))


@query("O6", sql="WITH l AS (SELECT l_suppkey AS a, l_partkey AS b, sum(l_quantity) AS score FROM lineitem GROUP BY 1, 2) SELECT a, b, score FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS r, count(*) OVER (PARTITION BY a) AS n FROM l) WHERE r <= 5 AND n <= 20000")
def topk_links(spark, sf):
    l = R.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b")).agg(F.sum("l_quantity").alias("score"))
    return L.top_links(l, 5, 20000)


@query("A24", sql="WITH l AS (SELECT l_suppkey AS a, l_partkey AS b, sum(l_quantity) AS score FROM lineitem GROUP BY 1, 2), h AS (SELECT floor(score)::BIGINT AS bin, count(*) AS c FROM l GROUP BY 1), c AS (SELECT bin, sum(c) OVER (ORDER BY bin DESC) AS above FROM h) SELECT min(bin)::DOUBLE AS threshold FROM c WHERE above <= 30 * (SELECT count(DISTINCT a) FROM l)")
def auto_score_threshold(spark, sf):
    l = R.table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b")).agg(F.sum("l_quantity").alias("score"))
    return L.auto_threshold(l, 30)


@query("F20", sql=f"WITH {R.LINKS}, p AS (SELECT node, sum(n) AS t FROM links GROUP BY 1), s AS (SELECT t, count(*) AS c FROM p GROUP BY 1), q AS (SELECT t, c, sum(c) OVER (ORDER BY t) AS upto, (SELECT sum(c) FROM s) AS al FROM s) SELECT node, t::BIGINT AS t FROM p WHERE t IN (SELECT t FROM q WHERE upto >= 0.05 * al AND upto - c < 0.95 * al)")
def depth_quantile_filter(spark, sf):
    return L.depth_filter(R.links(spark, sf)).groupBy("node").agg(F.sum("n").alias("t"))


@query("G4", "A32", sql="""WITH RECURSIVE e AS (SELECT DISTINCT l_orderkey AS a, 100000000 + l_partkey AS b FROM lineitem WHERE l_quantity >= 49), u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
    r AS (SELECT a AS node, a AS root FROM u UNION SELECT u.b, r.root FROM r JOIN u ON u.a = r.node) SELECT node, min(root) AS component FROM r GROUP BY 1""")
def components(spark, sf):
    e = R.table(spark, sf, "lineitem").where("l_quantity >= 49").select(F.col("l_orderkey").alias("src"), (F.col("l_partkey") + 100_000_000).alias("dst"))
    return connected_components(e)


@query("A26", "F23", sql="""WITH v AS (SELECT substring(o_orderpriority, 3, 1 + o_custkey % 2) AS ref, substring(o_orderpriority, 3, 1 + o_orderkey % 3) AS alt, o_orderkey % 4 AS ro, o_orderkey % 7 AS ao FROM orders),
    h AS (SELECT sum(CASE WHEN length(ref) = length(alt) THEN length(ref) ELSE 0 END)::BIGINT AS substitutions, sum(CASE WHEN length(ref) <> length(alt) THEN abs(length(ref) - length(alt)) ELSE 0 END)::BIGINT AS indels FROM v WHERE ao > 1 AND ao >= 2 * ro)
    SELECT substitutions, indels, round(100 * (1 - (substitutions + indels) / n), 6) AS quality, round(-10 * log10((substitutions + indels) / n + 1e-10), 6) AS qv FROM h, (SELECT sum(n_chars) AS n FROM documents)""")
def polish_report(spark, sf):
    o = R.table(spark, sf, "orders")
    cut = lambda n: F.substr(F.col("o_orderpriority"), F.lit(3), n.cast("int"))
    v = o.select(cut(1 + F.col("o_custkey") % 2).alias("ref"), cut(1 + F.col("o_orderkey") % 3).alias("alt"), (F.col("o_orderkey") % 4).alias("ro"), (F.col("o_orderkey") % 7).alias("ao"))
    size = R.table(spark, sf, "documents").agg(F.sum("n_chars").alias("bases"))
    return A.polish_report(v, size).withColumns({"quality": F.round("quality", 6), "qv": F.round("qv", 6)})


@query("A27", "D6", "Q12", "Q21", "X8", sql=f"WITH {R.PATHS}, u AS (SELECT name, unnest(string_split(path, '_')) AS u FROM paths), l AS (SELECT i AS uid, 20 + i % 7 AS len FROM generate_series(0, 49) t(i)) SELECT name, (sum(len) - (count(*) - 1) * 4)::BIGINT AS n FROM u JOIN l ON l.uid = regexp_replace(u, '[FR]', '')::INTEGER GROUP BY 1")
def super_read_sizes(spark, sf):
    units = R.paths(spark, sf).select("name", F.explode(S.parse_path("path")).alias("u")).select("name", F.col("u.id").alias("uid"))
    lens = units.join(R.unitigs(spark, sf), "uid").groupBy("name").agg(F.collect_list("len").alias("l"))
    return lens.select("name", S.path_length("l", 5).alias("n"))


@query("A29", sql="SELECT floor((l_quantity * 100 + 500) / 1000)::BIGINT AS library, max(l_quantity * 100)::BIGINT AS longest, count(*) AS n FROM lineitem WHERE l_quantity * 100 >= 2500 GROUP BY 1")
def library_bins(spark, sf):
    size = F.col("l_quantity") * 100
    return R.table(spark, sf, "lineitem").where(size >= 2500).groupBy(F.floor((size + 500) / 1000).alias("library")).agg(F.max(size).cast("bigint").alias("longest"), F.count("*").alias("n"))


@query("A30", sql="SELECT greatest(1, least(2, (SELECT sum(n_chars) FROM documents) // (SELECT sum(length(text)) * 100 FROM benchmark)))::BIGINT AS ploidy")
def ploidy_estimate(spark, sf):
    d = R.table(spark, sf, "documents").agg(F.sum("n_chars").alias("d"))
    b = R.table(spark, sf, "benchmark").agg((F.sum(F.length("text")) * 100).alias("b"))
    return d.crossJoin(b).select(F.greatest(F.lit(1), F.least(F.lit(2), F.expr("d div b"))).cast("bigint").alias("ploidy"))


@query("A31", sql=f"{_M} SELECT qry, round(sum(least(qlen, greatest(qs, qe)) - least(qs, qe) + 1) / max(qlen), 6) AS ratio FROM matches GROUP BY 1")
def span_ratio(spark, sf):
    span = F.least("qlen", F.greatest("qs", "qe")) - F.least("qs", "qe") + 1
    return R.matches(spark, sf).groupBy("qry").agg(F.round(F.sum(span) / F.max("qlen"), 6).alias("ratio"))
