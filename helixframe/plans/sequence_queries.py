"""Queries over paths, pieces of sequences, edits and merged matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.functions import sequence as S
from helixframe.operators import aggregates as A
from helixframe.operators import editing as E
from helixframe.operators import merging as M
from helixframe.operators import scaffold as G
from helixframe.plans import kernel_sql as K
from helixframe.plans import relations as R
from helixframe.plans.registry import query
from helixframe.runtime import materialize

RC = R.revcomp_sql


@query("X1", sql=f"WITH {R.FRAGMENTS} SELECT name, {RC('seq')} AS rc, {RC(RC('seq'))} = seq AS back FROM fragments")
def revcomp_roundtrip(spark, sf):
    rc = S.reverse_complement("seq")
    return R.fragments(spark, sf).select("name", rc.alias("rc"), (S.reverse_complement(rc) == F.col("seq")).alias("back"))


@query("X3", "X4", "D3", "D4", "D5", sql=f"WITH {R.PATHS} SELECT name, len(string_split(path, '_'))::INTEGER AS n, array_to_string(list_reverse([CASE WHEN ends_with(u, 'R') THEN replace(u, 'R', 'F') ELSE replace(u, 'F', 'R') END FOR u IN string_split(path, '_')]), '_') AS back FROM paths")
def path_reverse(spark, sf):
    p = S.parse_path("path")
    return R.paths(spark, sf).select("name", F.size(p).alias("n"), S.path_name(S.reverse_path(p)).alias("back"))


@query("X5", sql=f"WITH {R.PATHS} SELECT name, array_to_string(list_concat(string_split(path, '_'), string_split(path, '_')[3:]), '_') AS joined FROM paths")
def path_append(spark, sf):
    p = S.parse_path("path")
    return R.paths(spark, sf).select("name", S.path_name(S.append_path(p, p, 2)).alias("joined"))


@query("X6", "D4", sql=f"""WITH {R.PATHS}, p AS (SELECT x.name, string_split(x.path, '_') AS a, string_split(y.path, '_') AS b FROM paths x JOIN paths y ON y.name = x.name + 1)
    SELECT name, coalesce(list_max([m FOR m IN generate_series(1, least(len(a), len(b)) - 1) IF array_to_string(list_slice(a, len(a) - m + 1, len(a)), '_') = array_to_string(list_slice(b, 1, m), '_')]), 0)::INTEGER AS m FROM p""")
def path_overlaps(spark, sf):
    x = R.paths(spark, sf)
    y = x.select((F.col("name") - 1).alias("name"), F.col("path").alias("other"))
    return x.join(y, "name").select("name", S.path_overlap(S.parse_path("path"), S.parse_path("other")).alias("m"))


_UNITIGS = """digits AS (SELECT i AS uid, i * 7919 + 13 AS v FROM generate_series(0, 49) t(i)),
core AS (SELECT uid, array_to_string([substring('ACGT', ((v // (4::BIGINT ** (11 - j))::BIGINT) % 4 + 1)::INTEGER, 1) FOR j IN generate_series(0, 11)], '') AS c FROM digits),
unitigs AS (SELECT uid, 'ACGT' || c || substring(c, 1, (uid % 7)::INTEGER) || 'ACGT' AS seq FROM core)"""


@query("X7", "G22", "D1", sql=f"""WITH {R.PATHS}, {_UNITIGS}, u AS (SELECT name, unnest(string_split(path, '_')) AS u, generate_subscripts(string_split(path, '_'), 1) AS i FROM paths),
    s AS (SELECT name, i, CASE WHEN ends_with(u, 'R') THEN {RC('seq')} ELSE seq END AS s FROM u JOIN unitigs ON uid = regexp_replace(u, '[FR]', '')::INTEGER)
    SELECT name, string_agg(CASE WHEN i = 1 THEN s ELSE substring(s, 5) END, '' ORDER BY i) AS seq FROM s GROUP BY 1""")
def stitch_by_path(spark, sf):
    paths = R.paths(spark, sf).select("name", S.parse_path("path").alias("p"))
    return E.stitch_paths(paths, R.unitigs(spark, sf), 5)


@query("X9", "X10", sql="""WITH p AS (SELECT doc_id AS name, regexp_extract_all(text, '([^\\n]+|\\n+)') AS parts FROM documents), e AS (SELECT name, unnest(parts) AS piece, generate_subscripts(parts, 1) AS i FROM p),
    c AS (SELECT *, sum(length(piece)) OVER (PARTITION BY name ORDER BY i)::BIGINT AS stop FROM e) SELECT name, stop - length(piece) + 1 AS start, stop FROM c WHERE piece NOT LIKE chr(10) || '%'""")
def splits_at_runs(spark, sf):
    docs = R.table(spark, sf, "documents").select(F.col("doc_id").alias("name"), F.col("text").alias("seq"))
    return S.segments(docs, r"[^\n]", r"[\n]").select("name", "start", "stop")


@query("X12", "X13", "K7", sql=f"WITH {R.FRAGMENTS} SELECT name, start::INTEGER AS start, substring(seq, start::INTEGER, 60) AS piece FROM (SELECT name, seq, unnest(generate_series(1, length(seq), 40)) AS start FROM fragments) WHERE start = 1 OR (start + 20 <= length(seq) AND length(substring(seq, start::INTEGER, 60)) >= 30)")
def windowed_chunks(spark, sf):
    return S.windows(R.fragments(spark, sf), 60, 40, least=30)


@query("X11", sql=f"WITH {R.FRAGMENTS} SELECT name, CASE WHEN length(seq) > 100 THEN substring(seq, 1, 50) || repeat('N', length(seq) - 100) || substring(seq, length(seq) - 49) ELSE seq END AS masked FROM fragments")
def end_masked(spark, sf):
    return R.fragments(spark, sf).select("name", S.end_mask("seq", 50).alias("masked"))


@query("X14", "G11", sql=f"WITH {R.MATCHES} SELECT id, (floor(mlen / qlen * 10000 + 0.50001)::BIGINT // 100)::VARCHAR || '.' || lpad((floor(mlen / qlen * 10000 + 0.50001)::BIGINT % 100)::VARCHAR, 2, '0') AS cov FROM matches")
def percent_strings(spark, sf):
    return R.matches(spark, sf).select("id", S.percent2(F.col("mlen") / F.col("qlen")).alias("cov"))


@query("X19", sql="SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 12000 ELSE floor(8000 - (least(400000, greatest(50000, o_totalprice)) - 50000) / 350000 * 5000)::BIGINT END AS n FROM orders")
def spacer_lengths(spark, sf):
    score = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice"))
    return R.table(spark, sf, "orders").select("o_orderkey", S.spacer_length(score, 50_000, 400_000).alias("n"))


@query("K14", sql=f"WITH {R.FRAGMENTS}, l AS (SELECT name, i, substring(seq, (i * 50 + 1)::INTEGER, 50) AS s FROM (SELECT name, seq, unnest(generate_series(0, (length(seq) - 1) // 50)) AS i FROM fragments)) SELECT name, string_agg(s, chr(10) ORDER BY i) AS wrapped FROM l GROUP BY 1")
def wrapped_lines(spark, sf):
    return R.fragments(spark, sf).select("name", S.wrap_lines("seq", 50).alias("wrapped"))


@query("F15", "F28", "Y4", "Y5", sql=f"WITH {R.MATCHES} SELECT id FROM matches WHERE (mlen >= 2000 OR mlen * 100 > 20 * qlen) AND (rs <= 2000 OR re >= rlen - 2000) AND ref <> qry AND rlen > qlen")
def end_hang_filter(spark, sf):
    m = R.matches(spark, sf)
    long = (F.col("mlen") >= 2000) | (F.col("mlen") * 100 > 20 * F.col("qlen"))
    near = (F.col("rs") <= 2000) | (F.col("re") >= F.col("rlen") - 2000)
    return m.where(long & near & (F.col("ref") != F.col("qry")) & (F.col("rlen") > F.col("qlen"))).select("id")


@query("Y14", "Y13", "F14", sql=f"WITH {R.MATCHES} SELECT id, CASE WHEN qs < qe THEN qry * 2 ELSE qry * 2 + 1 END AS qid, CASE WHEN qs < qe THEN qs ELSE qlen - qs + 1 END AS a, CASE WHEN qs < qe THEN qe ELSE qlen - qe + 1 END AS b FROM matches")
def forward_strand(spark, sf):
    fwd = F.col("qs") < F.col("qe")
    turn = lambda c: F.when(fwd, F.col(c)).otherwise(F.col("qlen") - F.col(c) + 1)
    return R.matches(spark, sf).select("id", F.when(fwd, F.col("qry") * 2).otherwise(F.col("qry") * 2 + 1).alias("qid"), turn("qs").alias("a"), turn("qe").alias("b"))


@query("G25", "F31", sql=f"""WITH {R.FRAGMENTS}, c AS (SELECT name, 0 AS p FROM fragments UNION SELECT name, p FROM (SELECT name, length(seq) AS n, unnest([40, 40 + (name % 30)::INTEGER, 90]) AS p FROM fragments) WHERE p < n),
    o AS (SELECT c.name, p, row_number() OVER (PARTITION BY c.name ORDER BY p) - 1 AS part, lead(p) OVER (PARTITION BY c.name ORDER BY p) AS q, seq FROM c JOIN fragments f ON c.name = f.name)
    SELECT name, part::INTEGER AS part, p + 1 AS start, substring(seq, p + 1, coalesce(q, length(seq)) - p) AS seq FROM o""")
def broken_contigs(spark, sf):
    f = R.fragments(spark, sf)
    at = f.select("name", F.explode(F.array(F.lit(40), F.lit(40) + (F.col("name") % 30).cast("int"), F.lit(90))).alias("pos"))
    return E.break_at(f, at)


def _draws():
    """Two numbers for each base by a multiplicative generator, which SQL has too."""
    one = (F.col("name") * 1000003 + F.col("pos")) % 2147483647 * 48271 % 2147483647
    return one, one * 16807 % 2147483647


@query("G29", "D16", sql=K.APPLIED)
def apply_edits(spark, sf):
    docs = R.table(spark, sf, "documents").select(F.col("doc_id").alias("name"), F.col("text").alias("seq"))
    return E.apply_edits(docs, E.random_edits(docs, 0.01, draw=_draws())).select("name", F.md5("seq").alias("digest"), "applied", "skipped")


@query("G30", sql=f"""WITH {R.FRAGMENTS}, s AS (SELECT name, unnest([5, 20, 24, 60]) AS a, unnest([9, 30, 40, 64]) AS b FROM fragments),
    p AS (SELECT name, substring(seq, 1, 4) || 'n5' || substring(seq, 10, 10) || 'n20' || substring(seq, 31, 29) || 'n60' || substring(seq, 65) AS seq FROM fragments WHERE length(seq) >= 64)
    SELECT name, seq FROM p""")
def replaced_segments(spark, sf):
    """Segments replaced from right to left; one that starts inside an earlier one gives way."""
    f = R.fragments(spark, sf).where(F.length("seq") >= 64)
    spans = F.explode(F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("stop")) for a, b in ((5, 9), (20, 30), (24, 40), (60, 64)))))
    segs = f.select("name", spans.alias("x")).select("name", "x.start", "x.stop", F.concat(F.lit("n"), F.col("x.start").cast("string")).alias("new"))
    return E.replace_segments(f, segs)


@query("G32", sql=K.RANDOM_EDITS)
def random_errors(spark, sf):
    return E.random_edits(R.fragments(spark, sf), 0.05, draw=_draws())


@query("G26", "G27", "W17", sql="""WITH p AS (SELECT l_orderkey AS name, l_linenumber, l_partkey, repeat(CASE WHEN l_suppkey % 2 = 0 THEN 'A' ELSE 'T' END, 3) AS s, 1 + l_partkey % 4 AS before, 1 + l_suppkey % 5 AS after, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS i FROM lineitem),
    g AS (SELECT *, least(lag(after) OVER (PARTITION BY name ORDER BY i), before) AS g FROM p) SELECT name, string_agg(CASE WHEN i = 1 THEN '' ELSE repeat('N', g::INTEGER) END || s, '' ORDER BY i) AS seq FROM g GROUP BY 1""")
def scaffold_sequences(spark, sf):
    from pyspark.sql import Window

    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    p = R.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("name"), F.row_number().over(w).alias("i"), F.lit("AAA").alias("seq"), (F.col("l_suppkey") % 2 == 1).alias("rev"), (1 + F.col("l_partkey") % 4).alias("before"), (1 + F.col("l_suppkey") % 5).alias("after"))
    return E.scaffold(p)


@query("G31", "W5", sql=f"""WITH {R.MATCHES}, u AS (SELECT s_suppkey AS ref, 700 * d + 13 * (s_suppkey % 40) AS us, 700 * d + 13 * (s_suppkey % 40) + 5 AS ue FROM supplier, generate_series(1, 20) v(d)),
    n AS (SELECT *, lag(re) OVER w AS pe, lead(rs) OVER w AS ns FROM matches WINDOW w AS (PARTITION BY ref ORDER BY rs, re, id)),
    e AS (SELECT *, least(greatest(0, rs - 1 - coalesce(pe, 0)), CASE WHEN qs < qe THEN qs - 1 ELSE qlen - qs END, 100000) AS b, least(greatest(0, coalesce(ns, rlen + 1) - re - 1), CASE WHEN qs < qe THEN qlen - qe ELSE qe - 1 END, 100000) AS a FROM n)
    SELECT id, ref, qry, CASE WHEN EXISTS (SELECT 1 FROM u WHERE u.ref = e.ref AND us >= rs - b AND ue < rs) THEN 0 ELSE b END AS before, CASE WHEN EXISTS (SELECT 1 FROM u WHERE u.ref = e.ref AND us > re AND ue <= re + a) THEN 0 ELSE a END AS after FROM e""")
def extended_matches(spark, sf):
    """Matches stretched into free reference, but not over runs of unknown bases."""
    s = R.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("name"), F.explode(F.sequence(F.lit(1), F.lit(20))).alias("d"))
    at = F.col("d") * 700 + F.col("name") % 40 * 13
    return E.extend_matches(R.matches(spark, sf), s.select("name", at.alias("start"), (at + 5).alias("stop")))


@query("Y2", "A22", sql=f"WITH {R.FRAGMENTS} SELECT name, substring(seq, (name % 9 + 1)::INTEGER, (length(seq) - name % 9 - name % 5)::INTEGER) AS seq FROM fragments WHERE length(seq) - name % 9 - name % 5 >= 120")
def trimmed_sequences(spark, sf):
    f = R.fragments(spark, sf)
    cuts = f.select("name", (F.col("name") % 9).cast("int").alias("front"), (F.col("name") % 5).cast("int").alias("back"))
    return A.trimmed(f, cuts, 120)


@query("Y16", "W7", sql=f"""WITH {R.MATCHES}, b AS (SELECT *, max(re) OVER (PARTITION BY ref ORDER BY rs, re, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM matches WHERE mlen < 700)
    SELECT ref, e + 1 AS start, rs - 1 AS stop FROM b WHERE rs - 1 - e > 20""")
def unaligned_gaps(spark, sf):
    refs = R.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("name"), F.repeat(F.lit("ACGT"), F.lit(6000)).alias("seq"))
    return E.fill_gaps(R.matches(spark, sf).where("mlen < 700"), refs, 20, 1_000_000).select("ref", "start", "stop")


@query("Y21", sql=f"WITH {R.MATCHES} SELECT o_orderkey AS qry FROM orders WHERE o_custkey > 500 AND o_orderkey NOT IN (SELECT qry FROM matches GROUP BY 1 HAVING sum(mlen) * 100 > 10 * max(qlen))")
def added_sequences(spark, sf):
    placed = A.duplicates_by_coverage(R.matches(spark, sf), 10)
    new = R.table(spark, sf, "orders").where("o_custkey > 500").select(F.col("o_orderkey").alias("qry"))
    return new.join(placed, "qry", "left_anti")


@query("G11", "G12", "X14", sql=K.MERGED)
def merged_matches(spark, sf):
    return M.with_percents(M.merge_matches(R.matches(spark, sf), 2000)).select("ref", "qry", "rs", "re", "qs", "qe", "n", "idy2", "cov_r", "cov_q")


@query("G13", "Q13", sql=K.MERGED_AND_TILED)
def merged_and_tiled(spark, sf):
    return M.merge_and_tile(R.matches(spark, sf), 2000, least=1000)


@query("G14", sql=K.INTERVAL_TILING)
def interval_tiling(spark, sf):
    return M.interval_tiling(R.matches(spark, sf), 17)


@query("G10", "J20")
def coverage_gap_regions(spark, sf):
    return M.coverage_gaps(R.matches(spark, sf))


@query("A17", sql=K.MEDIANS)
def iterative_median_clusters(spark, sf):
    li = R.table(spark, sf, "lineitem")
    g = li.select((F.col("l_partkey") % 40).alias("u1"), (F.col("l_suppkey") % 10).alias("u2"), R.item_id().alias("id"), (F.col("l_quantity") * 40).cast("long").alias("gap"), F.round(F.col("l_discount") * 1000).cast("long").alias("over"))
    return M.gap_consensus(g, radius=200)


@query("F25", sql=K.THINNED)
def thinned_breaks(spark, sf):
    return M.thinned_positions(R.matches(spark, sf).select("ref", F.col("rs").alias("pos"), F.col("mlen").alias("score")), "ref", 500)


@query("F26", sql=K.PLACED)
def contained_placements(spark, sf):
    return M.placed_longest_first(R.matches(spark, sf).select(F.col("ref").alias("key"), "id", F.col("rs").alias("a"), F.col("re").alias("b")), "key", 50)


@query("F27", sql=K.ADVANCING)
def monotone_ends(spark, sf):
    return M.advancing(R.matches(spark, sf).select("ref", "id", "rs", "re"), "ref", "rs", "re", 100)


@query("F17", sql=K.STREAMED)
def streamed_matches(spark, sf):
    return M.filter_matches(R.matches(spark, sf), span=0.05).select("id", "qry")


def _scaffold_inputs(spark, sf):
    from helixframe.operators import joins as J

    links = J.best_joins(J.merge_geometry(J.adjacent(R.matches(spark, sf), 1)), overhang=4000)
    contigs = R.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("name"), (15500 + F.col("s_suppkey") * 10).alias("len"))
    return contigs, links


@query("G20", "G19", "D13", "D14", "D21", "Q18", "Q23")
def scaffold_walk(spark, sf):
    return G.walk_graph(*_scaffold_inputs(spark, sf))


@query("G23", "G22", "X7")
def scaffold_path_sequences(spark, sf):
    contigs, links = _scaffold_inputs(spark, sf)
    seqs = contigs.select("name", F.repeat(F.lit("ACGTT"), F.col("len").cast("int") / F.lit(500)).alias("seq"))
    return G.path_sequences(G.walk_graph(contigs, links), seqs).select("name", F.length("seq").alias("n"), F.md5("seq").alias("digest"))


@query("G33", "G35", "G36", "J15")
def barcode_trees(spark, sf):
    from helixframe.operators import links as L

    shared = materialize(L.shared_groups(R.links(spark, sf)), "shared")  # both directions of a link read it, with their means
    return G.trees(L.reciprocal(L.strong(L.scored(shared), -2.0), -3.0))


@query("G24", sql=K.GAP_PATHS)
def gap_paths(spark, sf):
    part = R.table(spark, sf, "part")
    edges = part.select(F.col("p_partkey").cast("string").alias("src"), ((F.col("p_partkey") * 3 + F.col("p_size")) % 200).cast("string").alias("dst"), (F.col("p_size") + 1).cast("long").alias("add"))
    gaps = R.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_suppkey").cast("string").alias("src"), (F.col("s_nationkey") * 7).cast("string").alias("dst"), F.lit(60).cast("long").alias("gap"))
    return G.fill_by_search(gaps, edges).select("id", F.array_join("path", "_").alias("path"))
