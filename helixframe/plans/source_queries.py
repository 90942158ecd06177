"""Queries over text formats: tables are written as files to the shared folder and read back.

The SQL states the rows that were written, so format, sink and source are all checked.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions import sequence as S
from helixframe.plans import relations as R
from helixframe.plans.registry import query
from helixframe.plans.sequence_queries import _UNITIGS
from helixframe.runtime import shared_dir
from helixframe.sources import formats, sinks


def stored(lines: DataFrame, **options) -> str:
    """The folder that now holds the column ``value`` as text files."""
    path = f"{shared_dir(lines.sparkSession)}/text-{uuid.uuid4().hex}"
    lines.write.options(**options).text(path)
    return path


def _line(rows: DataFrame, *parts, sep: str = "\t") -> DataFrame:
    return rows.select(F.concat_ws(sep, *(F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts)).alias("value"))


def _in_one_file(rows: DataFrame, *order) -> DataFrame:
    """For formats in which a line's ordinal is its id."""
    return rows.repartition(1).sortWithinPartitions(*order)


_M = f"WITH {R.MATCHES}"


@query("S1", "S2", "S3", "K14", sql=f"WITH {R.READS} SELECT name, seq FROM reads WHERE seq <> ''")
def fasta_files(spark, sf):
    """Two folders of wrapped multi-line FASTA as one table."""
    reads = R.reads(spark, sf)
    paths = [stored(sinks.fasta_lines(reads.where(F.col("name") % 2 == k), columns=70)) for k in (0, 1)]
    return formats.fasta(spark, paths).select(F.col("name").cast("bigint").alias("name"), "seq")


@query("S7", sql=f"WITH {R.FRAGMENTS} SELECT name, length(seq) AS n, seq FROM fragments WHERE seq <> ''")
def gzip_fasta(spark, sf):
    path = stored(sinks.fasta_lines(R.fragments(spark, sf)), compression="gzip")
    return formats.fasta(spark, path).select(F.col("name").cast("bigint").alias("name"), F.length("seq").alias("n"), "seq")


@query("S4", "D6", sql="SELECT (49 - i)::BIGINT AS uid, (20 + i % 7)::INTEGER AS len FROM generate_series(0, 49) t(i)")
def unitig_length_file(spark, sf):
    """Names in the file are ignored: the ordinal of the line is the id."""
    units = _in_one_file(R.unitigs(spark, sf), F.desc("uid"))
    return formats.unitig_lengths(spark, stored(_line(units, F.col("uid") * 3, "len", sep=" ")))


@query("S5", sql=f"WITH {_UNITIGS} SELECT (49 - uid)::BIGINT AS uid, seq FROM unitigs")
def unitig_sequence_file(spark, sf):
    units = _in_one_file(R.unitigs(spark, sf), F.desc("uid"))
    return formats.numbered_fasta(spark, stored(sinks.fasta_lines(units, "uid")))


def _summaries(spark, sf) -> DataFrame:
    n = lambda c: F.col(c).cast("int")
    q = F.col("l_quantity").cast("int")
    li = R.table(spark, sf, "lineitem")
    return li.select(
        F.concat(F.lit("r"), F.col("l_orderkey").cast("string")).alias("read"), (n("l_linenumber") * 100 + n("l_partkey") % 50).alias("r_start"), (n("l_linenumber") * 100 + n("l_partkey") % 50 + q).alias("r_end"),
        F.lit(1).alias("q_start"), q.alias("q_end"), (q % 9 + 1).alias("n_mers"), (q % 5).alias("r_cons"), (q % 4).alias("q_cons"), (q * 2).alias("r_cover"), (q * 3).alias("q_cover"),
        (5000 + F.col("l_orderkey") % 100).alias("r_len"), (300 + F.col("l_suppkey")).alias("q_len"), (1 + q / 64).alias("stretch"), (n("l_linenumber") * -0.5).alias("offset"), (q / 32).alias("avg_err"),
        F.concat(F.col("l_partkey").cast("string"), F.lit("F_"), F.col("l_suppkey").cast("string"), F.lit("R")).alias("frag"),
        F.array(q % 9, q % 3, n("l_linenumber")).alias("kmers_info"), F.array(q, q % 7, q * 2).alias("bases_info"), F.col("l_suppkey"),
    )


_SUMMARIES = """SELECT 'r' || l_orderkey AS read, (l_linenumber * 100 + l_partkey % 50)::INTEGER AS r_start, (l_linenumber * 100 + l_partkey % 50 + q)::INTEGER AS r_end, 1 AS q_start, q AS q_end, q % 9 + 1 AS n_mers, q % 5 AS r_cons, q % 4 AS q_cons, q * 2 AS r_cover, q * 3 AS q_cover,
  5000 + l_orderkey % 100 AS r_len, 300 + l_suppkey AS q_len, 1 + q / 64 AS stretch, l_linenumber * -0.5::DOUBLE AS "offset", q / 32 AS avg_err, l_partkey || 'F_' || l_suppkey || 'R' AS frag,
  concat_ws(' ', q % 9, q % 3, l_linenumber) AS kmers, concat_ws(' ', q, q % 7, q * 2) AS bases, l_suppkey FROM (SELECT *, l_quantity::INTEGER AS q FROM lineitem)"""


def _joined(df: DataFrame) -> DataFrame:
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), " ")
    return df.select("read", *(c for c, _ in formats.COORDS), text("kmers_info").alias("kmers"), text("bases_info").alias("bases"))


@query("S6", "K1", sql=f"SELECT * EXCLUDE l_suppkey FROM ({_SUMMARIES})")
def coords_file(spark, sf):
    path = stored(sinks.coords_lines(_summaries(spark, sf)))
    return _joined(formats.coords(spark, path).where("complete"))


@query("S19", sql=f"SELECT read, count(*) AS n, sum(n_mers)::BIGINT AS mers, max(r_len) AS r_len FROM ({_SUMMARIES}) GROUP BY 1")
def merged_coords_files(spark, sf):
    """Summaries from two indices, which must agree on every read's length."""
    rows = _summaries(spark, sf)
    parts = [formats.coords(spark, stored(sinks.coords_lines(rows.where(F.col("l_suppkey") % 2 == k)))) for k in (0, 1)]
    return formats.merged_coords(parts).groupBy("read").agg(F.count("*").alias("n"), F.sum("n_mers").alias("mers"), F.max("r_len").alias("r_len"))


_FASTQ = "SELECT 'o' || o_orderkey AS name, repeat('ACGTN', (o_custkey % 30 + 1)::INTEGER) AS seq, repeat('@I+5>', (o_custkey % 30 + 1)::INTEGER) AS qual FROM orders"


def _fastq_rows(spark, sf) -> DataFrame:
    n = (F.col("o_custkey") % 30 + 1).cast("int")
    return R.table(spark, sf, "orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("name"), F.repeat(F.lit("ACGTN"), n).alias("seq"), F.repeat(F.lit("@I+5>"), n).alias("qual"))


@query("S8", sql=_FASTQ)
def fastq_file(spark, sf):
    """Four-line records; qualities may start with any mark."""
    rows = _fastq_rows(spark, sf)
    path = stored(rows.select(F.concat(F.lit("@"), "name", F.lit(" x\n"), "seq", F.lit("\n+\n"), "qual").alias("value")))
    return formats.fastq(spark, path)


@query("S8", "S3", sql=f"SELECT name, seq FROM ({_FASTQ})")
def wrapped_fastq_to_fasta(spark, sf):
    rows = _fastq_rows(spark, sf)
    path = stored(rows.select(F.concat(F.lit("@"), "name", F.lit("\n"), S.wrap_lines("seq", 40), F.lit("\n+\n"), S.wrap_lines("qual", 40)).alias("value")))
    return formats.fasta(spark, stored(sinks.fasta_lines(formats.fastq(spark, path, wrapped=True))))


@query("S9", sql=f"{_M} SELECT rs, re, qs, qe, mlen, idy::DOUBLE AS idy, rlen, qlen, ref::VARCHAR AS ref, 'q' || qry AS qry FROM matches")
def show_coords_file(spark, sf):
    m = R.matches(spark, sf)
    bar = F.lit("|")
    path = stored(_line(m, F.lit("  "), "rs", "re", bar, "qs", "qe", bar, "mlen", "mlen", bar, "idy", bar, "rlen", "qlen", bar, F.lit("1.00"), F.lit("2.00"), bar, "ref", F.concat(F.lit("q"), F.col("qry").cast("string")), sep="  "))
    return formats.show_coords(spark, path).select("rs", "re", "qs", "qe", "mlen", "idy", "rlen", "qlen", "ref", "qry")


_PAF = f"""{_M}, p AS (SELECT 'q' || qry AS qry, qlen, least(qs, qe) - 1 AS q0, greatest(qs, qe) AS q1, qs < qe AS fwd, 'c' || ref AS ref, rlen, rs - 1 AS r0, re AS r1, idy FROM matches)"""


def _paf(spark, sf) -> DataFrame:
    m = R.matches(spark, sf)
    lo, hi = F.least("qs", "qe") - 1, F.greatest("qs", "qe")
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    tag = F.format_string("dv:f:0.%02d", 100 - F.col("idy"))
    lines = _line(m, name("q", "qry"), "qlen", lo, hi, F.when(F.col("qs") < F.col("qe"), "+").otherwise("-"), name("c", "ref"), "rlen", F.col("rs") - 1, "re", "mlen", "mlen", F.col("idy") - 40, F.lit("tp:A:P"), tag)
    return formats.paf(spark, stored(lines))


@query("S10", sql=f"{_PAF} SELECT qry, qlen, q0, q1, CASE WHEN fwd THEN '+' ELSE '-' END AS strand, ref, rlen, r0, r1, (idy - 40)::INTEGER AS mapq, 'P' AS kind, '0.' || lpad((100 - idy)::VARCHAR, 2, '0') AS dv FROM p")
def paf_file(spark, sf):
    return _paf(spark, sf).select("qry", "qlen", "q0", "q1", "strand", "ref", "rlen", "r0", "r1", "mapq", F.col("tags")["tp"].alias("kind"), F.col("tags")["dv"].alias("dv"))


@query(
    "F12",
    "F14",
    "S10",
    sql=f"""{_PAF} SELECT r0 + 1 AS rs, r1 AS re, CASE WHEN fwd THEN q0 + 1 ELSE q1 END AS qs, CASE WHEN fwd THEN q1 ELSE q0 + 1 END AS qe, round(100 * (1 - (100 - idy) / 100), 6) AS idy,
    floor(10000 * (r1 - r0) / rlen) / 100 AS cov_r, floor(10000 * (q1 - q0) / qlen) / 100 AS cov_q, ref, qry FROM p WHERE r1 - r0 > greatest(400, 6000 / 6) AND idy - 40 >= 52 AND (r0 < 2000 OR rlen - r1 < 2000)""",
)
def paf_overhanging_matches(spark, sf):
    m = formats.paf_as_matches(formats.paf_overhanging(_paf(spark, sf), 6000, 52, 2000))
    return m.select("rs", "re", "qs", "qe", F.round("idy", 6).alias("idy"), "cov_r", "cov_q", "ref", "qry")


@query("S11", "F23", sql="SELECT 'c' || o_custkey AS ctg, o_orderkey AS pos, substring(o_orderpriority, 3, 1) AS ref, substring(o_orderpriority, 4, 2) AS alt, o_custkey % 3 AS ro, o_orderkey % 9 AS ao FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 9 > 1 AND o_orderkey % 9 >= 2 * (o_custkey % 3)")
def vcf_file(spark, sf):
    """Variants with one alternative that the sample is homozygous for."""
    o = R.table(spark, sf, "orders")
    alt = F.concat(F.substring("o_orderpriority", 4, 2), F.when(F.col("o_orderkey") % 5 == 0, ",T").otherwise(""))
    sample = F.concat_ws(":", F.lit("1/1"), (F.col("o_custkey") % 3).cast("string"), (F.col("o_orderkey") % 9).cast("string"))
    dot = F.lit(".")
    lines = _line(o, F.concat(F.lit("c"), F.col("o_custkey").cast("string")), "o_orderkey", dot, F.substring("o_orderpriority", 3, 1), alt, F.lit("50"), dot, dot, F.lit("GT:RO:AO"), sample)
    head = spark.range(1).select(F.lit("##fileformat=VCFv4.2\n#CHROM\tPOS").alias("value"))
    v = formats.vcf(spark, [stored(lines), stored(head)])
    v = v.select("ctg", "pos", "ref", "alt", F.col("sample")[1].cast("bigint").alias("ro"), F.col("sample")[2].cast("bigint").alias("ao"))
    return v.where((F.col("ao") > 1) & (F.col("ao") >= 2 * F.col("ro")))


def _sam(spark, sf) -> list[str]:
    s, li = R.table(spark, sf, "supplier"), R.table(spark, sf, "lineitem")
    head = _line(s, F.lit("@SQ"), F.concat(F.lit("SN:c"), F.col("s_suppkey").cast("string")), F.concat(F.lit("LN:"), (15500 + F.col("s_suppkey") * 10).cast("string")))
    group = _line(s.where("s_suppkey < 3"), F.lit("@RG"), F.concat(F.lit("ID:g"), F.col("s_suppkey").cast("string")))
    star, n = F.lit("*"), F.col("l_quantity").cast("int")
    rows = _line(li, F.concat(F.lit("q"), F.col("l_orderkey").cast("string")), (F.col("l_linenumber") % 2) * 16, F.concat(F.lit("c"), F.col("l_suppkey").cast("string")), F.col("l_partkey") + 1, n, F.concat(n.cast("string"), F.lit("M")), star, F.lit(0), F.lit(0), F.repeat(F.lit("C"), n), star)
    return [stored(head), stored(group), stored(rows)]


@query("S12", sql="SELECT 'SQ' AS kind, 'c' || s_suppkey AS name, 15500 + s_suppkey * 10 AS len FROM supplier UNION ALL SELECT 'RG', 'g' || s_suppkey, NULL FROM supplier WHERE s_suppkey < 3")
def sam_header_file(spark, sf):
    return formats.sam_header(spark, _sam(spark, sf))


@query("S12", sql="SELECT 'q' || l_orderkey AS name, (l_linenumber % 2 * 16)::INTEGER AS flag, 'c' || l_suppkey AS ctg, l_partkey + 1 AS pos, l_quantity::INTEGER AS mapq, repeat('C', l_quantity::INTEGER) AS seq FROM lineitem WHERE l_quantity >= 20")
def sam_alignment_file(spark, sf):
    return formats.sam(spark, _sam(spark, sf), 20)


@query("S13", sql="SELECT 'c' || s_suppkey AS ctg, 100 + d AS start, 900 + d AS stop FROM supplier, (VALUES (0), (7000), (14000)) v(d) WHERE 100 + d < 2000 OR 900 + d > 15500 + s_suppkey * 10 - 2000")
def bed_windows_near_ends(spark, sf):
    s = R.table(spark, sf, "supplier").select(F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("ctg"), (15500 + F.col("s_suppkey") * 10).alias("len"))
    rows = s.select("ctg", F.explode(F.array(F.lit(0), F.lit(7000), F.lit(14000))).alias("d"))
    head = stored(spark.range(1).select(F.lit("track name=x\n# none").alias("value")))
    return formats.bed_near_ends(formats.bed(spark, [stored(_line(rows, "ctg", F.col("d") + 100, F.col("d") + 900)), head]), s, 2000)


@query("S14", "F18", sql=f"{_M} SELECT qry::VARCHAR AS qry, (ref * 40)::VARCHAR AS ref, idy::DOUBLE AS idy, mlen, qs, qe, rs, re FROM matches WHERE idy >= 95 AND (qry <> ref * 40 OR (abs(qs - rs) > 100 AND abs(qe - re) > 100))")
def blast_file_self_hits(spark, sf):
    m = R.matches(spark, sf)
    path = stored(_line(m, "qry", F.col("ref") * 40, "idy", "mlen", F.lit(0), F.lit(0), "qs", "qe", "rs", "re"))
    return formats.self_hits(formats.blast6(spark, path), 95).select("qry", "ref", "idy", "mlen", "qs", "qe", "rs", "re")


@query("S15", "J22", sql=f"{_M} SELECT ref::VARCHAR AS ref, qry::VARCHAR AS qry, rlen, qlen, rs, re, qs, qe, 100 - idy AS errors FROM matches WHERE qry IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def delta_file_of_queries(spark, sf):
    """Alignments under their pair's head, kept where the query is listed."""
    m = R.matches(spark, sf)
    row = F.concat(F.concat_ws(" ", *(F.col(c).cast("string") for c in ("rs", "re", "qs", "qe")), (100 - F.col("idy")).cast("string"), F.lit("3 0")), F.lit("\n-5\n12\n0"))
    blocks = m.groupBy("ref", "qry", "rlen", "qlen").agg(F.array_join(F.sort_array(F.collect_list(row)), "\n").alias("rows"))
    lines = blocks.select(F.concat(F.lit(">"), F.concat_ws(" ", *(F.col(c).cast("string") for c in ("ref", "qry", "rlen", "qlen"))), F.lit("\n"), "rows").alias("value"))
    head = stored(spark.range(1).select(F.lit("/a.fa /b.fa\nNUCMER").alias("value")))
    listed = R.table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("qry"))
    return formats.delta(spark, [head, stored(lines)]).join(listed, "qry", "left_semi").select("ref", "qry", "rlen", "qlen", "rs", "re", "qs", "qe", "errors")


@query("S16", sql=f"WITH {R.FRAGMENTS}, {R.kmers_sql('fragments', 13, 'fk')} SELECT kmer, count(*) AS n FROM fk GROUP BY 1")
def kmer_count_file(spark, sf):
    from helixframe.operators import kmers

    counts = kmers.words(R.fragments(spark, sf), 13).groupBy("kmer").agg(F.count("*").alias("n"))
    return formats.kmer_counts(spark, stored(_line(counts, "kmer", "n", sep=" ")))


@query("S17", sql="SELECT 'p' || l_partkey AS piece, 's' || l_suppkey AS whole, l_linenumber * 1000 AS start, l_linenumber * 1000 + l_quantity::BIGINT AS stop, CASE WHEN l_returnflag = 'R' THEN 'r' ELSE 'f' END AS dir FROM lineitem")
def position_file(spark, sf):
    li = R.table(spark, sf, "lineitem")
    at = F.col("l_linenumber") * 1000
    path = stored(_line(li, F.concat(F.lit("p"), F.col("l_partkey").cast("string")), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")), at, at + F.col("l_quantity").cast("bigint"), F.when(F.col("l_returnflag") == "R", "r").otherwise("f")))
    return formats.positions(spark, path)


@query(
    "S18",
    sql=f"""WITH {R.LINKS}, h AS (SELECT node FROM links GROUP BY 1 HAVING count(*) >= 2)
    SELECT 'GROUP' AS kind, o_orderkey AS id, 'g' || o_orderkey AS name, NULL::VARCHAR AS more, NULL::BIGINT AS n FROM orders
    UNION ALL SELECT 'CONTIG', s_suppkey, 'c' || s_suppkey, NULL, 15500 + s_suppkey * 10 FROM supplier
    UNION ALL SELECT 'NODE', s_suppkey, 'c' || s_suppkey || '.L', 'c' || s_suppkey || '.R', NULL FROM supplier
    UNION ALL SELECT 'NODE_HITS', node, grp::VARCHAR, NULL, n FROM links WHERE node IN (SELECT node FROM h)""",
)
def cache_file(spark, sf):
    """All four kinds of records of a parsed alignment cache, as one table."""
    o, s = R.table(spark, sf, "orders"), R.table(spark, sf, "supplier")
    name = lambda p, c, t="": F.concat(F.lit(p), F.col(c).cast("string"), F.lit(t))
    hit = F.concat_ws(":", F.col("grp").cast("string"), F.col("n").cast("string"))
    hits = R.links(spark, sf).groupBy("node").agg(F.array_join(F.sort_array(F.collect_list(hit)), ",").alias("h"))
    paths = [
        stored(_line(o, F.lit("GROUP"), "o_orderkey", name("g", "o_orderkey"))),
        stored(_line(s, F.lit("CONTIG"), "s_suppkey", name("c", "s_suppkey"), 15500 + F.col("s_suppkey") * 10)),
        stored(_line(s, F.lit("NODE"), "s_suppkey", name("c", "s_suppkey", ".L"), name("c", "s_suppkey", ".R"))),
        stored(_line(hits, F.lit("NODE_HITS"), "node", "h")),
    ]
    none = F.lit(None)
    groups, contigs, nodes = formats.cache_groups(spark, paths), formats.cache_contigs(spark, paths), formats.cache_nodes(spark, paths)
    out = groups.select(F.lit("GROUP").alias("kind"), "id", "name", none.cast("string").alias("more"), none.cast("bigint").alias("n"))
    out = out.unionByName(contigs.select(F.lit("CONTIG").alias("kind"), "id", "name", none.cast("string").alias("more"), F.col("len").alias("n")))
    out = out.unionByName(nodes.select(F.lit("NODE").alias("kind"), "id", "name", F.col("partner").alias("more"), none.cast("bigint").alias("n")))
    return out.unionByName(formats.node_hits(spark, paths).select(F.lit("NODE_HITS").alias("kind"), F.col("node").alias("id"), F.col("grp").cast("string").alias("name"), none.cast("string").alias("more"), "n"))


@query("S20", sql="SELECT 'c' || l_partkey AS ctg1, l_linenumber AS oh1, 'F' AS dir1, 'c' || l_suppkey AS ctg2, l_quantity::BIGINT AS oh2, 'R' AS dir2, l_linenumber - 4 AS gap, CASE WHEN l_linenumber < 4 THEN repeat('a', (4 - l_linenumber)::INTEGER) END AS seq FROM lineitem")
def link_file(spark, sf):
    """Lines of seven columns, and of eight where the gap has bases."""
    li = R.table(spark, sf, "lineitem")
    gap = F.col("l_linenumber") - 4
    seq = F.when(gap < 0, F.repeat(F.lit("a"), (-gap).cast("int")))
    path = stored(_line(li, F.concat(F.lit("c"), F.col("l_partkey").cast("string")), "l_linenumber", F.lit("F"), F.concat(F.lit("c"), F.col("l_suppkey").cast("string")), F.col("l_quantity").cast("bigint"), F.lit("R"), gap, seq, sep=" "))
    return formats.links(spark, path)


# Sinks


@query(
    "K2",
    sql="""WITH h AS (SELECT l_orderkey AS read, l_suppkey AS frag, l_partkey % 1000 AS r, l_linenumber * CASE WHEN l_partkey % 2 = 0 THEN 1 ELSE -1 END AS q, l_returnflag = 'A' AS m FROM lineitem),
    t AS (SELECT *, CASE WHEN m THEN '[' || r || ':' || q || ']' ELSE r || ':' || q END AS t FROM h) SELECT read || ' ' || frag || ' ' || string_agg(t, ' ' ORDER BY r, q, t) AS value FROM t GROUP BY read, frag""",
)
def details_file(spark, sf):
    li = R.table(spark, sf, "lineitem")
    hits = li.select(F.col("l_orderkey").alias("read"), F.col("l_suppkey").alias("frag"), (F.col("l_partkey") % 1000).alias("r_off"), (F.col("l_linenumber") * F.when(F.col("l_partkey") % 2 == 0, 1).otherwise(-1)).alias("q_off"), (F.col("l_returnflag") == "A").alias("member"))
    return spark.read.text(stored(sinks.details_lines(hits)))


@query("K3", sql="SELECT printf('%.2f', o_orderkey / 4.0) || ' ' || printf('%.2f', o_orderkey / 4.0 + 100) || ' ' || concat_ws(' ', o_custkey, o_custkey + 90, 1, 80, o_custkey % 70) || ' ' || printf('%.4f', (o_custkey % 70) / 16.0) || ' ' || o_custkey || 'F_7R 110' AS value FROM orders")
def mega_read_file(spark, sf):
    o = R.table(spark, sf, "orders")
    rows = o.select((F.col("o_orderkey") / 4).alias("imp_s"), (F.col("o_orderkey") / 4 + 100).alias("imp_e"), F.col("o_custkey").alias("r_start"), (F.col("o_custkey") + 90).alias("r_end"), F.lit(1).alias("q_start"), F.lit(80).alias("q_end"), (F.col("o_custkey") % 70).alias("score"), ((F.col("o_custkey") % 70) / 16).alias("density"), F.concat(F.col("o_custkey").cast("string"), F.lit("F_7R")).alias("path"), F.lit(110).alias("path_len"))
    return spark.read.text(stored(sinks.mega_read_lines(rows)))


@query(
    "K4",
    "K5",
    sql="""WITH n AS (SELECT DISTINCT l_orderkey AS key, 0 AS o, '  n' || l_linenumber || ' [label="' || l_partkey || '"];' AS t FROM lineitem),
    e AS (SELECT DISTINCT l_orderkey AS key, 1 AS o, '  n' || l_linenumber || ' -> n' || (l_linenumber + 1) || CASE WHEN l_suppkey % 3 = 0 THEN ' [color="red"]' ELSE '' END || ';' AS t FROM lineitem),
    g AS (SELECT key, 'digraph g' || key || ' {' || chr(10) || string_agg(t, chr(10) ORDER BY o, t) || chr(10) || '}' AS text FROM (SELECT * FROM n UNION ALL SELECT * FROM e) GROUP BY key)
    SELECT line AS value, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM g) GROUP BY 1""",
)
def dot_file(spark, sf):
    """Graphs as text; compared line by line, for the reader does not know where a graph ends."""
    li = R.table(spark, sf, "lineitem")
    nodes = li.select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("node"), F.col("l_partkey").alias("label")).distinct()
    edges = li.select(F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("src"), (F.col("l_linenumber") + 1).alias("dst"), (F.col("l_suppkey") % 3 == 0).alias("on_path")).distinct()
    return spark.read.text(stored(sinks.dot_lines(nodes, edges))).groupBy("value").agg(F.count("*").alias("n"))


@query("K10", sql="SELECT count(*) AS n, count(DISTINCT l_suppkey) AS grps, 0 AS split, TRUE AS enough FROM lineitem")
def match_files(spark, sf):
    """Whole groups dealt to files: no group is in two, and no row is lost."""
    li = R.table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey")
    path = f"{shared_dir(spark)}/groups-{uuid.uuid4().hex}"
    sinks.in_group_files(li, "l_suppkey", 8).write.csv(path)
    back = spark.read.schema("l_suppkey long, l_orderkey long").csv(path).withColumn("file", F.input_file_name())
    per = back.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.countDistinct("file").alias("files"), F.first("file").alias("file"))
    return per.agg(F.sum("n").alias("n"), F.count("*").alias("grps"), F.count_if(F.col("files") > 1).cast("int").alias("split"), (F.countDistinct("file") > 1).alias("enough"))


@query("K12", sql="SELECT concat_ws(',', l_partkey, l_suppkey, printf('%.4f', l_quantity / 16), CASE WHEN l_linenumber = 1 THEN 'TRUNK' WHEN l_linenumber < 4 THEN 'MST' ELSE 'EDGE' END) AS value FROM lineitem")
def cytoscape_file(spark, sf):
    li = R.table(spark, sf, "lineitem")
    edges = li.select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"), (F.col("l_quantity") / 16).alias("score"), (F.col("l_linenumber") < 4).alias("in_tree"), (F.col("l_linenumber") == 1).alias("in_trunk"))
    return spark.read.text(stored(sinks.cytoscape_lines(edges)))
