"""Relations for the queries, derived from the driver's tables; each with the same relation in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions import sequence as S
from helixframe.runtime import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long reads (name, seq): the documents' texts as bases."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select(F.col("doc_id").alias("name"), S.encode_text("text").alias("seq"))


def fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fragments (name, seq): the benchmark's passages as bases."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("name"), S.encode_text("text").alias("seq"))


def item_id():
    """A number for each item; order and line alone repeat."""
    return ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")) * 100 + F.col("l_quantity").cast("bigint")


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals (key, id, a, b): thirty days from an item's shipping, by part."""
    day = F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint")
    return table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("key"), item_id().alias("id"), day.alias("a"), (day + 30).alias("b"))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval matches of query ``qry`` on reference ``ref``; a reverse match has qs > qe."""
    n = F.col
    size = (F.lit(400) + n("l_quantity").cast("bigint") * 60).alias("size")
    base = table(spark, sf_dir, "lineitem").select(
        item_id().alias("id"),
        n("l_suppkey").alias("ref"),
        n("l_orderkey").alias("qry"),
        (1 + (n("l_partkey") * 37 + n("l_linenumber") * 911) % 12000).alias("rs"),
        (1 + (n("l_linenumber") * 1900 + n("l_suppkey") * 13) % 9000).alias("q"),
        size,
        (n("l_partkey") % 3 != 0).alias("fwd"),
        (90 + F.round(n("l_discount") * 100).cast("bigint") % 10).alias("idy"),
        (15500 + n("l_suppkey") * 10).alias("rlen"),
        (12500 + n("l_orderkey") % 500).alias("qlen"),
    )
    stop = n("q") + n("size") - 1
    return base.select("id", "ref", "qry", "rs", (n("rs") + n("size") - 1).alias("re"), F.when(n("fwd"), n("q")).otherwise(stop).alias("qs"), F.when(n("fwd"), stop).otherwise(n("q")).alias("qe"), n("size").alias("mlen"), "idy", "rlen", "qlen")


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Node-group hits (node, grp, n): suppliers and the orders that they share."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("node"), F.col("l_orderkey").alias("grp")).agg(F.count("*").alias("n"))


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths (name, path): the items of an order as oriented unitigs, in line order."""
    unit = F.concat((F.col("l_partkey") % 50).cast("string"), F.when(F.col("l_suppkey") % 2 == 0, "F").otherwise("R"))
    ordered = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", unit.alias("u"))))
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("name")).agg(F.array_join(F.transform(ordered, lambda x: x["u"]), "_").alias("path"))


def unitigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unitigs (uid, seq, len): fifty words of bases that share their first and last four."""
    core = F.translate(F.lpad(F.conv((F.col("id") * 7919 + 13).cast("string"), 10, 4), 12, "0"), "0123", "ACGT")
    seq = F.concat(F.lit("ACGT"), core, F.substr(core, F.lit(1), (F.col("id") % 7).cast("int")), F.lit("ACGT"))
    return spark.range(50).select(F.col("id").cast("int").alias("uid"), seq.alias("seq"), F.length(seq).alias("len"))


_ENC = "translate(regexp_replace(lower({0}), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')"
#: Common table expressions, to be joined with commas.
READS = f"reads AS (SELECT doc_id AS name, {_ENC.format('text')} AS seq FROM documents)"
FRAGMENTS = f"fragments AS (SELECT item_id AS name, {_ENC.format('text')} AS seq FROM benchmark)"
_DAY = "date_diff('day', DATE '1970-01-01', l_shipdate::DATE)::BIGINT"
INTERVALS = f"intervals AS (SELECT l_partkey AS key, ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 100 + l_quantity::BIGINT AS id, {_DAY} AS a, {_DAY} + 30 AS b FROM lineitem)"
MATCHES = """m0 AS (
  SELECT ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 100 + l_quantity::BIGINT AS id, l_suppkey AS ref, l_orderkey AS qry,
    1 + (l_partkey * 37 + l_linenumber * 911) % 12000 AS rs, 1 + (l_linenumber * 1900 + l_suppkey * 13) % 9000 AS q,
    400 + l_quantity::BIGINT * 60 AS size, l_partkey % 3 <> 0 AS fwd, 90 + round(l_discount * 100)::BIGINT % 10 AS idy,
    15500 + l_suppkey * 10 AS rlen, 12500 + l_orderkey % 500 AS qlen FROM lineitem
), matches AS (
  SELECT id, ref, qry, rs, rs + size - 1 AS re, CASE WHEN fwd THEN q ELSE q + size - 1 END AS qs,
    CASE WHEN fwd THEN q + size - 1 ELSE q END AS qe, size AS mlen, idy, rlen, qlen FROM m0
)"""
LINKS = "links AS (SELECT l_suppkey AS node, l_orderkey AS grp, count(*) AS n FROM lineitem GROUP BY ALL)"
PATHS = """paths AS (
  SELECT l_orderkey AS name, string_agg((l_partkey % 50)::VARCHAR || CASE WHEN l_suppkey % 2 = 0 THEN 'F' ELSE 'R' END, '_' ORDER BY l_linenumber, l_partkey, l_suppkey) AS path
  FROM lineitem GROUP BY 1)"""


def revcomp_sql(x: str) -> str:
    return f"reverse(translate({x}, 'ACGTNacgtn', 'TGCANtgcan'))"


def kmers_sql(source: str, k: int, name: str) -> str:
    """CTE ``name`` (name, pos, kmer) of the words of ``source``."""
    return f"""{name} AS (SELECT name, pos, substring(seq, pos, {k}) AS kmer FROM (
      SELECT name, seq, unnest(generate_series(1, length(seq) - {k} + 1)) AS pos FROM {source} WHERE length(seq) >= {k}))"""
