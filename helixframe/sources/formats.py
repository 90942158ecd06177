"""Text formats as DataFrames.  Paths may be lists or globs; compressed files are read by extension."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.runtime import bound_batches

Paths = str | list[str]


def _blocks(spark: SparkSession, paths: Paths) -> DataFrame:
    """Records that start with ``>``: (head, body), split by Spark's reader."""
    rows = spark.read.option("lineSep", ">").text(paths).where(F.trim("value") != "")
    text = F.regexp_replace("value", "\r", "")
    return rows.select(F.regexp_extract(text, r"^([^\n]*)", 1).alias("head"), F.regexp_replace(text, r"^[^\n]*\n?", "").alias("body"))


def _lines(spark: SparkSession, paths: Paths) -> DataFrame:
    return spark.read.text(paths).select(F.rtrim(F.regexp_replace("value", "\r", "")).alias("value")).where("value <> ''")


def _field(parts: Column, i: int, kind: str) -> Column:
    return F.get(parts, i).cast(kind)


def _table(spark: SparkSession, paths: Paths, schema: list[tuple[str, str]], sep: str = r"\s+", skip: str | None = None) -> DataFrame:
    """Lines split at ``sep``, positional columns; lines that match ``skip`` are left out."""
    rows = _lines(spark, paths)
    if skip:
        rows = rows.where(~F.col("value").rlike(skip))
    parts = F.split(F.trim("value"), sep)
    return rows.select(*(_field(parts, i, kind).alias(name) for i, (name, kind) in enumerate(schema)))


def fasta(spark: SparkSession, paths: Paths, first_word: bool = True) -> DataFrame:
    """(name, seq) of multi-line FASTA; empty records are dropped; ``first_word`` cuts names at white space."""
    r = _blocks(spark, paths)
    name = F.regexp_extract("head", r"^(\S*)", 1) if first_word else F.col("head")
    return r.select(name.alias("name"), F.regexp_replace("body", r"\s", "").alias("seq")).where("seq <> ''")


def numbered_fasta(spark: SparkSession, paths: Paths) -> DataFrame:
    """(uid, seq): strict FASTA whose records are numbered from 0 in file order; the names are ignored.

    Numbers come from the reader's partition order, two-level: partition sizes, then offsets.
    """
    return with_ordinal(fasta(spark, paths), "uid").select("uid", "seq")


def with_ordinal(rows: DataFrame, out: str) -> DataFrame:
    """Rows with their number from 0 in the order in which the files hold them."""
    # monotonically_increasing_id is partition << 33 | row, so numbering needs one row a partition.
    marked = rows.withColumn("__m", F.monotonically_increasing_id())
    sizes = marked.groupBy(F.shiftright("__m", 33).alias("__p")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o"))
    joined = marked.join(F.broadcast(offs), F.shiftright("__m", 33) == F.col("__p"))
    return joined.withColumn(out, (F.col("__o") + F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))).cast("bigint")).drop("__m", "__p", "__n", "__o")


def unitig_lengths(spark: SparkSession, paths: Paths) -> DataFrame:
    """(uid, len): lines ``name len``; the line's ordinal is the id."""
    return with_ordinal(_table(spark, paths, [("name", "string"), ("len", "int")]), "uid").select("uid", "len")


def fastq_records(lines: Iterable[str]) -> Iterator[tuple[str, str, str]]:
    """(name, sequence, quality) of FASTQ, lines wrapped or not; FASTA records pass with an empty quality."""
    it = iter(lines)
    line = next(it, None)
    while line is not None:
        if not line or line[0] not in "@>":
            line = next(it, None)
            continue
        kind, name, seq, line = line[0], line[1:].split(" ")[0], [], next(it, None)
        while line is not None and not line.startswith("+" if kind == "@" else ">"):
            seq.append(line.strip())
            line = next(it, None)
        bases, quality = "".join(seq), ""
        if kind == "@":
            line = next(it, None)
            while line is not None and len(quality) < len(bases):
                quality += line.strip()
                line = next(it, None)
        yield name, bases, quality


def fastq(spark: SparkSession, paths: Paths, wrapped: bool = False) -> DataFrame:
    """(name, seq, qual) of FASTQ files.

    Four-line records are split by Spark's reader, so a file is many tasks.  Where ``wrapped``,
    sequences and qualities may span lines and FASTA records may stand among them; such records can
    only be told apart from the start of a file, which is then one task.
    """
    if wrapped:
        bound_batches(spark)

        def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for df in frames:
                for text in df["value"]:
                    yield pd.DataFrame(fastq_records(text.splitlines()), columns=["name", "seq", "qual"])

        return spark.read.text(paths, wholetext=True).mapInPandas(parse, "name string, seq string, qual string")
    # A part is a record, unless its quality starts with @: then it is one without quality, and the next part is the quality.
    parts = spark.read.option("lineSep", "\n@").text(paths).select(F.regexp_replace(F.regexp_replace("value", "\r", ""), r"^@|\n+$", "").alias("value"), F.input_file_name().alias("f"), F.input_file_block_start().alias("b"), F.monotonically_increasing_id().alias("i"))
    lines = F.split("value", "\n")
    named = lambda x: F.regexp_extract(x, r"^(\S*)", 1)
    cut = parts.withColumn("l", lines)
    whole = cut.where(F.size("l") == 4).select(named(F.col("l")[0]).alias("name"), F.col("l")[1].alias("seq"), F.col("l")[3].alias("qual"))
    w = Window.partitionBy("f").orderBy("b", "i")
    halves = cut.where(F.size("l") != 4).select("l", F.lead("value").over(w).alias("q")).where(F.size("l") == 3)
    return whole.unionByName(halves.select(named(F.col("l")[0]).alias("name"), F.col("l")[1].alias("seq"), F.concat(F.lit("@"), F.coalesce("q", F.lit(""))).alias("qual")))


#: Columns of an alignment summary (fixed order of the format).
COORDS = [("r_start", "int"), ("r_end", "int"), ("q_start", "int"), ("q_end", "int"), ("n_mers", "int"), ("r_cons", "int"), ("q_cons", "int"), ("r_cover", "int"), ("q_cover", "int"), ("r_len", "long"), ("q_len", "long"), ("stretch", "double"), ("offset", "double"), ("avg_err", "double"), ("frag", "string")]


def coords(spark: SparkSession, paths: Paths) -> DataFrame:
    """Compact summaries: blocks ``>n read`` of n rows; each with its read, and the counts of its unitigs.

    A block whose rows are not as many as its head says has ``complete`` false.
    """
    r = _blocks(spark, paths).where(F.col("head").rlike(r"^[0-9]+ \S"))
    rows = F.filter(F.split("body", "\n"), lambda x: F.trim(x) != "")
    n = F.split("head", " ", 2)
    one = r.select(n[1].alias("read"), (F.size(rows) == n[0].cast("int")).alias("complete"), F.explode(rows).alias("row"))
    parts = F.split(F.trim("row"), r"\s+")
    info = F.slice(parts, len(COORDS) + 1, F.greatest(F.lit(1), F.size(parts)))
    pick = lambda i: F.transform(info, lambda x: F.split(x, ":")[i].cast("int"))
    return one.select("read", "complete", *(_field(parts, i, k).alias(c) for i, (c, k) in enumerate(COORDS)), pick(0).alias("kmers_info"), pick(1).alias("bases_info"))


def show_coords(spark: SparkSession, paths: Paths) -> DataFrame:
    """Interval matches: ``rs re | qs qe | rm qm | idy | R Q | covR covQ | ref qry``."""
    names = [("rs", 0, "long"), ("re", 1, "long"), ("qs", 3, "long"), ("qe", 4, "long"), ("rmlen", 6, "long"), ("mlen", 7, "long"), ("idy", 9, "double"), ("rlen", 11, "long"), ("qlen", 12, "long"), ("cov_r", 14, "double"), ("cov_q", 15, "double"), ("ref", 17, "string"), ("qry", 18, "string")]
    parts = F.split(F.trim("value"), r"\s+")
    return _lines(spark, paths).where(F.size(parts) >= 19).select(*(_field(parts, i, k).alias(c) for c, i, k in names))


def paf(spark: SparkSession, paths: Paths) -> DataFrame:
    """Twelve positional columns, and the tags as a map."""
    cols = [("qry", "string"), ("qlen", "long"), ("q0", "long"), ("q1", "long"), ("strand", "string"), ("ref", "string"), ("rlen", "long"), ("r0", "long"), ("r1", "long"), ("n_match", "long"), ("n_bases", "long"), ("mapq", "int")]
    parts = F.split("value", "\t")
    tags = F.transform(F.slice(parts, 13, F.greatest(F.lit(1), F.size(parts))), lambda t: F.struct(F.substr(t, F.lit(1), F.lit(2)).alias("k"), F.substr(t, F.lit(6)).alias("v")))
    return _lines(spark, paths).select(*(_field(parts, i, k).alias(c) for i, (c, k) in enumerate(cols)), F.map_from_entries(tags).alias("tags"))


def paf_overhanging(rows: DataFrame, least: int, quality: int, overhang: int) -> DataFrame:
    """Alignments longer than max(400, least / 6), good enough, that reach a target's end within ``overhang``."""
    long = F.col("r1") - F.col("r0") > F.greatest(F.lit(400), F.lit(least / 6))
    return rows.where(long & (F.col("mapq") >= quality) & ((F.col("r0") < overhang) | (F.col("rlen") - F.col("r1") < overhang)))


def paf_as_matches(rows: DataFrame) -> DataFrame:
    """Interval matches: 1-based, reverse strand with qs > qe, identity from the divergence tag."""
    fwd = F.col("strand") == "+"
    idy = 100 * (1 - F.coalesce(F.col("tags")["dv"].cast("double"), F.lit(0.0)))
    lo, hi = F.col("q0") + 1, F.col("q1")
    share = lambda a, b, n: F.floor(10000 * (F.col(b) - F.col(a)) / F.col(n)) / 100
    return rows.select((F.col("r0") + 1).alias("rs"), F.col("r1").alias("re"), F.when(fwd, lo).otherwise(hi).alias("qs"), F.when(fwd, hi).otherwise(lo).alias("qe"), (F.col("r1") - F.col("r0")).alias("rmlen"), (F.col("q1") - F.col("q0")).alias("mlen"), idy.alias("idy"), "rlen", "qlen", share("r0", "r1", "rlen").alias("cov_r"), share("q0", "q1", "qlen").alias("cov_q"), "ref", "qry")


def vcf(spark: SparkSession, paths: Paths) -> DataFrame:
    """(ctg, pos, ref, alt, sample) of variants with one alternative."""
    parts = F.split("value", "\t")
    rows = _lines(spark, paths).where(~F.col("value").startswith("#"))
    out = rows.select(parts[0].alias("ctg"), parts[1].cast("long").alias("pos"), parts[3].alias("ref"), parts[4].alias("alt"), F.split(parts[9], ":").alias("sample"))
    return out.where(~F.col("alt").contains(","))


def sam_header(spark: SparkSession, paths: Paths) -> DataFrame:
    """(kind, name, len): read groups and target sequences."""
    rows = _lines(spark, paths).where(F.col("value").rlike("^@(RG|SQ)\t"))
    name = F.coalesce(F.nullif(F.regexp_extract("value", r"\tSN:(\S+)", 1), F.lit("")), F.regexp_extract("value", r"\tID:(\S+)", 1))
    return rows.select(F.substr(F.col("value"), F.lit(2), F.lit(2)).alias("kind"), name.alias("name"), F.nullif(F.regexp_extract("value", r"\tLN:([0-9]+)", 1), F.lit("")).cast("long").alias("len"))


def sam(spark: SparkSession, paths: Paths, least: int = 0) -> DataFrame:
    """(name, flag, ctg, pos, mapq, seq) of alignments with at least the mapping quality."""
    parts = F.split("value", "\t")
    rows = _lines(spark, paths).where(~F.col("value").startswith("@"))
    out = rows.select(parts[0].alias("name"), parts[1].cast("int").alias("flag"), parts[2].alias("ctg"), parts[3].cast("long").alias("pos"), parts[4].cast("int").alias("mapq"), F.get(parts, 9).alias("seq"))
    return out.where(F.col("mapq") >= least)


def bed(spark: SparkSession, paths: Paths) -> DataFrame:
    return _table(spark, paths, [("ctg", "string"), ("start", "long"), ("stop", "long")], skip=r"^(#|track|browser)")


def bed_near_ends(windows: DataFrame, sizes: DataFrame, reach: int) -> DataFrame:
    """Windows within ``reach`` of an end of their contig (sizes: ctg, len)."""
    return windows.join(sizes, "ctg").where((F.col("start") < reach) | (F.col("stop") > F.col("len") - reach)).select("ctg", "start", "stop")


def blast6(spark: SparkSession, paths: Paths) -> DataFrame:
    cols = [("qry", "string"), ("ref", "string"), ("idy", "double"), ("mlen", "long"), ("mismatches", "long"), ("opens", "long"), ("qs", "long"), ("qe", "long"), ("rs", "long"), ("re", "long")]
    return _table(spark, paths, cols, sep="\t", skip="^#")


def self_hits(rows: DataFrame, identity: float, apart: int = 100) -> DataFrame:
    """Repeats: hits of the identity, on another contig or with both ends more than ``apart`` away."""
    other = (F.col("qry") != F.col("ref")) | ((F.abs(F.col("qs") - F.least("rs", "re")) > apart) & (F.abs(F.col("qe") - F.greatest("rs", "re")) > apart))
    return rows.where((F.col("idy") >= identity) & other)


def delta(spark: SparkSession, paths: Paths) -> DataFrame:
    """(ref, qry, rlen, qlen, rs, re, qs, qe, errors): the alignments of a delta file under their pair's head."""
    r = _blocks(spark, paths)
    head = F.split(F.trim("head"), r"\s+")
    rows = r.where(F.size(head) == 4).select(head.alias("h"), F.explode(F.split("body", "\n")).alias("row"))
    p = F.split(F.trim("row"), r"\s+")
    num = [("rs", 0), ("re", 1), ("qs", 2), ("qe", 3), ("errors", 4)]
    return rows.where(F.size(p) == 7).select(F.col("h")[0].alias("ref"), F.col("h")[1].alias("qry"), F.col("h")[2].cast("long").alias("rlen"), F.col("h")[3].cast("long").alias("qlen"), *(p[i].cast("long").alias(c) for c, i in num))


def positions(spark: SparkSession, paths: Paths) -> DataFrame:
    """(piece, whole, start, stop, dir): where pieces stand in larger sequences."""
    return _table(spark, paths, [("piece", "string"), ("whole", "string"), ("start", "long"), ("stop", "long"), ("dir", "string")])


def links(spark: SparkSession, paths: Paths) -> DataFrame:
    """(ctg1, oh1, dir1, ctg2, oh2, dir2, gap, seq): seven or eight columns."""
    return _table(spark, paths, [("ctg1", "string"), ("oh1", "long"), ("dir1", "string"), ("ctg2", "string"), ("oh2", "long"), ("dir2", "string"), ("gap", "long"), ("seq", "string")])


def placements(spark: SparkSession, paths: Paths) -> DataFrame:
    return _table(spark, paths, [("read", "string"), ("super_read", "string"), ("pos", "long"), ("ori", "string")])


def _cached(spark: SparkSession, paths: Paths, kind: str) -> tuple[DataFrame, Column]:
    """Records of one kind of a parsed alignment cache, and their fields."""
    return _lines(spark, paths).where(F.col("value").startswith(kind + "\t")), F.split("value", "\t")


def cache_groups(spark: SparkSession, paths: Paths) -> DataFrame:
    rows, p = _cached(spark, paths, "GROUP")
    return rows.select(_field(p, 1, "long").alias("id"), _field(p, 2, "string").alias("name"))


def cache_contigs(spark: SparkSession, paths: Paths) -> DataFrame:
    rows, p = _cached(spark, paths, "CONTIG")
    return rows.select(_field(p, 1, "long").alias("id"), _field(p, 2, "string").alias("name"), _field(p, 3, "long").alias("len"))


def cache_nodes(spark: SparkSession, paths: Paths) -> DataFrame:
    """(id, name, partner): the ends of contigs, each with the contig's other end."""
    rows, p = _cached(spark, paths, "NODE")
    return rows.select(_field(p, 1, "long").alias("id"), _field(p, 2, "string").alias("name"), _field(p, 3, "string").alias("partner"))


def node_hits(spark: SparkSession, paths: Paths) -> DataFrame:
    """(node, grp, n): hits of nodes in groups, given as ``grp:n,grp:n``; nodes with one group are left out."""
    rows, p = _cached(spark, paths, "NODE_HITS")
    hits = F.split(F.get(p, 2), ",")
    one = rows.where(F.size(hits) >= 2).select(_field(p, 1, "long").alias("node"), F.explode(hits).alias("h"))
    return one.select("node", F.split("h", ":")[0].cast("long").alias("grp"), F.split("h", ":")[1].cast("long").alias("n"))


def kmer_counts(spark: SparkSession, paths: Paths) -> DataFrame:
    """(kmer, n): lines of a word and its count."""
    return _table(spark, paths, [("kmer", "string"), ("n", "long")])


def merged_coords(parts: list[DataFrame]) -> DataFrame:
    """Summaries of the same reads from several indices as one table; rows of a read that disagree on its length raise."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    bad = out.groupBy("read").agg(F.countDistinct("r_len").alias("n")).where("n > 1")
    check = bad.agg(F.assert_true(F.count("*") == 0, F.lit("reads differ in length between inputs")).alias("__ok"))
    return out.crossJoin(F.broadcast(check)).drop("__ok")
