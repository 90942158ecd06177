"""Best matches, repeats, placements, duplicates and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def best_match(matches: DataFrame, whole_percent: bool = True) -> DataFrame:
    """The match of each query with the largest length x identity (whole hundredths if ``whole_percent``); first wins ties."""
    w = F.col("mlen") * F.col("idy")
    weight = F.floor(w / 100) if whole_percent else w
    return matches.groupBy("qry").agg(F.max_by(F.struct("id", "ref"), F.struct(weight.alias("w"), (-F.col("id")).alias("i"))).alias("m")).select("qry", "m.id", "m.ref")


def best_match_in_parts(matches: DataFrame, parts: int = 8, least: int = 0) -> DataFrame:
    """The best match of each query, found part by part: queries are dealt to references' parts, filtered there, merged, and filtered again.

    The second filter sees one match a part and query, so a query that hits references everywhere
    is no hot key; the result is that of one filter over all.
    """
    long = matches.where(F.col("mlen") >= least).withColumn("part", F.pmod(F.xxhash64("ref"), F.lit(parts)))
    weight = F.struct(F.floor(F.col("mlen") * F.col("idy") / 100).alias("w"), (-F.col("id")).alias("i"))
    first = long.groupBy("qry", "part").agg(F.max(F.struct(weight.alias("k"), "id", "ref")).alias("m"))
    return first.groupBy("qry").agg(F.max("m").alias("m")).select("qry", "m.id", "m.ref")


def duplicates_by_coverage(matches: DataFrame, least: float, by: str = "qry") -> DataFrame:
    """Queries whose coverage adds up to more than ``least`` percent."""
    cov = matches.withColumn("c", F.col("mlen") * 100.0 / F.col("qlen"))
    return cov.groupBy(by).agg(F.sum("mlen").alias("covered"), F.max("qlen").alias("qlen")).where(F.col("covered") * 100 > least * F.col("qlen")).select(by)


def repeats(matches: DataFrame, edges: DataFrame, depth: float = 2.0, ends: int = 2) -> DataFrame:
    """References covered ``depth`` times over that have at least ``ends`` edges at both ends."""
    cov = matches.groupBy("ref").agg((F.sum("mlen") / (F.max("rlen") + 1)).alias("depth")).where(F.col("depth") >= depth)
    many = edges.groupBy("ref").agg(F.count_if(F.col("end") == 5).alias("e5"), F.count_if(F.col("end") == 3).alias("e3")).where((F.col("e5") >= ends) & (F.col("e3") >= ends))
    return cov.join(many, "ref").select("ref")


def placements(matches: DataFrame, least: int = 0) -> DataFrame:
    """Each query's dominant reference and strand by matched length, and its mean position weighted by squared length."""
    m = matches.where(F.col("mlen") >= least).withColumn("fwd", F.col("qs") < F.col("qe"))
    # Where the query's first base would lie on the reference.
    start = F.when(F.col("fwd"), F.col("rs") - F.col("qs") + 1).otherwise(F.col("rs") - (F.col("qlen") - F.col("qs")))
    mid = start + F.col("qlen") / 2
    per = m.groupBy("qry", "ref", "fwd").agg(F.sum("mlen").alias("t"), F.sum(mid * F.col("mlen") * F.col("mlen")).alias("x"), F.sum(F.col("mlen") * F.col("mlen")).alias("y"))
    w = Window.partitionBy("qry").orderBy(F.desc("t"), "ref", F.desc("fwd"))
    top = per.withColumn("r", F.row_number().over(w)).where("r = 1")
    return top.select("qry", "ref", "fwd", F.col("t").alias("matched"), (F.col("x") / F.col("y")).alias("position"))


def path_ends(paths: DataFrame) -> DataFrame:
    """Per unitig: how often it starts a path, ends one, and stands inside (paths of parsed arrays)."""
    rows = paths.select(F.size("p").alias("n"), F.posexplode("p").alias("i", "u"))
    return rows.groupBy(F.col("u.id").alias("uid")).agg(F.count_if(F.col("i") == 0).alias("starts"), F.count_if(F.col("i") == F.col("n") - 1).alias("ends"), F.count_if((F.col("i") > 0) & (F.col("i") < F.col("n") - 1)).alias("inside"))


def trims(paths: DataFrame, ends: DataFrame, unitigs: DataFrame, k: int) -> DataFrame:
    """Per path the bases to trim at its start and end: an end unitig that occurs once, at an end, and nowhere else."""
    lone = ends.where((F.col("starts") + F.col("ends") == 1) & (F.col("inside") == 0)).join(unitigs, "uid").select("uid", (F.col("len") - (k - 1)).alias("cut"))
    p = paths.select("name", F.element_at("p", 1)["id"].alias("u1"), F.element_at("p", -1)["id"].alias("u2"))
    out = p.join(lone.select(F.col("uid").alias("u1"), F.col("cut").alias("c1")), "u1", "left").join(lone.select(F.col("uid").alias("u2"), F.col("cut").alias("c2")), "u2", "left")
    return out.select("name", F.coalesce("c1", F.lit(0)).alias("front"), F.coalesce("c2", F.lit(0)).alias("back"))


def trimmed(seqs: DataFrame, cuts: DataFrame, least: int) -> DataFrame:
    """Sequences without their trims, if at least ``least`` bases stay."""
    x = seqs.join(cuts, "name", "left").withColumns({"front": F.coalesce("front", F.lit(0)), "back": F.coalesce("back", F.lit(0))})
    cut = F.substr(F.col("seq"), F.col("front") + 1, F.greatest(F.lit(0), F.length("seq") - F.col("front") - F.col("back")))
    return x.select("name", cut.alias("seq")).where(F.length("seq") >= least)


def polish_report(variants: DataFrame, size: DataFrame) -> DataFrame:
    """Substitutions, indels, share of good bases and quality value of an assembly, from its homozygous variants.

    ``variants`` has (ref, alt, ro, ao), ``size`` one row with ``bases``.
    """
    hom = variants.where((F.col("ao") > 1) & (F.col("ao") >= 2 * F.col("ro")))
    sub = F.length("ref") == F.length("alt")
    counts = hom.agg(F.coalesce(F.sum(F.when(sub, F.length("ref")).otherwise(0)), F.lit(0)).cast("bigint").alias("substitutions"), F.coalesce(F.sum(F.when(~sub, F.abs(F.length("ref") - F.length("alt"))).otherwise(0)), F.lit(0)).cast("bigint").alias("indels"))
    both = counts.crossJoin(size)
    err = F.col("substitutions") + F.col("indels")
    return both.select("substitutions", "indels", (100 * (1 - err / F.col("bases"))).alias("quality"), (-10 * F.log10(err / F.col("bases") + 1e-10)).alias("qv"))
