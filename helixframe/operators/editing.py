"""Cutting, joining and editing sequences, in relational form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.sequence import reverse_complement, segments, stitch


def break_at(seqs: DataFrame, breaks: DataFrame, unknown_near: int = 0) -> DataFrame:
    """Rows (name, part, start, seq): sequences cut after the break positions (name, pos).

    With ``unknown_near``, a break is not made where unknown bases lie within that distance.
    """
    b = breaks
    if unknown_near:
        around = F.substr(F.col("seq"), F.greatest(F.lit(1), F.col("pos") - unknown_near), F.lit(2 * unknown_near))
        b = breaks.join(seqs, "name").where(~around.rlike("[Nn]")).select("name", "pos")
    cuts = b.groupBy("name").agg(F.sort_array(F.collect_set(F.col("pos").cast("int"))).alias("c"))
    joined = seqs.join(cuts, "name", "left")
    n = F.length("seq")
    inner = F.filter(F.coalesce("c", F.array().cast("array<int>")), lambda x: (x > 0) & (x < F.length("seq")))
    starts = F.concat(F.array(F.lit(0)), inner)
    stops = F.concat(inner, F.array(n))
    rows = joined.select("name", "seq", F.posexplode(F.arrays_zip(starts.alias("a"), stops.alias("b"))).alias("part", "x"))
    return rows.select("name", "part", (F.col("x.a") + 1).alias("start"), F.substr(F.col("seq"), F.col("x.a") + 1, F.col("x.b") - F.col("x.a")).alias("seq"))


def apply_edits(seqs: DataFrame, edits: DataFrame) -> DataFrame:
    """(name, seq, applied, skipped): edits (name, pos, ref, alt) put into the sequences.

    Edits go from right to left, so positions stay valid; an edit whose original differs from
    the sequence, or that overlaps the one to its right, is skipped.
    """
    e = edits.groupBy("name").agg(F.reverse(F.sort_array(F.collect_list(F.struct(F.col("pos").cast("int").alias("pos"), "ref", "alt")))).alias("e"))
    joined = seqs.join(e, "name", "left").withColumn("e", F.coalesce("e", F.array().cast("array<struct<pos:int,ref:string,alt:string>>")))
    folded = F.expr(
        """aggregate(e, named_struct('tail', array(''), 'stop', length(seq) + 1, 'n', 0),
            (acc, x) -> if(x.pos >= 1 AND x.pos + length(x.ref) <= acc.stop AND substring(seq, x.pos, length(x.ref)) = x.ref,
                named_struct('tail', concat(array(x.alt, substring(seq, x.pos + length(x.ref), acc.stop - x.pos - length(x.ref))), acc.tail), 'stop', x.pos, 'n', acc.n + 1),
                acc))"""
    )
    r = joined.select("name", "seq", F.size("e").alias("total"), folded.alias("f"))
    return r.select("name", F.concat(F.substr(F.col("seq"), F.lit(1), F.col("f.stop") - 1), F.array_join("f.tail", "")).alias("seq"), F.col("f.n").alias("applied"), (F.col("total") - F.col("f.n")).alias("skipped"))


def replace_segments(seqs: DataFrame, segs: DataFrame) -> DataFrame:
    """Sequences with the segments (name, start, stop, new) replaced; of overlapping ones the leftmost stays.

    Later starts may not lie inside any earlier segment that was kept or not.
    """
    w = Window.partitionBy("name").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    free = segs.withColumn("m", F.max("stop").over(w)).where(F.col("m").isNull() | (F.col("start") > F.col("m")))
    edits = free.join(seqs, "name").select("name", F.col("start").alias("pos"), F.substr(F.col("seq"), F.col("start"), F.col("stop") - F.col("start") + 1).alias("ref"), F.col("new").alias("alt"))
    return apply_edits(seqs, edits).select("name", "seq")


def stitch_paths(paths: DataFrame, unitigs: DataFrame, k: int) -> DataFrame:
    """(name, seq): oriented unitigs of each path (name, p: array<struct<id,rev>>) joined at their k-1 shared bases."""
    parts = paths.select("name", F.posexplode("p").alias("i", "u")).join(unitigs.select(F.col("uid").alias("id"), "seq"), F.col("u.id") == F.col("id"))
    oriented = F.when(F.col("u.rev"), reverse_complement("seq")).otherwise(F.col("seq"))
    g = parts.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("i", oriented.alias("s")))).alias("x"))
    return g.select("name", stitch(F.col("x.s"), k).alias("seq"))


def scaffold(pieces: DataFrame, spacer: int = 100, least_gap: int = 1) -> DataFrame:
    """(name, seq): pieces (name, i, seq, rev, before, after) in order, with unknown bases between them.

    The spacer is the smaller of the gaps after one and before the next; ``spacer`` where neither is known.
    """
    w = Window.partitionBy("name").orderBy("i")
    gap = F.coalesce(F.least(F.lag("after").over(w), F.col("before")), F.lit(spacer))
    rows = pieces.withColumn("g", F.when(F.row_number().over(w) == 1, F.lit(0)).otherwise(F.greatest(F.lit(least_gap), gap)).cast("int"))
    part = F.concat(F.repeat(F.lit("N"), F.col("g")), F.when(F.col("rev"), reverse_complement("seq")).otherwise(F.col("seq")))
    g = rows.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("i", part.alias("s")))).alias("x"))
    return g.select("name", F.array_join("x.s", "").alias("seq"))


def with_unused(scaffolds: DataFrame, pieces: DataFrame, contigs: DataFrame, least: int = 1000) -> DataFrame:
    """Scaffolds, and the contigs of at least ``least`` bases that no piece used."""
    rest = contigs.join(pieces.select(F.col("ctg").alias("name")), "name", "left_anti").where(F.length("seq") > least)
    return scaffolds.unionByName(rest.select("name", "seq"))


def recovered(pieces: DataFrame, spacer: int = 100) -> DataFrame:
    """Scaffolds from numbered pieces (name, i, seq): turned if the numbers fall along the rows (``at``)."""
    w = Window.partitionBy("name").orderBy("at")
    falls = F.when(F.col("i") < F.lag("i").over(w), 1).when(F.col("i") > F.lag("i").over(w), -1).otherwise(0)
    turn = pieces.withColumn("f", falls).groupBy("name").agg((F.sum("f") > 0).alias("rev"))
    return scaffold(pieces.join(turn, "name").withColumns({"before": F.lit(None).cast("int"), "after": F.lit(None).cast("int")}), spacer)


def split_scaffolds(seqs: DataFrame) -> DataFrame:
    """Pieces between unknown bases, with their places: (name, start, stop, piece)."""
    return segments(seqs, "[^Nn]", "[Nn]")


def unknown_runs(seqs: DataFrame) -> DataFrame:
    """Runs of unknown bases as 1-based inclusive intervals, a run at the end included."""
    return segments(seqs, "[Nn]", "[^Nn]").select("name", "start", "stop")


def fill_gaps(matches: DataFrame, refs: DataFrame, least: int, most: int) -> DataFrame:
    """(ref, start, stop, seq): reference bases between matches farther apart than ``least``, with known bases up to ``most``."""
    w = Window.partitionBy("ref").orderBy("rs", "re", "id")
    before = F.max("re").over(w.rowsBetween(Window.unboundedPreceding, -1))
    gaps = matches.select("ref", (before + 1).alias("start"), (F.col("rs") - 1).alias("stop")).where(F.col("stop") - F.col("start") + 1 > least)
    got = gaps.join(refs.select(F.col("name").alias("ref"), "seq"), "ref").select("ref", "start", "stop", F.substr(F.col("seq"), F.col("start").cast("int"), (F.col("stop") - F.col("start") + 1).cast("int")).alias("seq"))
    return got.where((F.length(F.regexp_replace("seq", "[Nn]", "")) < most) & (F.length("seq") > 0))


def extend_matches(matches: DataFrame, unknown: DataFrame, tolerance: int = 100_000) -> DataFrame:
    """Matches stretched over free reference up to their neighbours, unless unknown reference bases lie in between.

    Adds before and after: the free bases given, at most the unmatched query there and ``tolerance``.
    """
    w = Window.partitionBy("ref").orderBy("rs", "re", "id")
    rows = matches.select("*", F.lag("re").over(w).alias("pe"), F.lead("rs").over(w).alias("ns"))
    fwd = F.col("qs") < F.col("qe")
    head = F.when(fwd, F.col("qs") - 1).otherwise(F.col("qlen") - F.col("qs"))
    tail = F.when(fwd, F.col("qlen") - F.col("qe")).otherwise(F.col("qe") - 1)
    free_before = F.greatest(F.lit(0), F.col("rs") - 1 - F.coalesce("pe", F.lit(0)))
    free_after = F.greatest(F.lit(0), F.coalesce("ns", F.col("rlen") + 1) - F.col("re") - 1)
    rows = rows.withColumns({"before": F.least(free_before, head, F.lit(tolerance)), "after": F.least(free_after, tail, F.lit(tolerance))})
    u = unknown.select(F.col("name").alias("ref"), F.col("start").alias("us"), F.col("stop").alias("ue"))
    hit = rows.join(u, "ref").groupBy("id").agg(F.max(((F.col("us") >= F.col("rs") - F.col("before")) & (F.col("ue") < F.col("rs"))).cast("int")).alias("hb"), F.max(((F.col("us") > F.col("re")) & (F.col("ue") <= F.col("re") + F.col("after"))).cast("int")).alias("ha"))
    out = rows.join(hit, "id", "left")
    no = lambda c, h: F.when(F.coalesce(h, F.lit(0)) == 1, 0).otherwise(F.col(c))
    return out.select("id", "ref", "qry", no("before", F.col("hb")).cast("bigint").alias("before"), no("after", F.col("ha")).cast("bigint").alias("after"))


def random_edits(seqs: DataFrame, rate: float, seed: int = 1, draw: tuple[Column, Column] | None = None) -> DataFrame:
    """Substitutions (name, pos, ref, alt) at a share ``rate`` of the bases.

    ``draw`` are two whole numbers of (name, pos): the first, in millionths, chooses the bases, the second
    what they turn into; both come from a seeded hash where they are not given.
    """
    at = seqs.where(F.length("seq") > 0).select("name", F.posexplode(F.split("seq", "")).alias("i", "ref")).withColumn("pos", F.col("i") + 1)
    h = F.xxhash64("name", "pos", F.lit(seed))
    choose, turn = draw or (h, F.shiftright(h, 32))
    hit = at.where(F.upper("ref").isin("A", "C", "G", "T") & (F.pmod(choose, F.lit(1_000_000)) < int(rate * 1_000_000)))
    known = F.expr("instr('ACGT', upper(ref))")
    to = F.substr(F.lit("ACGTACGT"), known + F.pmod(turn, F.lit(3)).cast("int") + 1, F.lit(1))
    return hit.select("name", "pos", "ref", to.alias("alt"))
