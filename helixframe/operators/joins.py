"""Lookups, semi and anti joins, and self joins of matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.operators.kmers import BROADCAST_ROWS


def add_sequence(rows: DataFrame, seqs: DataFrame, on: str = "name", seq: str = "seq", unknown: int = 50_000) -> DataFrame:
    """``rows`` with each name's sequence; a name without one gets ``unknown`` unknown bases."""
    return rows.join(seqs.select(on, seq), on, "left").withColumn(seq, F.coalesce(F.col(seq), F.repeat(F.lit("N"), F.lit(unknown))))


def named(rows: DataFrame, names: DataFrame, on: str = "name") -> DataFrame:
    """Rows whose name is listed."""
    return rows.join(names.select(on), on, "left_semi")


def not_named(rows: DataFrame, names: DataFrame, on: str = "name") -> DataFrame:
    """Rows whose name is not listed."""
    return rows.join(names.select(on), on, "left_anti")


def split_named(rows: DataFrame, names: DataFrame, on: str = "name") -> tuple[DataFrame, DataFrame]:
    """(listed rows, the others)."""
    return named(rows, names, on), not_named(rows, names, on)


def pair_listed(rows: DataFrame, pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows whose unordered pair (a, b) is listed in either order."""
    key = pairs.select(F.least(a, b).alias("__x"), F.greatest(a, b).alias("__y"))
    return rows.withColumns({"__x": F.least(a, b), "__y": F.greatest(a, b)}).join(key, ["__x", "__y"], "left_semi").drop("__x", "__y")


def lookup(rows: DataFrame, table: DataFrame, on: list[str], value: str, default) -> DataFrame:
    """``rows`` with ``value`` from the table, or the default."""
    return rows.join(table.select(*on, value), on, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def neither_end_listed(rows: DataFrame, names: DataFrame, a: str, b: str, name: str = "name") -> DataFrame:
    """Rows with a < b of which neither end is listed."""
    out = rows.where(F.col(a) < F.col(b))
    for end in (a, b):
        out = out.join(names.select(F.col(name).alias(end)), end, "left_anti")
    return out


def adjacent(matches: DataFrame, reach: int = 1) -> DataFrame:
    """Pairs of matches of one query on different references, at most ``reach`` apart in order of position.

    Columns of the earlier match have the suffix 1, of the later one the suffix 2.
    """
    w = Window.partitionBy("qry").orderBy(F.least("qs", "qe"), "id")
    cols = ["id", "ref", "rs", "re", "qs", "qe", "rlen"]
    parts = []
    for k in range(1, reach + 1):
        ahead = F.lead(F.struct(*cols), k).over(w).alias("n")
        parts.append(matches.select("qry", *(F.col(c).alias(f"{c}1") for c in cols), ahead).where("n.ref <> ref1").select("*", *(F.col(f"n.{c}").alias(f"{c}2") for c in cols)).drop("n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def merge_geometry(pairs: DataFrame) -> DataFrame:
    """Adjacent pairs as joins of two references: gap, overhangs and directions by strand, first reference smaller."""
    f1, f2 = F.col("qs1") < F.col("qe1"), F.col("qs2") < F.col("qe2")
    near, far = F.when(f1, F.col("qe1")).otherwise(F.col("qs1")), F.when(f2, F.col("qs2")).otherwise(F.col("qe2"))
    gap = (far - near + 1).alias("gap")
    oh1 = F.when(f1, F.col("rlen1") - F.col("re1")).otherwise(F.col("rs1") - 1)
    oh2 = F.when(f2, F.col("rs2") - 1).otherwise(F.col("rlen2") - F.col("re2"))
    d1, d2 = F.when(f1, "F").otherwise("R"), F.when(f2, "F").otherwise("R")
    x = pairs.select("qry", "ref1", "ref2", gap, oh1.alias("oh1"), oh2.alias("oh2"), d1.alias("d1"), d2.alias("d2"))
    turn: Column = F.col("ref1") > F.col("ref2")
    flip = lambda d: F.when(F.col(d) == "F", "R").otherwise("F")
    pick = lambda a, b: F.when(turn, a).otherwise(b)
    return x.select(
        "qry",
        F.least("ref1", "ref2").alias("ctg1"),
        pick(F.col("oh2"), F.col("oh1")).alias("oh1"),
        pick(flip("d2"), F.col("d1")).alias("dir1"),
        F.greatest("ref1", "ref2").alias("ctg2"),
        pick(F.col("oh1"), F.col("oh2")).alias("oh2"),
        pick(flip("d1"), F.col("d2")).alias("dir2"),
        "gap",
    )


def best_joins(joins: DataFrame, least_gap: int = -10_000, most_gap: int = 500_000, overhang: int = 1000) -> DataFrame:
    """For each pair of contigs its join with the smallest overhangs, if it is the pair's only kind or was seen twice.

    Where a pair has joins in the same and in opposite directions, the opposite ones go.
    """
    ok = joins.where(F.col("gap").between(least_gap + 1, most_gap - 1) & (F.col("oh1") <= overhang) & (F.col("oh2") <= overhang))
    kind = ok.groupBy("ctg1", "dir1", "ctg2", "dir2").agg(F.count("*").alias("n"), F.min(F.struct((F.col("oh1") + F.col("oh2")).alias("s"), "oh1", "oh2", "gap", "qry")).alias("b"))
    pair = Window.partitionBy("ctg1", "ctg2")
    same = F.col("dir1") == F.col("dir2")
    seen = kind.withColumn("total", F.sum("n").over(pair)).withColumn("any_same", F.max(same.cast("int")).over(pair))
    good = seen.where(((F.col("n") == F.col("total")) | (F.col("n") > 1)) & (same | (F.col("any_same") == 0)))
    return good.select("ctg1", "dir1", "b.oh1", "ctg2", "dir2", "b.oh2", "b.gap", "n", "b.qry")


def near_reference_ends(matches: DataFrame, slack: int) -> DataFrame:
    """Matches that reach within ``slack`` of an end of their reference."""
    return matches.where((F.col("rs") <= slack) | (F.col("re") >= F.col("rlen") - slack))


def longest_member(joins: DataFrame, reads: DataFrame, size: str = "length(seq)") -> DataFrame:
    """For each kind of join its longest read and its distinct members, in order; ``size`` is a read's length, which ``reads`` may hold without its sequence."""
    with_len = joins.join(reads.select(F.col("name").alias("qry"), F.expr(size).alias("n")), "qry")
    return with_len.groupBy("ctg1", "dir1", "ctg2", "dir2").agg(F.max(F.struct("n", (-F.col("qry")).alias("q"))).alias("b"), F.sort_array(F.collect_set("qry")).alias("members")).select("ctg1", "dir1", "ctg2", "dir2", (-F.col("b.q")).alias("longest"), "members")


def all_pairs(matches: DataFrame, on: str, order: str) -> DataFrame:
    """Pairs of rows with the same ``on``, the first before the second in ``order``; columns get the suffixes 1 and 2."""
    a = matches.select(F.col(on), *(F.col(c).alias(f"{c}1") for c in matches.columns if c != on))
    b = matches.select(F.col(on), *(F.col(c).alias(f"{c}2") for c in matches.columns if c != on))
    return a.join(b, on).where(F.col(f"{order}1") < F.col(f"{order}2"))


def contained(spans: DataFrame, group: str, a: str, b: str, id: str) -> DataFrame:
    """(id, container) for each id whose span lies inside another's of the same group; of equal spans the smallest id contains the others.

    An id appears once, also where several rows share it.
    """
    x = spans.select(group, F.col(a).alias("xa"), F.col(b).alias("xb"), F.col(id).alias("xi"))
    inside = (F.col(a) >= F.col("xa")) & (F.col(b) <= F.col("xb")) & ((F.col(a) > F.col("xa")) | (F.col(b) < F.col("xb")) | (F.col(id) > F.col("xi")))
    return spans.join(x, group).where(inside).groupBy(id).agg(F.min("xi").alias("container"))


def translate_ids(rows: DataFrame, merged: DataFrame, contained_in: DataFrame, id: str = "id") -> DataFrame:
    """Names replaced: a merged name by its container; a contained one by container, orientation and offset; others kept.

    ``merged`` has (id, container); ``contained_in`` has (id, container, flip, shift).
    """
    m = merged.select(id, F.col("container").alias("__m"))
    c = contained_in.select(id, F.col("container").alias("__c"), F.col("flip").alias("__f"), F.col("shift").alias("__s"))
    out = rows.join(m, id, "left").join(c, id, "left")
    new = F.coalesce("__m", "__c", F.col(id))
    turned = F.when(F.col("__m").isNull() & F.coalesce("__f", F.lit(False)), -F.col("ori")).otherwise(F.col("ori"))
    moved = F.col("pos") + F.when(F.col("__m").isNull(), F.coalesce("__s", F.lit(0))).otherwise(0)
    return out.select(F.col(id), new.alias("new_id"), turned.alias("ori"), moved.alias("pos"))


def haplotype_counts(words: DataFrame, counts: DataFrame, least: int = 2, bound: int | None = None) -> DataFrame:
    """Per name, how many words are in table one only, two only, in both, and in all; words counted below ``least`` are absent.

    ``counts`` has (kmer, one, two); where it is known to have at most ``bound`` rows, and these are few, it is broadcast.
    """
    kept = counts.select("kmer", (F.col("one") >= least).alias("a"), (F.col("two") >= least).alias("b")).where("a OR b")
    x = words.join(F.broadcast(kept) if bound is not None and bound <= BROADCAST_ROWS else kept, "kmer", "left")
    a, b = F.coalesce("a", F.lit(False)), F.coalesce("b", F.lit(False))
    return x.groupBy("name").agg(F.count_if(a & ~b).alias("p1"), F.count_if(b & ~a).alias("p2"), F.count_if(a & b).alias("shared"), F.count("*").alias("total"))


def classify_haplotype(counts: DataFrame, least: int = 20, ratio: float = 1.5) -> DataFrame:
    """p1 or p2 where that parent has ``least`` words together and ``ratio`` times the other's; else both."""
    a, b = F.col("p1") + 1e-4, F.col("p2") + 1e-4
    enough = F.col("p1") + F.col("p2") >= least
    return counts.withColumn("class", F.when(enough & (a / b > ratio), "p1").when(enough & (b / a > ratio), "p2").otherwise("both"))


def several_targets(rows: DataFrame, query: str = "qry", target: str = "ref", least: int = 2) -> DataFrame:
    """Rows of queries that hit at least ``least`` distinct targets."""
    many = rows.groupBy(query).agg(F.countDistinct(target).alias("__n")).where(F.col("__n") >= least).select(query)
    return rows.join(many, query, "left_semi")
