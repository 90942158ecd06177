"""Seed words: enumeration, filters, and the join of reads with fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions import sequence as S
from helixframe.runtime import materialize, spread

#: A build side up to this many rows is broadcast; beyond it the join shuffles on the word.
BROADCAST_ROWS = 2_000_000
#: Words that are cut from one piece of a sequence; even, so that thinning keeps odd offsets.
PIECE = 32


def words(seqs: DataFrame, k: int, name: str = "name", seq: str = "seq", thin: bool = False) -> DataFrame:
    """Rows (name, pos, kmer): every word of ``k`` bases with its 1-based offset; words with other characters are skipped.

    ``thin`` keeps the words at odd offsets only.
    """
    s, size = F.col(seq), max(PIECE, k + k % 2)
    # A substring is found by walking from the string's start, so words are cut from short pieces of the sequence.
    pieces = F.regexp_extract_all(s, F.lit(f"(?s).{{1,{size}}}"), 0)
    ahead = lambda p, i: F.concat(p, F.coalesce(F.substr(F.get("__c", i + 1), F.lit(1), F.lit(k - 1)), F.lit("")))
    cut = seqs.where(F.length(s) >= k).select(F.col(name).alias("name"), pieces.alias("__c"))
    cut = spread(cut.select("name", F.posexplode(F.transform("__c", ahead)).alias("__n", "__p"))).where(F.length("__p") >= k)
    inner = F.sequence(F.lit(1), F.length("__p") - k + 1, F.lit(2 if thin else 1))
    # Bases are tested once a piece; only in pieces with other characters is each word looked at.
    out = cut.select("name", "__n", "__p", F.rlike("__p", F.lit("[^ACGTacgt]")).alias("__x"), F.explode(inner).alias("__i"))
    out = out.select("name", (F.col("__n") * size + F.col("__i")).alias("pos"), F.substr(F.col("__p"), F.col("__i"), F.lit(k)).alias("kmer"), "__x")
    return out.where(~F.col("__x") | F.col("kmer").rlike("^[ACGTacgt]+$")).select("name", "pos", "kmer")


def words_of_lengths(seqs: DataFrame, ks: tuple[int, ...], **how) -> DataFrame:
    """Words of several lengths in one table, with their length in ``k``."""
    parts = [words(seqs, k, **how).withColumn("k", F.lit(k)) for k in ks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stranded(rows: DataFrame) -> DataFrame:
    """Words in canonical form, with strand 1 where the word was canonical itself and -1 otherwise."""
    c = S.canonical("kmer")
    return rows.select("name", "pos", c.alias("kmer"), F.when(F.col("kmer") == c, 1).otherwise(-1).alias("strand"))


def without_short_repeats(rows: DataFrame, longest: int = 2) -> DataFrame:
    return rows.where(~S.is_short_repeat("kmer", longest))


def rare(index: DataFrame, max_count: int) -> DataFrame:
    """The index's words with fewer than ``max_count`` places; 0: all."""
    if not max_count:
        return index
    often = index.groupBy("kmer").count().where(F.col("count") >= max_count).select("kmer")
    return index.join(often, "kmer", "left_anti")


def seed_join(reads: DataFrame, fragments: DataFrame, k: int, both_strands: bool = False, max_count: int = 0, longest_repeat: int = 0) -> DataFrame:
    """Rows (read, frag, r_off, q_off): places where a read and a fragment share a word.

    q_off is negative for a match on opposite strands.  Frequent words are cut from the
    index before the join, so that they never multiply; the index is broadcast only
    while its counted size allows.
    """
    left, right = words(reads, k), words(fragments, k)
    if longest_repeat:
        left = without_short_repeats(left, longest_repeat)
    if both_strands:
        left, right = stranded(left), stranded(right)
    right = rare(right, max_count)
    build = right.select("kmer", F.col("name").alias("frag"), F.col("pos").alias("q_off"), *([F.col("strand").alias("__q")] if both_strands else []))
    probe = left.select("kmer", F.col("name").alias("read"), F.col("pos").alias("r_off"), *([F.col("strand").alias("__r")] if both_strands else []))
    if index_rows(fragments, k) <= BROADCAST_ROWS:
        build = F.broadcast(build)
    found = probe.join(build, "kmer")
    sign = F.col("q_off") * F.col("__q") * F.col("__r") if both_strands else F.col("q_off")
    return found.select("read", "frag", "r_off", sign.cast("int").alias("q_off"))


def index_rows(fragments: DataFrame, k: int, seq: str = "seq") -> int:
    """An upper bound on the words of an index, from the fragments' lengths."""
    return fragments.agg(F.sum(F.greatest(F.lit(0), F.length(seq) - k + 1))).first()[0] or 0


def frequency_cutoff(hits: DataFrame, share: float = 0.99) -> DataFrame:
    """Hits of a read's words that are not among its most frequent.

    Per read, n is its number of words with hits; the threshold is the smallest hit
    count t such that more than round(share n) words have at most t hits.  Words with
    more hits go; where no count qualifies, all stay.
    """
    per = hits.groupBy("read", "r_off").agg(F.count("*").alias("hits"))
    few = _not_frequent(per.groupBy("read", "hits").agg(F.count("*").alias("words")), share)
    kept = per.join(few.select("read", "hits"), ["read", "hits"], "left_semi").select("read", "r_off")
    return hits.join(kept, ["read", "r_off"], "left_semi")


def _not_frequent(counts: DataFrame, share: float) -> DataFrame:
    """Rows (read, hits, words) of hit counts up to the read's threshold."""
    upto = Window.partitionBy("read").orderBy("hits").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("read")
    cum = counts.withColumn("upto", F.sum("words").over(upto)).withColumn("n", F.sum("words").over(whole))
    t = F.min(F.when(F.col("upto") > F.floor(F.col("n") * share + 0.5), F.col("hits"))).over(whole)
    return cum.withColumn("t", t).where(F.col("t").isNull() | (F.col("hits") <= F.col("t"))).select("read", "hits", "words")


def cutoff_counts(reads: DataFrame, fragments: DataFrame, k: int, share: float = 0.99) -> DataFrame:
    """Rows (read, kept, hits): the words of a read that ``frequency_cutoff`` keeps of the seed join, and their hits.

    The index holds each word once with its number of places, so hits are counted and never
    made; words are counted by (read, hits) before a shuffle.  Only for names that several
    reads share words are counted by offset first, as equal offsets are one place.
    """
    index = words(fragments, k).groupBy("kmer").agg(F.count("*").alias("hits"))
    if index_rows(fragments, k) <= BROADCAST_ROWS:
        index = F.broadcast(index)
    shared = materialize(reads.groupBy("name").agg(F.count("*").alias("c")).where("c > 1").select(F.col("name").alias("__shared")), "shared")
    many = shared.count()
    per = _word_hits(_named(reads, shared, "left_anti", many), index, k).groupBy("read", "hits").agg(F.count("*").alias("words"))
    if many:
        places = _word_hits(_named(reads, shared, "left_semi", many), index, k).groupBy("read", "r_off").agg(F.sum("hits").alias("hits"))
        per = per.unionByName(places.groupBy("read", "hits").agg(F.count("*").alias("words")))
    return _not_frequent(per, share).groupBy("read").agg(F.sum("words").alias("kept"), F.sum(F.col("words") * F.col("hits")).alias("hits"))


def _named(reads: DataFrame, shared: DataFrame, how: str, rows: int) -> DataFrame:
    if not rows:
        return reads
    return reads.join(F.broadcast(shared) if rows <= BROADCAST_ROWS else shared, F.col("name").eqNullSafe(F.col("__shared")), how)


def _word_hits(reads: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """Rows (read, r_off, hits) of the reads' words that the index (kmer, hits) holds."""
    return words(reads, k).join(index, "kmer").select(F.col("name").alias("read"), F.col("pos").alias("r_off"), "hits")


def fine_join(reads: DataFrame, fragments: DataFrame, coarse: DataFrame, k: int, slack: int = 0) -> DataFrame:
    """Shorter seeds, only for pairs in ``coarse`` (read, frag, r_start, r_end) and inside their span."""
    hits = seed_join(reads.join(coarse.select(F.col("read").alias("name")).distinct(), "name", "left_semi"), fragments, k)
    inside: Column = F.col("r_off").between(F.col("r_start") - slack, F.col("r_end") - k + 1 + slack)
    return hits.join(coarse, ["read", "frag"]).where(inside).select("read", "frag", "r_off", "q_off")
