"""Column expressions over sequences, seed words and oriented paths.

A path is a string such as ``1R_2F_3F``: unitig numbers, each with its orientation.
Parsed, it is array<struct<id:int,rev:boolean>>.  Case is data: upper-case bases are
corrected, lower-case ones raw, so nothing here changes case unless it says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Complements (fixed values).
BASES, PAIRED = "ACGTNacgtn", "TGCANtgcan"
#: Letters of a text and the bases that stand for them in the deterministic encoding.
LETTERS, AS_BASES = "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def encode_text(text: Column | str) -> Column:
    """A text as a sequence: letters a-z become bases, all else is dropped."""
    return F.translate(F.regexp_replace(F.lower(_c(text)), "[^a-z]", ""), LETTERS, AS_BASES)


def reverse_complement(seq: Column | str) -> Column:
    """Complemented and reversed, case kept; other characters stay as they are."""
    return F.reverse(F.translate(_c(seq), BASES, PAIRED))


def strict_reverse_complement(seq: Column | str) -> Column:
    """Reverse complement in upper case, with N for every character that is no base."""
    return reverse_complement(F.regexp_replace(F.upper(_c(seq)), "[^ACGT]", "N"))


def canonical(word: Column | str) -> Column:
    """The smaller of a word and its reverse complement."""
    return F.least(_c(word), reverse_complement(word))


def canonical_sequence(seq: Column | str) -> Column:
    """The larger of a sequence and its reverse complement: the key under which sequences are deduplicated."""
    return F.greatest(_c(seq), reverse_complement(seq))


def word_code(word: Column | str) -> Column:
    """A word of at most 31 bases as a number, two bits a base (A, C, G, T: 0 to 3)."""
    return F.conv(F.translate(_c(word), "ACGT", "0123"), 4, 10).cast("bigint")


def compress_homopolymers(seq: Column | str) -> Column:
    """Runs of one base as a single base."""
    return F.regexp_replace(_c(seq), r"(.)\1+", "$1")


def is_short_repeat(word: Column | str, longest: int = 2) -> Column:
    """True for a word that equals itself rotated by 1 to ``longest`` bases."""
    w = _c(word)
    turned = [w == F.concat(F.substr(w, F.lit(i + 1)), F.substr(w, F.lit(1), F.lit(i))) for i in range(1, longest + 1)]
    out = turned[0]
    for t in turned[1:]:
        out = out | t
    return out


# Paths


def parse_path(name: Column | str) -> Column:
    """The oriented unitigs of a path; an empty array if any part does not parse."""
    n = _c(name)
    parts = F.transform(F.split(n, "_"), lambda p: F.struct(F.regexp_replace(p, "[FR]$", "").cast("int").alias("id"), p.endswith("R").alias("rev")))
    return F.when(n.rlike(r"^[0-9]+[FR](_[0-9]+[FR])*$"), parts).otherwise(F.array().cast("array<struct<id:int,rev:boolean>>"))


def path_name(path: Column | str) -> Column:
    return F.array_join(F.transform(_c(path), lambda u: F.concat(u["id"].cast("string"), F.when(u["rev"], "R").otherwise("F"))), "_")


def reverse_path(path: Column | str) -> Column:
    """The same unitigs read from the other strand."""
    return F.reverse(F.transform(_c(path), lambda u: F.struct(u["id"].alias("id"), (~u["rev"]).alias("rev"))))


def append_path(path: Column | str, other: Column | str, skip: Column | int) -> Column:
    """``path`` and ``other`` without its first ``skip`` unitigs."""
    a, b, s = _c(path), _c(other), skip if isinstance(skip, Column) else F.lit(skip)
    return F.concat(a, F.slice(b, s + 1, F.greatest(F.lit(0), F.size(b) - s)))


def path_overlap(a: Column | str, b: Column | str) -> Column:
    """The longest m such that the last m unitigs of ``a`` are the first m of ``b``; both longer than m, 0 if none."""
    x, y = _c(a), _c(b)
    most = F.least(F.size(x), F.size(y)) - 1
    fits = F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), most)), lambda m: (m <= most) & (F.slice(x, F.greatest(F.lit(1), F.size(x) - m + 1), m) == F.slice(y, F.lit(1), m)))
    return F.coalesce(F.array_max(fits), F.lit(0))


def stitch(sequences: Column | str, k: int) -> Column:
    """Oriented unitig sequences joined, each after the first without the k-1 bases it shares with the one before."""
    s = _c(sequences)
    rest = F.transform(F.slice(s, 2, F.greatest(F.lit(1), F.size(s))), lambda x: F.substr(x, F.lit(k)))
    return F.concat(F.coalesce(F.get(s, 0), F.lit("")), F.array_join(rest, ""))


def path_length(lengths: Column | str, k: int) -> Column:
    """Bases of the stitched path: the lengths' sum, less k-1 for each junction."""
    ls = _c(lengths)
    return F.aggregate(ls, F.lit(0).cast("bigint"), lambda acc, x: acc + x) - F.greatest(F.lit(0), F.size(ls) - 1) * (k - 1)


# Pieces of sequences


def segments(seqs: DataFrame, inside: str, outside: str, name: str = "name", seq: str = "seq") -> DataFrame:
    """Rows (name, start, stop, piece): maximal pieces of characters in the class ``inside``, 1-based, inclusive.

    ``inside`` and ``outside`` are complementary character classes such as ``[^N]`` and ``[N]``.
    """
    parts = F.regexp_extract_all(F.col(seq), F.lit(f"({inside}+|{outside}+)"), F.lit(1))
    rows = seqs.select(F.col(name).alias("name"), F.posexplode(parts).alias("i", "piece"))
    order = Window.partitionBy("name").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.length("piece")).over(order)
    placed = rows.withColumn("stop", stop).withColumn("start", F.col("stop") - F.length("piece") + 1)
    return placed.where(F.col("piece").rlike(f"^{inside}")).select("name", "start", "stop", "piece")


def windows(seqs: DataFrame, size: int, step: int, least: int = 1, name: str = "name", seq: str = "seq") -> DataFrame:
    """Rows (name, start, piece): windows of ``size`` characters every ``step``; a last one shorter than ``least`` is left out."""
    s = F.col(seq)
    at = seqs.where(F.length(s) >= 1).select(F.col(name).alias("name"), s.alias("__s"), F.explode(F.sequence(F.lit(1), F.length(s), F.lit(step))).alias("start"))
    cut = at.select("name", "start", F.substr(F.col("__s"), F.col("start"), F.lit(size)).alias("piece"), F.length("__s").alias("__n"))
    # A window that starts inside the part that the one before has read to the end adds nothing.
    new = (F.col("start") == 1) | (F.col("start") + size - step <= F.col("__n"))
    return cut.where(new & ((F.length("piece") >= least) | (F.col("start") == 1))).select("name", "start", "piece")


def end_mask(seq: Column | str, keep: int, fill: str = "N") -> Column:
    """The middle of a sequence replaced by ``fill`` where it is longer than twice ``keep``."""
    s = _c(seq)
    n = F.length(s)
    masked = F.concat(F.substr(s, F.lit(1), F.lit(keep)), F.repeat(F.lit(fill), n - 2 * keep), F.substr(s, n - keep + 1))
    return F.when(n > 2 * keep, masked).otherwise(s)


def wrap_lines(seq: Column | str, columns: int) -> Column:
    """A newline after every ``columns`` characters, none at the end."""
    return F.regexp_replace(_c(seq), "(.{" + str(columns) + "})(?=.)", "$1\n")


def percent2(share: Column) -> Column:
    """100 x ``share`` as a string with exactly two decimals: floor(100 x 100 share + .50001) hundredths."""
    whole = F.floor(share * 10000 + 0.50001)
    return F.concat(F.floor(whole / 100).cast("string"), F.lit("."), F.lpad((whole % 100).cast("string"), 2, "0"))


def implied_span(stretch: Column, offset: Column, q_len: Column, r_len: Column) -> Column:
    """Bases of the read that the whole fragment would cover: rounded half to even, kept inside the read."""
    start = F.greatest(F.lit(1), F.least(r_len.cast("bigint"), F.rint(stretch + offset).cast("bigint")))
    stop = F.greatest(F.lit(1), F.least(r_len.cast("bigint"), F.rint(stretch * q_len + offset).cast("bigint")))
    return F.abs(stop - start) + 1


def spacer_length(score: Column, low: float, high: float, shortest: int = 3000, longest: int = 8000) -> Column:
    """Unknown bases between linked contigs: fewer for better scores, half as many again as the longest without a link."""
    share = (F.least(F.lit(high), F.greatest(F.lit(low), score)) - low) / (high - low)
    return F.when(score.isNull(), F.lit(int(longest * 1.5))).otherwise(F.floor(longest - share * (longest - shortest))).cast("bigint")
