"""SimHash near-duplicate detection by multi-index hashing.

A document's 64-bit fingerprint is the bitwise majority of the XXH64 values of its
word shingles.  Two fingerprints link when they differ in at most ``radius`` bits.
With the fingerprint cut into ``segments`` equal segments, two linked fingerprints
differ in at most ``radius // segments`` bits inside at least one of them, so that
segment's value of one lies in the small Hamming ball around that of the other.  The
operator enumerates the ball, fetches the table's matches with an equi-join on
(segment, value), and verifies the complete distance.

Defined results for unusual input:

* null text counts as an empty text; a text without words has fingerprint zero, and
  such documents link with each other like any others;
* fewer words than the shingle length: the whole word sequence is the only shingle;
* null ids keep their fingerprint and component; the component's id is the smallest
  id that is not null in it, null only if all are null;
* repeated rows (equal ids, equal texts) each return their own row;
* an empty table returns an empty table with the same columns;
* other columns of the input pass through; the three result columns take the place of
  input columns that have the same names.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.operators.components import connected_components
from helixframe.runtime import bound_batches, fresh, materialize

#: Shingles whose bits are counted at once; bounds the memory for very long texts.
CHUNK = 16384
#: A fingerprint is hot if it has more rows than HOT_ROWS and than one in HOT_SHARE of all: fewer than HOT_SHARE are.
HOT_ROWS, HOT_SHARE = 1000, 10_000
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint_of(data: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit fingerprint of one UTF-8 text."""
    words = data.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    n = len(words) - width + 1
    spans = zip(starts[:n].tolist(), ends[width - 1 :].tolist(), strict=True)
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    while part := [digest(joined[a:b], seed) for a, b in itertools.islice(spans, CHUNK)]:
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """Column of signed 64-bit fingerprints of whole texts (null: as empty)."""

    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        found = (fingerprint_of(x.as_buffer().to_pybytes() if x.is_valid else b"", shingle, seed) for x in texts.cast(pa.binary()))
        return pa.array(np.fromiter(found, np.uint64, len(texts)).view(np.int64))

    return of(text)


def linked_pairs(distinct: DataFrame, column: str, radius: int = 3, segments: int = 2) -> DataFrame:
    """Pairs (a, b) of the distinct fingerprints in ``column`` that differ in 1 to ``radius`` bits.

    Of two values that differ by a flip mask, exactly one has a zero at the mask's
    lowest set bit; only that one enumerates the mask, which halves the probes and
    loses nothing.  Probes grow with the fingerprints, candidates with the true
    matches of ``64 / segments`` bits.  The join always shuffles: Spark's estimate of an
    exploded side leaves the masks out, so that a broadcast would send all probes through
    the driver.
    """
    edges = [round(i * 64 / segments) for i in range(segments + 1)]
    cut = [(lo, hi - lo) for lo, hi in itertools.pairwise(edges)]
    fp = F.col(column)
    rows = F.array(*(F.struct(F.lit(i).alias("segment"), F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << n) - 1 if n < 64 else -1)).alias("value")) for i, (lo, n) in enumerate(cut)))
    table = distinct.select(fp.alias("b"), F.inline(rows))
    width = max(n for _, n in cut)
    masks = [sum(1 << i for i in bits) for r in range(radius // segments + 1) for bits in itertools.combinations(range(width), r)]
    flips = F.array(*(F.lit(m - (1 << 64) if m >= 1 << 63 else m).cast("bigint") for m in masks))
    probe = table.select(F.col("b").alias("a"), "segment", "value", F.explode(flips).alias("flip"))
    lowest = F.col("flip").bitwiseAND(-F.col("flip"))
    probe = probe.where(F.col("value").bitwiseAND(lowest) == 0).select("a", "segment", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    found = probe.join(table.hint("merge"), ["segment", "value"]).where((F.col("a") != F.col("b")) & (distance <= radius))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _fingerprinted(docs: DataFrame, text: str, id: str, shingle: int, seed: int, radius: int, segments: int) -> tuple[DataFrame, DataFrame]:
    """(``docs`` without its text, with fingerprint_bits; for each fingerprint its __rows, component_id and __component, the smallest fingerprint of the component)."""
    bound_batches(docs.sparkSession)
    own = ("fingerprint", "fingerprint_bits", "component_id", "__component", "__rows")
    narrow = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c != text and c.lower() not in own), fingerprints(F.col(f"`{text}`"), shingle, seed).alias("fingerprint_bits"))
    narrow = materialize(narrow, "fingerprints")
    by_value = materialize(narrow.groupBy("fingerprint_bits").agg(F.min(f"`{id}`").alias("first_id"), F.count("*").alias("__rows")), "distinct")
    links = linked_pairs(by_value, "fingerprint_bits", radius, segments)
    comps = materialize(connected_components(links, "a", "b"), "components")
    # Only linked fingerprints go through the join; a lone fingerprint is its own component.
    members = comps.join(by_value, comps.node == by_value.fingerprint_bits).select("component", "fingerprint_bits", "first_id")
    smallest = members.groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = members.join(smallest, "component").select("fingerprint_bits", "component", "component_id")
    return narrow, by_value.join(linked, "fingerprint_bits", "left").select("fingerprint_bits", "__rows", F.coalesce("component_id", "first_id").alias("component_id"), F.coalesce("component", "fingerprint_bits").alias("__component"))


def simhash_components(docs: DataFrame, text: str = "text", id: str = "doc_id", shingle: int = 3, seed: int = 42, radius: int = 3, segments: int = 2) -> DataFrame:
    """``docs`` without its text, with fingerprint (16 hex digits), fingerprint_bits (signed long) and component_id."""
    hexed = F.lower(F.lpad(F.hex("fingerprint_bits"), 16, "0"))
    narrow, groups = _fingerprinted(docs, text, id, shingle, seed, radius, segments)
    groups = materialize(groups.select("fingerprint_bits", "__rows", "component_id"), "groups")
    # Rows of hot fingerprints stay where they are and get their component by broadcast; the others are shuffled.
    least = max(HOT_ROWS, narrow.count() // HOT_SHARE)
    hot = F.broadcast(groups.where(F.col("__rows") > least).drop("__rows"))
    few = narrow.join(hot, "fingerprint_bits", "left_anti").join(groups.drop("__rows"), "fingerprint_bits", "left")
    return narrow.join(hot, "fingerprint_bits").unionByName(few).select("*", hexed.alias("fingerprint"))


def keep_first(docs: DataFrame, text: str = "text", id: str = "doc_id", shingle: int = 3, seed: int = 42, radius: int = 3, segments: int = 2) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id; columns as in ``docs``.

    Groups go by fingerprints, so different texts that share an id each stand for their own
    group; of texts of one group under its smallest id, the one with the smallest md5 stays.
    Rows without an id cannot stand for rows that have one: of those of each group, one stays
    besides, again the one with the smallest md5.
    """
    hashed = F.coalesce(F.md5(F.col(f"`{text}`").cast("binary")), F.lit(""))
    # A struct, so that null ids are equal to each other.
    row, name = F.struct(F.col(f"`{id}`").alias("id"), hashed.alias("md5")), fresh(docs, "row")
    narrow, groups = _fingerprinted(docs.select(f"`{id}`", f"`{text}`", row.alias("__row")), text, id, shingle, seed, radius, segments)
    # First within a fingerprint, then within a component: no task meets all copies of a text.
    nameless = F.col("__row.id").isNull().alias("nameless")
    first = narrow.groupBy("fingerprint_bits", nameless).agg(F.min("__row").alias("__row"))
    kept = first.join(groups, "fingerprint_bits").groupBy("__component", "nameless").agg(F.min("__row").alias(name)).select(name)
    return docs.withColumn(name, row).join(kept, name, "left_semi").dropDuplicates([name]).select(*(F.col(f"`{c}`") for c in docs.columns))
