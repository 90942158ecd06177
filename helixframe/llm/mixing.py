"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

A source with u of H weight units owns u of every H slots; a slot takes one block of
documents.  Block j (from 0) of a source is released at floor(j H / u) and due at
ceil((j + 1) H / u).  In every slot the released block with the earliest deadline runs
(ties: first source by name).  As the units add up to H, no deadline is missed, and at
any slot every source has run less than one block more or less than its share.

Sources without a weight of their own, n of them with ``default`` units each, run as
one task of n ``default`` units, last in ties, which gives its blocks to them in turn; with the task
less than a block off its share, each of them is too.  So only the slots of sources with weights are
made one by one, each in a step that skips the slots of the others.  The work and the
table of slots are bounded by the sum of the weights, a parameter, however many sources
there are: the others' slots follow from the gaps by counting.

Sources never meet in one task: documents are numbered within hash buckets of a source,
whose sizes a small table adds up.

Defined results for unusual input: a null source is a source of its own; sources
without a weight get ``default``; weights of sources without documents are left out; null
ids order before others; ties between repeated ids fall anywhere, each row keeping its
own place; nothing is dropped, repeated or sampled: a source that has run out leaves its
slots empty; an empty table gives an empty table.  All other columns pass through,
whatever their names; the result columns take the place of input columns of the same
names.  Texts are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.runtime import fresh

#: Rows of a numbering bucket where a source has few, and the most buckets a source is cut into.
BUCKET_ROWS, BUCKETS = 64, 4096
#: Buckets in which the sources without weights are numbered.
SOURCE_BUCKETS = 256
OWN = ("mix_slot", "mix_block", "mix_row")

#: One step for each block of a weighted source; c blocks have run, the last in slot ``last``.  The next one runs
#: as soon as a released block is due no later than the other sources' next block, or that is not yet released.
_STEPS = """aggregate(
    sequence(0L, n - 1L),
    named_struct('done', array_repeat(0L, size(s)), 'last', -1L, 'ran', cast(array() AS array<struct<i:int,slot:bigint>>)),
    (acc, c) -> transform(
        array(greatest(acc.last + 1, least(
            array_min(transform(s, (x, i) -> greatest({release}, (({due} - 1) * d) div h + c))),
            ((c + 1) * d + n - 1) div n + c))),
        t -> transform(
            array(array_min(filter(transform(s, (x, i) -> named_struct('due', {due}, 'i', i, 'release', {release})), b -> b.release <= t)).i),
            k -> named_struct(
                'done', transform(acc.done, (x, i) -> x + if(i = k, 1L, 0L)),
                'last', t,
                'ran', concat(acc.ran, array(named_struct('i', k, 'slot', t)))))[0])[0],
    acc -> acc.ran)""".format(release="(acc.done[i] * h) div x.u", due="(((acc.done[i] + 1) * h + x.u - 1) div x.u)")


def schedule(spark: SparkSession, units: dict[str, int], others: int = 0) -> DataFrame:
    """Rows (sk, j, slot): the slots of weighted sources in one period; ``others`` units take its other slots."""
    if not units:
        return spark.range(0).select(F.lit("").alias("sk"), F.col("id").alias("j"), F.col("id").alias("slot"))
    pairs = F.array(*(F.struct(F.lit(k).alias("sk"), F.lit(int(u)).cast("bigint").alias("u")) for k, u in sorted(units.items())))
    n = sum(units.values())
    one = spark.range(1).select(pairs.alias("s"), F.lit(n).cast("bigint").alias("n"), F.lit(others).cast("bigint").alias("d"), F.lit(n + others).cast("bigint").alias("h"))
    ran = one.select("s", F.explode(F.expr(_STEPS)).alias("r")).select(F.expr("s[r.i].sk").alias("sk"), F.col("r.slot").alias("slot"))
    return ran.withColumn("j", F.row_number().over(Window.partitionBy("sk").orderBy("slot")).cast("bigint") - 1).select("sk", "j", "slot")


def _div(x: Column, by: int) -> Column:
    return ((x - x % by) / by).cast("bigint")


def _md5_bucket(md5: Column, n: int) -> Column:
    return F.floor(F.conv(F.substring(md5, 1, 8), 16, 10).cast("bigint") * F.lit(n) / F.lit(1 << 32)).cast("int")


def _numbered_sources(sizes: DataFrame, named: list[str]) -> DataFrame:
    """Rows (sk, i): the sources without weights, numbered from 0 in order of md5."""
    rows = sizes.where(~F.col("sk").isin(named)).select("sk", F.md5(F.col("sk").cast("binary")).alias("m"))
    rows = rows.withColumn("b", _md5_bucket(F.col("m"), SOURCE_BUCKETS))
    inner = rows.withColumn("r", F.row_number().over(Window.partitionBy("b").orderBy("m", "sk")) - 1)
    # At most SOURCE_BUCKETS rows meet in one task.
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("b").count().select("b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("o"))
    return inner.join(F.broadcast(offsets), "b").select("sk", (F.col("r") + F.col("o")).cast("bigint").alias("i"))


def mix(docs: DataFrame, weights: dict[str, int], default: int = 1, block_rows: int = 32, source: str = "source", id: str = "doc_id") -> DataFrame:
    """``docs`` with mix_slot, mix_block (number within the source) and mix_row (place in its block).

    Reading rows in order of (mix_slot, mix_row) mixes the sources.  Within a source
    documents come in order of md5(id), which neither favours nor clusters any.
    """
    if any(int(w) < 1 for w in [*weights.values(), default]):
        raise ValueError("weights are whole numbers from 1")
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in OWN))
    sk, md, b, n, o, i = (fresh(kept, c) for c in ("sk", "md", "bucket", "n", "offset", "other"))
    ident = F.col(f"`{id}`")
    keyed = kept.withColumn(sk, F.coalesce(F.concat(F.lit("s"), F.col(f"`{source}`").cast("string")), F.lit("n"))).withColumn(md, F.md5(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")))
    sizes = keyed.groupBy(F.col(sk).alias("sk")).count()
    wanted = ["s" + k for k in weights]
    seen = sizes.agg(F.max("count").alias("most"), F.collect_set(F.when(F.col("sk").isin(wanted), F.col("sk"))).alias("named"), F.count_if(~F.col("sk").isin(wanted)).alias("others")).first()
    units, others = {k: int(weights[k[1:]]) for k in seen["named"]}, seen["others"]
    period, task = sum(units.values()) + others * default, others * default
    named = schedule(docs.sparkSession, units, task)
    slots: dict[str, list[int]] = {k: [] for k in units}
    for r in named.orderBy("slot").collect():  # as many rows as the weights' sum
        slots[r["sk"]].append(r["slot"])

    keyed = keyed.withColumn(b, _md5_bucket(F.col(md), min(BUCKETS, -(-(seen["most"] or 1) // BUCKET_ROWS))))
    inside = keyed.withColumn(n, F.row_number().over(Window.partitionBy(sk, b).orderBy(md, F.asc_nulls_first(ident))).cast("bigint") - 1)
    before = Window.partitionBy(sk).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy(sk, b).count().select(sk, b, F.coalesce(F.sum("count").over(before), F.lit(0)).cast("bigint").alias(o))
    if others:
        offsets = offsets.join(_numbered_sources(sizes, list(units)).select(F.col("sk").alias(sk), F.col("i").alias(i)), sk, "left")
    else:
        offsets = offsets.withColumn(i, F.lit(0).cast("bigint"))
    rank = F.col(n) + F.col(o)
    placed = inside.join(offsets, [sk, b]).withColumn("mix_block", F.expr(f"(`{n}` + `{o}`) div {int(block_rows)}L")).withColumn("mix_row", rank % block_rows)

    slot: Column = F.lit(None).cast("bigint")
    if others:
        # Block g of the others in a period: g, and one more for each weighted slot before it.
        gaps = F.array(*(F.lit(t - k).cast("bigint") for k, t in enumerate(sorted(t for x in slots.values() for t in x)))).cast("array<bigint>")
        every = F.col("mix_block") * others + F.col(i)
        g = every % task
        slot = _div(every, task) * period + g + F.size(F.filter(gaps, lambda x: x <= g))
    for k, own in slots.items():
        at = F.element_at(F.array(*map(F.lit, own)), (F.col("mix_block") % len(own) + 1).cast("int"))
        slot = F.when(F.col(sk) == k, _div(F.col("mix_block"), len(own)) * period + at).otherwise(slot)
    return placed.select(*(F.col(f"`{c}`") for c in kept.columns), slot.cast("bigint").alias("mix_slot"), "mix_block", "mix_row")


def mixed_order(docs: DataFrame, weights: dict[str, int], **how) -> DataFrame:
    """``docs`` in mixed order, with their own columns only."""
    return mix(docs, weights, **how).orderBy("mix_slot", "mix_row").select(*(F.col(f"`{c}`") for c in docs.columns))
