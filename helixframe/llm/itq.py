"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

A rotation learned on a bounded sample makes balanced binary codes of centred,
normalised vectors.  Codes are cut into segments; the Hamming ball around each
segment's value is looked up in the table of all codes, and the original vectors of
the matches decide in double precision.

Equal vectors of one label are folded first.  Groups of very similar vectors would still make
one match per pair, so vectors of one label that lie within a small angle of a leader form a
class, however many they are; any two of them are closer than the threshold.  Crowded
neighbourhoods get their leaders from a sample of them, so that a dense group is one class
though many tasks share it.  Tables hold classes.  Of two classes that match, the angle
between the leaders and the widths of the classes often tell that all their vectors
link, or none; only else are the vectors verified, by matrix products of at most ``CHUNK`` rows.

Defined results for unusual input: vectors that are null, zero or hold null or
non-finite components, or whose label or id is null, have no links; they return
n_links 0 and themselves as component (kept true; with a null id: component null, kept
false).  Rows that share an id count and return as one vector, the smallest (label,
vector) of them.  Vectors of different lengths never link.  An empty table gives an
empty result.  Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm.vectors import matrix, takes_part
from helixframe.operators.components import connected_components
from helixframe.runtime import bound_batches, materialize, release

#: Vectors that the rotation is learned on, at most.
SAMPLE = 4096
#: Most vectors of a class in one row, and about as many as the group in which a task looks for classes.
CHUNK, GROUP = 256, 2048
#: Crowded neighbourhoods up to this number are broadcast.
BROADCAST_GROUPS = 100_000
#: Sampled vectors that a leader of a crowded neighbourhood has, at least.
DENSE = 8
#: Vectors of a label up to which tables have four segments (16 bits of 64); beyond, three (21 bits).
FOUR_SEGMENTS = 1 << 20
#: Bits by which the codes of a class may stray from their leader's, beyond the radius.
SLACK = 8


def learn(rows: np.ndarray, bits: int, rounds: int = 40, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) of balanced codes: principal axes, rotated towards the corners of the cube."""
    mean = rows.mean(0)
    _, axes = np.linalg.eigh((rows - mean).T @ (rows - mean))
    axes = axes[:, ::-1][:, :bits]
    flat = (rows - mean) @ axes
    turn, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((axes.shape[1],) * 2))
    for _ in range(rounds):
        u, _, vt = np.linalg.svd(np.where(flat @ turn >= 0, 1.0, -1.0).T @ flat)
        turn = vt.T @ u.T
    return mean, axes @ turn


def _unit(rows: np.ndarray) -> np.ndarray:
    big = np.abs(rows).max(1, keepdims=True)
    rows = rows / big  # so that squares neither overflow nor vanish
    return rows / np.sqrt((rows * rows).sum(1, keepdims=True))


def _fit(rows: np.ndarray, width: int) -> np.ndarray:
    return rows[:, :width] if rows.shape[1] >= width else np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def _codes(model: tuple[np.ndarray, np.ndarray], lists: pa.Array) -> np.ndarray:
    mean, axes = model
    out = np.zeros(len(lists), np.int64)
    sizes = np.diff(lists.offsets.to_numpy())
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        bits = (_fit(_unit(matrix(lists.take(pa.array(at)))), len(mean)) - mean) @ axes >= 0
        packed = np.zeros((len(at), 8), np.uint8)
        own = np.packbits(bits, axis=1, bitorder="little")
        packed[:, : own.shape[1]] = own
        out[at] = packed.view("<i8")[:, 0]
    return out


def _greedy(unit: np.ndarray, lean: float) -> list[np.ndarray]:
    """Members of greedy leaders, in order: every vector joins the first leader within the angle; the leader comes first."""
    free, out = np.ones(len(unit), bool), []
    for i in range(len(unit)):
        if free[i]:
            rest = np.flatnonzero(free)
            near = rest[unit[rest] @ unit[i] >= lean]
            own = np.concatenate(([i], near[near != i]))
            free[own] = False
            out.append(own)
    return out


def _leaders(table: pa.Table, lean: float) -> pa.Table:
    """The leaders of a sample that have at least ``DENSE`` vectors of it."""
    table = table.sort_by("id")
    found = [int(m[0]) for m in _greedy(_unit(matrix(table["v"])), lean) if len(m) >= DENSE]
    return table.take(pa.array(found, pa.int64())).select(["label", "d", "p", "id", "code", "v"])


def _classes(table: pa.Table, leaders: pa.Table, lean: float) -> pa.Table:
    """Rows of classes, of at most ``CHUNK`` vectors each: first the classes of given leaders, then those that the rest form."""
    cols: dict[str, list] = {c: [] for c in ("class", "lead", "lead_v", "slack", "width", "ids", "copies", "codes", "rows")}
    label, d = table["label"].type, pa.int32()
    if table.num_rows:
        table = table.sort_by("id")
        ids, codes, copies, rows = table["id"].to_numpy(), table["code"].to_numpy(), table["c"].to_numpy(), matrix(table["v"])
        unit, first = _unit(rows), np.full(table.num_rows, -1)
        groups = []
        if leaders.num_rows:
            leaders = leaders.sort_by("l_id")
            heads, lead_rows = _unit(matrix(leaders["l_v"])), matrix(leaders["l_v"])
            fits = unit @ heads.T >= lean
            first = np.where(fits.any(1), fits.argmax(1), -1)
            groups = [(leaders["l_id"][n].as_py(), leaders["l_code"][n].as_py(), lead_rows[n], heads[n], np.flatnonzero(first == n), SLACK) for n in range(leaders.num_rows)]
        rest = np.flatnonzero(first < 0)
        groups += [(ids[m[0]], codes[m[0]], rows[m[0]], unit[m[0]], m, SLACK * (len(m) > 1)) for m in (rest[x] for x in _greedy(unit[rest], lean))]
        for name, code, row, head, members, slack in groups:
            for k in range(0, len(members), CHUNK):
                m = members[k : k + CHUNK]
                made = (name, code, row, slack, float(np.arccos(np.clip(unit[m] @ head, -1, 1)).max()), ids[m], copies[m], codes[m], rows[m].ravel())
                for c, x in zip(cols, made, strict=True):
                    cols[c].append(x)
    n = len(cols["ids"])
    kinds = {"class": pa.int64(), "lead": pa.int64(), "lead_v": pa.list_(pa.float64()), "slack": pa.int32(), "width": pa.float64(), "ids": pa.list_(pa.int64()), "copies": pa.list_(pa.int64()), "codes": pa.list_(pa.int64()), "rows": pa.list_(pa.float64())}
    head = {"label": pa.array([table["label"][0].as_py()] * n if n else [], label), "d": pa.array([table["d"][0].as_py()] * n if n else [], d)}
    return pa.table(head | {c: pa.array(cols[c], t) for c, t in kinds.items()})


def _decide(batches, least: float):
    """For each pair of classes, by the angle between leaders, whether all their vectors link (true), none (left out), or some may (false)."""
    most = math.acos(least)
    for batch in batches:
        sure: list[bool | None] = []
        for x, y, wx, wy in zip(batch["va"], batch["vb"], batch["wa"].to_pylist(), batch["wb"].to_pylist(), strict=True):
            x, y = _unit(x.values.to_numpy()[None]), _unit(y.values.to_numpy()[None])
            angle = math.acos(max(-1.0, min(1.0, float((x * y).sum()))))
            sure.append(True if angle + wx + wy <= most - 1e-6 else (None if angle - wx - wy >= most + 1e-6 else False))
        made = pa.table({c: batch[c] for c in ("a", "b", "size_a", "size_b")} | {"sure": pa.array(sure, pa.bool_())})
        yield from made.filter(pa.array([x is not None for x in sure], pa.bool_())).to_batches()


def _verify(batches, least: float):
    """For each pair of classes' rows, how many vectors of the other class each vector links with, copies included."""
    for batch in batches:
        cols: dict[str, list[int]] = {"a": [], "b": [], "id": [], "n": []}
        for a, b, ia, ib, ca, cb, ra, rb in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), *(batch[c] for c in ("ids_a", "ids_b", "copies_a", "copies_b", "rows_a", "rows_b")), strict=True):
            ids, copies = [x.values.to_numpy() for x in (ia, ib)], [x.values.to_numpy() for x in (ca, cb)]
            one, two = (_unit(r.values.to_numpy().reshape(len(i), -1)) for r, i in zip((ra, rb), ids, strict=True))
            near = one @ two.T >= least
            for i, n in ((ids[0], near @ copies[1]), (ids[1], copies[0] @ near)):
                hit = np.flatnonzero(n)
                cols["a"] += [a] * len(hit)
                cols["b"] += [b] * len(hit)
                cols["id"] += i[hit].tolist()
                cols["n"] += n[hit].tolist()
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in cols.items()})


def near_duplicates(vectors: DataFrame, id: str = "vec_id", vec: str = "embedding", label: str = "label", least: float = 0.93, segments: int | None = None, ball: int | None = None, radius: int = 18, sample: int = SAMPLE, group: int = GROUP) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one a vector.

    Codes have 64 bits, or as many as the vectors' components.  Codes within ``radius`` bits whose
    segments differ by at most ``ball`` bits somewhere are verified.  Where they are not given, both
    follow from the number of vectors: longer segments for more of them, so that a table entry keeps few.
    """
    spark = vectors.sparkSession
    bound_batches(spark)
    i, v, l = F.col(f"`{id}`"), F.col(f"`{vec}`"), F.col(f"`{label}`")
    named = vectors.where(i.isNotNull()).select(i.cast("bigint").alias("id"), l.alias("label"), v.cast("array<double>").alias("v"))
    one = named.groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v")
    one = one.withColumn("ok", takes_part(F.col("v")) & F.col("label").isNotNull()).withColumns({"k1": F.xxhash64("label", "v"), "k2": F.xxhash64(F.lit(1), "v", "label")})
    one = materialize(one, "vectors")

    # Equal vectors are one row from here on, under their smallest id.
    rows = one.where("ok").groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("c")).withColumn("d", F.size("v"))
    rows = materialize(rows, "distinct")
    drawn = rows.orderBy(F.xxhash64("id")).limit(sample).select("v", "d").collect()
    if not drawn:
        alone = one.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
        return _result(alone, vectors, i)
    width = max(sorted({x["d"] for x in drawn}), key=[x["d"] for x in drawn].count)
    bits = min(64, width)
    model = learn(_unit(np.array([x["v"] for x in drawn if x["d"] == width])), bits)

    @F.arrow_udf("bigint")
    def code_of(lists: pa.Array) -> pa.Array:
        return pa.array(_codes(model, lists))

    coded = materialize(rows.select("id", "label", "v", "d", "c", code_of("v").alias("code")), "codes")
    seen = coded.groupBy("label").count().agg(F.sum("count").alias("n"), F.max("count").alias("most")).first()
    if segments is None:
        segments, ball = (4, 2) if seen["most"] <= FOUR_SEGMENTS else (3, 3)

    # Neighbourhoods for the search of classes: a prefix of the code.  Crowded ones are dealt to several tasks, which share the leaders.
    prefix_bits = min(bits, 24, max(4, int(math.log2(max(2, seen["n"] / 512)))))
    place = ["label", "d", "p"]
    keyed = coded.withColumn("p", F.shiftrightunsigned("code", bits - prefix_bits) if bits > prefix_bits else F.col("code"))
    crowded = keyed.groupBy(*place).count().where(F.col("count") > group).withColumn("parts", F.ceil(F.col("count") / F.lit(group // 2)).cast("bigint")).drop("count")
    # At most a row for ``group`` vectors: broadcast while these are few, so that a crowded neighbourhood meets in no task.
    crowded = materialize(crowded, "crowded")
    few = crowded.count() <= BROADCAST_GROUPS
    salted = keyed.join(F.broadcast(crowded) if few else crowded, place, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    salted = materialize(salted.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("parts"))), "salted")
    lean = math.cos(0.98 * math.acos(least) / 2)  # two vectors of a class are then closer than the threshold
    kind = dict(vectors.select(l.alias("l")).dtypes)["l"]
    drawn_of = salted.where("parts > 1 AND salt = 0").select(*place, "id", "code", "v")
    leaders = drawn_of.groupBy(*place).applyInArrow(lambda t: _leaders(t, lean), f"label {kind}, d int, p long, id long, code long, v array<double>")
    shared = leaders.join(crowded, place).select(F.col("label").alias("l_label"), F.col("d").alias("l_d"), F.col("p").alias("l_p"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("l_salt"), F.col("id").alias("l_id"), F.col("code").alias("l_code"), F.col("v").alias("l_v"))
    schema = f"label {kind}, d int, class long, lead long, lead_v array<double>, slack int, width double, ids array<long>, copies array<long>, codes array<long>, rows array<double>"
    # Dealt by the salt as well: the join above has left the rows of a neighbourhood in one task.
    left = salted.select(*place, "salt", "id", "c", "code", "v").repartition(*place, "salt")
    classes = left.groupBy(*place, "salt").cogroup(shared.groupBy("l_label", "l_d", "l_p", "l_salt")).applyInArrow(lambda t, u: _classes(t, u, lean), schema)
    classes = materialize(classes, "classes")
    for done in (rows, coded, salted):
        release(done)

    cuts = list(itertools.pairwise(round(k * bits / segments) for k in range(segments + 1)))
    cut = F.array(*(F.struct(F.lit(k).alias("s"), F.shiftrightunsigned("code", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("x")) for k, (lo, hi) in enumerate(cuts)))
    key = ["label", "d", "s", "x"]
    table = classes.select("label", "d", "class", "lead", "slack", F.explode("codes").alias("code")).select("label", "d", "class", "lead", "slack", F.inline(cut)).distinct()
    widest = max(hi - lo for lo, hi in cuts)
    masks = [sum(1 << b for b in at) for r in range(ball + 1) for at in itertools.combinations(range(widest), r)]
    probes = table.select("*", F.explode(F.array(*(F.lit(m).cast("bigint") for m in masks))).alias("m"))
    # Of two values that differ by a mask, only the one with a zero at its lowest bit looks it up.
    probes = probes.where(F.col("x").bitwiseAND(F.col("m").bitwiseAND(-F.col("m"))) == 0)
    probes = probes.select("label", "d", "s", F.col("x").bitwiseXOR(F.col("m")).alias("x"), F.col("class").alias("a"), F.col("lead").alias("la"), F.col("slack").alias("sa"))
    apart: Column = F.bit_count(F.col("la").bitwiseXOR(F.col("lead")))
    found = probes.join(table, key).where((F.col("a") != F.col("class")) & (apart <= radius + F.col("sa") + F.col("slack")))
    pairs = found.select(F.least("a", "class").alias("a"), F.greatest("a", "class").alias("b")).distinct()

    weight = F.aggregate("copies", F.lit(0).cast("bigint"), lambda s, x: s + x)
    info = classes.groupBy("class").agg(F.first("lead_v").alias("v"), F.max("width").alias("w"), F.sum(weight).alias("size"))
    head = lambda x: info.select(F.col("class").alias(x), F.col("v").alias(f"v{x}"), F.col("w").alias(f"w{x}"), F.col("size").alias(f"size_{x}"))
    judged = pairs.join(head("a"), "a").join(head("b"), "b").select("a", "b", "size_a", "size_b", "va", "vb", "wa", "wb")
    judged = materialize(judged.mapInArrow(lambda b: _decide(b, least), "a long, b long, size_a long, size_b long, sure boolean"), "judged")

    side = lambda x: classes.select(F.col("class").alias(x), F.col("ids").alias(f"ids_{x}"), F.col("copies").alias(f"copies_{x}"), F.col("rows").alias(f"rows_{x}"))
    chunks = judged.where("NOT sure").select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "ids_a", "ids_b", "copies_a", "copies_b", "rows_a", "rows_b")
    links = materialize(chunks.mapInArrow(lambda b: _verify(b, least), "a long, b long, id long, n long"), "links")
    certain = judged.where("sure")

    parts = connected_components(links.select("a", "b").unionByName(certain.select("a", "b")).distinct(), "a", "b")
    whole = certain.select(F.col("a").alias("class"), F.col("size_b").alias("n")).unionByName(certain.select(F.col("b").alias("class"), F.col("size_a").alias("n"))).groupBy("class").agg(F.sum("n").alias("beside"))
    sized = info.join(whole, "class", "left").select("class", (F.col("size") - 1 + F.coalesce("beside", F.lit(0))).alias("within"))
    # Rows of classes hold many vectors each, so joins by class and component see few rows of a large one.
    grouped = classes.select("class", "ids").join(sized, "class").join(parts.withColumnRenamed("node", "class"), "class", "left").withColumn("part", F.coalesce("component", "class"))
    first = grouped.groupBy("part").agg(F.min(F.array_min("ids")).alias("component_id"))
    inner = grouped.join(first, "part").select(F.explode("ids").alias("rep"), "within", "component_id")
    crossing = links.groupBy(F.col("id").alias("rep")).agg(F.sum("n").alias("across"))
    taking = inner.join(crossing, "rep", "left").select("rep", (F.col("within") + F.coalesce("across", F.lit(0))).alias("links"), F.col("component_id").alias("part_id"))
    # Back to all vectors by the hashes of their representative.
    keys = one.select("id", "k1", "k2")
    known = taking.join(keys, taking.rep == keys.id).select("k1", "k2", "links", "part_id")
    out = one.select("id", "k1", "k2", "ok").join(known, ["k1", "k2"], "left")
    own = F.col("ok") & F.col("part_id").isNotNull()
    out = out.select("id", F.when(own, F.col("links")).otherwise(0).cast("bigint").alias("n_links"), F.when(own, F.col("part_id")).otherwise(F.col("id")).alias("component_id"))
    return _result(out.withColumn("kept", F.col("id") == F.col("component_id")), vectors, i)


def _result(named: DataFrame, vectors: DataFrame, i: Column) -> DataFrame:
    nameless = vectors.where(i.isNull()).select(F.lit(None).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("n_links"), F.lit(None).cast("bigint").alias("component_id"), F.lit(False).alias("kept"))
    return named.unionByName(nameless).withColumnRenamed("id", "vec_id")
