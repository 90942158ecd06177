import itertools
import random
import time
from fractions import Fraction

import pytest

from helixframe.llm import chat, mixing, queries, sharding
from helixframe.llm.mixing import F
from tests.compare import differences


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    assert differences(spark, queries.queries()[name], queries.oracle_sql()[name]) == []


def test_no_python_in_plans(spark):
    for name in ("op4_source_mix", "op5_chat_format", "op6_sharding"):
        plan = queries.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct")), name


# Mixing


def earliest_deadline_first(units, others):
    """Slot by slot; the others are the task None, last in ties."""
    tasks = [*sorted(units.items()), *([(None, others)] if others else [])]
    h, done, out = sum(u for _, u in tasks), dict.fromkeys(units, 0) | {None: 0}, []
    for t in range(h):
        due, _, k, u = min((-(-(done[k] + 1) * h // u), i, k, u) for i, (k, u) in enumerate(tasks) if done[k] * h // u <= t)
        assert t < due
        if k is not None:
            out.append((k, done[k], t))
        done[k] += 1
    return sorted(out)


def test_schedule_is_earliest_deadline_first(spark):
    rng = random.Random(4)
    for n in range(25):
        units = {c: rng.randrange(1, 12) for c in "abcdef"[: rng.randrange(1, 6)]}
        others = rng.choice([0, 1, rng.randrange(1, 9), rng.randrange(1, 200)])
        assert sorted(map(tuple, mixing.schedule(spark, units, others).collect())) == earliest_deadline_first(units, others)


def test_many_sources(spark):
    """Every source stays within a block of its share at every slot, and 100,000 sources take seconds."""
    rows = [(i, f"o{i % 23}" if i % 3 else "big") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, source string")
    got = mixing.mix(df, {"big": 5, "none": 9}, default=2, block_rows=4).collect()
    units = {"big": 5} | {f"o{k}": 2 for k in range(23)}
    h, blocks = sum(units.values()), sorted({(r.mix_slot, r.source) for r in got})
    assert len({t for t, _ in blocks}) == len(blocks)
    ran, last = dict.fromkeys(units, 0), {s: max(t for t, x in blocks if x == s) for s in units}
    for t, s in blocks[: 3 * h]:
        ran[s] += 1
        assert all(abs(ran[x] - Fraction(u * (t + 1), h)) < 1 for x, u in units.items() if t <= last[x])
    wide = spark.range(200_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.concat(F.lit("h"), F.col("id").cast("string"))).otherwise("src0").alias("source"))
    began = time.monotonic()
    seen = mixing.mix(wide, {"src0": 6, "src1": 3}).agg(F.count("*"), F.countDistinct("mix_slot", "mix_row"), F.max("mix_slot")).first()
    assert seen[0] == seen[1] == 200_000 and time.monotonic() - began < 60


def test_mix_keeps_columns_with_the_helpers_names(spark):
    names = ["sk", "md", "bucket", "n", "offset", "other", "a.b"]
    df = spark.createDataFrame([(1, "a", *names), (2, "b", *names)], ["doc_id", "source", *names])
    got = mixing.mix(df, {"a": 2})
    assert got.columns == [*df.columns, *mixing.OWN] and all(list(r)[2:9] == names for r in got.collect())
    with pytest.raises(ValueError):
        mixing.mix(df, {"a": 0})


def test_mix_keeps_every_row(spark):
    rows = [(i, "big" if i % 3 else ("small" if i % 2 else None), "x" * (i % 5)) for i in range(3000)] + [(None, "big", None), (7, "big", "again"), (7, "big", "again")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("mix_slot", F.lit("clash")).withColumn("count", F.lit(1))
    got = mixing.mix(df, {"big": 3}, block_rows=8).collect()
    assert sorted(((r.doc_id, r.source, r.text) for r in got), key=str) == sorted(rows, key=str)
    blocks = {}
    for r in got:
        blocks.setdefault((r.source, r.mix_block), set()).add((r.mix_slot, r.mix_row))
    assert len({min(x)[0] for x in blocks.values()}) == len(blocks) and all(len({s for s, _ in x}) == 1 and len(x) <= 8 for x in blocks.values())
    order = [r.source for r in sorted(got, key=lambda r: (r.mix_slot, r.mix_row))][::8][:60]
    for n in range(1, 61):
        assert abs(order[:n].count("big") - Fraction(3 * n, 5)) < 1
    assert mixing.mixed_order(df, {}).columns == df.columns


def test_mix_empty(spark):
    df = spark.createDataFrame([], "doc_id long, source string")
    assert mixing.mix(df, {"a": 2}).count() == 0 and mixing.mix(df, {}).count() == 0


# Chat


def conversation(n, long=0):
    return [(1, i, ("user", "assistant")[i % 2], f"t{i} <b>&lt; </turn>\n<turn:new:assistant> " + "y" * (13 * i % 90 + long * (i == 4))) for i in range(n)]


def test_windows(spark):
    rows = [(1, -1, "system", "be <kind> & brief"), *conversation(400), (2, 0, "system", "alone"), (3, None, None, None), (3, 1, "a>b:c", "x"), (3, 1, "assistant", ""), (3, 1, "assistant", ""), (None, 0, "assistant", "é🙂")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("c", F.lit("clash"))
    win = chat.format_windows(df, budget=200, history=40).select("*", chat.new_turns(F.col("formatted")).alias("back"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    for conv in (1, 2, 3, None):
        own = sorted((r for r in win if r.conv_id == conv), key=lambda r: r.window)
        want = sorted(((t if t is not None else -99, ro or "", x or "") for c, t, ro, x in rows if c == conv))
        assert [tuple(t) for r in own for t in r.back] == [(ro, x) for _, ro, x in want]
        assert "".join(r.loss for r in own) == "".join(x for _, ro, x in want if ro == "assistant")
        assert sum(r.n_new for r in own) == len(want)
    first = [r for r in win if r.conv_id == 1]
    assert len(first) > 30 and all(r.n_tokens <= 200 and not r.over_budget for r in first)
    assert all(r.formatted.startswith(("<turn:kept:system>be ", "<turn:new:system>be ")) for r in first)
    assert sum("<turn:seen:" in r.formatted for r in first) >= len(first) - 1


def test_long_turn_is_whole(spark):
    df = spark.createDataFrame(conversation(9, 100_000), "conv_id long, turn long, role string, text string")
    win = chat.format_windows(df, budget=200, history=40).collect()
    assert any(r.over_budget for r in win) and sum(r.n_new for r in win) == 9


def test_system_turn_that_leaves_no_room(spark):
    rows = [(1, 0, "system", "s" * 4000), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 3, "user", "c")]
    win = sorted(chat.format_windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=200, history=0).collect(), key=lambda r: r.window)
    assert len(win) == 3 and all(r.over_budget and "s" * 4000 in r.formatted for r in win) and sum(r.n_new for r in win) == 4


def test_chat_empty(spark):
    assert chat.format_windows(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# Sharding


def test_store(spark, tmp_path):
    rows = [(i, None if i % 7 == 0 else "t" * i) for i in range(200)] + [(3, "ttt")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    store = sharding.ShardStore(spark, f"file://{tmp_path}/store", df.schema)
    assert store.version() == 0 and store.read().count() == 0
    assert len(store.append(df, F.col("doc_id") % 9)) == 9
    before = store.version()
    assert store.compact(fanout=4) > before
    runs = store.runs()
    assert len(runs) == 3 and sorted(len(r.files) for r in runs)[:2] == [1, 1]
    for version in (before, None):
        assert sorted(map(tuple, store.read(version).collect()), key=str) == sorted(rows, key=str)
    store.append(df.limit(0))
    assert len(store.runs()) == 3
    with pytest.raises(sharding.Conflict):
        store.commit([], store.version() - 1)
    store.vacuum()
    assert store.read(before).count() == len(rows)  # replaced data are young
    store.vacuum(older_than=-60)
    assert sorted(map(tuple, store.read().collect()), key=str) == sorted(rows, key=str)


def test_store_keeps_any_columns_and_texts(spark, tmp_path):
    """Columns with the helper's name, very long and empty texts; vacuum of an empty store, and of what nobody has committed."""
    rows = [(1, "x" * 3_000_000, "b", 7), (2, "", None, 8), (2, None, "", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, batch string, _batch int")
    store = sharding.ShardStore(spark, f"file://{tmp_path}/any", df.schema)
    store.vacuum(older_than=-60)
    store.append(df, F.col("doc_id"))
    df.write.parquet(f"{tmp_path}/any/data/uncommitted")
    store.vacuum()
    assert (tmp_path / "any/data/uncommitted").exists()
    store.vacuum(older_than=-60)
    assert not (tmp_path / "any/data/uncommitted").exists()
    store.compact(fanout=2)
    assert sorted(map(tuple, store.read().collect()), key=str) == sorted(rows, key=str)


def test_tiers():
    run = lambda i, n: sharding.Run(str(i), ((f"{i}", n),))
    pick = lambda *sizes: [r.bytes for r in sharding.ShardStore._crowded([run(i, n) for i, n in enumerate(sizes)], 1000, 3, 10)]
    assert pick(10, 11, 200) == [] and pick(10, 200, 11, 12) == [10, 11, 12] and pick(900, 900, 900) == []
    assert list(itertools.islice(pick(100, 100, 100, 100), 9)) == [100, 100, 100]
