"""Operators at sizes and on ids where plainer forms of them failed."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helixframe import catalog
from helixframe.operators import grouped, kmers, merging, scaffold
from helixframe.operators import joins as J
from tests.compare import DATA

Q = catalog.queries()


def matches(spark):
    cols = "id long, ref long, qry long, rs long, re long, qs long, qe long, mlen long, idy long, rlen long, qlen long"
    r = random.Random(5)
    data = []
    for i in range(600):
        rs, q, n = r.randrange(1, 9000), r.randrange(1, 9000), r.randrange(300, 2500)
        way = r.random() < 0.7
        data.append((i, r.randrange(4), r.randrange(12), rs, rs + n - 1, q if way else q + n - 1, q + n - 1 if way else q, n, r.randrange(90, 100), 12000, 12000))
    return spark.createDataFrame(data, cols), data


def best_at_starts(data, share, span):
    kept = set()
    for qry in {x[2] for x in data}:
        own, last = [x for x in data if x[2] == qry and x[7] >= span * x[9]], -1
        for lo in sorted({min(x[5:7]) for x in own}):
            same = [x for x in own if min(x[5:7]) == lo]
            good = [x for x in same if x[7] >= share * max(y[7] for y in same) and max(x[5:7]) > last]
            last = max([last, *(max(x[5:7]) for x in good)])
            kept |= {x[0] for x in good}
    return kept


def test_streamed_without_frames(spark):
    df, data = matches(spark)
    found = merging.filter_matches(df, span=0.05)
    assert "InPandas" not in found._jdf.queryExecution().toString() and found.columns == df.columns
    assert {r.id for r in found.collect()} == best_at_starts(data, 0.95, 0.05)


def no_group_frames(spark, monkeypatch, run):
    """Rows of an operator that must not make a frame for each group."""
    monkeypatch.setattr(merging, "per_group", None)
    return run(matches(spark)[0]).collect()


def test_merged_without_group_frames(spark, monkeypatch):
    got = no_group_frames(spark, monkeypatch, lambda m: merging.merge_matches(m, 2000))
    rows = matches(spark)[0].collect()
    want = [merging._merged(c) for p in {(r.ref, r.qry) for r in rows} for c in merging.chain_matches([r for r in rows if (r.ref, r.qry) == p], 2000)]
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and any(r.n > 1 for r in got)


def test_merged_and_tiled_without_group_frames(spark, monkeypatch):
    got = no_group_frames(spark, monkeypatch, lambda m: merging.merge_and_tile(m, 2000, least=1000))
    placed = [r for r in got if not r.contained]
    assert placed and all(r.re - r.rs + 1 >= 1000 for r in placed)
    inside = lambda x, p: p.ref == x.ref and p.rs - 100 <= x.rs and x.re <= p.re + 100
    assert all(x.re - x.rs + 1 < 1000 or any(inside(x, p) for p in placed) for x in got if x.contained)


def test_interval_tiling_without_group_frames(spark, monkeypatch):
    got = no_group_frames(spark, monkeypatch, lambda m: merging.interval_tiling(m, 17))
    assert got and {r.ref for r in got} == {0, 1, 2, 3}
    assert not [1 for x in got for y in got if x is not y and x.ref == y.ref and x.rs <= y.rs and y.re <= x.re]


@pytest.mark.parametrize("batch", [1, 1000])
def test_rows_per_group_are_whole(spark, batch):
    data = [(k, i) for k in range(7) for i in range(k * 3 + 1)] + [(None, 1), (None, None)]
    df = spark.createDataFrame(data, "k long, v long")
    got = grouped.rows_per_group(df, ["k"], lambda g: [(g[0].k, len(g), sum(x.v or 0 for x in g))], "k long, n long, s long", batch).collect()
    assert Counter(map(tuple, got)) == Counter([(k, k * 3 + 1, sum(range(k * 3 + 1))) for k in range(7)] + [(None, 2, 1)])


def test_longest_member_makes_no_sequences(spark):
    plan = Q["longest_read_per_join"](spark, f"{DATA}/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "repeat(" not in plan


class Links(list):
    """A list that counts how often it is gone through."""

    times = 0

    def __iter__(self):
        self.times += 1
        return super().__iter__()


def test_branches_in_one_pass(spark):
    """Each node off the trunk goes beside the placed node that it links best with, in one pass over the links."""
    r = random.Random(3)
    names = [f"n{i:03}" for i in range(60)]
    links = Links((a, b, float(r.randrange(9))) for i, a in enumerate(names) for b in names[i + 1 :] if r.random() < 0.2 or b == names[i + 1])
    tree = scaffold.spanning_tree(links, {})
    path = scaffold.trunk(tree)
    want = {x: float(i) for i, x in enumerate(path)}
    both = [(-s, x, y) for a, b, s in [*list(links), *tree] for x, y in ((a, b), (b, a))]
    while rest := [e for e in both if e[1] not in want and e[2] in want]:
        _, x, y = min(rest)
        want[x] = want[y] + 0.5
    links.times = 0
    assert dict(scaffold.place_branches(path, tree, links)) == want and len(want) == 60 and len(path) < 55
    assert links.times == 1


def items(spark, path):
    """Line items of which some share all that their id is made of."""
    li = spark.read.parquet(f"{DATA}/sf0.001/lineitem.parquet").limit(300)
    li.unionByName(li.limit(40)).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_tile_none_with_shared_ids(spark, tmp_path):
    assert Q["tile_none"](spark, items(spark, tmp_path)).count() == 340


def test_containment_with_shared_ids(spark):
    rows = [(1, 1, 0, 100), (2, 1, 10, 20), (2, 1, 30, 40), (2, 2, 0, 5), (3, 1, 0, 100)]
    got = J.contained(spark.createDataFrame(rows, "id long, ref long, a long, b long"), "ref", "a", "b", "id")
    assert sorted((r.id, r.container) for r in got.select("id", "container").collect()) == [(2, 1), (3, 1)]


def test_cutoff_counts_make_no_hits(spark):
    """The counts are those of the hits themselves, also where reads share a name, and no join makes a row for each hit."""
    r = random.Random(7)
    seq = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    common = "ACGTACG" * 9
    reads = spark.createDataFrame([(i % 5, seq(80) + common[: 7 * i] + seq(30)) for i in range(7)] + [(9, "AC"), (10, common)], "name long, seq string")
    frags = spark.createDataFrame([(i, seq(60) + common) for i in range(20)], "name long, seq string")
    hits = kmers.frequency_cutoff(kmers.seed_join(reads, frags, 7), 0.9)
    want = hits.groupBy("read").agg(F.countDistinct("r_off").alias("kept"), F.count("*").alias("hits")).collect()
    got = kmers.cutoff_counts(reads, frags, 7, 0.9)
    assert got.collect() and sorted(map(tuple, got.collect())) == sorted(map(tuple, want))
