import numpy as np
import pytest

from helixframe.llm import ann, itq
from helixframe.llm import queries as llm

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(seed=3, n=900, d=64):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        rows.append((i, rng.standard_normal(d), i % 3))
    base = rng.standard_normal((6, d))
    for k in range(6):  # groups with cosines from about .9 to .99
        for j in range(60 if k == 0 else 12):
            rows.append((n + len(rows), base[k] + rng.standard_normal(d) * (0.12 + 0.05 * k), k % 3))
    rows = [(i, [float(x) for x in np.float32(v)], l) for i, v, l in rows]
    rows += [(5000, rows[0][1], 0), (5001, None, 0), (5002, [0.0] * d, 1), (5003, [float("nan")] + [1.0] * (d - 1), 1), (5004, [None] + [1.0] * (d - 1), 1), (5005, [float("inf")] * d, 2)]
    rows += [(5006, rows[0][1], None), (5007, [1.0, 2.0, 3.0], 1), (5008, [1.0, 2.0, 3.1], 1), (5009, [], 1), rows[7]]
    return rows


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute_links(rows, least=0.93):
    seen = {i: (v, l) for i, v, l in rows}
    ids = sorted(seen)
    part = [i for i in ids if good(seen[i][0]) and seen[i][1] is not None]
    links = {i: set() for i in ids}
    for a in part:
        for b in part:
            if a < b and seen[a][1] == seen[b][1] and len(seen[a][0]) == len(seen[b][0]):
                x, y = np.array(seen[a][0], float), np.array(seen[b][0], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                    links[a].add(b)
                    links[b].add(a)
    return links


@pytest.fixture(scope="module")
def found(spark):
    df = spark.createDataFrame([*table(), (None, [1.0] * 64, 1)], SCHEMA).withColumn("component_id", itq.F.lit("clash"))
    return itq.near_duplicates(df).collect()


def test_links_against_brute_force(found):
    want = brute_links(table())
    got = {r.vec_id: r for r in found}
    assert set(got) == {*want, None} and len(found) == len(got)
    total = sum(map(len, want.values()))
    assert total > 3000
    assert all(got[i].n_links <= len(want[i]) for i in want)
    assert sum(got[i].n_links for i in want) >= 0.99 * total
    for i, r in got.items():
        assert r.kept == (i is not None and i == r.component_id)


def planted(n, d=64, seed=9):
    """Vectors in all directions, near copies of some (cosines around the threshold), one dense group and one group of equal vectors."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    x[n // 2 : n // 2 + n // 8] = x[: n // 8] + rng.standard_normal((n // 8, d)) * np.linspace(0.05, 0.45, n // 8)[:, None]
    x[-n // 6 : -n // 12] = x[0] + rng.standard_normal((n // 6 - n // 12, d)) * 0.15
    x[-n // 12 :] = x[1]
    return x, np.arange(n) % 2


def truth(x, labels, least=0.93):
    u, n = x / np.linalg.norm(x, axis=1, keepdims=True), len(x)
    counts, edges = np.zeros(n, int), []
    for a in range(0, n, 2000):
        near = (u[a : a + 2000] @ u.T >= least) & (labels[a : a + 2000, None] == labels)
        near[np.arange(len(near)), np.arange(a, a + len(near))] = False
        counts[a : a + len(near)] = near.sum(1)
        edges.append(np.minimum(np.where(near.any(1), near.argmax(1), n), np.arange(a, a + len(near))))
    return counts, np.concatenate(edges)


@pytest.mark.parametrize("group", [64, itq.GROUP])
def test_planted_links_at_scale(spark, group):
    """Recall on planted links; small neighbourhoods make many tasks share the dense and the equal group."""
    n = 3000 if group == 64 else 20_000
    x, labels = planted(n)
    pdf = spark.createDataFrame([(i, v.tolist(), int(l)) for i, (v, l) in enumerate(zip(x, labels))], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in itq.near_duplicates(pdf, group=group).collect()}
    want, _ = truth(x, labels)
    mine = np.array([got[i].n_links for i in range(n)])
    assert (mine <= want).all() and mine.sum() >= 0.99 * want.sum()
    pairs = np.arange(n // 2, n // 2 + n // 8)
    assert mine[pairs].sum() >= 0.95 * want[pairs].sum() > 0
    assert len({got[i].component_id for i in range(n - n // 12, n)}) == 2


def test_longer_segments_find_the_same(spark):
    """The setting for very many vectors, on few."""
    x, labels = planted(2000)
    df = spark.createDataFrame([(i, v.tolist(), int(l)) for i, (v, l) in enumerate(zip(x, labels))], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in itq.near_duplicates(df, segments=3, ball=3).collect()}
    want, _ = truth(x, labels)
    assert all(got[i] <= want[i] for i in got) and sum(got.values()) >= 0.98 * want.sum()


def test_registered_links_over_a_whole_table(spark):
    """The query's columns on the driver's vectors, which have no links, and on the same with planted ones."""
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = llm.op3_embedding_dedup(spark, "/root/testdata/sf0.01")
    assert got.columns[:4] == ["vec_id", "n_links", "component_id", "kept"] and got.count() == rows.select("vec_id").distinct().count()
    want = {i: len(x) for i, x in brute_links([(r.vec_id, r.embedding, r.label) for r in rows.collect()]).items()}
    assert {r.vec_id: r.n_links for r in got.collect()} == want


def test_nothing_to_link(spark):
    df = spark.createDataFrame([(1, None, 1), (2, [0.0], 1)], SCHEMA)
    assert [(r.vec_id, r.n_links, r.component_id) for r in itq.near_duplicates(df).orderBy("vec_id").collect()] == [(1, 0, 1), (2, 0, 2)]
    assert itq.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_nearest_against_brute_force(spark):
    rows = [r for r in table(seed=4) if r[0] != 5006]
    df = spark.createDataFrame([*rows, (None, [1.0] * 64, 1)], SCHEMA)
    got = ann.nearest(df, ann.F.col("vec_id") % 20 == 0, block_rows=300, query_rows=30).collect()
    seen = {i: v for i, v, _ in rows if good(v)}
    hits = total = 0
    for q in (i for i in seen if i % 20 == 0):
        pairs = sorted((-float((np.array(v) * np.array(seen[q])).sum()), i) for i, v in seen.items() if i != q and len(v) == len(seen[q]))[:20]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r[0] for r in mine] == list(range(1, len(pairs) + 1))
        assert all(abs(s - float(np.dot(np.array(seen[i]), np.array(seen[q])))) < 1e-9 for _, i, s in mine)
        hits += len({i for _, i in pairs} & {r[1] for r in mine})
        total += len(pairs)
    assert hits >= 0.92 * total > 0


def recall_and_share(x, queries, k=20):
    top2 = float((x * x).sum(1).max())
    index, ids = ann.BlockIndex(np.arange(len(x)), x, ann.project(x, top2, 16, 11)), np.arange(len(x))
    at, hits = ann.project(x[queries], top2, 16, 11, lifted=False), 0
    for q, a in zip(queries, at):
        got, _ = index.search(q, x[q], a, top2, k, ann.stop_ratio(16, 0.92))
        s = np.where(ids == q, -np.inf, x @ x[q])
        hits += len(set(got) & set(np.argsort(-s, kind="stable")[:k]))
    return hits / k / len(queries), index.verified / len(queries) / len(x)


def test_stopping_test_saves_work():
    """On clustered vectors few are verified; on directionless ones (no index helps there) still not all, and recall holds on both."""
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((200, 64))
    clustered = centres[rng.integers(0, 200, 16_000)] + rng.standard_normal((16_000, 64)) * 0.25
    recall, share = recall_and_share(clustered, np.arange(0, 16_000, 160))
    assert recall >= 0.95 and share <= 0.15
    even = rng.standard_normal((10_000, 64))
    recall, share = recall_and_share(even / np.linalg.norm(even, axis=1, keepdims=True), np.arange(0, 10_000, 100))
    assert recall >= 0.92 and share <= 0.7


def test_registered_search_over_a_whole_table(spark):
    """The query's own rows against brute force: complete ranks, exact scores, and recall."""
    rows = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect() if good(r.embedding)}
    got = llm.op8_nearest_neighbours(spark, "/root/testdata/sf0.1").collect()
    ids = np.array(sorted(rows))
    x = np.stack([rows[i] for i in ids])
    hits, queries = 0, [i for i in rows if i % 20 == 0]
    assert len(got) == 20 * len(queries)
    for q in queries:
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r[0] for r in mine] == list(range(1, 21)) and all(abs(s - rows[q] @ rows[i]) < 1e-12 for _, i, s in mine)
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        s = np.where(ids == q, -np.inf, x @ rows[q])
        hits += len(set(ids[np.argsort(-s, kind="stable")[:20]]) & {i for _, i, _ in mine})
    assert hits >= 0.9 * 20 * len(queries)


def test_many_cells_and_columns_with_the_results_names(spark):
    """Cells, blocks within a hot cell, and groups of queries; norms of many sizes; copies of one vector."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((1500, 16)) * rng.lognormal(0, 1, 1500)[:, None]
    x[500:900] = x[500]
    df = spark.createDataFrame([(i, [float(y) for y in v], 0, 1, 2.0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, rank int, score int, query_id double")
    got = ann.nearest(df, ann.F.col("vec_id") % 10 == 0, k=5, block_rows=100, query_rows=7).collect()
    hits = 0
    for q in range(0, 1500, 10):
        s = np.where(np.arange(1500) == q, -np.inf, (x * x[q]).sum(1))
        mine = sorted((r.rank, r.vec_id) for r in got if r.query_id == q)
        assert len(mine) == 5
        hits += len({i for _, i in mine} & set(np.lexsort((np.arange(1500), -s))[:5]))
    assert hits >= 0.9 * 5 * 150


def test_nearest_ties_and_empty(spark):
    v = [1.0, 0.5]
    df = spark.createDataFrame([(i, v, 0) for i in (0, 3, 1, 2, 2)], SCHEMA)
    got = ann.nearest(df, ann.F.col("vec_id") == 0, k=2).collect()
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(1, 1), (2, 2)]
    assert ann.nearest(spark.createDataFrame([], SCHEMA), ann.F.col("vec_id") == 0).count() == 0


def test_chi_square():
    assert abs(float(ann.chi_square_cdf(7.344121497701792, 8)) - 0.5) < 1e-9
