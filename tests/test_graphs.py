import random

from pyspark.sql import functions as F

from helixframe import catalog
from helixframe.functions import sequence as S
from helixframe.operators import editing as E
from helixframe.operators import joining, merging
from helixframe.operators import scaffold as G
from helixframe.operators.components import connected_components


def test_path_overlap_table(spark):
    rows = [("1F_2R_3F_4R", "4R_5F_6R", 1), ("1F_2R_7F_1F_2R", "1F_2R_3F_4R", 2), ("1F_2R_7F_1F_2R", "2R", 0), ("", "", 0), ("1F", "1F", 0), ("1F_2F", "2F_1F", 1), ("bad", "1F_2F", 0)]
    got = spark.createDataFrame(rows, "a string, b string, m int").select("m", S.path_overlap(S.parse_path("a"), S.parse_path("b")).alias("n")).collect()
    assert [r.m for r in got] == [r.n for r in got]


def test_stitch_and_lengths(spark):
    df = spark.createDataFrame([(["ACGTA", "CGTAGG", "TAGGC"], [5, 6, 5]), (["AC"], [2]), ([], [])], "s array<string>, n array<int>")
    assert [tuple(r) for r in df.select(S.stitch("s", 5), S.path_length("n", 5)).collect()] == [("ACGTAGGC", 8), ("AC", 2), ("", 0)]
    odd = spark.createDataFrame([("acGTNx",)], "s string").select(S.reverse_complement("s"), S.strict_reverse_complement("s")).first()
    assert tuple(odd) == ("xNACgt", "NNACGT")


def test_components_against_union_find(spark):
    import random

    rng = random.Random(3)
    for edges in ([(i, i + 1) for i in range(99) if i % 15 != 14], [(rng.randrange(300), rng.randrange(300)) for _ in range(200)], [(0, i) for i in range(1, 200)], []):
        top = {}

        def find(x, top=top):
            while top.setdefault(x, x) != x:
                x = top[x]
            return x

        for a, b in edges:
            if a != b:
                x, y = sorted((find(a), find(b)))
                top[y] = x
        want = {x: find(x) for x in top}
        got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
        assert got == want


def test_walk_removes_tips_and_bubbles():
    long = {c: 20_000 for c in "ABCDE"} | {"tip": 500, "b1": 900, "b2": 800}
    links = [(("A", "3"), ("B", "5"), 10), (("A", "3"), ("tip", "5"), 1), (("B", "3"), ("b1", "5"), 2), (("B", "3"), ("b2", "5"), 2), (("b1", "3"), ("C", "3"), 3), (("b2", "3"), ("C", "3"), 3), (("D", "3"), ("E", "5"), 4), (("E", "3"), ("D", "5"), 5)]
    assert G.resolve(long, links) == [[("A", "F", 10), ("B", "F", 2), ("b1", "F", 3), ("C", "R", 0)], [("D", "F", 4), ("E", "F", 0)]]
    assert len(G.resolve(long, links, simplify=False)) == 7


def test_walk_frame_and_sequences(spark):
    contigs = spark.createDataFrame([("a", 20_000, "AAC"), ("b", 20_000, "GGT"), ("c", 20_000, "T")], "name string, len long, seq string")
    links = spark.createDataFrame([("a", "F", "b", "R", 2)], "ctg1 string, dir1 string, ctg2 string, dir2 string, gap long")
    paths = G.walk_graph(contigs, links)
    assert sorted(map(tuple, paths.collect())) == [("a", 0, "a", "F", 2), ("a", 1, "b", "R", 0), ("c", 0, "c", "F", 0)]
    assert sorted(map(tuple, G.path_sequences(paths, contigs).collect())) == [("a", "AACNNACC"), ("c", "T")]
    bridge = spark.createDataFrame([("a", "F", "b", "R", "c", "R", 1, -1)], "ctg1 string, dir1 string, ctg2 string, dir2 string, repeat string, rdir string, gap1 long, gap2 long")
    with_c = G.insert_repeats(paths, bridge)
    assert [(r.ctg, r.gap) for r in with_c.where("path = 'a'").orderBy("i").collect()] == [("a", 1), ("c", -1), ("b", 0)]
    patch = spark.createDataFrame([("a", "F", "b", "R", "tt")], "ctg string, dir string, ctg2 string, dir2 string, fill string")
    assert dict(map(tuple, G.path_sequences(paths, contigs, patch).collect()))["a"] == "AACttACC"
    pieces = spark.createDataFrame([("w", 0, "p0", 1, 10), ("w", 1, "p1", 11, 5), ("w", 2, "p2", 20, 5)], "whole string, i int, name string, start long, len long")
    assert [(r.ctg1, r.gap) for r in G.piece_links(pieces).orderBy("ctg1").collect()] == [("p0", 0), ("p1", 4)]


def test_trees():
    edges = [("a", "b", 5.0), ("b", "c", 4.0), ("a", "c", 1.0), ("b", "x", 2.0), ("c", "d", 3.0)]
    tree = G.spanning_tree(edges, {})
    assert sum(s for *_, s in tree) == 14 and len(tree) == 4
    path = G.trunk(tree)
    assert path in (["a", "b", "c", "d"], ["d", "c", "b", "a"], ["x", "b", "c", "d"], ["d", "c", "b", "x"])
    placed = dict(G.place_branches(path, tree, edges))
    assert len(placed) == 5 and sum(v % 1 == 0.5 for v in placed.values()) == 1
    assert G.spanning_tree([("a1", "b1", 1.0)], {"a1": "a2"})[0] == ("a1", "a2", 1000.0)


def test_fill_by_search(spark):
    edges = spark.createDataFrame([("s", "m", 5), ("m", "t", 5), ("s", "x", 5), ("x", "y", 50), ("p", "q", 1), ("p", "r", 1), ("q", "z", 1), ("r", "z", 1)], "src string, dst string, add long")
    gaps = spark.createDataFrame([(1, "s", "t", 10), (2, "p", "z", 10), (3, "s", "t", 3)], "id int, src string, dst string, gap long")
    assert [(r.id, r.path) for r in G.fill_by_search(gaps, edges, 3).collect()] == [(1, ["s", "m", "t"])]


def brute_gap_paths(gaps, edges, width=10):
    """Answers level by level, without a limit on links."""
    near = {}
    for a, b, add in edges:
        near.setdefault(a, []).append((b, add))
    out = {}
    for id, src, dst, gap in gaps:
        front, found = [([src], 0)], []
        while front:
            front = [([*p, b], n + add) for p, n in front for b, add in near.get(p[-1], ()) if n + add <= 2 * gap]
            if len(front) > width:
                found = []
                break
            found += [p for p, _ in front if p[-1] == dst]
            front = [(p, n) for p, n in front if p[-1] != dst]
        if len(found) == 1:
            out[id] = found[0]
    return out


def test_fill_by_search_has_no_limit_on_links(spark):
    chain = [(f"c{i}", f"c{i + 1}", 2) for i in range(12)]
    second = [("s", "t", 1), ("s", "l0", 1), *((f"l{i}", f"l{i + 1}", 1) for i in range(9)), ("l9", "t", 1)]
    ring = [("r", "r", 1)]
    crowd = [("k", "z", 1), *(("k", f"k{i}", 1) for i in range(2)), *((f"k{i}", f"k{i}_{j}", 1) for i in range(2) for j in range(7))]
    edges = [*chain, *second, *ring, *crowd]
    gaps = [(1, "c0", "c12", 12), (2, "c0", "c12", 11), (3, "s", "t", 10), (4, "s", "t", 5), (5, "r", "q", 15), (6, "k", "z", 10)]
    want = brute_gap_paths(gaps, edges)
    assert len(want[1]) == 13 and set(want) == {1, 4}
    frames = spark.createDataFrame(gaps, "id int, src string, dst string, gap long"), spark.createDataFrame(edges, "src string, dst string, add long")
    assert {r.id: r.path for r in G.fill_by_search(*frames).collect()} == want


def test_gap_paths_against_brute_force(spark):
    data = "/root/testdata/sf0.01"
    part, supplier = (spark.read.parquet(f"{data}/{t}.parquet").collect() for t in ("part", "supplier"))
    edges = [(str(r.p_partkey), str((r.p_partkey * 3 + r.p_size) % 200), r.p_size + 1) for r in part]
    gaps = [(r.s_suppkey, str(r.s_suppkey), str(r.s_nationkey * 7), 60) for r in supplier]
    want = {i: "_".join(p) for i, p in brute_gap_paths(gaps, edges).items()}
    assert {r.id: r.path for r in catalog.queries()["gap_paths"](spark, data).collect()} == want


def test_merge_pairs(spark):
    flip = lambda x: x.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    a, b = "A" * 2000 + "C" * 700, "C" * 700 + "G" * 2000
    both = "A" * 2000 + "C" * 700 + "G" * 2000

    def merged(x, y, spans):
        df = spark.createDataFrame([(x, y, *spans)], "x string, y string, a1 int, a2 int, b1 int, b2 int")
        return df.select(G.merged_pair(*(F.col(c) for c in df.columns)).alias("s")).first().s

    assert merged(a, b, (2001, 2700, 1, 700)) == merged(a, flip(b), (2001, 2700, 2700, 2001)) == merged(b, a, (1, 700, 2001, 2700)) == both
    assert merged(a, "C" * 700, (2001, 2700, 1, 700)) == a == merged("C" * 700, a, (1, 700, 2001, 2700))
    assert merged("A" * 900 + "C" * 9 + "A" * 900, "G" * 900 + "C" * 9 + "G" * 900, (901, 909, 901, 909)) is None


def test_disjoint_pairs_are_the_greedy_ones(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(30), rng.randrange(30)) for i in range(60)]
    used, want = set(), []
    for i, a, b in rows:
        if a != b and not {a, b} & used:
            used |= {a, b}
            want.append((i, a, b))
    got = G.disjoint_pairs(spark.createDataFrame(rows, "i int, a int, b int"), "a", "b", "i")
    assert sorted(map(tuple, got.collect())) == want
    assert G.disjoint_pairs(got.limit(0), "a", "b", "i").count() == 0


def test_node_windows(spark):
    """Against counting bases one by one."""
    rng = random.Random(6)
    contigs, excluded, want = [], [], {}
    for n in range(60):
        size = rng.randrange(60, 400)
        spans = [(a, a + rng.randrange(0, 40)) for a in (rng.randrange(1, size) for _ in range(rng.randrange(0, 6)))]
        contigs.append((n, size))
        excluded += [(n, a, min(b, size)) for a, b in spans]
        bad = [any(a <= p <= b for a, b in spans) for p in range(1, size + 1)]

        def window(flags):
            usable = skipped = p = 0
            while p < len(flags) and usable < 100:
                skip = flags[p] and skipped < 50
                skipped, usable, p = skipped + skip, usable + (not skip), p + 1
            return p

        want[n] = (window(bad), window(bad[::-1]))
    got = G.node_windows(spark.createDataFrame(contigs, "name int, len int"), spark.createDataFrame(excluded, "name int, start int, stop int"), 100, 50)
    assert {r.name: (r.left, r.right) for r in got.collect()} == want



def test_edits(spark):
    seqs = spark.createDataFrame([("s", "ACGTACGT"), ("t", "AAAA"), ("u", "")], "name string, seq string")
    edits = spark.createDataFrame([("s", 1, "A", "TT"), ("s", 3, "GT", ""), ("s", 4, "TA", "x"), ("s", 8, "T", "G"), ("s", 7, "C", "no"), ("s", 99, "A", "C"), ("t", 4, "A", "ACC")], "name string, pos int, ref string, alt string")
    got = {r.name: tuple(r)[1:] for r in E.apply_edits(seqs, edits).collect()}
    assert got == {"s": ("TTCGxCGG", 3, 3), "t": ("AAAACC", 1, 0), "u": ("", 0, 0)}
    segs = spark.createDataFrame([("s", 2, 3, "gggg"), ("s", 3, 5, "z"), ("s", 7, 8, "")], "name string, start int, stop int, new string")
    assert {r.name: r.seq for r in E.replace_segments(seqs, segs).collect()}["s"] == "AggggTAC"
    cut = spark.createDataFrame([("s", 3), ("s", 0), ("s", 8), ("t", 2)], "name string, pos int")
    assert sorted(map(tuple, E.break_at(seqs, cut).where("name <> 'u'").collect())) == [("s", 0, 1, "ACG"), ("s", 1, 4, "TACGT"), ("t", 0, 1, "AA"), ("t", 1, 3, "AA")]
    veto = spark.createDataFrame([("n", "AAAANAAAAAAAAAAAA")], "name string, seq string")
    at = spark.createDataFrame([("n", 6), ("n", 13)], "name string, pos int")
    assert [r.start for r in E.break_at(veto, at, 3).orderBy("part").collect()] == [1, 14]
    some = E.random_edits(seqs, 0.9)
    assert some.where("ref = alt").count() == 0 and sorted(map(tuple, some.collect())) == sorted(map(tuple, E.random_edits(seqs, 0.9).collect())) and some.count() > 5
    pieces = spark.createDataFrame([("w", 2, 0, "AC"), ("w", 1, 1, "GG")], "name string, i int, at int, seq string")
    assert E.recovered(pieces, 3).first().seq == "GGNNNAC" or E.recovered(pieces, 3).first().seq == "CCNNNGT"
    runs = spark.createDataFrame([("r", "NNACNNNGNN")], "name string, seq string")
    assert [(r.start, r.stop) for r in E.unknown_runs(runs).orderBy("start").collect()] == [(1, 2), (5, 7), (9, 10)]
    assert [(r.start, r.piece) for r in E.split_scaffolds(runs).orderBy("start").collect()] == [(3, "AC"), (8, "G")]
    used = runs.select(F.lit("r").alias("ctg"))
    assert E.with_unused(runs, used, runs.union(seqs), 3).count() == 3


def test_joining():
    read = "".join("ACGT"[(i * i + i // 7) % 4] for i in range(3000))
    p = lambda a, b, n="m": {"name": n, "start": a, "stop": b, "seq": read[a - 1 : b]}
    assert joining.join_pieces(read, [p(1, 1000), p(901, 2000), p(1200, 1300)], least=1) == [read[:2000]]
    yes, no = (lambda a, b: 1), (lambda a, b: 0)
    assert joining.join_pieces(read, [p(1, 900), p(1001, 2000, "q")], yes) == [read[:900] + read[900:1000].lower() + read[1000:2000]]
    assert joining.join_pieces(read, [p(1, 900), p(1001, 2000, "q")], no) == [read[:900], read[1000:2000]]
    assert joining.join_pieces(read, [p(1, 900), p(1701, 2500, "q")], lambda a, b: -1) == [read[:900], read[1700:2500]]
    assert joining.join_pieces(read, [p(1, 900), p(1001, 2000, "q")], fill="fixed") == [read[:900] + "N" * 100 + read[1000:2000]]
    assert joining.join_pieces(read, [p(1, 900), p(911, 2000, "q")], fill="n") == [read[:900] + "N" * 10 + read[910:2000]]
    assert joining.join_pieces(read, [p(1, 300), p(400, 600)]) == [] == joining.join_pieces(read, [])
    assert joining.correct_read("aaaaaaaaaa", [(2, 4, "CCC"), (7, 9, "GG")], 4) == "aCCCaaGGa"
    assert joining.correct_read("aaaaaaaaaa", [(2, 6, "CCGGT"), (4, 9, "GGTACC")], 4) == "aCCGGTACCa"


def test_joined_reads(spark):
    reads = spark.createDataFrame([(1, "ACGT" * 400), (2, "A")], "name long, seq string")
    pieces = spark.createDataFrame([(1, "m", 1, 700, ("ACGT" * 400)[:700]), (1, "q", 801, 1600, ("ACGT" * 400)[800:1600])], "read long, name string, start int, stop int, seq string")
    v = spark.createDataFrame([(1, "q", "m", 1)], "read long, a string, b string, verdict int")
    assert [len(r.seq) for r in joining.join_reads(reads, pieces, v).collect()] == [1600]
    assert [len(r.seq) for r in joining.join_reads(reads, pieces).orderBy("part").collect()] == [700, 800]
    placed = spark.createDataFrame([(1, 1, 4, "TTTT")], "name long, start int, stop int, unitig string")
    assert {r.name: r.seq[:5] for r in joining.correct_reads(reads, placed, 5).collect()} == {1: "TTTTA", 2: "A"}


def test_unsafe_regions_and_consensus(spark):
    # Two covered stretches with a gap between; only matches whose implied spans reach over it make it unsafe.
    assert merging.unsafe_regions([(1, 500, 0, 500), (700, 1000, 650, 1000)]) == []
    assert merging.unsafe_regions([(1, 500, 0, 900), (700, 1000, 300, 1000)]) == [(500, 700)]
    rows = [(1, 2, 1, 100, 5)] + [(1, 3, 1, 100, 5), (1, 3, 2, 450, 5)] + [(1, 4, i, g, o) for i, (g, o) in enumerate([(1000, 1), (1100, 2), (950, 900), (9000, 3)])]
    got = {(r.u2, r.id): r.verdict for r in merging.gap_consensus(spark.createDataFrame(rows, "u1 long, u2 long, id long, gap long, over long")).collect()}
    assert got == {(2, 1): -1, (3, 1): 1, (3, 2): 1, (4, 0): 1, (4, 1): 1, (4, 2): 0, (4, 3): 0}
