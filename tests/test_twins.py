"""Queries that SQL cannot express, against plain brute-force versions on the tables of sf0.001."""

from collections import defaultdict
from itertools import pairwise

import pytest

from helixframe import catalog
from helixframe.operators import kmers, megareads
from helixframe.operators import links as L
from helixframe.plans import kernel_queries as KQ
from helixframe.plans import relations as R
from helixframe.plans import sequence_queries as SQ
from tests.compare import DATA

SF = f"{DATA}/sf0.001"
Q = catalog.queries()


def rows(df):
    return sorted(map(tuple, df.collect()))


def longest_chain(hits):
    """Over every predecessor: q grows, and each step stretches by at most 10 + 1.3 either way; so does the whole by 1.3."""
    best = []
    for i, (p, q) in enumerate(hits):
        before = [j for j in range(i) if hits[j][1] < q and max(p - hits[j][0], q - hits[j][1]) <= 10_000 and p - hits[j][0] <= 10 + 1.3 * (q - hits[j][1]) and q - hits[j][1] <= 10 + 1.3 * (p - hits[j][0])]
        best.append(max((best[j] + [i] for j in before), key=lambda c: (len(c), -c[-2]), default=[i]))
    ok = [c for c in best if (dp := hits[c[-1]][0] - hits[c[0]][0]) <= 1.3 * (dq := hits[c[-1]][1] - hits[c[0]][1]) and dq <= 1.3 * dp]
    return max(ok, key=lambda c: (len(c), -c[-1]), default=[])


def chains_of(hits, repeat):
    hits, out = sorted(hits), []
    while hits and len(c := longest_chain(hits)) >= 2:
        out.append([hits[i] for i in c])
        if not repeat:
            break
        hits = [h for i, h in enumerate(hits) if i not in set(c)]
    return out


def chained(hits, repeat):
    by = defaultdict(list)
    for read, frag, p, q in hits:
        by[read, frag].append((p, q))
    for key, own in by.items():
        sides = [chains_of([h for h in own if (h[1] > 0) == fwd], repeat) for fwd in (True, False)]
        size = [max(map(len, s), default=0) for s in sides]
        yield key, sides[0] if size[0] >= size[1] else sides[1]


def test_chained_hits(spark):
    hits = rows(kmers.seed_join(R.reads(spark, SF), R.fragments(spark, SF), KQ.K, both_strands=True))
    want = sorted((*key, n, *h) for key, found in chained(hits, True) for n, c in enumerate(found) for h in c)
    assert want and rows(Q["chained_hits"](spark, SF)) == want


@pytest.fixture(scope="module")
def paths(spark):
    """name -> (path, lengths, q_len) of the super-reads, and chains of (read, name)."""
    _, table = KQ.super_reads(spark, SF)
    known = {r.name: (r.path, list(r.lens), len(r.seq)) for r in table.collect()}
    hits = rows(kmers.seed_join(R.reads(spark, SF), table.select("name", "seq"), KQ.K))
    return known, {key: found[0] for key, found in chained(hits, False) if found}


def counts(chain, lengths):
    """Per unitig and overlap, the seeds that lie inside and the bases that any seed covers, base by base."""
    spans, end = [], 0
    for i, n in enumerate(lengths):
        first = 1 if not i else end - KQ.UNITIG_K + 2
        spans += [set(range(first, end + 1))] if i else []
        end = first + n - 1
        spans.append(set(range(first, end + 1)))
    seeds = [set(range(q, q + KQ.K)) for _, q in chain]
    return [sum(s <= x for s in seeds) for x in spans], [len(set().union(*seeds) & x) for x in spans]


def test_unitig_seed_counts(spark, paths):
    known, found = paths
    want = []
    for (read, name), c in found.items():
        path, lengths, _ = known[name]
        want.append((read, path, min(p for p, _ in c), max(p for p, _ in c) + KQ.K - 1, *counts(c, lengths)))
    assert want and rows(Q["unitig_seed_counts"](spark, SF)) == sorted(want)


@pytest.mark.parametrize("name", ["mega_read_assembly", "trimmed_mega_reads"])
def test_mega_reads(spark, name):
    """The best walk of every component among all walks of the overlap graph, found by trying every pair and every walk."""
    unitigs, _ = KQ.super_reads(spark, SF)
    lengths = {str(r.uid): r.len for r in unitigs.collect()}
    al = KQ.aligned_paths(spark, SF).collect()
    by = defaultdict(list)
    for r in al:
        by[r.read].append(megareads.Node(r.path.split("_"), r.stretch + r.offset, r.stretch * r.q_len + r.offset, r.r_start, r.r_end, r.q_start, r.q_end, r.q_len, r.avg_err, r.q_cover, list(r.i.bases)))
    read_len = {r.read: r.read_len for r in al}
    want = []
    for read, nodes in by.items():
        nodes.sort(key=lambda n: (n.imp_s, n.imp_e, n.path))
        into = defaultdict(list)
        for i, x in enumerate(nodes):
            for j in range(i + 1, len(nodes)):
                y = nodes[j]
                if x.imp_e >= read_len[read] or y.imp_s <= 1 or x.imp_e > y.imp_e + KQ.UNITIG_K:
                    continue
                room, slip = x.imp_e - y.imp_s, 3 * (x.err + y.err)
                if room * 1.3 + slip < KQ.UNITIG_K:
                    break
                m = 0 if x.path == y.path else max((m for m in range(1, min(len(x.path), len(y.path))) if x.path[-m:] == y.path[:m]), default=0)
                bases = sum(lengths[u[:-1]] for u in y.path[:m]) - (m - 1) * (KQ.UNITIG_K - 1)
                if m and bases <= 1.3 * room + slip and room <= 1.3 * (bases + slip):
                    into[j].append((i, m, sum(y.info[0 : 2 * m : 2]) - sum(y.info[1 : 2 * m - 1 : 2])))

        def walks(j):
            yield nodes[j].score, (j,), tuple(nodes[j].path)
            for i, m, common in into[j]:
                for s, w, p in walks(i):
                    yield s + nodes[j].score - common, (*w, j), p + tuple(nodes[j].path[m:])

        group = list(range(len(nodes)))
        for j, edges in into.items():
            for i, *_ in edges:
                group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
        inner, best = {i for e in into.values() for i, *_ in e}, {}
        for j in range(len(nodes)):
            s, w, p = max(walks(j), key=lambda z: (z[0], len(z[1]) > 1, nodes[z[1][0]].imp_s))
            a, b = nodes[w[0]].r_start, nodes[j].r_end
            dense = s / (min(read_len[read] + 0.5, b) - max(0.5, a))
            if j not in inner and dense >= 0.029 and b - a >= 60:
                best[group[j]] = max(best.get(group[j], (0,)), (s, dense, -j, a, b, w, p))
        chosen, covered = [], set()
        for s, dense, j, a, b, w, p in sorted(best.values(), key=lambda z: -z[0]):
            own = set(range(a, b))
            runs = [len(list(r)) for r in _runs(sorted(covered & own))]
            if not any(r >= max(KQ.UNITIG_K * 1.3, (b - a) * 0.4) for r in runs) and not any(x <= a and b <= y for x, y, *_ in chosen):
                chosen.append((a, b, s, dense, p, nodes[w[0]], nodes[-j]))
                covered |= own
        for a, b, s, dense, p, first, last in chosen:
            if name == "trimmed_mega_reads":
                p = megareads.trim(first, last, list(p), lengths, KQ.UNITIG_K)[0]
            want.append((read, a, b, s, round(dense, 9), "_".join(p)))
    got = [(r.read, r.r_start, r.r_end, r.score, round(r.density, 9), r.path) for r in Q[name](spark, SF).collect()]
    assert want and sorted(got) == sorted(want)


def _runs(values):
    run = []
    for v in values:
        if run and v != run[-1] + 1:
            yield run
            run = []
        run.append(v)
    if run:
        yield run


def test_coverage_gap_regions(spark):
    """Base by base: what no match covers deeply enough, and whether matches on both sides claim to reach over it."""
    by = defaultdict(list)
    for m in R.matches(spark, SF).collect():
        a, b = min(m.qs, m.qe), max(m.qs, m.qe)
        left, right = (m.rs - 1, m.rlen - m.re) if m.qs < m.qe else (m.rlen - m.re, m.rs - 1)
        by[m.qry].append((a, b, max(0, a - left), min(m.qlen, b + right)))
    want = []
    for qry, spans in by.items():
        spans = sorted(x for x in spans if x[1] - x[0] >= 29)
        gaps = []
        for n, (a, *_) in enumerate(spans):
            far = max((b for _, b, *_ in spans[:n]), default=0)
            if far > 0 and a > far - 70 and (min(a, far), max(a, far)) not in gaps[-1:]:
                gaps.append((min(a, far), max(a, far)))
        bad = []
        for x, y in gaps:
            reach = [(a, b) for a, b, ia, ib in spans if ib - ia > 200 and ia <= x - 100 and ib >= y + 100]
            if any(a < x for a, b in reach) and any(b > y for a, b in reach):
                bad.append((x, y))
        merged = []
        for x, y in bad:
            if merged and x <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(merged[-1][1], y))
            else:
                merged.append((x, y))
        want += [(qry, *z) for z in merged]
    assert want and rows(Q["coverage_gap_regions"](spark, SF)) == sorted(want)


def test_scaffold_walk(spark):
    """Each contig once; neighbours are linked, at ends that nothing else uses; paths cannot be prolonged or joined."""
    contigs, links = SQ._scaffold_inputs(spark, SF)
    linked = {}
    for r in links.collect():
        a, b = (str(r.ctg1), "3" if r.dir1 == "F" else "5"), (str(r.ctg2), "5" if r.dir2 == "F" else "3")
        if a != b and a[0] != b[0]:
            linked[frozenset((a, b))] = min(r.gap, linked.get(frozenset((a, b)), r.gap))
    by = defaultdict(list)
    for r in Q["scaffold_walk"](spark, SF).orderBy("path", "i").collect():
        by[r.path].append(r)
    used = [r.ctg for p in by.values() for r in p]
    assert len(used) == len(set(used)) and set(used) <= {r.name for r in contigs.collect()}
    assert all(path == min(r.ctg for r in p) for path, p in by.items())
    for p in by.values():
        for x, y in pairwise(p):
            ends = frozenset(((x.ctg, "3" if x.dir == "F" else "5"), (y.ctg, "5" if y.dir == "F" else "3")))
            assert linked[ends] == x.gap
            others = [k for k in linked if k & ends and k != ends and {n for n, _ in k} <= set(used)]
            assert not others
    seqs = {r.name: r.n for r in Q["scaffold_path_sequences"](spark, SF).collect()}
    size = {r.name: (r.len // 500) * 5 for r in contigs.collect()}
    assert set(seqs) == set(by) and all(seqs[k] == sum(size[r.ctg] - max(0, -(p[n - 1].gap if n else 0)) + (max(0, r.gap) if n < len(p) - 1 else 0) for n, r in enumerate(p)) for k, p in by.items())


def test_barcode_trees(spark):
    """Every component's tree has the weight of the greatest spanning tree (Kruskal), seen through its placed nodes and trunk."""
    edges = L.reciprocal(L.strong(L.scored(L.shared_groups(R.links(spark, SF))), -2.0), -3.0).collect()
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    near = defaultdict(set)
    for r in sorted(edges, key=lambda r: -r.score):
        a, b = str(r.a), str(r.b)
        if find(a) != find(b):
            top[find(a)] = find(b)
            near[a].add(b)
            near[b].add(a)
    got = defaultdict(list)
    for r in Q["barcode_trees"](spark, SF).collect():
        got[r.component].append(r)
    assert got and {frozenset(r.node for r in p) for p in got.values()} == {frozenset(x for x in top if find(x) == root) for root in map(find, top)}

    def far(root):
        seen = {root: 0}
        todo = [root]
        for x in todo:
            for y in near[x] - seen.keys():
                seen[y] = seen[x] + 1
                todo.append(y)
        return max(seen.values())

    for p in got.values():
        trunk = sorted((r for r in p if r.in_trunk), key=lambda r: r.position)
        assert len(trunk) == 1 + max(far(r.node) for r in p)
        assert all(y.node in near[x.node] for x, y in pairwise(trunk))
