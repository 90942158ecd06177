import random

import pytest

from helixframe.operators import chain, megareads, tiling


def brute_lis(v):
    best = [1] * len(v)
    for i in range(len(v)):
        best[i] += max((best[j] for j in range(i) if v[j] < v[i]), default=0)
    return max(best, default=0)


def test_increasing():
    rng = random.Random(1)
    assert chain.increasing([]) == [] and chain.increasing([3, 2, 1]) == [2] and chain.increasing(range(9)) == list(range(9))
    for _ in range(200):
        v = [rng.randrange(12) for _ in range(rng.randrange(15))]
        at = chain.increasing(v)
        assert len(at) == brute_lis(v) and all(v[a] < v[b] and a < b for a, b in zip(at, at[1:]))


#: The vectors of the next test and of test_unitig_counts are fixed values: chains and counts must come out like this.
HOW = {"a": 5, "b": 1, "cap": 1e9}


@pytest.mark.parametrize(
    ("v", "window", "want"),
    [
        ([(1, 1), (3, 3), (4, 2), (5, 5), (7, 7)], 1, [0, 1, 3, 4]),
        ([(1, 1), (2, 2), (3, 3), (10, 4)], 1, 3),
        ([(2, 2), (3, 3), (13, 4)], 2, 2),
        ([(2, 2), (3, 3), (13, 4), (14, 5)], 2, 4),
        ([(2, 2), (3, 3), (13, 4), (14, 5), (24, 6)], 2, 4),
        ([(1, 1), (2, 2), (3, 3), (14, 4), (16, 5)], 1, 3),
        ([], 1, 0),
    ],
)
def test_stretch_chain(v, window, want):
    how = HOW
    got = chain.stretch_chain([x for x, _ in v], [y for _, y in v], window=window, whole=5, **how)
    assert got == want if isinstance(want, list) else len(got) == want


def test_repeated_chains_are_disjoint():
    p, q = [*range(10), *range(100, 106)], [*range(10), *range(6)]
    found = chain.chains(p, q, True, lambda c: len(c) >= 3)
    assert [len(c) for c in found] == [10, 6] and not set(found[0]) & set(found[1])


def test_unitig_counts():
    count = lambda x, n: chain.unitig_counts(x, n, 31, 17)
    good = [100, 100, 100]
    assert count([70], good) == ([1, 0, 0, 0, 0], [17, 16, 16, 0, 0])
    assert count([70, 84], good) == ([2, 1, 1, 0, 0], [31, 30, 30, 0, 0])
    assert count([70, 84, 130, 150, 165], good) == ([2, 1, 3, 1, 2], [31, 30, 68, 27, 38])
    bad = [100, 100, None]
    assert count([20, 71, 85], bad) == ([2, 1, 2, 0, 0], [47, 30, 31, 0, 0])
    assert count([20, 71, 85, 142], bad) == ([], []) == count([1], [None, 5])
    many = [100, 31, 31, 40, 100]
    assert count([70], many) == ([1, 0, 0, 0, 0, 0, 0, 0, 0], [17, 16, 16, 15, 15, 14, 14, 4, 4])
    assert count([70, 71, 72, 73, 74, 82, 83, 84, 85, 86, 87, 96, 97, 166], many) == ([8, 7, 8, 7, 8, 7, 9, 6, 8], [31, 30, 31, 30, 31, 30, 40, 30, 48])
    assert count([166, 167], many) == ([], [])


def spans_of(rng, n, reach, shortest, longest):
    return [(float(a), float(a + rng.randrange(shortest, longest))) for a in (rng.randrange(reach) for _ in range(n))]


def test_greedy_tiling():
    rng = random.Random(7)
    for _ in range(60):
        spans = spans_of(rng, 60, 1000, 20, 200)
        scores = [b - a for a, b in spans]
        g = tiling.greedy(spans, scores, 10)
        assert len(set(g)) == len(g) and tiling.greedy(spans, scores, 10, at_most=3) == g[:3]
        # Every span left out is contained in a heavier chosen one, or overlaps what they cover by too much.
        for i in set(range(60)) - set(g):
            a, b = spans[i]
            before = sorted(spans[j] for j in g if (-scores[j], j) < (-scores[i], i))
            pieces = []
            for x, y in before:
                if pieces and x <= pieces[-1][1]:
                    pieces[-1][1] = max(y, pieces[-1][1])
                else:
                    pieces.append([x, y])
            limit = max(13.0, (b - a) * 0.4)
            assert any(x <= a and b <= y for x, y in before) or any(min(b, y) - max(a, x) >= limit for x, y in pieces)
    assert tiling.greedy([(0, 10), (2, 8), (20, 30)], [5, 9, 1], 1) == [1, 2]


def test_maximal_tiling_is_the_optimum():
    """Against every chain of spans that are longer than the slack: starts and ends grow, neighbours overlap by at most k play."""
    rng = random.Random(11)
    for _ in range(150):
        spans = spans_of(rng, 10, 200, 15, 60)
        scores = [rng.randrange(1, 30) for _ in spans]
        best = 0
        order = sorted(range(10), key=lambda i: spans[i][1])

        def chains(at, last, total):
            nonlocal best
            best = max(best, total)
            for n in range(at, 10):
                a, b = spans[order[n]]
                if last is None or (last[0] < a and last[1] <= a + 13):
                    chains(n + 1, (a, b), total + scores[order[n]])

        chains(0, None, 0)
        m = tiling.maximal(spans, scores, 10)
        assert sum(scores[i] for i in m) == best
        assert sum(scores[i] for i in tiling.greedy(spans, scores, 10, 1e9)) > 0
        for x, y in zip(m, m[1:]):
            assert spans[x][0] < spans[y][0] and spans[x][1] <= spans[y][0] + 13
    assert tiling.maximal([], [], 5) == [] == tiling.choose("none", [], [], 5)
    assert len(tiling.maximal([(i, i + 30.0) for i in range(0, 90_000, 30)], [1] * 3000, 5)) == 3000


def node(path, s, e=None, info=(50, 20, 50), q_len=80):
    path = path.split("_")
    return megareads.Node(path, s, s + q_len - 1 if e is None else e, s, s + q_len - 1, 1, q_len, q_len, 0.0, 80, list(info))


def test_mega_read_follows_the_path():
    lengths = {"1": 50, "2": 50, "3": 50, "7": 80}
    out = megareads.mega_reads([node("1F_2R", 10), node("2R_3F", 40), node("7F", 300)], lengths, 21, 400, least=50)
    assert out[0]["path"] == "1F_2R_3F" and out[0]["path_len"] == 110 and out[0]["score"] == 110
    assert abs(out[0]["density"] - 110 / 109) < 1e-9
    assert [x["path"] for x in out] == ["1F_2R_3F", "7F"] and megareads.path_overlap("1F 2R 7F 1F 2R".split(), "1F 2R 3F 4R".split()) == 2
    both = [node("1F_2R", 10), node("7F", 300)]
    assert len(megareads.mega_reads(both, lengths, 21, 400, least=50, at_most=1)) == 1


def test_chains_are_the_heaviest():
    """Against all walks of random overlap graphs, and components against a walk over the edges."""
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 8)
        nodes = sorted((node("1F", rng.randrange(100)) for _ in range(n)), key=lambda x: x[1:3])
        nodes = [x._replace(score=rng.randrange(10, 90)) for x in nodes]
        edges = [megareads.Edge(i, j, 1, rng.randrange(0, 10)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.4]

        def walks(j):
            yield nodes[j].score
            for x in edges:
                if x.dst == j:
                    yield from (w + nodes[j].score - x.common for w in walks(x.src))

        assert megareads.heaviest_chains(nodes, edges).score == [max(walks(j)) for j in range(n)]
        part = list(range(n))
        for _ in range(n):
            for x in edges:
                part = [min(part[x.src], part[x.dst]) if k in (x.src, x.dst) else p for k, p in enumerate(part)]
        assert megareads.components(n, edges).tolist() == part


def test_trimmed_mega_reads():
    lengths = {"1": 50, "2": 50, "3": 50, "4": 50}
    first, last = node("1F_2F", -20, info=(0, 0, 40)), node("2F_3F_4F", 12, info=(40, 9, 30, 0, 0), q_len=110)
    plain = megareads.mega_reads([first, last], lengths, 21, 130, least=1, density=0)
    cut = megareads.mega_reads([first, last], lengths, 21, 130, least=1, density=0, trimmed=True)
    assert plain[0]["path"] == "1F_2F_3F_4F" and cut[0]["path"] == "2F_3F"
    assert (cut[0]["imp_s"], cut[0]["imp_e"]) == (plain[0]["imp_s"] + 30, plain[0]["imp_e"] - 30)
    assert (cut[0]["path_len"], cut[0]["q_start"], cut[0]["q_end"]) == (80, plain[0]["q_start"] - 30, plain[0]["q_end"] - 30)
    # Inside the read, and without any seeds, nothing is cut.
    assert megareads.trim(node("1F_2F", 5, info=(0, 0, 9)), node("1F_2F", 5, 60, info=(0, 0, 9)), ["1F", "2F"], lengths, 21) == (["1F", "2F"], 0, 0)
    assert megareads.trim(node("1F_2F", -5, info=(0, 0, 0)), node("1F_2F", -5, 300, info=(0, 0, 0)), ["1F", "2F"], lengths, 21) == (["1F", "2F"], 0, 0)
