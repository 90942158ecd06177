import re

import xxhash

from helixframe.llm import simhash


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\\x20\\x09-\\x0D]+", low)
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                comp[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return sorted(((d, f"{f:016x}", best.get(find(i))) for i, ((d, _), f) in enumerate(zip(rows, fps, strict=True))), key=str)


def rows():
    base = " ".join(f"word{i % 37}x{i}" for i in range(400))
    near = [(100 + k, base.replace(f"x{k * 7}", f"y{k}")) for k in range(1, 12)]
    return [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (9, base), (8, base), (8, base), (None, base), *near, (50, "Ä b c d é"), (51, "x" * 200_000), (None, "lonely text here")]


def test_components_against_brute_force(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string").withColumns({"component_id": simhash.F.lit("clash"), "a": simhash.F.lit(1)})
    got = simhash.simhash_components(df).collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == brute_components(rows())


def test_hot_fingerprints(spark, monkeypatch):
    """Rows of fingerprints that count as hot get the same components as others."""
    monkeypatch.setattr(simhash, "HOT_ROWS", 1)
    df = spark.createDataFrame(rows() * 2, "doc_id long, text string")
    got = simhash.simhash_components(df)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()), key=str) == brute_components(rows() * 2)


def test_pairs_complete(spark):
    values = [0, 1, 7, 0xF, 1 << 63, (1 << 63) | 3, (1 << 32) | 1, (1 << 33) | (1 << 40) | 1, 2**64 - 1, 2**64 - 9]
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    want = {(min(a, b), max(a, b)) for a in signed for b in signed if 0 < ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    for segments in (2, 3, 4):
        assert {(r.a, r.b) for r in simhash.linked_pairs(df, "fp", 3, segments).collect()} == want


def test_keep_first(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string")
    kept = [r.doc_id for r in simhash.keep_first(df).collect()]
    want = {d for d, _, c in brute_components(rows()) if d is not None and d == c}
    assert sorted(k for k in kept if k is not None) == sorted(want) and kept.count(None) == 2


def test_keep_first_with_clashing_and_null_ids(spark):
    """Different texts under one id all stay; copies go, whichever id or none they have."""
    one, two, three, four = (" ".join(f"{c}{i}" for i in range(300)) for c in "pqrs")
    odd = [(1, one), (7, one), (7, two), (8, two), (7, three), (None, four), (None, four), (None, four.upper()), (None, None), (None, "")]
    kept = simhash.keep_first(spark.createDataFrame(odd, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.doc_id) == sorted([(1, one), (7, two), (7, three)])
    assert sorted((r.text or "").lower() for r in kept if r.doc_id is None) == ["", four]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert simhash.simhash_components(df).count() == 0 and simhash.keep_first(df).columns == df.columns


def test_probes_are_never_broadcast(spark):
    """The estimated size of the probes leaves the masks out; a broadcast would take all of them through the driver."""
    df = spark.range(2000).select(simhash.F.xxhash64("id").alias("fp"))
    found = simhash.linked_pairs(df, "fp")
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
