import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from helixframe.llm import langid, quality, queries
from helixframe.llm.langid import F

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").cache()


# Language ID


def test_text_alone_finds_the_language(spark, docs):
    """Held out: the texts that declare nothing are neither learned from nor hinted at."""
    held = docs.withColumn("said", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    got = langid.identify(held, declared=F.col("said")).where("said is null").select("lang", "lang_id", "lang_kept").collect()
    assert len(got) > 300
    assert sum(r.lang == r.lang_id and r.lang_kept for r in got) >= 0.99 * len(got)


def test_pages_combine_markup_address_and_host(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    html = F.col("html")
    got = langid.identify(pages, text=langid.page_text(html), declared=langid.declared_in(html), host=langid.host_of(F.col("url"))).select("lang_id", "lang_kept", langid.declared_in(html).alias("d")).collect()
    assert all(r.lang_kept for r in got) and sum(r.lang_id == r.d for r in got) >= 0.98 * len(got)


def test_each_evidence_counts(spark, docs):
    base = docs.select("doc_id", "text", "lang", F.lit(None).cast("string").alias("host"))
    odd = [(-1, "a", None, "www.x.fr"), (-2, "e", "de", None), (-3, "a", None, "h.example.com")]
    # The words of host h are Spanish; one letter alone says little.
    spanish = base.where("lang = 'es'").withColumn("host", F.lit("h.example.com"))
    rows = spark.createDataFrame([(i, t + " " * 3, d, h) for i, t, d, h in odd], base.schema)
    got = {r.doc_id: r.lang_id for r in langid.identify(base.where("lang <> 'es'").unionByName(spanish).unionByName(rows), declared=F.col("lang"), host=F.col("host")).where("doc_id < 0").collect()}
    assert got == {-1: "fr", -2: "de", -3: "es"}


def test_hosts(spark):
    rows = [("https://u@M.Ab.example.net:80/x", "<HTML class=a LANG='De-at'>x"), ("nothing", "<p lang=fr>"), (None, None)]
    got = spark.createDataFrame(rows, "url string, html string").select(langid.host_of(F.col("url")), langid.declared_in(F.col("html"))).collect()
    assert [tuple(r) for r in got] == [("m.ab.example.net", "de"), (None, None), (None, None)]


def test_language_edge_cases(spark, docs):
    rows = [(-1, None, "en"), (-2, "", "en"), (-3, "*** 123", "en"), (-4, "Это русский текст о погоде и природе, который отвергается", None), (-5, "the and of that with " * 20_000, None), (-6, "Von.", "de"), (-6, "Von.", "de")]
    df = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(rows, "doc_id long, text string, lang string")).withColumn("lang_id", F.lit("clash")).withColumn("h", F.lit(1))
    got = [(r.doc_id, r.lang_id, r.lang_kept) for r in langid.identify(df, declared=F.col("lang")).where("doc_id < 0").collect()]
    assert sorted(got) == sorted([(-1, "und", False), (-2, "und", False), (-3, "und", False), (-4, "und", False), (-5, "en", True), (-6, "de", True), (-6, "de", True)])
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert langid.identify(empty, declared=F.col("lang"), host=F.col("source")).count() == 0


def test_many_hosts_take_the_shuffle(spark, docs, monkeypatch):
    df = docs.select("doc_id", "text", "lang", "source")
    want = {r.doc_id: r.lang_id for r in langid.identify(df, declared=F.col("lang"), host=F.col("source")).collect()}
    monkeypatch.setattr(langid, "BROADCAST_HOSTS", 3)
    assert {r.doc_id: r.lang_id for r in langid.identify(df, declared=F.col("lang"), host=F.col("source")).collect()} == want


def plain_fusion(rows, languages=("de", "en", "es", "fr")):
    """(id, language, posterior) of (id, text, declared, host), by dictionaries and loops over bytes."""
    names = [*languages, "und"]

    def grams(text):
        data = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in (text or "").encode())
        for i in range(len(data) - 2):
            if data[i : i + 3] != b"   ":
                yield (data[i] << 16 | data[i + 1] << 8 | data[i + 2]) * 2654435761 % (1 << 32) >> 32 - langid.BITS

    counts = {x: Counter(g for _, t, d, _ in rows if d == x for g in grams(t)) for x in languages}
    size = {x: sum(c.values()) + langid.ALPHA * 2**langid.BITS for x, c in counts.items()}
    said, hosts = [], defaultdict(lambda: np.zeros(5))
    for _, text, _, host in rows:
        g = list(grams(text))
        s = np.array([sum(math.log((counts[x][h] + langid.ALPHA) / size[x]) for h in g) for x in languages] + [-langid.BITS * math.log(2) * len(g)])
        s = s * min(1, langid.EVIDENCE / max(1, len(g)))
        said.append(s - s.max() if g else None)
        if g:
            hosts[host or ""] += np.exp(said[-1]) / np.exp(said[-1]).sum()
        hosts[host or ""] += 0
    label = lambda h, k: ".".join(h.split(".")[-k:])

    def share(of, up):
        n = sum((v for h, v in hosts.items() if of(h)), np.zeros(5))
        return (n + langid.SMOOTH * up) / (n.sum() + langid.SMOOTH)

    out = []
    for (i, _, declared, host), s in zip(rows, said):
        h = host or ""
        if s is None:
            out.append((i, "und", 1.0))
            continue
        up = share(lambda x: True, np.full(5, 0.2))
        up = share(lambda x: label(x, 1) == label(h, 1), up)
        up = share(lambda x: label(x, 2) == label(h, 2), up)
        left = np.maximum(0, hosts[h] - np.exp(s) / np.exp(s).sum())
        prior = (left + langid.SMOOTH * up) / (left.sum() + langid.SMOOTH)
        hint = langid.SUFFIXES.get(label(h, 1))
        f = s + np.log(np.maximum(prior, 1e-9))
        if declared is not None:
            f += np.log([0.9 if x == (declared if declared in languages else "und") else 0.1 / 4 for x in names])
        if hint:
            f += np.log([0.7 if x == hint else 0.3 / 4 for x in names])
        out.append((i, names[int(np.argmax(f))], round(float(1 / np.exp(f - f.max()).sum()), 6)))
    return out


def same_languages(got, want):
    got, want = sorted(got), sorted(want)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert all(abs(a[2] - b[2]) < 1e-4 for a, b in zip(got, want))


@pytest.mark.parametrize("query", ["op7_language_id", "page_languages"])
def test_registered_queries_against_plain_fusion(spark, query):
    """Every row of the query over its whole table."""
    sf = "/root/testdata/sf0.001"
    if query == "page_languages":
        html = F.col("html")
        table = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", langid.page_text(html), langid.declared_in(html), langid.host_of(F.col("url")))
    else:
        table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    rows = [tuple(r) for r in table.collect()]
    got = queries.queries()[query](spark, sf).collect()
    assert all(r.kept == (r.lang_id != "und" and r.posterior >= 0.5) for r in got)
    same_languages([(r[0], r.lang_id, r.posterior) for r in got], plain_fusion(rows))


def test_columns_with_the_helpers_names(spark, docs):
    names = ["__t", "__d", "__h", "__k", "__r", "c0", "q", "a.b"]
    df = docs.select("doc_id", "text", "lang", *(F.lit(x).alias(x) for x in names))
    for got in (langid.identify(df, declared=F.col("lang")), quality.classify(df)):
        assert got.columns[: len(df.columns)] == df.columns and [tuple(r)[3:11] for r in got.limit(3).collect()] == [tuple(names)] * 3


# Quality


def test_votes_and_em_against_plain_versions(spark, docs):
    """Statistics text by text, and expectation-maximisation over the raw votes instead of patterns."""
    texts = [r.text or "" for r in docs.orderBy("doc_id").limit(300).collect()]
    data = [t.encode() for t in texts]
    stats = quality.statistics(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    for t, got in zip(data, stats):
        w = t.lower().split()
        letters = [c for c in t if 65 <= c <= 90 or 97 <= c <= 122 or c >= 128]
        n = max(1, len(w))
        cut = min(quality.WINDOW, len(w))
        parts = [w[a : a + cut] for a in [*range(0, len(w) - cut, max(1, cut)), len(w) - cut]]
        want = [
            sum(65 <= c <= 90 for c in letters) / len(letters) if len(letters) >= 20 else np.nan,
            sum(c in b"*#$%&@^~=_<>{}[]\\" for c in t) / max(1, len(t)),
            t.count(b"|") / n,
            t.count(b"!") / n,
            sum(a == b for a, b in zip(w, w[1:])) / n if len(w) >= 5 else np.nan,
            sum(a == b for a, b in zip(w, w[2:])) / n if len(w) >= 5 else np.nan,
            np.mean([1 - len(set(p)) / cut for p in parts]) if len(w) >= 5 else np.nan,
            1 - sum(x in quality.COMMON for x in w) / n if len(w) >= 12 else np.nan,
            1 - (t.count(b".") + t.count(b"?")) / n if len(w) >= 15 else np.nan,
        ]
        assert np.allclose(got, want if w else [np.nan] * 9, equal_nan=True)
    vote = quality.votes(stats)
    vote = vote[(vote != quality.ABSTAIN).any(1)]
    good = np.clip([((v == quality.GOOD).sum() + 1) / ((v != quality.ABSTAIN).sum() + 2) for v in vote], 0.05, 0.95)
    for _ in range(200):
        prior = min(max(good.mean(), 1e-3), 1 - 1e-3)
        like = np.log(np.array([[1 - prior, prior]] * len(vote)))
        for k in range(vote.shape[1]):
            for side, weight in ((0, 1 - good), (1, good)):
                n = np.array([weight[vote[:, k] == x].sum() for x in (0, 1)]) / len(vote) + 1e-6
                for x in (0, 1):
                    like[vote[:, k] == x, side] += math.log(n[x] / n.sum())
        new = 1 / (1 + np.exp(np.clip(like[:, 0] - like[:, 1], -700, 700)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    patterns, at, counts = np.unique(quality._pattern(vote), return_inverse=True, return_counts=True)
    post, _, p = quality.expectation_maximisation(patterns, counts)
    assert np.abs(post[at] - good).max() < 1e-6 and abs(p - prior) < 1e-6


def test_scorer_is_the_optimum():
    """The fit's gradient vanishes, and no small step from it is better."""
    rng = np.random.default_rng(2)
    x, y = rng.standard_normal((300, 12)).astype(np.float32), (rng.random(300) < 0.6).astype(np.float32) * 0.9 + 0.05
    w = quality.fit(x, y, rounds=4000, ridge=0.01)

    def loss(v):
        z = x @ v[:-1] + v[-1]
        share = np.where(y > 0.5, quality.GOOD_SHARE / (y > 0.5).sum(), (1 - quality.GOOD_SHARE) / (y <= 0.5).sum())
        return float((share * (np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - y * z)).sum() + 0.005 * v @ v)

    best = loss(w.astype(float))
    for _ in range(100):
        assert loss(w + rng.standard_normal(13) * 0.05) > best - 1e-6


def test_quality_against_held_out_labels(spark, docs):
    """No label takes part in the fit, so all are held out."""
    truth = dict(zip(*pq.read_table(f"{DATA}/labels.parquet", columns=["doc_id", "quality"]).to_pydict().values(), strict=True))
    got = {r.doc_id: r.quality_kept for r in quality.classify(docs).collect()}
    assert len(got) == 1000
    clean, junk = [d for d, q in truth.items() if q], [d for d, q in truth.items() if not q]
    assert sum(got[d] for d in clean) >= 0.99 * len(clean) and sum(not got[d] for d in junk) >= 0.93 * len(junk)


def test_em_recovers_accuracies():
    rng = np.random.default_rng(1)
    m, n = len(quality.LABELLERS), 40_000
    good, acc = rng.random(n) < 0.8, np.linspace(0.65, 0.95, m)
    vote = np.where(rng.random((n, m)) < acc, good[:, None], ~good[:, None]).astype(int)
    vote[rng.random((n, m)) < 0.2] = quality.ABSTAIN
    patterns, at, counts = np.unique(quality._pattern(vote), return_inverse=True, return_counts=True)
    post, said, prior = quality.expectation_maximisation(patterns, counts)
    assert abs(prior - 0.8) < 0.02
    assert np.abs(said[quality.GOOD, :, quality.GOOD] - acc).max() < 0.03 and np.abs(said[quality.BAD, :, quality.BAD] - acc).max() < 0.03
    assert ((post[at] > 0.5) == good).mean() > 0.93


@pytest.mark.parametrize("period", [3, 7, 30])
def test_repetition_is_seen_at_any_length(period):
    at = list(quality.LABELLERS).index("monotony")
    for n in (300, 400, 401, 777, 20_000):
        text = b" ".join(b"word%d" % (i % period) for i in range(n))
        fresh = b" ".join(b"word%d" % i for i in range(n))
        stats = quality.statistics(np.frombuffer(text + fresh, np.uint8), np.array([0, len(text), len(text) + len(fresh)]))
        assert quality.votes(stats)[:, at].tolist() == [quality.BAD, quality.GOOD]
        assert abs(stats[0, at] - (1 - period / min(n, quality.WINDOW))) < 1e-9 and abs(stats[1, at]) < 1e-9


def test_quality_edge_cases(spark, docs):
    junk = "".join("WORD!! ***" for _ in range(9000))
    rows = [(-1, None), (-2, ""), (-3, " \n"), (-4, junk), (-4, junk)]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string")).withColumn("quality_score", F.lit("clash")).withColumn("key", F.lit(1))
    got = [(r.doc_id, r.quality_kept, r.quality_score) for r in quality.classify(df).where("doc_id < 0").collect()]
    assert not any(k for _, k, _ in got) and len(got) == 5
    assert all(s == 0.0 for d, _, s in got if d > -4) and len({s for d, _, s in got if d == -4}) == 1
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert quality.classify(empty).count() == 0
    one = spark.createDataFrame([(1, "The rain and the wind are in the hills of the north. It is cold."), (2, None)], "doc_id long, text string")
    assert [r.quality_kept for r in quality.classify(one).orderBy("doc_id").collect()] == [True, False]
