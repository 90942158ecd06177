"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document.
Expectation-maximisation over the counts of all vote patterns (bounded by the number of
patterns, not of documents) estimates each labeller's accuracies and, for each pattern,
the posterior that a document is good.  A hashed linear scorer is trained on documents
with these posterior labels and then scores every document by itself, so it also decides
where labellers abstain or disagree.

The scorer's features are hashed trigrams of character shapes (letters, capitals,
digits, space, other bytes as they are) and hashed bins of the labellers' statistics.
It is fitted on at most ``sample`` distinct texts of either posterior label, those with
the smallest hash of their text; statistics, votes and scores cover all whole texts.

Defined results for unusual input: null counts as empty; texts without words get no
votes and are scored and rejected as bad (score 0); repeated rows get equal scores; if
the votes name no document bad, or none good, the scorer returns the posterior's prior
side for all; an empty table gives an empty table.  Other columns pass through, whatever their names; the
result columns take the place of input columns of the same names.
"""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.textbytes import pieces, row_sums, trigrams
from helixframe.runtime import bound_batches, fresh, materialize

BITS = 11
#: Distinct texts of either label that the scorer is fitted on, at most.
SAMPLE = 2000
BAD, GOOD, ABSTAIN = 0, 1, 2
#: Words in which repetition is measured at once, so that it does not grow with a text's length.
WINDOW = 400
#: Weight of the good texts in the fit: in doubt a document stays.
GOOD_SHARE = 0.7
OWN = ("quality_score", "quality_kept")
#: Common words of the corpus's languages (fixed values).
COMMON = frozenset(b"the of and to in is that it was for are with as be by on not he this from at der die und das den von zu mit sich des auf nicht ein eine im dem auch als le la les de et un une du en que qui est pour dans par sur au el los las y se su una con para como del al o".split())
#: (name, thresholds): a statistic up to the first is good, from the second on bad; between, the labeller abstains.
LABELLERS = {
    "capitals": (0.12, 0.35),  # share of capitals among letters
    "symbols": (0.01, 0.05),  # share of symbol characters
    "bars": (0.005, 0.10),  # vertical bars a word
    "shouts": (0.01, 0.20),  # exclamation marks a word
    "repeats": (0.04, 0.20),  # words equal to the one before
    "echoes": (0.05, 0.20),  # words equal to the second before
    "monotony": (0.75, 0.90),  # share of words seen before in a window of WINDOW words, mean over the text's windows
    "rare": (0.85, 0.97),  # share of words that are not common
    "unended": (0.97, 0.995),  # words that end no sentence
}


def _table(chars: bytes, low: int = 0, high: int = 0) -> np.ndarray:
    out = np.zeros(256, np.float64)
    out[list(chars)] = 1
    out[low:high] = 1
    return out


CAPITAL, LETTER = _table(b"", 65, 91), _table(b"", 65, 91) + _table(b"", 97, 123) + _table(b"", 128, 256)
SYMBOL, BAR, SHOUT, STOP = _table(b"*#$%&@^~=_<>{}[]\\"), _table(b"|"), _table(b"!"), _table(b".?")
SHAPE = np.arange(256).astype(np.uint8)
SHAPE[97:123] = SHAPE[128:] = 97
SHAPE[65:91], SHAPE[48:58], SHAPE[9:14] = 65, 48, 32


def seen_before(w: list[bytes]) -> float:
    """Share of words seen before in their window, mean over windows that cover all words; the last one ends with the text."""
    n = min(WINDOW, len(w))
    starts = [*range(0, len(w) - n, n), len(w) - n]
    return sum(1 - len(set(w[a : a + n])) / n for a in starts) / len(starts)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """[row, labeller] of the labellers' statistics; NaN where a row gives none."""
    sums = {k: row_sums(t[data], offsets, 0) for k, t in (("cap", CAPITAL), ("let", LETTER), ("sym", SYMBOL), ("bar", BAR), ("shout", SHOUT), ("stop", STOP))}
    n = len(offsets) - 1
    raw = data.tobytes()
    words, again, echo, seen, common = np.zeros((5, n))
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        w = raw[a:b].lower().split()
        if w:
            words[i], again[i], seen[i] = len(w), sum(map(operator.eq, w, w[1:])), seen_before(w)
            echo[i] = sum(map(operator.eq, w, w[2:]))
            common[i] = sum(map(COMMON.__contains__, w))
    size = np.maximum(1, np.diff(offsets))
    with np.errstate(all="ignore"):
        few = words < 5
        cols = [
            np.where(sums["let"] < 20, np.nan, sums["cap"] / sums["let"]),
            sums["sym"] / size,
            sums["bar"] / words,
            sums["shout"] / words,
            np.where(few, np.nan, again / words),
            np.where(few, np.nan, echo / words),
            np.where(few, np.nan, seen),
            np.where(words < 12, np.nan, 1 - common / words),
            np.where(words < 15, np.nan, 1 - sums["stop"] / words),
        ]
    out = np.stack(cols, 1)
    out[words == 0] = np.nan
    return out


def votes(stats: np.ndarray) -> np.ndarray:
    """[row, labeller] of GOOD, BAD or ABSTAIN."""
    low, high = np.array(list(LABELLERS.values())).T
    with np.errstate(invalid="ignore"):
        return np.where(stats <= low, GOOD, np.where(stats >= high, BAD, ABSTAIN))


def _pattern(v: np.ndarray) -> np.ndarray:
    return v @ 3 ** np.arange(v.shape[1])


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """(posterior of good for each pattern, P(vote | class) [class, labeller, vote of BAD or GOOD], prior of good)."""
    v = patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    good, bad = (v == GOOD).sum(1), (v == BAD).sum(1)
    post = np.clip((good + 1) / (good + bad + 2), 0.05, 0.95)
    weight = counts / counts.sum()
    for _ in range(rounds):
        prior = float(np.clip((weight * post).sum(), 1e-3, 1 - 1e-3))
        said = np.empty((2, v.shape[1], 2))
        for c, w in ((BAD, weight * (1 - post)), (GOOD, weight * post)):
            for x in (BAD, GOOD):
                said[c, :, x] = (w[:, None] * (v == x)).sum(0) + 1e-6
        said /= said.sum(2, keepdims=True)
        log = [np.log(p) + sum(np.where(v == x, np.log(said[c, :, x]), 0.0).sum(1) for x in (BAD, GOOD)) for c, p in ((BAD, 1 - prior), (GOOD, prior))]
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))
        if np.abs(new - post).max() < 1e-9:
            break
        post = new
    return post, said, prior


def features(texts: pa.Array):
    """For consecutive rows [row, 2**BITS] of features of unit length, and their statistics."""
    size = 1 << BITS
    for data, offsets in pieces(texts):
        stats = statistics(data, offsets)
        bins = np.where(np.isnan(stats), 15, np.clip(np.nan_to_num(stats) * 14, 0, 14).astype(np.int64))
        slot = (np.arange(stats.shape[1]) * 16 + bins + 1) * 2654435761 % (1 << 32) >> (32 - BITS)
        h = trigrams(data, SHAPE, BITS) if len(data) >= 3 else np.empty(0, np.int32)
        out = np.zeros((len(offsets) - 1, size), np.float32)
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            if b - a >= 3:
                tf = np.sqrt(np.bincount(h[a : b - 2], minlength=size) / (b - a - 2))
                out[i] = tf
            np.add.at(out[i], slot[i], 0.4)
        yield out, stats


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 400, ridge: float = 1e-4) -> np.ndarray:
    """Weights (the last is the intercept) of a logistic scorer for the probabilistic labels ``y``."""
    x = np.hstack((x, np.ones((len(x), 1), np.float32)))
    w, step, prev = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(x.shape[1], np.float32)
    share = np.where(y > 0.5, GOOD_SHARE / max(1, (y > 0.5).sum()), (1 - GOOD_SHARE) / max(1, (y <= 0.5).sum())).astype(np.float32)
    step = 4.0 / float((share[:, None] * x * x).sum())
    for k in range(rounds):
        ahead = w + (k / (k + 3)) * (w - prev)
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        prev, w = w, ahead - step * (x.T @ (share * (p - y)) + ridge * ahead)
    return w


def classify(docs: DataFrame, text: str = "text", least: float = 0.4, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with quality_score (estimated probability of good quality) and quality_kept."""
    bound_batches(docs.sparkSession)
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c.lower() not in OWN))
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))

    def tally(batches):
        # Keys and votes come back without the texts, so no task queues rows that wait for a result.
        for batch in batches:
            found = [_pattern(votes(statistics(*p))) for p in pieces(batch["t"])]
            yield pa.RecordBatch.from_pydict({"key": batch["key"], "pattern": pa.array(np.concatenate([*found, np.empty(0, np.int64)]).astype(np.int32))})

    voted = materialize(kept.select(F.xxhash64(body).alias("key"), body.alias("t")).mapInArrow(tally, "key long, pattern int"), "votes")
    counted = sorted((r["pattern"], r["n"]) for r in voted.groupBy("pattern").agg(F.count("*").alias("n")).collect())  # at most 3 ** labellers rows
    none = int(_pattern(np.full((1, len(LABELLERS)), ABSTAIN))[0])
    counted = [x for x in counted if x[0] != none]
    if not counted:
        return _scored(kept, text, None, least)
    patterns, counts = np.array(counted, np.int64).T
    post, _, prior = expectation_maximisation(patterns, counts)

    bad = [int(p) for p in patterns[post <= 0.5]]
    known = voted.where(F.col("pattern") != none).select("key", F.col("pattern").isin(bad).alias("bad"), "pattern").distinct()
    drawn = known.where("bad").orderBy("key").limit(sample).unionByName(known.where(~F.col("bad")).orderBy("key").limit(sample))
    label = dict(zip(patterns.tolist(), post.tolist(), strict=True))
    chosen = {r["key"]: label[r["pattern"]] for r in drawn.collect()}  # at most 2 * sample rows
    if len({y > 0.5 for y in chosen.values()}) < 2:
        return _scored(kept, text, float(prior > 0.5), least)
    keys = drawn.sparkSession.createDataFrame([(k,) for k in chosen], "key long")
    picked = kept.select(F.xxhash64(body).alias("key"), body.alias("t")).join(F.broadcast(keys), "key", "left_semi").dropDuplicates(["key"])

    def vectors(batches):
        for batch in batches:
            x = np.concatenate([f for f, _ in features(batch["t"])] or [np.empty((0, 1 << BITS), np.float32)])
            yield pa.RecordBatch.from_pydict({"key": batch["key"], "x": pa.array([r.tobytes() for r in x], pa.binary())})

    found = picked.mapInArrow(vectors, "key long, x binary").toArrow().sort_by("key")
    x = np.stack([np.frombuffer(b.as_py(), np.float32) for b in found["x"]])
    y = np.array([chosen[k] for k in found["key"].to_pylist()], np.float32)
    return _scored(kept, text, fit(x, y), least)


def _scored(kept: DataFrame, text: str, model, least: float) -> DataFrame:
    @F.arrow_udf("double")
    def score_of(texts: pa.Array) -> pa.Array:
        out = []
        for x, stats in features(texts):
            z = x @ model[:-1] + model[-1] if isinstance(model, np.ndarray) else np.full(len(x), 30.0 if model else -30.0)
            p = 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))
            out.append(np.where(np.isnan(stats).all(1), 0.0, p))
        return pa.array(np.concatenate([*out, np.empty(0)]))

    q = fresh(kept, "q")
    scored = kept.withColumn(q, score_of(F.coalesce(F.col(f"`{text}`"), F.lit(""))))
    return scored.select(*(F.col(f"`{c}`") for c in kept.columns), F.col(q).alias("quality_score"), (F.col(q) >= least).alias("quality_kept"))
