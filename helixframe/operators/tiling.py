"""Choosing intervals that tile a line: greedy, weighted and maximal."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from helixframe.operators.grouped import per_group


def _union(covered: list[tuple[float, float]], a: float, b: float) -> list[tuple[float, float]]:
    """Disjoint intervals of ``covered`` and [a, b), touching ones joined."""
    apart = [x for x in covered if x[1] < a or x[0] > b]
    meets = [x for x in covered if not (x[1] < a or x[0] > b)]
    return sorted([*apart, (min([a, *(x[0] for x in meets)]), max([b, *(x[1] for x in meets)]))])


def greedy(spans: list[tuple[float, float]], weights: list[float], k: int, play: float = 1.3, at_most: int | None = None) -> list[int]:
    """Indices in order of choice: heaviest first, if no piece already covered is too long and no chosen span contains it.

    Too long: max(k play, length (play - 0.9)).  Equal weights: smaller index first.
    """
    covered: list[tuple[float, float]] = []
    out: list[int] = []
    for i in sorted(range(len(spans)), key=lambda i: (-weights[i], i)):
        a, b = spans[i]
        limit = max(k * play, (b - a) * (play - 0.9))
        shared = (min(b, y) - max(a, x) for x, y in covered)
        if any(n > 0 and n >= limit for n in shared) or any(spans[j][0] <= a and b <= spans[j][1] for j in out):
            continue
        out.append(i)
        covered = _union(covered, a, b)
        if at_most is not None and len(out) >= at_most:
            break
    return out


def weighted(spans: list[tuple[float, float]], density: list[float], k: int, play: float = 1.3, at_most: int | None = None) -> list[int]:
    """As ``greedy``, by squared density times length."""
    return greedy(spans, [d * d * (b - a + 1) for d, (a, b) in zip(density, spans, strict=True)], k, play, at_most)


def _links(link: dict[int, int], at: int) -> Iterator[int]:
    while at >= 0:
        yield at
        at = link[at]


def maximal(spans: list[tuple[float, float]], scores: list[float], k: int, play: float = 1.3) -> list[int]:
    """Indices of a chain of spans with the largest total score, in order; neighbours overlap by at most k play.

    Take-or-skip over the spans in order of end.  What a span may follow is the best chain
    among those that end by its own start plus the slack, and not after its own end, less any
    last spans of that chain that start no earlier than itself.
    """
    order = sorted(range(len(spans)), key=lambda i: (spans[i][1], i))
    ends = [spans[i][1] for i in order]
    value, link = {-1: 0.0}, {}
    top = [-1]  # the last span of the best chain among the first 0, 1, ... spans
    for n, i in enumerate(order):
        a, b = spans[i]
        before = top[min(n, bisect_right(ends, min(a + k * play, b)))]
        link[i] = next((j for j in _links(link, before) if spans[j][0] < a), -1)
        value[i] = scores[i] + value[link[i]]
        top.append(i if top[n] < 0 or value[i] > value[top[n]] else top[n])
    return [*_links(link, top[-1])][::-1]


def choose(how: str, spans: list[tuple[float, float]], values: list[float], k: int, play: float = 1.3, at_most: int | None = None) -> list[int]:
    """Indices by greedy, weighted or maximal tiling, or all (none); ``values`` are scores, for weighted densities."""
    if how == "maximal":
        return maximal(spans, values, k, play)[:at_most]
    if how == "none":
        return list(range(len(spans)))
    return {"greedy": greedy, "weighted": weighted}[how](spans, values, k, play, at_most)


def tile(rows: DataFrame, how: str = "greedy", key: str = "key", k: int = 17, play: float = 1.3, at_most: int | None = None) -> DataFrame:
    """Rows (key, id) chosen among spans (key, id, a, b, score), at most ``at_most`` a key: greedy, weighted or maximal; ``none`` keeps all."""
    if how == "none":
        return rows.select(key, "id")
    kind = dict(rows.dtypes)[key]

    def one(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["a", "b", "id"]).reset_index(drop=True)
        spans, scores = list(zip(df.a.tolist(), df.b.tolist(), strict=True)), df.score.tolist()
        return df.iloc[sorted(choose(how, spans, scores, k, play, at_most))][[key, "id"]]

    return per_group(rows.select(key, "id", "a", "b", "score"), [key], one, f"{key} {kind}, id long")
