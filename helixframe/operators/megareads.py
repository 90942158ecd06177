"""Mega-reads: overlap graphs of aligned paths on a read, their heaviest chains, and tilings."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from helixframe.operators import tiling
from helixframe.operators.grouped import per_group


#: Pairs of nodes that are looked at together.
CELLS = 1 << 20


class Node(NamedTuple):
    """An aligned path on a read; ``info`` has seeds or bases of its unitigs and, between them, of their overlaps."""

    path: list[str]
    imp_s: float
    imp_e: float
    r_start: int
    r_end: int
    q_start: int
    q_end: int
    q_len: int
    err: float
    score: int
    info: list[int]


class Edge(NamedTuple):
    """The last ``shared`` unitigs of node ``src`` are the first of node ``dst``; ``common`` is their part of the score."""

    src: int
    dst: int
    shared: int
    common: int


class Chains(NamedTuple):
    """For each node the heaviest chain that ends in it: its score, the edge it came by (-1: none) and its first node."""

    score: list[int]
    via: list[int]
    start: list[int]


def path_overlap(a: list[str], b: list[str]) -> int:
    """The largest m with the last m of ``a`` the first m of ``b``; m less than both sizes, 0 if none."""
    return next((m for m in range(min(len(a), len(b)) - 1, 0, -1) if a[-m:] == b[:m]), 0)


def spelled(path: list[str], lengths: dict[str, int], unitig_k: int) -> int:
    """Bases of a path, whose unitigs overlap by ``unitig_k`` - 1."""
    return sum(lengths[u[:-1]] for u in path) - max(0, len(path) - 1) * (unitig_k - 1)


def near_pairs(nodes: list[Node], unitig_k: int, read_len: int, play: float, errors: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j), i < j, whose implied positions allow an overlap; nodes are in order of implied span.

    Node i must end inside the read and not a word beyond j, and j must start inside it.  The
    first such j with too little room for a word, errors allowed for, ends the band of i.
    """
    s, e, err = (np.array([x[f] for x in nodes], float) for f in (1, 2, 8))
    found = [(np.empty(0, int), np.empty(0, int))]
    for a in range(0, len(nodes), step := max(1, CELLS // max(1, len(nodes)))):
        own = np.arange(a, min(len(nodes), a + step))[:, None]
        met = (np.arange(len(nodes)) > own) & (e[own] < read_len) & (s > 1) & (e[own] <= e + unitig_k)
        short = met & ((e[own] - s) * play + errors * (err[own] + err) < unitig_k)
        i, j = np.nonzero(met & ~np.logical_or.accumulate(short, axis=1))
        found.append((i + a, j))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def overlap_edges(nodes: list[Node], lengths: dict[str, int], unitig_k: int, read_len: int, play: float = 1.3, errors: float = 3.0) -> list[Edge]:
    """Edges between nodes that dovetail with about as many bases as their implied positions overlap by; sorted."""
    i, j = near_pairs(nodes, unitig_k, read_len, play, errors)
    shared = np.array([0 if nodes[a].path == nodes[b].path else path_overlap(nodes[a].path, nodes[b].path) for a, b in zip(i.tolist(), j.tolist(), strict=True)], int)
    i, j, shared = i[shared > 0], j[shared > 0], shared[shared > 0]
    bases = np.array([spelled(nodes[b].path[:m], lengths, unitig_k) for b, m in zip(j.tolist(), shared.tolist(), strict=True)], float)
    room = np.array([nodes[a].imp_e - nodes[b].imp_s for a, b in zip(i.tolist(), j.tolist(), strict=True)], float)
    slip = errors * np.array([nodes[a].err + nodes[b].err for a, b in zip(i.tolist(), j.tolist(), strict=True)], float)
    agree = (bases <= play * room + slip) & (room <= play * (bases + slip))
    found = zip(i[agree].tolist(), j[agree].tolist(), shared[agree].tolist(), strict=True)
    return [Edge(a, b, m, sum(nodes[b].info[: 2 * m - 1 : 2]) - sum(nodes[b].info[1 : 2 * m - 2 : 2])) for a, b, m in found]


def heaviest_chains(nodes: list[Node], edges: list[Edge]) -> Chains:
    """The longest-path pass over an acyclic edge list; equal scores: an edge rather than none, then the later start."""
    into: dict[int, list[int]] = {}
    for k, x in enumerate(edges):
        into.setdefault(x.dst, []).append(k)
    out = Chains([n.score for n in nodes], [-1] * len(nodes), list(range(len(nodes))))
    for j in sorted(into):
        total, _, k = max(((out.score[edges[k].src] + nodes[j].score - edges[k].common, nodes[out.start[edges[k].src]].imp_s, -k) for k in into[j]))
        if total >= nodes[j].score:
            out.score[j], out.via[j], out.start[j] = total, -k, out.start[edges[-k].src]
    return out


def components(n: int, edges: list[Edge]) -> np.ndarray:
    """For each node the smallest node of its component."""
    part = np.arange(n)
    a, b = np.array([x.src for x in edges], int), np.array([x.dst for x in edges], int)
    while True:
        new = part.copy()
        np.minimum.at(new, a, part[b])
        np.minimum.at(new, b, part[a])
        new = new[new]
        if (new == part).all():
            return part
        part = new


def chain_path(nodes: list[Node], edges: list[Edge], chains: Chains, end: int) -> list[str]:
    """The unitigs along the heaviest chain that ends in node ``end``."""
    parts = []
    while (k := chains.via[end]) >= 0:
        parts.append(nodes[end].path[edges[k].shared :])
        end = edges[k].src
    return sum(reversed(parts), list(nodes[end].path))


def unmatched(info: list[int]) -> int:
    """Unitigs without seeds at the front of a path whose unitigs have the counts ``info[::2]``."""
    return next((u for u, n in enumerate(info[::2]) if n), (len(info) + 1) // 2)


def trim(first: Node, last: Node, path: list[str], lengths: dict[str, int], unitig_k: int) -> tuple[list[str], int, int]:
    """(path without the unmatched unitigs that reach out of the read, bases cut at its start, at its end).

    The start is cut if the first node begins before the read, the end if the last one
    ends beyond the length of its own path.  A node without any seed is not cut.
    """
    head, tail = unmatched(first.info), unmatched(last.info[::-1])
    head = head if first.imp_s < 1 and head < len(first.path) else 0
    tail = tail if last.imp_e > last.q_len and tail < len(last.path) else 0
    if head + tail >= len(path):
        return path, 0, 0
    cut = lambda part: sum(lengths[u[:-1]] - unitig_k + 1 for u in part)
    return path[head : len(path) - tail], cut(path[:head]), cut(path[len(path) - tail :])


def mega_reads(nodes: list[Node], lengths: dict[str, int], unitig_k: int, read_len: int, density: float = 0.029, least: int = 100, how: str = "greedy", play: float = 1.3, errors: float = 3.0, trimmed: bool = False, at_most: int | None = None) -> list[dict]:
    """The best chain of each component (score, then density), tiled, in order of implied position.

    ``trimmed`` cuts unmatched unitigs off at both ends (see ``trim``); ``at_most`` bounds the tiles.
    """
    nodes = sorted(nodes, key=lambda n: (n.imp_s, n.imp_e))
    edges = overlap_edges(nodes, lengths, unitig_k, read_len, play, errors)
    chains, part = heaviest_chains(nodes, edges), components(len(nodes), edges)
    inner = {x.src for x in edges}
    best: dict[int, tuple] = {}
    for i, n in enumerate(nodes):
        a = nodes[chains.start[i]].r_start
        dense = chains.score[i] / max(1e-9, min(read_len + 0.5, n.r_end) - max(0.5, a))
        if i not in inner and dense >= density and n.r_end - a >= least:
            best[part[i]] = max(best.get(part[i], (-1,)), (chains.score[i], dense, -i))
    found = []
    for score, dense, i in best.values():
        first, last, path = nodes[chains.start[-i]], nodes[-i], chain_path(nodes, edges, chains, -i)
        front = back = 0
        if trimmed:
            path, front, back = trim(first, last, path, lengths, unitig_k)
        slope = [(n.imp_e - n.imp_s) / max(1, n.q_len - 1) for n in (first, last)]
        size = spelled(path, lengths, unitig_k)
        found.append(
            {
                "imp_s": first.imp_s + slope[0] * front,
                "imp_e": last.imp_e - slope[1] * back,
                "r_start": first.r_start,
                "r_end": last.r_end,
                "q_start": first.q_start - front,
                "q_end": size + back - (last.q_len - last.q_end),
                "score": score,
                "density": dense,
                "path": "_".join(path),
                "path_len": size,
            }
        )
    spans = [(float(x["r_start"]), float(x["r_end"])) for x in found]
    pick = tiling.choose(how, spans, [x["density"] if how == "weighted" else x["score"] for x in found], unitig_k, play, at_most)
    return sorted((found[i] for i in pick), key=lambda x: (x["imp_s"], x["imp_e"]))


SCHEMA = "read long, imp_s double, imp_e double, r_start int, r_end int, q_start int, q_end int, score int, density double, path string, path_len int"


def assemble(coords: DataFrame, unitigs: DataFrame, unitig_k: int, **how) -> DataFrame:
    """Mega-reads of every read.

    ``coords`` has (read, read_len, path, stretch, offset, avg_err, r_start, r_end, q_start,
    q_end, q_len, score, info array<int>); each row brings the lengths of its path's
    unitigs along (joined here), so no table of all unitigs is needed in a task.
    """
    from pyspark.sql import functions as F

    named = coords.withColumn("__u", F.explode(F.split("path", "_")))
    lens = named.withColumn("uid", F.regexp_replace("__u", "[FR]$", "")).join(unitigs.select(F.col("uid").cast("string").alias("uid"), "len"), "uid")
    known = lens.groupBy("read").agg(F.collect_set(F.struct("uid", "len")).alias("lens"))

    def one(df: pd.DataFrame) -> pd.DataFrame:
        lengths = {x["uid"]: x["len"] for x in df.lens.iloc[0]}
        nodes = [
            Node(r.path.split("_"), r.stretch + r.offset, r.stretch * r.q_len + r.offset, r.r_start, r.r_end, r.q_start, r.q_end, r.q_len, r.avg_err, r.score, list(r.info))
            for r in df.sort_values(["path", "r_start"]).itertuples()
            if all(u[:-1] in lengths for u in r.path.split("_"))
        ]
        rows = mega_reads(nodes, lengths, unitig_k, int(df.read_len.iloc[0]), **how)
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pd.DataFrame([{"read": df.read.iloc[0], **x} for x in rows], columns=names)

    return per_group(coords.join(known, "read"), ["read"], one, SCHEMA)
