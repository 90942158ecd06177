"""Joining the corrected pieces of a long read, and correcting reads with unitigs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame

from helixframe.runtime import bound_batches


def anchored_overlap(left: str, right: str, implied: int, seed: int = 15, probes: int = 10) -> int | None:
    """The overlap of two pieces nearest to the implied one at which a seed of the right piece is found in the left."""
    best = None
    for i in range(probes):
        word = right[i * seed : (i + 1) * seed]
        if len(word) < seed:
            break
        at = left.find(word)
        while at >= 0:
            n = len(left) - at + i * seed
            if n <= min(len(left), len(right)) and (best is None or abs(n - implied) < abs(best - implied)):
                best = n
            at = left.find(word, at + 1)
    return best


def join_pieces(read: str, pieces: list[dict], verdict=lambda a, b: 0, max_gap: int = 1000, least: int = 500, short: int = 5, long: int = 35, fill: str = "raw") -> list[str]:
    """Sequences of a read's pieces joined in order; split where they do not join.

    Pieces are dicts (name, start, stop, seq; 1-based on the read).  Contained pieces go.
    Pieces of a mean length below ``least`` give nothing.  A gap is filled with the read's bases in lower
    case if its verdict allows it and it is short enough (half of ``max_gap`` for verdict -1), else it
    splits.  An overlap over ``long`` bases is anchored by exact seeds, a shorter one is
    taken as implied, and one of at most ``short`` splits unless the pieces are of one
    mega-read or agreed on.  ``fill`` may also be ``n`` (unknown bases for every gap) or
    ``fixed`` (100 of them).
    """
    ps = sorted(pieces, key=lambda p: (p["start"], -p["stop"]))
    if not ps or sum(len(p["seq"]) for p in ps) / len(ps) < least:
        return []
    out, last = [ps[0]["seq"]], ps[0]
    for p in ps[1:]:
        if p["stop"] <= last["stop"]:
            continue
        gap, says = p["start"] - last["stop"] - 1, verdict(last["name"], p["name"])
        if gap >= 0 and fill == "n":
            out[-1] += "N" * max(1, gap) + p["seq"]
        elif gap >= 0 and fill == "fixed":
            out[-1] += "N" * 100 + p["seq"]
        elif gap >= 0:
            limit = max_gap / 2 if says == -1 else max_gap
            if says and gap <= limit:
                out[-1] += read[last["stop"] : p["start"] - 1].lower() + p["seq"]
            else:
                out.append(p["seq"])
        else:
            n = -gap
            cut = anchored_overlap(out[-1], p["seq"], n) if n > long else (n if n > short or says == 1 or p["name"] == last["name"] else None)
            if cut is None or cut >= len(p["seq"]):
                out.append(p["seq"])
            else:
                out[-1] += p["seq"][cut:]
        last = p
    return out


def join_reads(reads: DataFrame, pieces: DataFrame, verdicts: DataFrame | None = None, least_out: int = 500, **how) -> DataFrame:
    """Rows (read, part, seq) of all reads: ``reads`` (name, seq), ``pieces`` (read, name, start, stop, seq), ``verdicts`` (read, a, b, verdict)."""
    bound_batches(reads.sparkSession)
    schema = "read long, part int, seq string"

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame(columns=["read", "part", "seq"])
        given = {tuple(sorted((v["a"], v["b"]))): v["verdict"] for v in _verdicts(right)}
        found = join_pieces(left.seq.iloc[0], right[["name", "start", "stop", "seq"]].to_dict("records"), lambda a, b: given.get(tuple(sorted((a, b))), 0), **how)
        rows = [(left.name.iloc[0], i, s) for i, s in enumerate(s for s in found if len(s) >= least_out)]
        return pd.DataFrame(rows, columns=["read", "part", "seq"])

    from pyspark.sql import functions as F

    own = pieces
    if verdicts is not None:
        own = pieces.join(verdicts.groupBy("read").agg(F.collect_list(F.struct("a", "b", "verdict")).alias("verdicts")), "read", "left")
    read_of = reads.select(F.col("name").alias("name"), "seq")
    return read_of.groupBy("name").cogroup(own.groupBy("read")).applyInPandas(lambda x, y: one(_first(x), y), schema)


def _verdicts(df: pd.DataFrame) -> list:
    given = df.verdicts.iloc[0] if "verdicts" in df else None
    return [] if given is None else list(given)


def _first(df: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"name": df["name"].values[:1], "seq": df["seq"].values[:1]})


def correct_read(read: str, placed: list[tuple[int, int, str]], k: int) -> str:
    """A read with the unitigs (start, stop, seq) put in place of its own bases, right to left.

    Two neighbours that overlap join where the end of one is the start of the other for at
    least k-1 bases; otherwise the left one gives way where they overlap.
    """
    out, edge, head = read, len(read) + 1, ""
    for start, stop, seq in sorted(placed, key=lambda x: (-x[0], -x[1])):
        if start < 1 or stop > len(read):
            continue
        if stop >= edge:
            most = min(len(seq), len(head))
            n = next((m for m in range(most, k - 2, -1) if seq[-m:] == head[:m]), 0)
            if not n:
                continue
            seq, stop = seq[:-n], edge - 1
            if stop < start:
                continue
        out = out[: start - 1] + seq + out[stop:]
        edge, head = start, seq + head if stop == edge - 1 else seq
    return out


def correct_reads(reads: DataFrame, placed: DataFrame, k: int) -> DataFrame:
    """(name, seq): reads corrected by placements (name, start, stop, unitig)."""
    from pyspark.sql import functions as F

    bound_batches(reads.sparkSession)
    p = placed.groupBy("name").agg(F.collect_list(F.struct("start", "stop", "unitig")).alias("p"))

    @F.pandas_udf("string")
    def fix(seq: pd.Series, p: pd.Series) -> pd.Series:
        return pd.Series([s if x is None else correct_read(s, [(v["start"], v["stop"], v["unitig"]) for v in x], k) for s, x in zip(seq, p, strict=True)])

    return reads.join(p, "name", "left").select("name", fix("seq", "p").alias("seq"))
