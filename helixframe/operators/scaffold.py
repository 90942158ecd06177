"""Scaffold graphs: walks, repeats, gap filling, and spanning trees.

Graphs are cut into connected components by a distributed contraction; each component
is then resolved by a kernel, so a task holds one component at most.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.sequence import reverse_complement
from helixframe.operators.components import connected_components
from helixframe.operators.grouped import per_group
from helixframe.runtime import bound_batches, materialize, release

End = tuple[str, str]


def opposite(end: End) -> End:
    return end[0], "3" if end[1] == "5" else "5"


class EndGraph:
    """Contigs with two ends each, and links between ends with the gap they bridge."""

    def __init__(self, lengths: dict[str, int], links: Iterable[tuple[End, End, int]]):
        self.lengths = dict(lengths)
        self.links: dict[End, dict[End, int]] = defaultdict(dict)
        for a, b, gap in links:
            if a != b:
                self.links[a][b] = min(gap, self.links[a].get(b, gap))
                self.links[b][a] = self.links[a][b]

    def degree(self, end: End) -> int:
        return len(self.links.get(end, ()))

    def drop(self, name: str) -> None:
        for end in ((name, "5"), (name, "3")):
            for other in self.links.pop(end, {}):
                self.links[other].pop(end, None)
        del self.lengths[name]

    def drop_tips(self, short: int) -> bool:
        """Remove short contigs linked at one end only, where that neighbour has another way to go on."""
        tips = []
        for name in sorted(self.lengths):
            used = [e for e in ((name, "5"), (name, "3")) if self.degree(e)]
            if self.lengths[name] < short and len(used) == 1 and all(self.degree(x) > 1 for x in self.links[used[0]]):
                tips.append(name)
        done = False
        for name in tips:
            ends = [x for e in ((name, "5"), (name, "3")) for x in self.links.get(e, ())]
            if all(self.degree(x) > 1 for x in ends):
                self.drop(name)
                done = True
        return done

    def pop_bubbles(self) -> bool:
        """Of contigs that bridge the same two ends, keep the longest."""
        between = defaultdict(list)
        for name in self.lengths:
            if self.degree((name, "5")) == self.degree((name, "3")) == 1:
                between[tuple(sorted((*self.links[name, "5"], *self.links[name, "3"])))].append(name)
        done = False
        for names in between.values():
            for name in sorted(names, key=lambda n: (-self.lengths[n], n))[1:]:
                self.drop(name)
                done = True
        return done

    def joins(self) -> dict[End, tuple[End, int]]:
        """Links that are the only one at both of their ends."""
        out = {}
        for a, others in self.links.items():
            if len(others) == 1:
                (b, gap), = others.items()
                if self.degree(b) == 1 and b[0] != a[0]:
                    out[a] = (b, gap)
        return out

    def paths(self) -> list[list[tuple[str, str, int]]]:
        """Paths of (contig, F or R, gap after it), each contig in one; cycles are cut at their smallest contig."""
        joins, seen, out = self.joins(), set(), []

        def walk(name: str, entry: str) -> None:
            path, at = [], (name, entry)
            while at[0] not in seen:
                seen.add(at[0])
                leave = opposite(at)
                nxt, gap = joins.get(leave, (None, 0))
                go_on = nxt is not None and nxt[0] not in seen
                path.append((at[0], "F" if at[1] == "5" else "R", gap if go_on else 0))
                if not go_on:
                    break
                at = nxt
            out.append(path)

        for name in sorted(self.lengths):
            for entry in ("5", "3"):
                if name not in seen and (name, entry) not in joins:
                    walk(name, entry)
        for name in sorted(self.lengths):
            if name not in seen:
                walk(name, "5")
        return out


def resolve(lengths: dict[str, int], links: Iterable[tuple[End, End, int]], short: int = 10_000, simplify: bool = True) -> list[list[tuple[str, str, int]]]:
    """Paths after removing tips and popping bubbles until nothing changes."""
    g = EndGraph(lengths, links)
    while simplify and (g.drop_tips(short) or g.pop_bubbles()):
        pass
    return g.paths()


def walk_graph(contigs: DataFrame, links: DataFrame, short: int = 10_000, simplify: bool = True) -> DataFrame:
    """Rows (path, i, ctg, dir, gap) of resolved scaffolds.

    ``contigs`` has (name string, len); ``links`` (ctg1, dir1, ctg2, dir2, gap): ctg1 read in
    dir1 is followed by ctg2 read in dir2.  A path is named by its smallest contig.
    """
    bound_batches(contigs.sparkSession)
    ends = links.select(
        F.col("ctg1").cast("string").alias("a"), F.when(F.col("dir1") == "F", "3").otherwise("5").alias("ae"),
        F.col("ctg2").cast("string").alias("b"), F.when(F.col("dir2") == "F", "5").otherwise("3").alias("be"), F.col("gap").cast("long").alias("gap"),
    ).where("a <> b")
    named = contigs.select(F.col("name").cast("string").alias("name"), F.col("len").cast("long").alias("len"))
    comp = materialize(connected_components(ends, "a", "b"), "parts")
    nodes = named.join(comp, named.name == comp.node).select("component", "name", "len")
    edges = ends.join(comp, ends.a == comp.node).select(F.col("component").alias("part"), "a", "ae", "b", "be", "gap")

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        lengths = dict(zip(left.name, left.len, strict=True))
        found = [((r.a, r.ae), (r.b, r.be), int(r.gap)) for r in right.itertuples() if r.a in lengths and r.b in lengths]
        rows = [(min(c for c, _, _ in p), i, c, d, g) for p in resolve(lengths, found, short, simplify) for i, (c, d, g) in enumerate(p)]
        return pd.DataFrame(rows, columns=["path", "i", "ctg", "dir", "gap"])

    schema = "path string, i int, ctg string, dir string, gap long"
    linked = nodes.groupBy("component").cogroup(edges.groupBy("part")).applyInPandas(lambda x, y: one(x, y), schema)
    alone = named.join(comp, named.name == comp.node, "left_anti").select(F.col("name").alias("path"), F.lit(0).alias("i"), F.col("name").alias("ctg"), F.lit("F").alias("dir"), F.lit(0).cast("long").alias("gap"))
    return linked.unionByName(alone)


def insert_repeats(paths: DataFrame, bridges: DataFrame) -> DataFrame:
    """Paths with a repeat between neighbours that a bridge (ctg1, dir1, ctg2, dir2, repeat, rdir, gap1, gap2) connects."""
    w = Window.partitionBy("path").orderBy("i")
    nxt = paths.select("*", F.lead("ctg").over(w).alias("ctg2"), F.lead("dir").over(w).alias("dir2"))
    j = nxt.join(bridges.withColumnsRenamed({"ctg1": "ctg", "dir1": "dir"}), ["ctg", "dir", "ctg2", "dir2"], "left")
    own = j.select("path", (F.col("i") * 2).alias("i"), "ctg", "dir", F.coalesce("gap1", "gap").alias("gap"))
    new = j.where("repeat is not null").select("path", (F.col("i") * 2 + 1).alias("i"), F.col("repeat").alias("ctg"), F.col("rdir").alias("dir"), F.col("gap2").alias("gap"))
    both = own.unionByName(new)
    return both.withColumn("i", F.row_number().over(Window.partitionBy("path").orderBy("i")) - 1)


def path_sequences(paths: DataFrame, contigs: DataFrame, patches: DataFrame | None = None) -> DataFrame:
    """(name, seq) of paths: contigs in their directions; gaps as unknown bases or the patch's, overlaps trimmed.

    ``patches`` has (ctg, dir, ctg2, dir2, fill) with the bases of a gap, read along the path.
    """
    w = Window.partitionBy("path").orderBy("i")
    rows = paths.join(contigs.select(F.col("name").cast("string").alias("ctg"), "seq"), "ctg")
    turned = F.when(F.col("dir") == "R", reverse_complement("seq")).otherwise(F.col("seq"))
    rows = rows.select("path", "i", "ctg", "dir", "gap", turned.alias("s"), F.lead("ctg").over(w).alias("ctg2"), F.lead("dir").over(w).alias("dir2"), F.coalesce(F.lag("gap").over(w), F.lit(0)).alias("g0"))
    fill = F.lit(None).cast("string")
    if patches is not None:
        rows, fill = rows.join(patches, ["ctg", "dir", "ctg2", "dir2"], "left"), F.col("fill")
    own = F.substr(F.col("s"), F.greatest(F.lit(0), -F.col("g0")).cast("int") + 1)
    bridge = F.coalesce(fill, F.repeat(F.lit("N"), F.greatest(F.lit(0), F.col("gap")).cast("int")))
    part = F.concat(own, F.when(F.col("ctg2").isNull(), F.lit("")).otherwise(bridge))
    g = rows.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("i", part.alias("t")))).alias("x"))
    return g.select(F.col("path").alias("name"), F.array_join("x.t", "").alias("seq"))


def piece_links(pieces: DataFrame) -> DataFrame:
    """Links between consecutive pieces (whole, i, name, start, len) of one sequence; gap 0 where they touch."""
    w = Window.partitionBy("whole").orderBy("i")
    rows = pieces.select(F.lag("name").over(w).alias("ctg1"), F.lit("F").alias("dir1"), F.col("name").alias("ctg2"), F.lit("F").alias("dir2"), (F.col("start") - F.lag(F.col("start") + F.col("len")).over(w)).alias("gap"))
    return rows.where("ctg1 is not null")


def fill_by_search(gaps: DataFrame, edges: DataFrame, width: int = 10) -> DataFrame:
    """(id, path): the only chain of overlapping unitigs between the gap's ends, of at most twice its length.

    ``gaps`` has (id, src, dst, gap), ``edges`` (src, dst, add): oriented unitigs that follow each
    other, and the bases that the second adds, at least one.  Breadth-first until no chain is open,
    which the length bounds; a gap that ever has more than ``width`` open chains, or several answers,
    gets none.
    """
    front = gaps.select("id", F.col("src").alias("at"), "dst", "gap", F.lit(0).cast("long").alias("n"), F.array(F.col("src")).alias("path"))
    least = F.when(F.col("add") < 1, F.raise_error(F.lit("an edge must add at least one base"))).otherwise(F.col("add"))
    e = edges.select(F.col("src").alias("at"), F.col("dst").alias("to"), least.alias("add"))
    done = crowded = None
    while done is None or not front.isEmpty():
        nxt = front.join(e, "at").where(F.col("n") + F.col("add") <= 2 * F.col("gap"))
        nxt = nxt.select("id", F.col("to").alias("at"), "dst", "gap", (F.col("n") + F.col("add")).alias("n"), F.concat("path", F.array("to")).alias("path"))
        crowd = F.count("*").over(Window.partitionBy("id"))
        level = materialize(nxt.withColumn("c", crowd), "front")
        full = level.where(F.col("c") > width).select("id")
        front = level.where(F.col("c") <= width).drop("c")
        hit = front.where("at = dst").select("id", "path")
        done = hit if done is None else done.unionByName(hit)
        crowded = full if crowded is None else crowded.unionByName(full)
        front = front.where("at <> dst")
    found = done.join(crowded.distinct(), "id", "left_anti")
    return found.groupBy("id").agg(F.count("*").alias("k"), F.first("path").alias("path")).where("k = 1").select("id", "path")


def spanning_tree(edges: list[tuple[str, str, float]], partner: dict[str, str], bond: float = 1000.0) -> list[tuple[str, str, float]]:
    """Edges of a greatest spanning tree grown from the smallest node; the two ends of a contig (``partner``) bond first."""
    near: dict[str, dict[str, float]] = defaultdict(dict)
    for a, b, s in edges:
        near[a][b] = near[b][a] = max(s, near[a].get(b, s))
    for a in list(near):
        if (p := partner.get(a)) is not None:
            near[a][p] = near[p][a] = bond
    out, seen = [], set()
    for root in sorted(near):
        if root in seen:
            continue
        seen.add(root)
        heap = [(-s, root, b) for b, s in near[root].items()]
        heapq.heapify(heap)
        while heap:
            s, a, b = heapq.heappop(heap)
            if b not in seen:
                seen.add(b)
                out.append((a, b, -s))
                for c, t in near[b].items():
                    if c not in seen:
                        heapq.heappush(heap, (-t, b, c))
    return out


def trunk(tree: list[tuple[str, str, float]]) -> list[str]:
    """The longest path of a tree, by nodes; the smallest ends win ties."""
    near: dict[str, list[str]] = defaultdict(list)
    for a, b, _ in tree:
        near[a].append(b)
        near[b].append(a)
    if not near:
        return []

    def far(root: str) -> list[str]:
        before, order = {root: None}, [(0, root)]
        for d, x in order:
            order += [(d + 1, y) for y in near[x] if y not in before and not before.update({y: x})]
        end = min(order, key=lambda z: (-z[0], z[1]))[1]
        path = []
        while end is not None:
            path.append(end)
            end = before[end]
        return path

    return far(far(min(near))[0])


def place_branches(path: list[str], tree: list[tuple[str, str, float]], scores: list[tuple[str, str, float]]) -> list[tuple[str, float]]:
    """Positions of all nodes along the trunk; a node off it stands half a step after the placed node it links best with."""
    at = {x: float(i) for i, x in enumerate(path)}
    rest = {x for a, b, _ in tree for x in (a, b)} - set(path)
    near: dict[str, list[tuple[float, str]]] = defaultdict(list)
    for a, b, s in chain(scores, tree):
        near[a].append((-s, b))
        near[b].append((-s, a))
    # A link becomes open once, when the first of its nodes is placed.
    heap = [(s, x, y) for y in at for s, x in near[y] if x in rest]
    heapq.heapify(heap)
    while heap:
        _, x, y = heapq.heappop(heap)
        if x in rest:
            rest.remove(x)
            at[x] = at[y] + 0.5
            for s, z in near[x]:
                if z in rest:
                    heapq.heappush(heap, (s, z, x))
    return sorted(at.items(), key=lambda z: (z[1], z[0]))


def trees(edges: DataFrame) -> DataFrame:
    """Rows (component, node, position, in_trunk) of each component's spanning tree over edges (a, b, score)."""
    bound_batches(edges.sparkSession)
    e = edges.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), "score")
    e = materialize(e, "links")  # read by every round and by the kernel
    comp = connected_components(e, "a", "b")
    rows = e.join(comp, F.col("a") == F.col("node")).select("component", "a", "b", "score")

    def one(df: pd.DataFrame) -> pd.DataFrame:
        links = list(df[["a", "b", "score"]].sort_values(["a", "b"]).itertuples(index=False, name=None))
        tree = spanning_tree(links, {})
        path = trunk(tree)
        placed, on = place_branches(path, tree, links), set(path)
        return pd.DataFrame([(df.component.iloc[0], n, p, n in on) for n, p in placed], columns=["component", "node", "position", "in_trunk"])

    return per_group(rows, ["component"], one, "component string, node string, position double, in_trunk boolean")


def disjoint_pairs(pairs: DataFrame, a: str, b: str, order: str) -> DataFrame:
    """Pairs taken in ``order`` (unique), each of whose two members no earlier taken pair has.

    In a round every pair goes that comes first among the pairs of both of its members; it
    would be taken in turn as well, as nothing before it shares a member.
    """
    left, out = materialize(pairs.where(F.col(a) != F.col(b)), "pairs"), None
    while out is None or not left.isEmpty():
        ends = left.select(F.col(a).alias("__n"), F.col(order).alias("__o")).unionByName(left.select(F.col(b).alias("__n"), F.col(order).alias("__o")))
        first = ends.groupBy("__n").agg(F.min("__o").alias("__m"))
        side = lambda c: first.select(F.col("__n").alias(c), F.col("__m").alias(f"__m_{c}"))
        now = materialize(left.join(side(a), a).join(side(b), b).where((F.col(order) == F.col(f"__m_{a}")) & (F.col(order) == F.col(f"__m_{b}"))).select(*pairs.columns), "taken")
        out = now if out is None else out.unionByName(now)
        used = now.select(F.col(a).alias("__n")).unionByName(now.select(F.col(b).alias("__n")))
        before, left = left, materialize(left.join(used, F.col(a) == F.col("__n"), "left_anti").join(used, F.col(b) == F.col("__n"), "left_anti"), "pairs")
        release(before)
    return out


def merged_pair(a: Column, b: Column, a1: Column, a2: Column, b1: Column, b2: Column, slack: int = 500) -> Column:
    """Two overlapping contigs as one: a1-a2 and b1-b2 match, 1-based, b reversed if b1 > b2; null if neither end hangs over."""
    turn, nb = b1 > b2, F.length(b)
    s = F.when(turn, reverse_complement(b)).otherwise(b)
    x1, x2 = F.when(turn, nb - b1 + 1).otherwise(b1), F.when(turn, nb - b2 + 1).otherwise(b2)
    fits = {"a_tail": F.length(a) - a2 <= slack, "b_tail": nb - x2 <= slack, "a_head": a1 - 1 <= slack, "b_head": x1 - 1 <= slack}
    joined = lambda x, end, y, start: F.concat(F.substr(x, F.lit(1), end.cast("int")), F.substr(y, start.cast("int") + 1))
    return (
        F.when(fits["a_tail"] & fits["b_head"] & ~fits["b_tail"], joined(a, a2, s, x2))
        .when(fits["b_tail"] & fits["a_head"] & ~fits["b_head"], joined(s, x2, a, a2))
        .when(fits["b_head"] & fits["b_tail"], a)
        .when(fits["a_head"] & fits["a_tail"], s)
    )


def merge_pairs(pairs: DataFrame, contigs: DataFrame, order: str = "i", slack: int = 500) -> DataFrame:
    """(a, b, seq): contigs (name, seq) merged pair by pair in order of ``order``; a merge uses both up.

    ``pairs`` has (a, b, a1, a2, b1, b2) and the order; pairs whose ends do not fit use up nothing.
    """
    side = lambda c: contigs.select(F.col("name").alias(c), F.col("seq").alias(f"seq_{c}"))
    made = pairs.join(side("a"), "a").join(side("b"), "b").withColumn("seq", merged_pair(*(F.col(c) for c in ("seq_a", "seq_b", "a1", "a2", "b1", "b2")), slack))
    return disjoint_pairs(made.where("seq is not null").select(order, "a", "b", "seq"), "a", "b", order).select("a", "b", "seq")


def node_windows(contigs: DataFrame, excluded: DataFrame, size: int, most: int) -> DataFrame:
    """(name, left, right): lengths of the windows at a contig's (name, len) ends that hold ``size`` usable bases.

    Bases in ``excluded`` (name, start, stop) are skipped, up to ``most`` more at each end.
    """
    spans = excluded.groupBy("name").agg(F.collect_list(F.struct(F.col("start").cast("long").alias("a"), F.col("stop").cast("long").alias("b"))).alias("x"))
    rows = contigs.join(spans, "name", "left").withColumn("x", F.coalesce("x", F.array().cast("array<struct<a:bigint,b:bigint>>")))
    rows = rows.withColumn("y", F.transform("x", lambda s: F.struct((F.col("len") - s["b"] + 1).alias("a"), (F.col("len") - s["a"] + 1).alias("b"))))
    # The bases of a span that lie inside the window, and were not skipped before, move the window's end, as far as allowed.
    window = """aggregate(sort_array({0}), named_struct('stop', {1}L, 'at', 0L),
        (acc, s) -> if(greatest(s.a, acc.at + 1) > acc.stop OR s.b <= acc.at, acc,
            named_struct('stop', acc.stop + least(s.b - greatest(s.a, acc.at + 1) + 1, {1}L + {2}L - acc.stop), 'at', s.b)),
        acc -> least(acc.stop, cast(len AS bigint)))"""
    return rows.select("name", F.expr(window.format("x", int(size), int(most))).alias("left"), F.expr(window.format("y", int(size), int(most))).alias("right"))
