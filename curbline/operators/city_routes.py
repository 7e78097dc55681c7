"""Shortest paths on large street graphs, over their overlay.

For graphs of some hundred nodes ``routing`` is faster: it searches the graph as it is.

The search runs on the overlay of the street graph (``overlay``): every origin is brought to the border of its
cell, every destination from the border of its own, both inside the cells. Between them there is one label per
(origin, border node), shared by all destinations of an origin. Labels are partitioned by origin, and every round
expands the labels improved last:

* an overlay below the broadcast limit (checked by its row count) joins without a shuffle, so several rounds run
  inside one stage;
* beyond the limit the same rounds join by node with an ordinary shuffle.

A label stops where no destination of its origin can be nearer than what is known: landmarks bound the rest of the
way from below. Pairs in graphs that no edge joins are left out before the search. Node sequences are rebuilt by
pointer jumping over border nodes, and each stretch inside a cell once for all pairs that use it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbline.operators.overlay import FAR, GRAPH, STEPS, Cell, Overlay, build_overlay, by_cell, relax
from curbline.operators.routing import EDGE_BYTES, PAIR, ROUNDS_PER_JOB, _pointers
from curbline.session import broadcast_if_small, stage

LANDMARKS = 16
# A broadcast border node with its landmarks takes about this many bytes in a hash relation.
LANDMARK_BYTES = 600


class _Network:
    """Pairs in node numbers, and their ways inside cells."""

    def __init__(self, pairs: DataFrame, overlay: Overlay, marks: DataFrame | None = None):
        self.overlay, self.marks = overlay, marks
        pairs = pairs.select(*PAIR).distinct()
        # A node is reached from itself, whether the graph has it or not.
        self.still = pairs.where("origin = destination")

        def keyed(df: DataFrame, column: str, key: str) -> DataFrame:
            return df.join(overlay.nodes.select(*GRAPH, F.col("node").alias(column), F.col("key").alias(key), F.col("cell").alias(f"c{key}"),
                                                F.col("root").alias(f"r{key}")), [*GRAPH, column])
        # No edges join nodes of different roots.
        joined = keyed(keyed(pairs.where("origin <> destination"), "origin", "o"), "destination", "d").where("ro = rd")
        self.pairs = stage(joined.drop("ro", "rd"), "pairs")
        self.width = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        none = F.lit(None).cast("long")
        ends = {"exit": ["o"], "entry": ["d"]} if marks is None else {"exit": ["o", "d"], "entry": ["o", "d"]}
        asked = [self.pairs.select(F.col(f"c{key}").alias("cell"), F.lit(kind).alias("kind"), F.col(key).alias("a"), none.alias("b"))
                 for kind, keys in ends.items() for key in keys]
        asked.append(self.pairs.where("co = cd").select(F.col("co").alias("cell"), F.lit("inside").alias("kind"), F.col("o").alias("a"), F.col("d").alias("b")))
        wanted = reduce(DataFrame.unionByName, asked).distinct()
        border = (overlay.borders.join(wanted.select("cell").distinct(), "cell", "left_semi")
                  .select("cell", F.lit("border").alias("kind"), F.col("node").alias("a"), none.alias("b")))
        ways = stage(by_cell(overlay.inner, stage(wanted.unionByName(border), "asked"), _ways, "kind string, a long, b long, w long"), "ways")
        # From a node to the border of its cell, from the border to a node, and from an origin to a destination inside a cell.
        self.exits = ways.where("kind = 'exit'").select(F.col("a").alias("o"), F.col("b").alias("n"), "w")
        self.entries = ways.where("kind = 'entry'").select(F.col("a").alias("n"), F.col("b").alias("d"), "w")
        inside = ways.where("kind = 'inside'").select(F.col("a").alias("o"), F.col("b").alias("d"), "w")
        self.inside = self.pairs.select("o", "d").join(inside, ["o", "d"])
        # ``cap``: no pair's way is longer than this.
        self.searched = self.pairs.select("o", "d", F.lit(FAR).cast("long").alias("cap"))
        if marks is not None:
            self.vectors = stage(self._vectors(), "vectors")
            self.searched = stage(self._possible(), "possible")
        # The ways by which a pair may enter its last cell.
        self.last = stage(self.searched.select("o", "d").join(self.entries, "d"), "last")
        self.outer = broadcast_if_small(overlay.outer, EDGE_BYTES)

    def _vectors(self) -> DataFrame:
        """``node, ahead, back``: distances of origins and destinations to the landmarks and from them."""
        def through(ways: DataFrame, node: str, side: str) -> DataFrame:
            far = ways.join(self.marks.select(F.col("node").alias("n"), side), "n").select(
                F.col(node).alias("node"), F.posexplode(F.transform(side, lambda x: F.least(x + F.col("w"), F.lit(FAR)))).alias("k", "far"))
            least = far.groupBy("node", "k").agg(F.min("far").alias("far"))
            return least.groupBy("node").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "far"))), lambda x: x["far"]).alias(side))
        return through(self.exits, "o", "ahead").join(through(self.entries, "d", "back"), "node", "full").select(
            "node", *(F.coalesce(side, F.array_repeat(F.lit(FAR).cast("long"), LANDMARKS)).alias(side) for side in ("ahead", "back")))

    def _possible(self) -> DataFrame:
        """Pairs but for those that a landmark shows to have no way over the border of a cell; ``cap`` is the shortest way by a landmark."""
        of = lambda key, name: self.vectors.select(F.col("node").alias(key), F.struct("ahead", "back").alias(name))
        joined = self.pairs.select("o", "d").join(of("o", "at"), "o").join(of("d", "to"), "d")
        by = F.array_min(F.zip_with("at.ahead", "to.back", lambda x, y: F.least(x + y, F.lit(FAR))))
        return joined.where(_way_left(F.col("at"), F.col("to.ahead"), F.col("to.back")) < FAR).select("o", "d", by.alias("cap"))


def _way_left(at: Column, ahead: Column, back: Column) -> Column:
    """A lower bound of the way from a node with the distances ``at`` to nodes with these distances.

    It is at least the way to a landmark less the destination's, and the destination's way from it less the
    node's own. Where only the larger of the two is missing there is no way at all.
    """
    def apart(more: Column, less: Column) -> Column:
        return F.when(less >= FAR, F.lit(0).cast("long")).when(more >= FAR, F.lit(FAR).cast("long")).otherwise(more - less)
    return F.greatest(F.lit(0).cast("long"), F.array_max(F.zip_with(at["ahead"], ahead, apart)), F.array_max(F.zip_with(back, at["back"], apart)))


def _ways(edges: pa.Table, rows: pa.Table) -> pa.Table:
    kind, a = rows["kind"].to_numpy(zero_copy_only=False), rows["a"].to_numpy()
    ends, outs, ins = (np.unique(a[kind == k]) for k in ("border", "exit", "entry"))
    pairs = rows.filter(pa.array(kind == "inside"))
    x, y = pairs["a"].to_numpy(), pairs["b"].to_numpy()
    cell = Cell(edges, [a, y])
    out, into = cell.distances(outs), cell.distances(ends)
    found = [("exit", np.repeat(outs, len(ends)), np.tile(ends, len(outs)), out[:, cell.at(ends)].ravel()),
             ("entry", np.repeat(ends, len(ins)), np.tile(ins, len(ends)), into[:, cell.at(ins)].ravel()),
             ("inside", x, y, out[np.searchsorted(outs, x), cell.at(y)])]
    ways = pa.concat_tables([pa.table({"kind": pa.array([k] * len(w), pa.string()), "a": pa.array(s, pa.int64()), "b": pa.array(t, pa.int64()),
                                       "w": pa.array(w, pa.int64())}) for k, s, t, w in found])
    return ways.filter(pa.array(ways["w"].to_numpy() < FAR))


def _round(labels: DataFrame, outer: DataFrame) -> DataFrame:
    """Expand the open labels by one edge and keep the best label per node; a node that this lowers is open."""
    ahead = labels.where("open").join(outer, F.col("n") == F.col("s")).select(
        "o", F.col("t").alias("n"), (F.col("dist") + F.col("w")).alias("dist"), F.lit(None).cast("long").alias("old"))
    best = ahead.unionByName(labels.select("o", "n", "dist", F.col("dist").alias("old"))).groupBy("o", "n").agg(
        F.min("dist").alias("dist"), F.min("old").alias("old"))
    return best.select("o", "n", "dist", (F.col("old").isNull() | (F.col("dist") < F.col("old"))).alias("open"))


def _flood(labels: DataFrame, outer: DataFrame, width: int, closed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Labels ``o, n, dist, open`` expanded until none is open; ``closed`` closes those that lead nowhere, job by job."""
    finished = []
    while True:
        # A fixed number of partitions: labels multiply within a job, so merging partitions
        # by the size they have at its start would leave too few tasks.
        labels = labels.repartition(width, "o")
        for _ in range(ROUNDS_PER_JOB):
            labels = _round(labels, outer)
        labels = stage(closed(stage(labels, "labels")), "labels")
        active = stage(labels.where("open").select("o").distinct(), "active")
        finished.append(labels.join(active, "o", "left_anti").select("o", "n", "dist"))
        if active.isEmpty():
            return stage(reduce(DataFrame.unionByName, finished), "labels")
        labels = labels.join(active, "o", "left_semi")


def _best(net: _Network, labels: DataFrame) -> DataFrame:
    """``o, d, best``: what is known of every searched pair; ``FAR`` where nothing is."""
    over = net.last.join(labels.select("o", "n", "dist"), ["o", "n"]).select("o", "d", (F.col("dist") + F.col("w")).alias("best"))
    inside = net.inside.select("o", "d", F.col("w").alias("best"))
    none = net.searched.select("o", "d", F.lit(FAR).cast("long").alias("best"))
    return over.unionByName(inside).unionByName(none).groupBy("o", "d").agg(F.min("best").alias("best"))


def search(net: _Network) -> DataFrame:
    """Shortest distance from each origin to the border nodes that matter to it: ``o, n, dist``."""
    aims = None
    if net.marks is not None:
        # All destinations of an origin share one bound for each landmark, however many they are.
        spread = net.searched.join(net.vectors.withColumnRenamed("node", "d"), "d")
        aims = stage(spread.groupBy("o").agg(F.array(*[F.max(F.col("ahead")[k]) for k in range(LANDMARKS)]).alias("to_ahead"),
                                             F.array(*[F.min(F.col("back")[k]) for k in range(LANDMARKS)]).alias("to_back")), "aims")
        at = broadcast_if_small(net.marks.select(F.col("node").alias("n"), F.struct("ahead", "back").alias("at")), LANDMARK_BYTES)

    def closed(labels: DataFrame) -> DataFrame:
        """No destination of the origin can be nearer over a closed label than it is known to be."""
        known = _best(net, labels).join(net.searched, ["o", "d"]).groupBy("o").agg(F.max(F.least("best", "cap")).alias("reach"))
        bounded = labels.join(known, "o")
        left = F.lit(0)
        if aims is not None:
            bounded = bounded.join(aims, "o").join(at, "n", "left")
            left = F.coalesce(_way_left(F.col("at"), F.col("to_ahead"), F.col("to_back")), F.lit(0))
        return bounded.select("o", "n", "dist", (F.col("open") & (F.col("dist") + left <= F.col("reach"))).alias("open"))

    starts = net.searched.select("o").distinct().join(net.exits, "o").select("o", "n", F.col("w").alias("dist"), F.lit(True).alias("open"))
    return _flood(starts, net.outer, net.width, closed)


def landmarks(overlay: Overlay) -> DataFrame:
    """``node, ahead, back`` for every border node: its distances to ``LANDMARKS`` landmarks and from them, ``FAR`` for none.

    Landmarks lie in cells as many cells apart as can be, chosen one after another for each part of a graph.
    """
    where = overlay.nodes.select("key", "cell", "root")
    at = overlay.borders.join(where.select(F.col("key").alias("node"), "root"), "node")
    crossing = overlay.outer.join(at.select(F.col("node").alias("s"), F.col("cell").alias("a"), "root"), "s").join(
        at.select(F.col("node").alias("t"), F.col("cell").alias("b")), "t").where("a <> b").select("root", "a", "b").distinct()
    chosen = stage(crossing.groupBy("root").applyInArrow(_spread_cells(LANDMARKS), "root long, k int, cell long"), "landmarks")
    marked = chosen.join(at.groupBy("cell").agg(F.min("node").alias("node")), "cell").select("root", "k", "node")
    marked = stage(marked, "landmarks")
    width = int(overlay.nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = marked.select(F.col("node").alias("o"), F.col("node").alias("n"), F.lit(0).cast("long").alias("dist"), F.lit(True).alias("open")).distinct()
    sides = []
    for side, outer in (("back", overlay.outer.select("s", "t", "w")), ("ahead", overlay.outer.select(F.col("t").alias("s"), F.col("s").alias("t"), "w"))):
        reached = _flood(starts, broadcast_if_small(outer, EDGE_BYTES), width, lambda labels: labels)
        sides.append(reached.join(marked.select(F.col("node").alias("o"), "k"), "o").select(F.col("n").alias("node"), F.lit(side).alias("side"), "k", "dist"))
    found = sides[0].unionByName(sides[1]).groupBy("node").agg(*[
        F.array(*[F.coalesce(F.min(F.when((F.col("side") == side) & (F.col("k") == k), F.col("dist"))), F.lit(FAR)) for k in range(LANDMARKS)]).alias(side)
        for side in ("ahead", "back")])
    return stage(found, "landmarks")


def _spread_cells(count: int):
    """Per part of a graph, cells that are far from each other by the number of cells between them."""
    def run(links: pa.Table) -> pa.Table:
        a, b = links["a"].to_numpy(), links["b"].to_numpy()
        cells = np.unique(np.concatenate([a, b]))
        s, t = np.searchsorted(cells, np.concatenate([a, b])), np.searchsorted(cells, np.concatenate([b, a]))
        order = np.lexsort([s, t])
        s, t = s[order], t[order]

        def away(cell: int) -> np.ndarray:
            reached = np.full((1, len(cells)), FAR, np.int64)
            reached[0, cell] = 0
            return relax(reached, s, t, np.ones(len(s), np.int64))[0]
        chosen = [int(np.argmax(away(0)))]
        nearest = away(chosen[0])
        while len(chosen) < min(count, len(cells)) and nearest.max() > 0:
            chosen.append(int(np.argmax(nearest)))
            nearest = np.minimum(nearest, away(chosen[-1]))
        return pa.table({"root": pa.array([links["root"][0].as_py()] * len(chosen), pa.int64()),
                         "k": pa.array(range(len(chosen)), pa.int32()), "cell": cells[chosen]})
    return run


def _predecessors(net: _Network, labels: DataFrame, reached: DataFrame) -> DataFrame:
    """For every labelled node and every destination: the border node before it on its shortest path, or the origin."""
    node_ids = net.overlay.nodes.select(F.col("key").alias("s"), F.col("node").alias("u"))
    steps = (labels.join(net.outer, F.col("n") == F.col("s")).select("o", F.col("t").alias("n"), (F.col("dist") + F.col("w")).alias("dist"), "u", "s")
             .unionByName(net.exits.join(node_ids.withColumnRenamed("s", "o"), "o").select("o", "n", F.col("w").alias("dist"), "u", F.col("o").alias("s"))))
    ends = (net.last.join(labels, ["o", "n"]).join(node_ids.withColumnRenamed("s", "n"), "n")
            .select("o", F.col("d").alias("n"), (F.col("dist") + F.col("w")).alias("dist"), "u", F.col("n").alias("s"))
            .unionByName(net.inside.join(node_ids.withColumnRenamed("s", "o"), "o").select("o", F.col("d").alias("n"), F.col("w").alias("dist"), "u", F.col("o").alias("s"))))
    known = labels.select("o", "n").unionByName(reached.select("o", F.col("d").alias("n"))).distinct()
    # A node may be both a border node and a destination, and its own border node: such a step leads nowhere.
    return (steps.unionByName(ends).where("n <> s and n <> o").join(known, ["o", "n"], "left_semi").groupBy("o", "n")
            .agg(F.min(F.struct("dist", "u", "s")).alias("best")).select("o", "n", F.col("best.s").alias("back")))


def _follow(reached: DataFrame, pointers: DataFrame) -> DataFrame:
    """``o, d, keys``: the origin, the border nodes passed and the destination of every reached pair."""
    at = reached.select("o", "d", F.col("d").alias("n"), F.array().cast("array<bigint>").alias("nodes"))
    done = []
    while True:
        arrived = F.col("n") == F.col("o")
        done.append(at.where(arrived).select("o", "d", F.concat(F.array("o"), "nodes").alias("keys")))
        moving = at.where(~arrived)
        if moving.isEmpty():
            break
        at = stage(moving.join(pointers, ["o", "n"]).select(
            "o", "d", F.col("back").alias("n"), F.concat("passed", "nodes").alias("nodes")), "follow")
    return reduce(DataFrame.unionByName, done)


def _stretches(edges: pa.Table, rows: pa.Table) -> pa.Table:
    """The nodes after ``a`` on the way to ``b`` inside a cell; of equal ways each step goes back to the smaller id."""
    a, b = rows["a"].to_numpy(), rows["b"].to_numpy()
    cell = Cell(edges, [a, b])
    starts = np.unique(a)
    known = cell.distances(starts)
    order = np.lexsort([cell.u, cell.t])
    s, t, w = cell.s[order], cell.t[order], cell.w[order]
    first = np.searchsorted(t, np.arange(len(cell.keys) + 1))
    keys = []
    for row, end in zip(known[np.searchsorted(starts, a)], cell.at(b)):
        way, start = [], int(np.flatnonzero(row == 0)[0])
        while end != start:
            way.append(int(cell.keys[end]))
            into = slice(first[end], first[end + 1])
            end = int(s[into][np.flatnonzero(row[s[into]] + w[into] == row[end])[0]])
        keys.append(way[::-1])
    return pa.table({"a": a, "b": b, "keys": pa.array(keys, pa.list_(pa.int64()))})


def _reached(net: _Network, labels: DataFrame) -> DataFrame:
    return _best(net, labels).where(F.col("best") < FAR)


def _network(pairs: DataFrame, edges: DataFrame, nodes: DataFrame | None, overlay: Overlay | None, marks: DataFrame | None) -> _Network:
    return _Network(pairs, overlay or build_overlay(edges, nodes), marks)


def shortest_lengths(pairs: DataFrame, edges: DataFrame, nodes: DataFrame | None = None, overlay: Overlay | None = None,
                     marks: DataFrame | None = None) -> DataFrame:
    """Length of the shortest path of each distinct pair; unreachable pairs are left out.

    An ``overlay`` made by ``build_overlay``, and its ``landmarks``, can be given instead of being made here.
    """
    net = _network(pairs, edges, nodes, overlay, marks)
    found = net.pairs.join(_reached(net, search(net)), ["o", "d"]).select(*PAIR, (F.col("best") / STEPS).alias("length_m"))
    return found.unionByName(net.still.select(*PAIR, F.lit(0.0).alias("length_m")))


def shortest_paths(pairs: DataFrame, edges: DataFrame, nodes: DataFrame | None = None, overlay: Overlay | None = None,
                   marks: DataFrame | None = None) -> DataFrame:
    """Vertices of the shortest path of each distinct reachable pair: ``pos`` from 0 and
    ``node_id``, with ``length_m`` of the whole path.

    Of equal lengths, every step from border node to border node goes back to the smaller ``node_id``, and so does
    every step inside a cell, whatever the task layout. A pair whose ends are one node has that single vertex.
    """
    net = _network(pairs, edges, nodes, overlay, marks)
    labels = search(net)
    reached = stage(_reached(net, labels), "reached")
    pointers = stage(_pointers(stage(_predecessors(net, labels, reached), "back")), "pointers")
    hops = _follow(reached, pointers).select("o", "d", F.posexplode("keys").alias("hop", "b"))
    before = W.partitionBy("o", "d").orderBy("hop")
    cells = net.overlay.nodes
    hops = (hops.withColumn("a", F.lag("b").over(before))
            .join(cells.select(F.col("key").alias("b"), "cell"), "b")
            .join(cells.select(F.col("key").alias("a"), F.col("cell").alias("from")), "a", "left"))
    hops = stage(hops, "hops")
    inside = F.col("cell") == F.col("from")
    stretches = stage(by_cell(net.overlay.inner, hops.where(inside).select("cell", "a", "b").distinct(), _stretches,
                              "a long, b long, keys array<long>"), "stretches")
    whole = (hops.join(stretches, ["a", "b"], "left").withColumn("keys", F.coalesce("keys", F.array("b")))
             .groupBy("o", "d").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("hop", "keys"))), lambda x: x["keys"])).alias("keys")))
    vertices = (net.pairs.join(reached, ["o", "d"]).join(whole, ["o", "d"])
                .select(*PAIR, (F.col("best") / STEPS).alias("length_m"), F.posexplode("keys").alias("pos", "key")))
    found = vertices.join(cells.select("key", F.col("node").alias("node_id")), "key").select(*PAIR, "length_m", "pos", "node_id")
    return found.unionByName(net.still.select(*PAIR, F.lit(0.0).alias("length_m"), F.lit(0).alias("pos"), F.col("origin").alias("node_id")))
