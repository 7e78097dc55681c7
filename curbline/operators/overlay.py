"""A street graph cut into cells, and the graph of the nodes at which cells meet.

Built once per graph. Nodes are put in order along a Z curve over their positions (by id without positions)
and cut into cells of at most ``CELL_NODES``. A cell's border nodes have an edge from or to another cell. The
overlay holds the edges between cells and, as shortcuts, the distances between border nodes inside a cell, so a
route is one way inside the first cell, a few overlay edges, and one way inside the last. Lengths are whole
numbers of ``UNIT`` metres from here on: sums are exact, whatever the order they are made in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbline.session import broadcast_if_small, stage
from curbline.sources.streets import lightest_edges

CELL_NODES = 256
# Steps of a metre; the longest route is 2**63 of them, about 134,000 km.
STEPS = float(1 << 36)
# Longer than any route, and small enough to be added up twice.
FAR = 1 << 61
# Bits a coordinate has on the Z curve: about a metre around the globe.
BITS = 25

GRAPH = ("city_bfs_id", "mode")


class Overlay(NamedTuple):
    """Tables of one or more graphs; a graph is a (region, mode).

    nodes: city_bfs_id, mode, node, key, cell, root (the same for nodes that edges join, whatever their direction)
    inner: cell, s, t, w, u (the id of ``s``), edges inside cells
    outer: s, t, w, u, edges of the overlay, shortcuts among them
    borders: cell, node (a key)
    """

    nodes: DataFrame
    inner: DataFrame
    outer: DataFrame
    borders: DataFrame


def ranked(rows: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``key``, numbers that ascend by ``group`` and ``order``, and ``place``, from 0 within the group.

    Dealt by ranges, so a group may lie on many tasks; only row counts of a range and group are brought together.
    """
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage(rows.repartitionByRange(count, *group, *order).sortWithinPartitions(*group, *order)
                  .withColumn("part", F.spark_partition_id()).withColumn("key", F.monotonically_increasing_id()), "ranked")
    earlier = W.partitionBy(*group).orderBy("part")
    runs = (dealt.groupBy(*group, "part").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("held"))
            .select(*group, "part", "first", (F.sum("held").over(earlier) - F.col("held")).alias("before")))
    return (dealt.join(broadcast_if_small(stage(runs, "ranked"), 100), [*group, "part"])
            .withColumn("place", F.col("key") - F.col("first") + F.col("before")).drop("part", "first", "before"))


def z_order(lon: Column, lat: Column) -> Column:
    """The place of a position on a Z curve around the globe."""
    def spread(at: Column, span: float) -> Column:
        x = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (at + span / 2) / span)) * float((1 << BITS) - 1)
        x = F.floor(x).cast("long")
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                            (2, 0x3333333333333333), (1, 0x5555555555555555)):
            x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
        return x
    return spread(lon, 360.0).bitwiseOR(F.shiftleft(spread(lat, 180.0), 1))


def relax(reached: np.ndarray, s: np.ndarray, t: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Shortest distances, a row for each start: ``reached`` lowered along the edges until nothing changes."""
    if not len(s):
        return reached
    order = np.argsort(t, kind="stable")
    s, t, w = s[order], t[order], w[order]
    starts = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
    ends = t[starts]
    while True:
        lower = np.minimum(reached[:, ends], np.minimum.reduceat(reached[:, s] + w, starts, axis=1))
        if (lower == reached[:, ends]).all():
            return np.minimum(reached, FAR)
        reached[:, ends] = lower


class Cell:
    """The edges inside a cell, with its nodes numbered from 0."""

    def __init__(self, edges: pa.Table, nodes: Sequence[np.ndarray]):
        s, t = edges["s"].to_numpy(), edges["t"].to_numpy()
        self.keys = np.unique(np.concatenate([s, t, *nodes]))
        self.s, self.t, self.w, self.u = self.at(s), self.at(t), edges["w"].to_numpy(), edges["u"].to_numpy()

    def at(self, keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, keys)

    def distances(self, starts: np.ndarray) -> np.ndarray:
        """From each of the keys to all nodes."""
        reached = np.full((len(starts), len(self.keys)), FAR, np.int64)
        reached[np.arange(len(starts)), self.at(starts)] = 0
        return relax(reached, self.s, self.t, self.w)


def by_cell(inner: DataFrame, asked: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``work`` on the edges and the rows of ``asked`` of each cell that ``asked`` names; both are bounded by the cell's size."""
    def run(edges: pa.Table, rows: pa.Table) -> pa.Table:
        return work(edges, rows)
    wanted = inner.join(asked.select("cell").distinct(), "cell", "left_semi")
    return wanted.groupBy("cell").cogroup(asked.groupBy("cell")).applyInArrow(run, schema)


def _shortcuts(edges: pa.Table, rows: pa.Table) -> pa.Table:
    """Distances between border nodes, but for those that lead over a third one."""
    ends = rows["node"].to_numpy()
    cell = Cell(edges, [ends])
    known = cell.distances(ends)[:, cell.at(ends)]
    direct = known < FAR
    np.fill_diagonal(direct, False)
    for k in range(len(ends)):
        over = known[:, k:k + 1] + known[k:k + 1, :] <= known
        over[k, :] = over[:, k] = False
        direct &= ~over
    a, b = np.nonzero(direct)
    ids = dict(zip(rows["node"].to_pylist(), rows["id"].to_pylist()))
    return pa.table({"s": ends[a], "t": ends[b], "w": known[a, b], "u": pa.array([ids[k] for k in ends[a].tolist()], pa.int64())})


def _parts(edges: pa.Table, rows: pa.Table) -> pa.Table:
    """For each node of a cell the least node that edges inside it join it with."""
    cell = Cell(edges, [rows["node"].to_numpy()])
    least = np.arange(len(cell.keys))
    while True:
        before = least.copy()
        low = np.minimum(least[cell.s], least[cell.t])
        np.minimum.at(least, cell.s, low)
        np.minimum.at(least, cell.t, low)
        least = least[least]
        if (least == before).all():
            return pa.table({"node": cell.keys, "part": cell.keys[least]})


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of the links (``a``, ``b``): the least node it is joined with."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = stage(both, "links")
    roots = stage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root")).withColumnRenamed("a", "node"), "roots")
    while True:
        # The least root next to a node, then the root of that root.
        near = (both.join(roots.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near")))
        lower = stage(roots.join(near, "node").withColumn("lower", F.least("root", "near")), "roots")
        hooked = lower.groupBy("root").agg(F.min("lower").alias("hook"))
        higher = hooked.select(F.col("root").alias("hook"), F.col("hook").alias("further"))
        jumped = hooked.join(higher, "hook", "left").select("root", F.coalesce("further", "hook").alias("to"))
        step = stage(lower.join(jumped, "root").select("node", F.least("lower", "to").alias("new"), "root"), "roots")
        changed = not step.where("new <> root").isEmpty()
        roots = step.select("node", F.col("new").alias("root"))
        if not changed:
            return roots


def build_overlay(edges: DataFrame, nodes: DataFrame | None = None, cell_nodes: int = CELL_NODES) -> Overlay:
    """The overlay of all graphs in ``edges``; ``nodes`` (with lon and lat) makes cells of nodes close to each other."""
    edges = stage(lightest_edges(edges), "edges")
    ends = edges.select(*GRAPH, F.explode(F.array("u", "v")).alias("node")).distinct()
    if nodes is None:
        ends = ends.withColumn("z", F.lit(0).cast("long"))
    else:
        where = nodes.groupBy(*GRAPH, F.col("node_id").alias("node")).agg(F.min(z_order(F.col("lon"), F.col("lat"))).alias("z"))
        ends = ends.join(where, [*GRAPH, "node"], "left").withColumn("z", F.coalesce("z", F.lit(0).cast("long")))
    placed = ranked(ends, GRAPH, ["z", "node"])
    first = W.partitionBy(*GRAPH, F.floor(F.col("place") / cell_nodes))
    named = stage(placed.withColumn("cell", F.min("key").over(first)).select(*GRAPH, "node", "key", "cell"), "cells")

    def keyed(df: DataFrame, column: str, key: str, cell: str) -> DataFrame:
        return df.join(named.select(*GRAPH, F.col("node").alias(column), F.col("key").alias(key), F.col("cell").alias(cell)), [*GRAPH, column])
    length = F.round(F.col("length_m") * STEPS).cast("long")
    numbered = stage(keyed(keyed(edges, "u", "s", "cell"), "v", "t", "other").select("cell", "other", "s", "t", length.alias("w"), "u", "v"), "edges")
    inner = stage(numbered.where("cell = other").select("cell", "s", "t", "w", "u"), "inner")
    between = numbered.where("cell <> other")
    borders = stage(between.select(F.inline(F.array(F.struct("cell", F.col("s").alias("node"), F.col("u").alias("id")),
                                                    F.struct(F.col("other").alias("cell"), F.col("t").alias("node"), F.col("v").alias("id")))))
                    .distinct(), "borders")
    shortcuts = by_cell(inner, borders, _shortcuts, "s long, t long, w long, u long")
    outer = stage(between.select("s", "t", "w", "u").unionByName(shortcuts), "outer")
    parts = stage(by_cell(inner, named.select("cell", F.col("key").alias("node")), _parts, "node long, part long"), "parts")
    part_of = lambda column, name: parts.select(F.col("node").alias(column), F.col("part").alias(name))
    links = between.select("s", "t").join(part_of("s", "a"), "s").join(part_of("t", "b"), "t").select("a", "b")
    roots = components(links)
    rooted = (named.join(part_of("key", "part"), "key").join(roots.withColumnRenamed("node", "part"), "part", "left")
              .select(*GRAPH, "node", "key", "cell", F.coalesce("root", "part").alias("root")))
    return Overlay(stage(rooted, "overlay-nodes"), inner, outer, borders.select("cell", "node"))
