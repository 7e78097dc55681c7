"""Shortest paths by edge length for many origin-destination pairs at once.

The search is one label per (region, mode, origin, node), shared by all destinations of
an origin, so its size is bounded by the street graph and not by the number of trips.
Labels are partitioned by origin, and every round expands the labels improved last:

* an edge table below the broadcast limit (checked by its row count) joins without a
  shuffle, so several rounds run inside one stage;
* beyond the limit the same rounds join by node with an ordinary shuffle.

An origin stops expanding labels that lie farther than its farthest destination. Node
sequences are rebuilt afterwards by pointer jumping, which takes a logarithmic number of
joins to build the pointers and a few more to follow them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbline.functions.geo import line_length, line_or_null, point
from curbline.session import broadcast_if_small, stage
from curbline.sources.streets import lightest_edges

PAIR = ("city_bfs_id", "mode", "origin", "destination")
# Expansion rounds per job, and pointer doublings before paths are followed.
ROUNDS_PER_JOB = 6
DOUBLINGS = 3
# A broadcast edge takes about this many bytes in a hash relation.
EDGE_BYTES = 80

INFINITE = float("inf")


def _node_keys(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """One number per (region, mode, node), so that labels are plain longs. Written once,
    which fixes the numbers for every later job."""
    ends = edges.select("city_bfs_id", "mode", F.explode(F.array("u", "v")).alias("node"))
    asked = pairs.select("city_bfs_id", "mode", F.explode(F.array("origin", "destination")).alias("node"))
    return stage(ends.unionByName(asked).distinct().withColumn("key", F.monotonically_increasing_id()), "keys")


def _keyed(df: DataFrame, keys: DataFrame, column: str, key: str) -> DataFrame:
    return df.join(keys.select("city_bfs_id", "mode", F.col("node").alias(column), F.col("key").alias(key)),
                   ["city_bfs_id", "mode", column])


class _Network:
    """Pairs and edges in node numbers, and the joins that expand labels along edges."""

    def __init__(self, pairs: DataFrame, edges: DataFrame):
        edges = stage(lightest_edges(edges), "edges")
        pairs = stage(pairs.select(*PAIR).distinct(), "pairs")
        keys = _node_keys(pairs, edges)
        self.keys = keys
        self.pairs = stage(_keyed(_keyed(pairs, keys, "origin", "o"), keys, "destination", "d"), "pairs")
        self.edges = stage(_keyed(_keyed(edges, keys, "u", "s"), keys, "v", "t").select("s", "t", "length_m", "u"), "edges")
        # Edges plus a zero-length step from every node to itself, which keeps its label.
        self.expansion = broadcast_if_small(self.edges.drop("u").unionByName(
            keys.select(F.col("key").alias("s"), F.col("key").alias("t"), F.lit(0.0).alias("length_m"))), EDGE_BYTES)
        self.edges = broadcast_if_small(self.edges, EDGE_BYTES)
        self.width = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _round(labels: DataFrame, expansion: DataFrame) -> DataFrame:
    """Expand the open labels by one edge and keep the best label per node."""
    own = F.col("s") == F.col("t")
    joined = labels.join(expansion, (F.col("n") == F.col("s")) & (F.col("open") | own))
    reached = joined.select(
        "o", F.col("t").alias("n"), (F.col("dist") + F.col("length_m")).alias("dist"),
        F.when(own, F.col("dist")).alias("old"), (own & F.col("target")).alias("target"))
    best = reached.groupBy("o", "n").agg(
        F.min("dist").alias("dist"), F.min("old").alias("old"), F.max("target").alias("target"))
    return best.select("o", "n", "dist",
                       (F.col("dist") < F.coalesce("old", F.lit(INFINITE))).alias("open"), "target")


def _settle(labels: DataFrame) -> DataFrame:
    """Close labels that are not nearer than the farthest destination of their origin, and
    mark the origins that still have an open one. Labels too far to matter are dropped
    once their origin is done."""
    by_origin = W.partitionBy("o")
    farthest = F.max(F.when(F.col("target"), F.col("dist"))).over(by_origin)
    return (labels.withColumn("reach", farthest)
            .withColumn("open", F.col("open") & (F.col("dist") < F.col("reach")))
            .withColumn("active", F.max("open").over(by_origin))
            .where(F.col("active") | ((F.col("dist") <= F.col("reach")) & (F.col("dist") < INFINITE)))
            .drop("reach"))


def _search(net: _Network) -> DataFrame:
    """Shortest distance from each origin to the nodes around it: ``o, n, dist``."""
    targets = net.pairs.select("o", F.col("d").alias("n"), F.lit(INFINITE).alias("dist"),
                               F.lit(False).alias("open"), F.lit(True).alias("target"))
    starts = net.pairs.select("o").distinct().select(
        "o", F.col("o").alias("n"), F.lit(0.0).alias("dist"),
        F.lit(True).alias("open"), F.lit(False).alias("target"))
    labels = targets.unionByName(starts).groupBy("o", "n").agg(
        F.min("dist").alias("dist"), F.max("open").alias("open"), F.max("target").alias("target"))
    finished = []
    while True:
        # A fixed number of partitions: labels multiply within a job, so merging partitions
        # by the size they have at its start would leave too few tasks.
        labels = labels.repartition(net.width, "o")
        for _ in range(ROUNDS_PER_JOB):
            labels = _round(labels, net.expansion)
        labels = stage(_settle(labels), "labels")
        finished.append(labels.where(~F.col("active")).select("o", "n", "dist"))
        labels = labels.where("active").drop("active")
        if labels.isEmpty():
            return reduce(DataFrame.unionByName, finished)


def _predecessors(labels: DataFrame, net: _Network) -> DataFrame:
    """For every reached node but the origin: the previous node on its shortest path."""
    step = labels.join(net.edges, F.col("n") == F.col("s"))
    return (step.where(F.col("t") != F.col("o")).groupBy("o", F.col("t").alias("n"))
            .agg(F.min(F.struct((F.col("dist") + F.col("length_m")).alias("dist"), "u", "s")).alias("best"))
            .select("o", "n", F.col("best.s").alias("back")))


def _pointers(predecessors: DataFrame) -> DataFrame:
    """Pointers 2^DOUBLINGS nodes back (or to the origin) with the nodes passed on the way."""
    jump = predecessors.select("o", "n", "back", F.array("n").alias("passed"))
    for _ in range(DOUBLINGS):
        onward = jump.select("o", F.col("n").alias("back"), F.col("back").alias("back2"),
                             F.col("passed").alias("passed2"))
        jump = jump.join(onward, ["o", "back"], "left").select(
            "o", "n", F.coalesce("back2", "back").alias("back"),
            F.when(F.col("passed2").isNull(), F.col("passed"))
            .otherwise(F.concat("passed2", "passed")).alias("passed"))
    return jump


def _follow(net: _Network, labels: DataFrame, pointers: DataFrame) -> DataFrame:
    """Node sequence of every reachable pair, from origin to destination."""
    at = _reached(net, labels).withColumns(
        {"n": F.col("d"), "nodes": F.array().cast("array<bigint>")})
    done = []
    while True:
        arrived = F.col("n") == F.col("o")
        done.append(at.where(arrived).select(*PAIR, "length_m", F.concat(F.array("o"), "nodes").alias("keys")))
        moving = at.where(~arrived)
        if moving.isEmpty():
            break
        at = stage(moving.join(pointers, ["o", "n"]).select(
            *PAIR, "length_m", "o", F.col("back").alias("n"), F.concat("passed", "nodes").alias("nodes")), "follow")
    return reduce(DataFrame.unionByName, done)


def _reached(net: _Network, labels: DataFrame) -> DataFrame:
    found = labels.select("o", F.col("n").alias("d"), F.col("dist").alias("length_m"))
    return net.pairs.join(found, ["o", "d"])


def shortest_lengths(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Length of the shortest path of each distinct pair; unreachable pairs are left out."""
    net = _Network(pairs, edges)
    return _reached(net, _search(net)).select(*PAIR, "length_m")


def shortest_paths(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertices of the shortest path of each distinct reachable pair: ``pos`` from 0 and
    ``node_id``, with ``length_m`` of the whole path.

    Among equal lengths every step goes back to the smaller ``node_id``, whatever the task layout. A pair whose ends are one node has that
    single vertex.
    """
    net = _Network(pairs, edges)
    labels = _search(net)
    pointers = stage(_pointers(stage(_predecessors(labels, net), "back")), "pointers")
    vertices = _follow(net, labels, pointers).select(*PAIR, "length_m", F.posexplode("keys").alias("pos", "key"))
    return vertices.join(net.keys.select("key", F.col("node").alias("node_id")), "key").drop("key")


def path_lines(vertices: DataFrame, nodes: DataFrame) -> DataFrame:
    """The line through each path's nodes and its length in LV03 metres.

    A path of one node has no line and no length.
    """
    where = nodes.select("city_bfs_id", "mode", "node_id", point(F.col("lon"), F.col("lat")).alias("at"))
    return (vertices.join(where, ["city_bfs_id", "mode", "node_id"])
            .groupBy(*PAIR).agg(F.first("length_m").alias("length_m"),
                                F.array_sort(F.collect_list(F.struct("pos", "at"))).alias("vertices"))
            .select(*PAIR, "length_m", line_or_null(F.transform("vertices", lambda v: v["at"])).alias("line"))
            .withColumn("line_m", line_length(F.col("line"))))


def pairs_from(stays: DataFrame, modes: tuple[str, ...], extra: tuple[Column, ...] = ()) -> DataFrame:
    """One pair per stay and mode: the previous stay's node (its own for the first) and its node."""
    return stays.select("city_bfs_id", *extra, F.inline(F.array(*[
        F.struct(F.lit(m).alias("mode"),
                 F.coalesce(F.col(f"previous.node_{m}"), F.col(f"node_{m}")).alias("origin"),
                 F.col(f"node_{m}").alias("destination")) for m in modes])))
