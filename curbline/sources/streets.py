"""Street-graph tables, clipped to regions.

Nodes are ``city_bfs_id, mode, node_id, lon, lat``; edges ``city_bfs_id, mode, u, v,
length_m``. Both are plain Parquet tables, one graph per region and mode.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.regions import REGIONS, Region

MODES = ("walk", "bike")
# Edges shorter than this are counted as this long, so that no cycle has length zero.
SHORTEST_EDGE_M = 0.001


def read_street_nodes(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema("city_bfs_id int, mode string, node_id bigint, lon double, lat double")
            .parquet(path))


def read_street_edges(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema("city_bfs_id int, mode string, u bigint, v bigint, length_m double")
            .parquet(path))


def clip_nodes(nodes: DataFrame, regions: Sequence[Region] = REGIONS) -> DataFrame:
    """Nodes strictly inside the region they belong to."""
    inside = [(F.col("city_bfs_id") == r.city_bfs_id) & r.contains(F.col("lon"), F.col("lat"))
              for r in regions]
    return nodes.where(reduce(or_, inside))


def clip_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges whose both ends are among ``nodes``."""
    kept = nodes.select("city_bfs_id", "mode", F.col("node_id"))
    head = kept.withColumnRenamed("node_id", "u")
    tail = kept.withColumnRenamed("node_id", "v")
    return (edges.join(head, ["city_bfs_id", "mode", "u"], "left_semi")
            .join(tail, ["city_bfs_id", "mode", "v"], "left_semi")
            .select("city_bfs_id", "mode", "u", "v", "length_m"))


def lightest_edges(edges: DataFrame) -> DataFrame:
    """One edge per ordered node pair: the shortest of parallel ones, none from a node to itself."""
    return (edges.where("u <> v").groupBy("city_bfs_id", "mode", "u", "v")
            .agg(F.greatest(F.min("length_m"), F.lit(SHORTEST_EDGE_M)).alias("length_m")))
