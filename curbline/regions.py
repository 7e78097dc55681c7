"""The regions vehicles are observed in, and their assignment to points.

Regions are a short constant list, so assignment is a per-row expansion over literals
instead of a join: it needs no shuffle and no broadcast and stays in one codegen span.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.functions.geo import in_box


@dataclass(frozen=True)
class Region:
    name: str
    city_bfs_id: int
    south: float
    north: float
    west: float
    east: float

    def contains(self, lon: Column, lat: Column) -> Column:
        return in_box(lon, lat, self.south, self.north, self.west, self.east)


# Region name, id, south, north, west, east. The order decides which
# region keeps a stay seen in two overlapping boxes (the last one does).
REGIONS: tuple[Region, ...] = (
    Region("Winterthur", 230, 47.449753, 47.532571, 8.687158, 8.784503),
    Region("Zurich", 261, 47.306, 47.460, 8.420, 8.610),
    Region("Uster", 198, 47.330, 47.375, 8.672, 8.757),
    Region("Effretikon", 296, 47.410, 47.451, 8.659, 8.715),
    Region("Frauenfeld", 4566, 47.534, 47.578, 8.825, 8.946),
    Region("St. Gallen", 3203, 47.388, 47.490, 9.152, 9.443),
    Region("Basel", 2701, 47.465, 47.623, 7.489, 7.703),
    Region("Biel", 371, 47.112, 47.174, 7.203, 7.322),
    Region("Grenchen", 2546, 47.172, 47.217, 7.362, 7.440),
    Region("Bern", 351, 46.900, 47.000, 7.329, 7.542),
)

# A move is a step of more than this; rows are kept this long.
MOVE_THRESHOLD_M = 50.0
RETENTION_DAYS = 400
DEFAULT_REGION = Region("Default", -1, 0.0, 0.0, 0.0, 0.0)


def pick(ids: Sequence[int], regions: Sequence[Region] = REGIONS) -> tuple[Region, ...]:
    wanted = set(ids)
    return tuple(r for r in regions if r.city_bfs_id in wanted)


def in_any(lon: Column, lat: Column, regions: Sequence[Region] = REGIONS) -> Column:
    return reduce(or_, (r.contains(lon, lat) for r in regions))


def assign_regions(df: DataFrame, lon: str = "lon", lat: str = "lat",
                   regions: Sequence[Region] = REGIONS) -> DataFrame:
    """One row per (row, region that strictly contains it); rows outside all are dropped."""
    boxes = F.inline(F.array(*[
        F.struct(F.lit(r.city_bfs_id).alias("city_bfs_id"), F.lit(r.south).alias("_south"),
                 F.lit(r.north).alias("_north"), F.lit(r.west).alias("_west"), F.lit(r.east).alias("_east"))
        for r in regions]))
    return (df.select("*", boxes)
            .where(in_box(F.col(lon), F.col(lat), F.col("_south"), F.col("_north"),
                          F.col("_west"), F.col("_east")))
            .drop("_south", "_north", "_west", "_east"))


def region_rank(city: Column, regions: Sequence[Region] = REGIONS) -> Column:
    """Position of a region in the list; the highest rank wins a shared key."""
    ranks = F.array(*[F.lit(r.city_bfs_id) for r in regions])
    return F.array_position(ranks, city)
