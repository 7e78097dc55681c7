"""Exact duplicates by two Bloom passes: only rows that may repeat are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import BLANK_RUN, row_order, text_rows
from curbline.session import stage

CELLS_PER_ROW = 16
# The filter never takes more than 64 MB; with more rows than it suits, more rows shuffle.
MAX_CELLS = 1 << 29
BITMAP_BITS = 1 << 15


def normalized(text: Column) -> Column:
    """Every run of white space as one space."""
    return F.regexp_replace(text, BLANK_RUN, " ")


def filter_cells(rows: int) -> int:
    """A power of two for about ``CELLS_PER_ROW`` cells a row, within the bounds."""
    wanted = max(1, rows) * CELLS_PER_ROW
    return min(MAX_CELLS, max(BITMAP_BITS, 1 << (wanted - 1).bit_length()))


def _cells(key: str, cells: int) -> list[Column]:
    """Two cells from separate bits of the hash of ``key``."""
    digest = F.xxhash64(key)
    return [F.pmod(digest, F.lit(cells)), F.pmod(F.shiftrightunsigned(digest, 32), F.lit(cells))]


def repeated_cells(rows: DataFrame, key: str, cells: int) -> DataFrame:
    """First pass: ``bucket, bitmap`` of the cells that at least two entries fall into.

    Entries are counted by cell before they move, so a group of copies moves as one count a task.
    """
    hits = (rows.select(F.explode(F.array(*_cells(key, cells))).alias("cell"))
            .groupBy("cell").agg(F.count("*").alias("entries")).filter("entries > 1"))
    return (hits.groupBy(F.floor(F.col("cell") / BITMAP_BITS).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.pmod("cell", F.lit(BITMAP_BITS))).alias("bitmap")))


def flag_repeats(rows: DataFrame, key: str, bitmaps: DataFrame, cells: int) -> DataFrame:
    """Second pass: adds ``may_repeat``, true where both cells of a row are taken by others too."""
    columns, flags = rows.columns, []
    for number, cell in enumerate(_cells(key, cells)):
        rows = rows.withColumn(f"cell{number}", cell)
        side = F.broadcast(bitmaps.select(F.col("bucket").alias(f"bucket{number}"), F.col("bitmap").alias(f"bitmap{number}")))
        rows = rows.join(side, F.floor(F.col(f"cell{number}") / BITMAP_BITS) == F.col(f"bucket{number}"), "left")
        place = f"(cell{number} % {BITMAP_BITS})"
        byte = f"cast(conv(hex(substring(bitmap{number}, cast({place} div 8 as int) + 1, 1)), 16, 10) as int)"
        flags.append(f"coalesce(bit_get({byte}, cast({place} % 8 as int)) = 1, false)")
    return rows.select(*columns, F.expr(" and ".join(flags)).alias("may_repeat"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal when identical after replacing runs of white space by one space; null counts
    as empty, and empty texts are equal to each other. Of equal texts the row with the smallest
    ``doc_id`` stays; null ids come last, and of repeated ids the first row of the table stays.
    An empty table gives no rows. Other columns are not read.
    """
    rows = stage(text_rows(docs).select("rid", "doc_id", F.sha2(normalized(F.col("text")), 256).alias("text_sha256")),
                 "exact-rows")
    cells = filter_cells(rows.count())
    flagged = flag_repeats(rows, "text_sha256", repeated_cells(rows, "text_sha256", cells), cells)
    repeats = flagged.filter("may_repeat").select("rid", "doc_id", "text_sha256")
    # Staged, so that the join below deals both sides itself and can split a large group.
    groups = stage(repeats.groupBy("text_sha256").agg(F.min(row_order()).alias("first"), F.count("*").alias("group_size")),
                   "exact-groups")
    grouped = repeats.join(groups, "text_sha256").select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("first.rid")).alias("kept"), "text_sha256")
    single = flagged.filter("not may_repeat").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    return single.unionByName(grouped)


ORACLE_SQL = r"""
with t as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = min(doc_id) over g as kept, text_sha256
from t window g as (partition by text_sha256)
"""
