"""What the corpus operators share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.session import broadcast_if_small, small_batches, stage

# The white space that separates words: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# Plans that give the rows of one scan as they stand in its files.
_SCANS = {"LogicalRelation", "Project", "Filter", "SubqueryAlias"}
# Rows of a file, as bits of a row id; the bits above number the files.
_FILE_ROWS = 40


def text_rows(docs: DataFrame, carry: bool = False) -> DataFrame:
    """``rid, doc_id, text``: one row each, null text as empty, other columns left out.

    ``rid`` tells rows with equal or null ids apart within one plan. It follows the split of the scan, so another
    plan may number the rows otherwise: what joins results by it takes ``numbered_rows`` or stages these rows first.
    ``carry`` adds ``rest``, a struct of all columns but the text, which cannot clash with a name used here;
    ``restored`` unpacks it.
    """
    return docs.select(F.monotonically_increasing_id().alias("rid"), *_text(docs, carry))


def _text(docs: DataFrame, carry: bool) -> list[Column]:
    # Every corpus operator takes its texts from here.
    small_batches(docs.sparkSession)
    rest = [F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("rest")] if carry else []
    return [F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *rest]


def numbered_rows(docs: DataFrame, carry: bool = False) -> DataFrame:
    """``text_rows`` with a ``rid`` that stays the same however a later plan splits the scan.

    It is made of the file's number, in the order of the paths, and the row's place in the file. A frame
    that is no plain scan of files is staged first.
    """
    columns = _text(docs, carry)
    placed = _placed(docs, columns)
    if placed is None:
        placed = _placed(stage(docs, "rows"), columns)
    # One row for each file, which the driver lists anyway.
    files = stage(placed.select("_path").distinct().withColumn("_file", F.row_number().over(Window.orderBy("_path"))), "row-files")
    rid = F.shiftleft(F.col("_file").cast("long"), _FILE_ROWS) + F.col("_seat")
    kept = [c for c in placed.columns if c not in ("_path", "_seat")]
    return placed.join(broadcast_if_small(files, 400), "_path").select(rid.alias("rid"), *kept)


def _placed(docs: DataFrame, columns: list[Column]) -> DataFrame | None:
    """The columns with ``_path`` and ``_seat``, or None where a row's place in a file is not known."""
    def nodes(plan) -> list[str]:
        below = plan.children()
        return [plan.getClass().getSimpleName(), *(n for k in range(below.size()) for n in nodes(below.apply(k)))]

    if not set(nodes(docs._jdf.queryExecution().analyzed())) <= _SCANS:
        return None
    try:
        place = docs.metadataColumn("_metadata")
        return docs.select(place["file_path"].alias("_path"), place["row_index"].alias("_seat"), *columns)
    except AnalysisException:
        return None


def restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from ``rest`` and the new ``text``; ``n_chars``, where there is one, follows the text."""
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("text"))
        elif c == "n_chars":
            columns.append(F.length("text").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col("rest")[c].alias(c))
    return rows.select(*columns)


def row_order(doc_id: str = "doc_id", rid: str = "rid") -> Column:
    """Smallest id first, null ids last, then the order of the table."""
    return F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("doc_id"), F.col(rid).alias("rid"))


def schema_with(df: DataFrame, columns: list[str], added: str) -> T.StructType:
    """The schema of some columns of ``df``, followed by ``added`` (DDL)."""
    more = T.StructType.fromDDL(added)
    return T.StructType([df.schema[c] for c in columns] + more.fields)


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most so many rows, so that a worker holds few texts as Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def lean(work: Callable) -> Callable:
    """``work`` for ``mapInArrow``, such that its worker gives back what Arrow has freed after each batch.

    Arrow keeps freed memory for itself, and a worker lives on into the next job, so what one step
    took at most would stay with the executor for all that follow.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in work(batches):
            yield made
            del made
            pa.default_memory_pool().release_unused()
        pa.default_memory_pool().release_unused()
    return run


def worker_cache(name: tuple, make: Callable):
    """An object that a Python worker makes once and keeps for its later tasks."""
    kept = sys.modules.setdefault("_curbline_worker_cache", types.ModuleType("_curbline_worker_cache")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]
