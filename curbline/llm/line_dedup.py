"""Repeated passages of several lines, found as content-defined chunks of lines."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import BLANKS, lean, numbered_rows, restored, row_order, schema_with, slices
from curbline.llm.exact_dedup import filter_cells, flag_repeats, repeated_cells
from curbline.session import stage

# The rolling hash runs over the hashes of this many lines.
WINDOW = 2
MIN_LINES = 2
# One line so many times in a row is a passage of its own, in blocks of MIN_LINES.
RUN = 3
# Texts that a Python worker holds as objects, with their chunks, at once.
TEXTS = 500
_BASE = 0x9E3779B97F4A7C15
_WORD = (1 << 64) - 1


def chunk_spans(lines: list[str], window: int = WINDOW) -> list[tuple[int, int]]:
    """``(first line, line count)`` of the chunks, in order.

    Equal lines in a row count as one here. A boundary lies after a line whose rolling hash, over the
    ``window`` lines up to it, is less than a neighbour's: that depends on ``window + 1`` lines alone, so lines
    put in elsewhere move none, and of any ``window + 1`` lines in a row the last or the one before has one. A
    chunk reaches from the window of one boundary to the next boundary, so that what tells its ends apart
    lies inside it; the ends of a text are boundaries as well. With windows of two lines a chunk has three or
    four, and five lines in a row that stand elsewhere too share a whole one, whatever stands around them.
    """
    firsts = [n for n in range(len(lines)) if not n or lines[n] != lines[n - 1]]
    ends = [*firsts[1:], len(lines)]
    digests = [xxhash.xxh64_intdigest(lines[n].encode()) for n in firsts]
    leaving = pow(_BASE, window, 1 << 64)
    hashes, rolling = [], 0
    for number, digest in enumerate(digests):
        rolling = (rolling * _BASE + digest) & _WORD
        if number >= window:
            rolling = (rolling - digests[number - window] * leaving) & _WORD
        if number >= window - 1:
            hashes.append(rolling)
    last = len(hashes) - 1
    cuts = [k + window - 1 for k, h in enumerate(hashes)
            if k < last and h < hashes[k + 1] or k > 0 and h <= hashes[k - 1]]
    spans, start = [], 0
    for cut in cuts if cuts and cuts[-1] == len(firsts) - 1 else [*cuts, len(firsts) - 1]:
        if cut > start:
            spans.append((firsts[start], ends[cut] - firsts[start]))
        start = cut - window + 1
    return spans


def run_spans(lines: list[str], run: int = RUN) -> list[tuple[int, int]]:
    """Blocks of two lines of the runs of one line, unless it is blank; the last of an odd run has three."""
    spans, first = [], 0
    for _, same in groupby(lines):
        count = sum(1 for _ in same)
        if count >= run and lines[first].strip(BLANKS):
            blocks = count // 2
            spans += [(first + 2 * k, 2 + (count % 2 if k == blocks - 1 else 0)) for k in range(blocks)]
        first += count
    return spans


def _chunks(with_body: bool, window: int, min_lines: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, TEXTS):
            row, at, count, keys, bodies = [], [], [], [], []
            for number, text in enumerate(batch.column("text").to_pylist()):
                lines = text.split("\n")
                if len(lines) < min_lines:
                    continue
                found = [(a, n, n) for a, n in chunk_spans(lines, window) if n >= min_lines]
                found += [(a, n, 2) for a, n in run_spans(lines)]
                for first, size, compared in found:
                    body = "\n".join(lines[first:first + compared])
                    row.append(number)
                    at.append(first)
                    count.append(size)
                    keys.append(xxhash.xxh3_128_digest(body.encode()))
                    if with_body:
                        bodies.append(body)
            picked = batch.select([c for c in batch.schema.names if c != "text"]).take(pa.array(row, pa.int64()))
            columns = [*picked.columns, pa.array(at, pa.int32()), pa.array(count, pa.int32()), pa.array(keys, pa.binary())]
            names = [*picked.schema.names, "at", "size", "key"]
            if with_body:
                columns, names = [*columns, pa.array(bodies, pa.string())], [*names, "body"]
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


@lean
def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Takes the spans in ``drops`` out of the texts."""
    for batch in slices(batches, TEXTS):
        texts, total, removed = [], [], []
        for text, drops in zip(batch.column("text").to_pylist(), batch.column("drops").to_pylist()):
            lines = text.split("\n")
            gone = {n for d in drops or () for n in range(d["at"], d["at"] + d["size"])}
            texts.append("\n".join([line for n, line in enumerate(lines) if n not in gone]) if gone else text)
            total.append(len(lines))
            removed.append(len(gone))
        kept = batch.select([c for c in batch.schema.names if c not in ("text", "drops")])
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(texts, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())],
            [*kept.schema.names, "text", "n_lines", "n_removed"])


def line_dedup(docs: DataFrame, window: int = WINDOW, min_lines: int = MIN_LINES, carry: bool = False) -> DataFrame:
    """``rid, doc_id, text, n_lines, n_removed`` (and ``rest``) for every row: texts without repeated chunks.

    A chunk of at least ``min_lines`` lines that occurs again, in any row or further on in the
    same one, stays where its document has the smallest ``doc_id`` (null ids last, then the order
    of the table, then of the lines) and is taken out elsewhere. Chunks overlap: a line goes when any chunk
    over it goes, and every line that goes stands at an earlier place too, so each stays somewhere. Of a run of
    ``window + 3`` or more lines that stands elsewhere too, all but the line at each end goes for sure. One
    line three times or more in a row is compared by blocks of two: the first block of the table stays. Lines end at a line feed only;
    an empty or null text is one empty line and has no chunk. Two 128-bit hashes that agree for
    different bytes are no repeat: such chunks stay. An empty table gives no rows.
    """
    full = numbered_rows(docs, carry)
    rows = full.select("rid", "doc_id", "text")
    plain = schema_with(rows, ["rid", "doc_id"], "at int, size int, key binary")
    bodied = schema_with(rows, ["rid", "doc_id"], "at int, size int, key binary, body string")
    chunks = stage(rows.mapInArrow(_chunks(False, window, min_lines), plain), "line-chunks")
    cells = filter_cells(chunks.count())
    bodies = rows.mapInArrow(_chunks(True, window, min_lines), bodied)
    # Only bodies whose hash may repeat move; grouping by the bytes is the comparison.
    repeats = flag_repeats(bodies, "key", repeated_cells(chunks, "key", cells), cells).filter("may_repeat")
    order = F.struct(*[row_order()[c].alias(c) for c in ("no_id", "doc_id", "rid")], F.col("at"))
    same = repeats.groupBy("key", "body").agg(F.min(order).alias("first"), F.count("*").alias("copies"))
    groups = stage(same.groupBy("key").agg(F.count("*").alias("bodies"), F.first("first").alias("first"),
                                           F.sum("copies").alias("copies"))
                   .filter("bodies = 1 and copies > 1").select("key", F.col("first.rid").alias("rid0"), F.col("first.at").alias("at0")),
                   "line-groups")
    drops = (chunks.join(groups, "key").filter("not (rid = rid0 and at = at0)")
             .groupBy("rid").agg(F.collect_list(F.struct("at", "size")).alias("drops")))
    kept = ["rid", "doc_id", *(["rest"] if carry else [])]
    joined = full.join(drops, "rid", "left")
    return joined.mapInArrow(_without, schema_with(full, kept, "text string, n_lines long, n_removed long"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated chunks of its texts taken out; all columns and rows stay."""
    return restored(line_dedup(docs, carry=True), docs)
