"""Removes every byte of a 400-byte string that starts anywhere else, by sorting suffixes bucket by bucket.

A bucket holds the windows that choose the same 64-byte anchor, the least by hash of all 64-byte
strings inside the window. Equal windows choose the same anchor at the same place, so they meet in
one bucket, counted from the anchor at the same position. There the positions that are multiples of
40 are a difference cover for every pair that can tie: their suffixes are ranked first, by blocks
and by doubling, and a window is then a cover suffix of known rank with at most 40 bytes around it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import lean, numbered_rows, restored, schema_with, slices
from curbline.session import settled, stage

LENGTH = 400
GRAM = 64
STEP = 40
# A passage of more words than this is long too; every word is WORD bytes of its hash when passages of words are compared.
WORDS = 50
WORD = 8
# A bucket with more different contexts than this is divided before it is sorted.
CROWD = 1000
# Windows hashed, and bytes of contexts sorted, in one go.
BLOCK = 1 << 18
SORTED_BYTES = 8 << 20
# Kinds of cover suffixes whose windows, at most STEP each, are sorted in one go; the bytes beside them take 5 MB.
SORTED_KINDS = 1 << 12
# Texts that a Python worker holds as objects at once.
TEXTS = 500
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    steps = np.full(count, _BASE)
    back = np.full(count, _INVERSE)
    steps[0] = back[0] = 1
    return np.cumprod(steps, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)


def anchors(data: np.ndarray, length: int, gram: int, powers: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple]:
    """``(at, first, last, hash)`` arrays, block by block: windows ``first`` to ``last`` choose the gram at ``at``."""
    width = length - gram + 1
    place_bits = np.uint64(19)
    for begin in range(0, len(data) - length + 1, BLOCK):
        part = data[begin:begin + BLOCK + length - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers[0][:len(part)], out=sums[1:])
        grams = (sums[gram:] - sums[:-gram]) * powers[1][:len(part) - gram + 1]
        grams ^= grams >> np.uint64(29)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
        grams ^= grams >> np.uint64(32)
        # Of equal grams the first in the window is chosen.
        keys = (grams >> place_bits << place_bits) | np.arange(len(grams), dtype=np.uint64)
        short = -len(keys) % width
        table = np.append(keys, np.full(short, ~np.uint64(0))).reshape(-1, width)
        ahead = np.minimum.accumulate(table, axis=1).ravel()
        behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
        count = len(keys) - width + 1
        chosen = (np.minimum(behind[:count], ahead[width - 1:width - 1 + count]) & ((np.uint64(1) << place_bits) - np.uint64(1))).astype(np.int64)
        first = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
        last = np.append(first[1:], count) - 1
        at = chosen[first]
        yield at + begin, first + begin, last + begin, grams[at].view(np.int64)


def word_codes(text: str) -> bytes:
    """The hashes of the words, one after another, so that ``WORDS`` words are always ``WORD * WORDS`` bytes."""
    return b"".join(map(xxhash.xxh64_digest, text.encode().split()))


def _find_anchors(length: int, gram: int, code=str.encode):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _powers(BLOCK + length)
        for batch in slices(batches, TEXTS):
            found: list[tuple] = []
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("text").to_pylist()):
                data = np.frombuffer(code(text), np.uint8)
                for part in anchors(data, length, gram, powers) if len(data) >= length else ():
                    found.append((np.full(len(part[0]), rid), *part))
            columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rid", "at", "first", "last", "gram"])
    return run


def _contexts(length: int, code=str.encode):
    """Rows ``rid, text, marks`` to one row a mark, with the bytes its windows cover."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 500):
                batch = whole.slice(start, 500)
                out: list[tuple] = []
                for rid, text, marks in zip(*[batch.column(c).to_pylist() for c in ("rid", "text", "marks")]):
                    data = code(text)
                    for mark in marks:
                        at, first, last = mark["at"], mark["first"], mark["last"]
                        context = data[first:last + length]
                        digest = xxhash.xxh3_128_digest(context + (at - first).to_bytes(4, "big"))
                        out.append((rid, first, mark["gram"], at - first, digest, context))
                columns = list(zip(*out)) or [()] * 6
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 ["rid", "first", "gram", "lead", "digest", "context"])
    return run


def dense_rank(*columns: np.ndarray) -> np.ndarray:
    """Ranks from 0 by the columns, the first counting most; equal rows have equal ranks."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for column in columns:
        ordered = column[order]
        new[1:] |= ordered[1:] != ordered[:-1]
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def _words(data: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """The ``STEP`` bytes at each start as big-endian numbers, which sort as the bytes do."""
    rows = np.lib.stride_tricks.sliding_window_view(data, STEP)[starts]
    return list(np.ascontiguousarray(rows).view(">u8").astype(np.uint64).T)


def repeated_windows(grams: np.ndarray, leads: np.ndarray, contexts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each context, which of its windows also start in another one of the same bucket (``gram``).

    All contexts are laid side by side so that their anchors are multiples of ``STEP`` from the
    cover positions; bytes outside a context are padding that no window reaches.
    """
    if not contexts:
        return []
    blocks = length // STEP - 1  # of the cover suffix every window holds
    sizes = np.array([len(c) for c in contexts])
    windows = sizes - length + 1
    # A context starts so many bytes after a cover position.
    shift = (-leads) % STEP
    room = -(-(shift + sizes + 2 * STEP) // STEP) * STEP
    base = np.cumsum(room) - room + STEP
    data = np.zeros(int(room.sum()) + 2 * STEP, np.uint8)
    for context, begin in zip(contexts, base + shift):
        data[begin:begin + len(context)] = np.frombuffer(context, np.uint8)
    flags = [np.zeros(count, bool) for count in windows]

    # Ranks of the cover suffixes, by blocks of STEP bytes and then by doubling.
    cover = np.arange(0, len(data) - STEP + 1, STEP)
    block = dense_rank(*_words(data, cover))
    rank, held = block, 1
    for size in _doublings(blocks):
        ahead = np.append(rank, np.full(held, -1))[held:held + len(rank)] if size == 2 * held else np.append(block, np.full(held, -1))[held:held + len(rank)]
        rank, held = dense_rank(rank, ahead), size

    # Per context: the cover positions that some window has as its next one.
    origin = base  # a cover position at or before the context's start
    lowest = np.where(shift > 0, 1, 0)
    highest = -(-(shift + windows - 1) // STEP)
    count = highest - lowest + 1
    owner = np.repeat(np.arange(len(contexts)), count)
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lowest, count)
    place = origin[owner] + step * STEP
    from_anchor = step * STEP - shift[owner] - leads[owner]
    # Window ``place - back`` for back in low..high exists in the context.
    low = np.maximum(0, step * STEP - shift[owner] - (windows[owner] - 1))
    high = np.minimum(STEP - 1, step * STEP - shift[owner])
    group = dense_rank(grams[owner], from_anchor, rank[place // STEP])
    shared = np.bincount(group)[group] > 1
    owner, step, place, low, high, group = (x[shared] for x in (owner, step, place, low, high, group))
    if not len(owner):
        return flags
    left, right = _words(data, place - STEP), _words(data, place + blocks * STEP)
    # Cover suffixes with the same bytes all around: every window of theirs repeats.
    kind = dense_rank(group, low, high, *left, *right)
    alike = np.bincount(kind)[kind] > 1
    for at in np.flatnonzero(alike):
        begin = place[at] - base[owner[at]] - shift[owner[at]]
        flags[owner[at]][begin - high[at]:begin - low[at] + 1] = True
    # Groups with several kinds: sort the windows by their rank and the STEP bytes around it.
    _, one = np.unique(kind, return_index=True)
    several = np.bincount(group[one])[group] > 1
    kinds = one[np.bincount(group[one])[group[one]] > 1]
    hit: dict[int, list[int]] = {}
    for part in _whole_groups(kinds, group, SORTED_KINDS):
        span = high[part] - low[part] + 1
        who = np.repeat(part, span)
        back = np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span) + np.repeat(low[part], span)
        around = np.concatenate([
            np.lib.stride_tricks.sliding_window_view(data, STEP)[place[part] - STEP],
            np.lib.stride_tricks.sliding_window_view(data, STEP)[place[part] + blocks * STEP]], axis=1)
        line = np.repeat(np.arange(len(part)), span)
        # STEP bytes for each window, picked by row and start, not by an index for every byte.
        beside = np.lib.stride_tricks.sliding_window_view(around, STEP, axis=1)[line, STEP - back]
        words = list(np.ascontiguousarray(beside).view(">u8").astype(np.uint64).T)
        same = dense_rank(group[who], back, *words)
        for w, b in zip(who[np.bincount(same)[same] > 1].tolist(), back[np.bincount(same)[same] > 1].tolist()):
            hit.setdefault(int(kind[w]), []).append(b)
    if hit:
        for at in np.flatnonzero(several & ~alike):
            begin = place[at] - base[owner[at]] - shift[owner[at]]
            for b in hit.get(int(kind[at]), ()):
                flags[owner[at]][begin - b] = True
    return flags


def _doublings(blocks: int) -> list[int]:
    """Numbers of blocks ranked one after another: doubled while that is enough, then one more at a time."""
    sizes, held = [], 1
    while held < blocks:
        held = 2 * held if 2 * held <= blocks else held + 1
        sizes.append(held)
    return sizes


def _whole_groups(kinds: np.ndarray, group: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """``kinds`` in order of their groups, in parts of about ``most`` that cut no group."""
    ordered = kinds[np.argsort(group[kinds], kind="stable")]
    ends = np.flatnonzero(np.append(group[ordered][1:] != group[ordered][:-1], True)) + 1 if len(ordered) else []
    begin = 0
    for end in ends:
        if end - begin >= most or end == len(ordered):
            yield ordered[begin:end]
            begin = end


def _ranges(flags: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edges[::2], edges[1::2])]


def _sorted_buckets(length: int):
    """Rows sorted by ``gram`` to ``digest, ranges``: repeated windows, one bucket after another."""
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        grams, leads, digests, contexts, copies = zip(*rows)
        flags = repeated_windows(np.array(grams), np.array(leads, np.int64), list(contexts), length)
        digest, ranges = [], []
        for key, own, count in zip(digests, flags, copies):
            found = [{"first": 0, "last": len(own) - 1}] if count > 1 else _ranges(own)
            if found:
                digest.append(key)
                ranges.append(found)
        return pa.RecordBatch.from_arrays(
            [pa.array(digest, pa.binary()), pa.array(ranges, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))],
            ["digest", "ranges"])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("gram", "lead", "digest", "context", "copies")]):
                if size > SORTED_BYTES and rows[-1][0] != row[0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
        if rows:
            yield solve(rows)
    return run


def _divided(length: int, narrow: int):
    """Contexts of crowded buckets to parts whose windows lie within ``narrow`` places before the anchor.

    All windows of a part share the bytes from its farthest place on to the end of its nearest one. With them
    the bucket is told apart further; equal windows stay together, as they lie at one place.
    """
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                out: list[tuple] = []
                for key, lead, digest, context, copies in zip(*whole.slice(start, 200).to_pydict().values()):
                    count = len(context) - length + 1
                    for place in range((lead - count + 1) // narrow, lead // narrow + 1):
                        # Windows ``lead - high`` to ``lead - low``; the anchor is ``lead`` bytes into the context.
                        high, low = min(lead, (place + 1) * narrow - 1), max(lead - count + 1, place * narrow)
                        first, last = lead - high, lead - low
                        part = context[first:last + length]
                        # A part need not reach its outermost places, but always holds the bytes they share.
                        shared = context[max(0, lead - place * narrow):lead - ((place + 1) * narrow - 1) + length]
                        deeper = xxhash.xxh64_intdigest(shared + key.to_bytes(8, "little", signed=True) + place.to_bytes(4, "little"))
                        out.append((digest, first, deeper - (1 << 64) if deeper >> 63 else deeper, high,
                                    xxhash.xxh3_128_digest(part + high.to_bytes(4, "big")), part, copies))
                columns = list(zip(*out)) or [()] * 7
                kinds = [pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                                 ["whole", "begin", "gram", "lead", "digest", "context", "copies"])
    return run


_RANGES = "digest binary, ranges array<struct<first: int, last: int>>"


def repeated_ranges(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """``digest, ranges`` of the different contexts (``gram, lead, digest, context, copies``) that have repeated windows.

    A bucket is sorted in one task. One with more than ``CROWD`` contexts is divided first: its contexts fall into parts
    with a quarter of the places before the anchor, which agree in more bytes and are often equal. That goes on until no
    bucket is crowded; a part of one window agrees in all its bytes, so it ends. Ranges found for parts go back up.
    """
    count = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["gram", "lead", "digest", "context", "copies"]
    width, found, above = length - gram + 1, [], []
    while True:
        crowded = stage(contexts.groupBy("gram").agg(F.count("*").alias("contexts")).filter(F.col("contexts") > CROWD).select("gram"), "crowded")
        last = width == 1 or crowded.isEmpty()
        alone = contexts if last else contexts.join(crowded, "gram", "left_anti")
        found.append(alone.select(*columns).repartition(count, "gram").sortWithinPartitions("gram").mapInArrow(_sorted_buckets(length), _RANGES))
        if last:
            break
        narrow = -(-width // 4)
        parts = stage(contexts.join(crowded, "gram", "left_semi").select(*columns).mapInArrow(
            _divided(length, narrow),
            "whole binary, begin int, gram long, lead int, digest binary, context binary, copies long"), "parts")
        above.append(parts.select("whole", "begin", "digest"))
        contexts = stage(parts.groupBy("gram", "lead", "digest", "context").agg(F.sum("copies").alias("copies")), "contexts")
        width = narrow
    ranges = found.pop()
    while above:
        # Each part's ranges, counted from the start of the whole context.
        moved = F.transform("ranges", lambda r: F.struct((r["first"] + F.col("begin")).alias("first"), (r["last"] + F.col("begin")).alias("last")))
        up = above.pop().join(stage(ranges, "ranges"), "digest").select(F.col("whole").alias("digest"), moved.alias("some"))
        ranges = found.pop().unionByName(up.groupBy("digest").agg(F.flatten(F.collect_list("some")).alias("ranges")))
    return stage(ranges, "ranges")


def _merged(spans: list[dict], length: int) -> list[tuple[int, int]]:
    """Maximal byte runs covered by windows ``first`` to ``last``."""
    runs: list[list[int]] = []
    for first, last in sorted((s["first"], s["last"]) for s in spans):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last + length)
        else:
            runs.append([first, last + length])
    return [(a, b) for a, b in runs]


def _whole_characters(data: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without the characters they hold only in part."""
    inner = []
    for a, b in runs:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while a < b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        inner.append((a, b))
    return inner


def _word_runs(data: bytes, spans: list[dict]) -> list[tuple[int, int]]:
    """Byte runs of the passages of over ``WORDS`` words that windows of ``word_codes`` cover."""
    long = [(-(-a // WORD), b // WORD) for a, b in _merged(spans, WORD * WORDS)]
    long = [(a, b) for a, b in long if b - a > WORDS]
    words = [m.span() for m in re.finditer(rb"[^ \t\n\x0b\x0c\r]+", data)] if long else []
    return [(words[a][0], words[b - 1][1]) for a, b in long]


def _joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The bytes of all runs as runs that do not overlap."""
    return _merged([{"first": a, "last": b} for a, b in runs if a < b], 0)


def _cut(length: int, as_text: bool):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                size, removed, runs_of, kept = [], [], [], []
                by_words = batch.column("word_spans").to_pylist() if "word_spans" in batch.schema.names else repeat(None)
                for text, spans, words in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), by_words):
                    data = text.encode()
                    runs = _merged(spans or [], length)
                    if as_text:
                        runs = _whole_characters(data, runs)
                    if words:
                        runs = _joined([*runs, *_word_runs(data, words)])
                    parts, at = [], 0
                    for a, b in runs:
                        parts.append(data[at:a])
                        at = b
                    rest = b"".join([*parts, data[at:]])
                    size.append(len(data))
                    removed.append(len(data) - len(rest))
                    runs_of.append(len(runs))
                    kept.append(rest.decode() if as_text else rest)
                others = [c for c in batch.schema.names if c not in ("text", "spans", "word_spans")]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in others), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(runs_of, pa.int64()), pa.array(kept, pa.string() if as_text else pa.binary())],
                    [*others, "n_bytes", "n_removed", "n_spans", "text" if as_text else "kept"])
    return run


def repeated_spans(rows: DataFrame, length: int = LENGTH, gram: int = GRAM, code=str.encode) -> DataFrame:
    """``rid, spans``: for ``numbered_rows`` that have any, the windows ``first`` to ``last`` that start elsewhere too.

    The strings are those of ``code(text)``.
    """
    if length % STEP or length < 3 * STEP or not 0 < gram < length:
        raise ValueError(f"length must be a multiple of {STEP} and at least {3 * STEP}, gram shorter")
    return settled(rows.sparkSession, "spans", lambda: _spans(rows.select("rid", "text"), length, gram, code))


def _spans(rows: DataFrame, length: int, gram: int, code) -> DataFrame:
    found = stage(rows.mapInArrow(_find_anchors(length, gram, code), "rid long, at long, first long, last long, gram long"), "anchors")
    shared = stage(found.groupBy("gram").agg(F.count("*").alias("places")).filter("places > 1").select("gram"), "anchors-shared")
    marks = (found.join(shared, "gram").groupBy("rid")
             .agg(F.collect_list(F.struct("at", "first", "last", "gram")).alias("marks")))
    held = stage(rows.join(marks, "rid"), "suffix-texts")
    contexts = held.mapInArrow(_contexts(length, code), "rid long, first long, gram long, lead int, digest binary, context binary")
    # Equal contexts are one context from here on, so copies of a passage are sorted once.
    different = stage(contexts.groupBy("gram", "lead", "digest", "context").agg(F.count("*").alias("copies")), "contexts")
    results = repeated_ranges(different, length, gram)
    places = contexts.select("rid", "first", "digest").join(results, "digest")
    moved = F.transform("ranges", lambda r: F.struct((r["first"] + F.col("first")).alias("first"), (r["last"] + F.col("first")).alias("last")))
    return places.select("rid", moved.alias("some")).groupBy("rid").agg(F.flatten(F.collect_list("some")).alias("spans"))


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``rid, doc_id, n_bytes, n_removed, n_spans, kept`` of every row, ``kept`` being the bytes that remain.

    A byte goes when some ``length``-byte string over it starts at another place too, in any row
    or in the same one; strings end with their text and are judged on the input. So every copy
    of a long passage goes, repeated rows included. Null and empty texts, like all texts shorter
    than ``length``, keep their bytes. An empty table gives no rows.
    """
    rows = numbered_rows(docs)
    joined = rows.join(repeated_spans(rows, length, gram), "rid", "left")
    return joined.mapInArrow(_cut(length, False), schema_with(
        rows, ["rid", "doc_id"], "n_bytes long, n_removed long, n_spans long, kept binary"))


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated bytes of its texts taken out, but for characters covered in part; all rows stay."""
    rows = numbered_rows(docs, carry=True)
    joined = rows.join(repeated_spans(rows, length, gram), "rid", "left")
    cut = joined.mapInArrow(_cut(length, True), schema_with(
        rows, ["rid", "doc_id", "rest"], "n_bytes long, n_removed long, n_spans long, text string"))
    return restored(cut, docs)


def without_passages(docs: DataFrame) -> DataFrame:
    """``deduplicated``, with the passages of over ``WORDS`` words that stand elsewhere too taken out as well, however few bytes.

    Words are compared by a 64-bit hash each, white space between them is not. Both kinds are judged on
    the input, so neither hides a copy from the other. All rows stay, those with repeated ids too; null texts become empty
    ones, repeated rows lose what they share, an empty table gives no rows.
    """
    rows = numbered_rows(docs, carry=True)
    by_words = repeated_spans(rows, WORD * WORDS, GRAM, word_codes).withColumnRenamed("spans", "word_spans")
    joined = rows.join(repeated_spans(rows), "rid", "left").join(by_words, "rid", "left")
    cut = joined.mapInArrow(_cut(LENGTH, True), schema_with(
        rows, ["rid", "doc_id", "rest"], "n_bytes long, n_removed long, n_spans long, text string"))
    return restored(cut, docs)
