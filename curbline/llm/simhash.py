"""Near-duplicates by 64-bit SimHash, linked through a Gray-order hierarchical index."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import lean, numbered_rows, restored, row_order, schema_with
from curbline.session import stage

WORDS = 3
SEED = 42
DISTANCE = 3
FAN = 8
# Pieces that hold more fingerprints than this are divided by a second set of bands.
PIECE = 2048
# Node pairs looked at in one go.
FRONT = 1 << 18


def fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """A bit is 1 when it is set in over half of the shingle hashes; without words all bits are 0."""
    tokens = text.encode().lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = map(b" ".join, zip(*[tokens[k:] for k in range(words)]))
    count = max(1, len(tokens) - words + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, count)
    votes = np.zeros(64, np.int64)
    for part in range(0, count, 1 << 16):
        bits = np.unpackbits(hashes[part:part + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > count).tobytes(), "big")


def _fingerprints(words: int, seed: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array([fingerprint(t, words, seed) for t in batch.column("text").to_pylist()], np.uint64)
            kept = batch.select([c for c in batch.schema.names if c != "text"])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(codes.view(np.int64))], [*kept.schema.names, "code"])
    return run


def fingerprints(rows: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """``text`` replaced by ``code``, the fingerprint as a signed 64-bit number."""
    kept = [c for c in rows.columns if c != "text"]
    return rows.mapInArrow(_fingerprints(words, seed), schema_with(rows, kept, "code long"))


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence; neighbours there differ in few bits."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Codes in Gray order under nodes that hold the bits all their codes share.

    ``masks[l]`` marks the shared bits of the nodes of level ``l`` and ``patterns[l]`` holds
    them. A lower node only adds the bits its parent does not share.
    """

    def __init__(self, codes: np.ndarray):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        self.codes = codes[self.order]
        self.masks = [np.full(len(codes), ~np.uint64(0))]
        self.patterns = [self.codes]
        low, high = self.codes, self.codes
        while len(low) > FAN:
            short = -len(low) % FAN
            low = np.bitwise_and.reduce(np.append(low, np.repeat(low[-1:], short)).reshape(-1, FAN), axis=1)
            high = np.bitwise_or.reduce(np.append(high, np.repeat(high[-1:], short)).reshape(-1, FAN), axis=1)
            mask = ~(low ^ high)
            self.masks.append(mask)
            self.patterns.append(low & mask)

    def pairs(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of codes at most ``distance`` bits apart, each pair once.

        A pair of nodes carries the differences of the bits seen so far; its children add those of
        the further shared bits, and whole groups go once the sum is too high.
        """
        top = len(self.masks) - 1
        a, b = np.triu_indices(len(self.masks[top]))
        zero = np.zeros(len(a), np.uint64)
        stack = [(top, *self._near(top, a, b, zero, np.zeros(len(a), np.int64), distance))]
        while stack:
            level, a, b, seen, apart = stack.pop()
            if len(a) > FRONT:
                half = len(a) // 2
                stack.append((level, a[half:], b[half:], seen[half:], apart[half:]))
                stack.append((level, a[:half], b[:half], seen[:half], apart[:half]))
                continue
            if level == 0:
                other = a != b
                if other.any():
                    yield a[other], b[other]
                continue
            left = (a[:, None] * FAN + np.repeat(np.arange(FAN), FAN)).ravel()
            right = (b[:, None] * FAN + np.tile(np.arange(FAN), FAN)).ravel()
            size = len(self.masks[level - 1])
            real = (left < size) & (right < size) & (left <= right)
            back = np.repeat(np.arange(len(a)), FAN * FAN)[real]
            stack.append((level - 1, *self._near(level - 1, left[real], right[real], seen[back], apart[back], distance)))

    def _near(self, level, a, b, seen, apart, distance):
        shared = self.masks[level][a] & self.masks[level][b]
        more = (self.patterns[level][a] ^ self.patterns[level][b]) & shared & ~seen
        apart = apart + np.bitwise_count(more)
        near = apart <= distance
        return a[near], b[near], shared[near], apart[near]


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Lowers the labels of linked places to one another's, in place."""
    while True:
        left, right = labels[a], labels[b]
        apart = left != right
        if not apart.any():
            return
        a, b, left, right = a[apart], b[apart], left[apart], right[apart]
        np.minimum.at(labels, np.maximum(left, right), np.minimum(left, right))
        while True:
            higher = labels[labels]
            if (higher == labels).all():
                break
            labels[:] = higher


def _small_links(labels: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray, distance: int) -> None:
    """Links within pieces no larger than a node, for all of them at once."""
    ends = np.repeat(starts + sizes, sizes)
    places = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    for step in range(1, int(sizes.max(initial=1))):
        left = places[places + step < ends]
        near = np.bitwise_count(codes[left] ^ codes[left + step]) <= distance
        _merge(labels, left[near], left[near] + step)


def _links(distance: int):
    """Rows sorted by ``piece`` to ``(code, other)``: a spanning forest of the links within each piece."""
    def solve(pieces: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.append(True, pieces[1:] != pieces[:-1])) if len(pieces) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(starts, len(pieces)))
        labels = np.arange(len(codes))
        small = sizes <= FAN
        _small_links(labels, starts[small], sizes[small], codes, distance)
        for start, size in zip(starts[~small], sizes[~small]):
            index = GrayIndex(codes[start:start + size])
            for a, b in index.pairs(distance):
                _merge(labels, start + index.order[a], start + index.order[b])
        linked = labels != np.arange(len(codes))
        return pa.RecordBatch.from_arrays([pa.array(codes[linked].view(np.int64)), pa.array(codes[labels[linked]].view(np.int64))],
                                          ["code", "other"])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, codes = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            pieces = np.append(pieces, batch.column("piece").to_numpy(zero_copy_only=False))
            codes = np.append(codes, batch.column("code").to_numpy(zero_copy_only=False).view(np.uint64))
            if not len(pieces):
                continue
            # The last piece may go on in the next batch.
            others = np.flatnonzero(pieces != pieces[-1])
            cut = int(others[-1]) + 1 if len(others) else 0
            if cut:
                yield solve(pieces[:cut], codes[:cut])
                pieces, codes = pieces[cut:], codes[cut:]
        if len(pieces):
            yield solve(pieces, codes)
    return run


def _banded(codes: DataFrame, key, bits: int, bands: int, by: tuple[str, ...]) -> DataFrame:
    """``piece, code`` by the value of each band of the bits in ``key``."""
    width = bits // bands
    values = [F.struct(F.lit(k).alias("band"), F.shiftrightunsigned(key, k * width).bitwiseAND((1 << width) - 1).alias("value"))
              for k in range(bands)]
    return codes.withColumn("at", F.explode(F.array(*values))).select(
        F.xxhash64(*by, "at.band", "at.value").alias("piece"), "code", "at.band", "at.value")


def near_links(codes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``code, other`` whose links join all distinct codes at most ``distance`` bits apart.

    Codes that near agree in at least one of ``distance + 1`` bands; the bands' values are the top
    nodes of the index, dealt over the cluster. A value shared by many codes is divided once more
    by bands of the other bits, which loses no pair either. Below that each piece is one Gray-order index.
    """
    spark = codes.sparkSession
    bands = distance + 1
    width = 64 // bands
    first = stage(_banded(codes, F.col("code"), 64, bands, ()), "simhash-bands")
    sizes = first.groupBy("band", "value").agg(F.count("*").alias("codes"))
    large = stage(sizes.filter(F.col("codes") > PIECE).select("band", "value"), "simhash-large")
    # The other bits, moved together: those above the band and those below it.
    low = F.col("code").bitwiseAND(F.expr(f"shiftleft(1L, band * {width}) - 1L"))
    high = F.expr(f"case when band = {bands - 1} then 0L else shiftleft(shiftrightunsigned(code, (band + 1) * {width}), band * {width}) end")
    divided = first.join(large, ["band", "value"]).select("code", F.struct("band", "value").alias("above"), low.bitwiseOR(high).alias("rest"))
    deeper = _banded(divided, F.col("rest"), 64 - width, bands, ("above",)).select("piece", "code")
    pieces = first.join(large, ["band", "value"], "left_anti").select("piece", "code").unionByName(deeper)
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(count, "piece").sortWithinPartitions("piece").mapInArrow(_links(distance), "code long, other long")


def components(links: DataFrame, a: str = "code", b: str = "other") -> DataFrame:
    """``node, root``: each linked node but the roots with the smallest node it is connected to.

    Alternates two steps until nothing changes: every node hands its larger neighbours its least
    neighbour, then its smaller ones. Every step's result is written to shared storage.
    """
    edges = stage(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")), "least")
        # An edge to the larger neighbour v of u becomes (v, m); edges of a least node stay as they are.
        large = stage(edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u")
                      .select(F.col("w").alias("u"), F.col("m").alias("v")).distinct(), "large-star")
        down = stage(large.groupBy("u").agg(F.min("v").alias("m")), "down")
        small = large.join(down, "u")
        edges = stage(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                      .unionByName(down.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen


def near_groups(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``rid, doc_id, code, first`` for every row.

    ``first`` is the ``row_order`` struct of the first row of the group: rows whose fingerprints
    are joined by steps of at most ``distance`` bits, copies included. Empty and null texts have
    the fingerprint zero and link like others. Null ids come last; equal ids go by the order of
    the table. An empty table gives no rows.
    """
    return _grouped(numbered_rows(docs), distance)


def _grouped(rows: DataFrame, distance: int) -> DataFrame:
    marked = stage(fingerprints(rows.select("rid", "doc_id", "text")), "simhash")
    distinct = stage(marked.groupBy("code").agg(F.min(row_order()).alias("first")), "simhash-codes")
    roots = components(near_links(distinct.select("code"), distance))
    rooted = distinct.join(roots.withColumnRenamed("node", "code"), "code", "left").withColumn("root", F.coalesce("root", "code"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    # Staged: the join with the rows then deals both sides itself and can split a fingerprint many rows have.
    places = stage(rooted.drop("first").join(firsts, "root").select("code", "first"), "simhash-places")
    return marked.join(places, "code").select("rid", "doc_id", "code", "first")


def deduplicated(docs: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """The first row of every group of near-duplicates, as ``near_groups`` has them, with all its columns.

    Null and empty texts are one group, of which one row stays; repeated rows are copies. An empty table gives no rows.
    """
    rows = numbered_rows(docs, carry=True)
    kept = _grouped(rows, distance).filter("rid = first.rid").select("rid")
    return restored(rows.join(kept, "rid", "left_semi"), docs)
