"""Best-fit packing of token pieces: locally first, then of underfull bins as items up a tree."""

from __future__ import annotations

import os
import re
import string
from collections.abc import Iterator
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import lean, schema_with, slices, text_rows, worker_cache
from curbline.session import stage

CAPACITY = 2048
END_ID = 0
# A bin with at most this much room is done.
SLACK = 8
# Items packed together; bounds a task's memory.
GROUP = 50_000
# The rounds end when one saves less than this share of the open bins.
LEAST_GAIN = 0.002
# Words whose ids a worker remembers, and keeps for its later tasks; they take some 170 bytes each.
WORDS_KEPT = 200_000
# Words encoded in one go.
ENCODED_WORDS = 1000
MARKS = string.punctuation


class WordEncoder:
    """Ids of whole texts by a tokenizer that drops white space, word by word.

    The vocabulary joins nothing across white space, so the ids of a text are those of its words.
    Literal special tokens are found first, in the text as it is, and stand for their own ids.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.special = {content: np.array([i], "<u4").tobytes() for content, i in special.items()}
        self.cut = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True))) or "(?!)")
        # Words are in lower case by then: one like <|ENDOFTEXT|> must not become special.
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {"": b""}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        ids, ends = self.encoded(pa.array(texts, pa.string()))
        data, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [data[begin:end] for begin, end in zip(cuts, cuts[1:])]

    def encoded(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, each text followed by ``end``, and where each text's ids end.

        A text is cut at its special tokens; every part is followed by the ids of the token that ended it.
        """
        parts, closers, last = texts, [end] * len(texts), np.arange(len(texts))
        if any(pc.any(pc.match_substring(texts, content)).as_py() for content in self.special):
            split = [self.cut.split(text) for text in texts.to_pylist()]
            tokens = [self.cut.findall(text) for text in texts.to_pylist()]
            parts = pa.array([part for own in split for part in own], pa.string())
            closers = [ids for own in tokens for ids in (*(self.special[token] for token in own), end)]
            last = np.cumsum([len(own) for own in split]) - 1
        # The vocabulary is in lower case, so words are too. Each different word is looked up once.
        words = pc.ascii_split_whitespace(pc.ascii_lower(parts))
        coded = words.flatten().dictionary_encode()
        values, ends = self._words(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), words.offsets.to_numpy()[1:]
        closing = {ids: len(values) + k for k, ids in enumerate(dict.fromkeys(closers))}
        order = np.insert(coded.indices.to_numpy(), ends, [closing[ids] for ids in closers])
        taken = pa.array([*values, *closing], pa.large_binary()).take(pa.array(order))
        if not len(taken):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        _, offsets, data = taken.buffers()
        cuts = np.frombuffer(offsets, np.int64, len(taken) + 1) // 4
        return np.frombuffer(data, "<u4", cuts[-1]), cuts[ends[last] + last + 1]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of different words; the empty one has none."""
        found = list(map(self.known.get, words))
        missing = [at for at, ids in enumerate(found) if ids is None]
        if missing:
            for at, ids in zip(missing, self._made([words[at] for at in missing])):
                found[at] = ids
        return found

    def _made(self, words: list[str]) -> list[bytes]:
        # Marks after a letter or digit are matched by themselves, all of them together.
        cores = [word.rstrip(MARKS) for word in words]
        marked = [at for at, core in enumerate(cores) if len(core) < len(words[at]) and core[-1:].isascii() and core[-1:].isalnum()]
        marks = [words[at][len(cores[at]):] for at in marked]
        whole = words.copy()
        for at in marked:
            whole[at] = cores[at]
        made = dict.fromkeys([*whole, *marks])
        made.update((word, self.known.get(word)) for word in made)
        new = [word for word, ids in made.items() if ids is None]
        letters = list(map(str.isalpha, new))
        for group, as_text in ((list(compress(new, letters)), True), (list(compress(new, map(not_, letters))), False)):
            for start in range(0, len(group), ENCODED_WORDS):
                part = group[start:start + ENCODED_WORDS]
                made.update(zip(part, self._encoded(part, as_text)))
        found = list(map(made.__getitem__, whole))
        for at, mark in zip(marked, marks):
            found[at] += made[mark]
        if len(self.known) < WORDS_KEPT:
            self.known.update(made)
            self.known.update(zip(words, found))
        return found

    def _encoded(self, words: list[str], as_text: bool) -> list[bytes]:
        """Ids of each word. ``as_text`` is quicker: words of letters are one match each, so a text of them tells them apart."""
        encoded = self.tokenizer.encode(" ".join(words) if as_text else words, is_pretokenized=not as_text, add_special_tokens=False)
        owner = np.array(encoded.word_ids, np.int64)
        if as_text and owner[-1] + 1 != len(words):
            return self._encoded(words, False)
        data, cuts = np.array(encoded.ids, "<u4").tobytes(), (4 * np.searchsorted(owner, np.arange(len(words) + 1))).tolist()
        return [data[begin:end] for begin, end in zip(cuts, cuts[1:])]


def _pieces(path: str, capacity: int, end_id: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = worker_cache(("packing", path), lambda: WordEncoder(path)), np.array([end_id], "<u4").tobytes()
        for batch in slices(batches, 1000):
            ids, ends = encoder.encoded(batch.column("text"), end)
            sizes = np.diff(ends, prepend=0)
            count = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), count)
            number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            first = number * capacity
            length = np.minimum(capacity, sizes[row] - first)
            # Pieces lie one after another in the ids.
            cuts = np.append(0, 4 * np.cumsum(length)).astype(np.int32)
            data = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(cuts), pa.py_buffer(ids)])
            kept = batch.select([c for c in batch.schema.names if c != "text"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(number.astype(np.int32)), pa.array(first), pa.array(length), data],
                [*kept.schema.names, "piece", "start", "length", "ids"])
    return run


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``rid, doc_id, piece, start, length, ids``: each document's ids and the end id, cut at ``capacity``.

    Null text counts as empty; every document has at least its end id.
    """
    rows = text_rows(docs)
    path = path or public_tokenizers.path("word_bpe_49k.json")
    schema = schema_with(rows, ["rid", "doc_id"], "piece int, start long, length long, ids binary")
    return rows.mapInArrow(_pieces(path, capacity, end_id), schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each item, and the bins' fills: longest first, each into the fullest bin that takes it."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set when a bin has exactly r left
    fills: list[int] = []
    for at in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[at])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            which = open_by_room[room].pop()
            if not open_by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, which = capacity, len(fills)
            fills.append(0)
        bins[at], offsets[at] = which, fills[which]
        fills[which] += length
        left = room - length
        if left:
            open_by_room[left].append(which)
            rooms |= 1 << left
    return bins, offsets, fills


def _round(level: int, capacity: int, group: int):
    """Items ``item, length`` to ``item, bin, offset, fill``; bin numbers hold the round and the task."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = (level << 58) | (TaskContext.get().partitionId() << 34)
        waiting: list[pa.RecordBatch] = []
        count = 0

        def solve() -> pa.RecordBatch:
            nonlocal made, waiting, count
            table = pa.Table.from_batches(waiting).combine_chunks()
            bins, offsets, fills = best_fit(table.column("length").to_numpy(), capacity)
            item = table.column("item").combine_chunks()
            out = pa.RecordBatch.from_arrays(
                [item, pa.array(made + bins), pa.array(offsets), pa.array(np.array(fills, np.int64)[bins])],
                ["item", "bin", "offset", "fill"])
            made, waiting, count = made + len(fills), [], 0
            return out

        for batch in batches:
            for start in range(0, batch.num_rows, group):
                part = batch.slice(start, group)
                if count and count + part.num_rows > group:
                    yield solve()
                waiting.append(part)
                count += part.num_rows
        if count:
            yield solve()
    return run


def pack(items: DataFrame, capacity: int = CAPACITY, slack: int = SLACK, group: int = GROUP) -> DataFrame:
    """``item, sequence_id, offset`` for rows ``item, length``: unique items and lengths from 1 to ``capacity``.

    Each task packs its own items. Bins with at most ``slack`` left are done; the others, as items
    of their fill, go to fewer tasks and are packed again, until they meet in one group or a
    round no longer saves bins. Placements of the rounds are joined back down the tree.
    """
    schema = "item long, bin long, offset long, fill long"
    rounds = [stage(items.select("item", "length").mapInArrow(_round(0, capacity, group), schema), "packed")]
    while True:
        underfull = rounds[-1].filter((F.col("offset") == 0) & (F.col("fill") < capacity - slack))
        left = underfull.count()
        if not left:
            break
        tasks = -(-left // group)
        again = underfull.select(F.col("bin").alias("item"), F.col("fill").alias("length")).repartition(tasks, "item")
        rounds.append(stage(again.mapInArrow(_round(len(rounds), capacity, group), schema), "packed"))
        bins = rounds[-1].filter("offset = 0").count()
        if tasks == 1 or bins > left * (1 - LEAST_GAIN):
            break
    placed = rounds[0].select("item", F.col("bin").alias("sequence_id"), "offset")
    for upper in rounds[1:]:
        moved = upper.select(F.col("item").alias("sequence_id"), "bin", F.col("offset").alias("further"))
        placed = placed.join(moved, "sequence_id", "left").select(
            "item", F.coalesce("bin", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("further", F.lit(0))).alias("offset"))
    return placed


def packed_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: every piece of every row once.

    Pieces fill their sequence without gaps from 0. Null and empty texts give a piece of one id;
    rows with equal or null ids are packed as separate documents. An empty table gives no rows.
    The ids are those of ``token_pieces``; only their digest moves.
    """
    pieces = stage(token_pieces(docs, path, capacity).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), "pieces")
    numbered = stage(pieces.withColumn("item", F.monotonically_increasing_id()), "pieces")
    return numbered.join(pack(numbered, capacity), "item").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
