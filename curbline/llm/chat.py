"""Conversations as token sequences with a loss mask, by way of character offsets.

A conversation is rendered into one string and encoded once. The tokenizer gives every token's place
in the string; the places of the turns that are learned from are found among them by binary search.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import worker_cache
from curbline.session import broadcast_if_small, stage

# Turn marks; each is one token, so that no token lies across the end of a text.
TURN, SAYS, END = "<turn>", "<says>", "</turn>"
LEARNED = "assistant"
# A conversation of more characters is encoded in segments of about this many, cut between turns.
WHOLE = 1 << 20
# Characters encoded in one go.
BATCH = 1 << 19

_PIECE = "segment long, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
_READ = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


class Template:
    """Renders turns, and reads them back; texts may hold anything, marks and special tokens included."""

    def __init__(self, special: list[str] = ()):
        controls = sorted({TURN, SAYS, END, *special}, key=len, reverse=True)
        # A backslash comes after the first character of a control string and after every backslash.
        self._control = re.compile("|".join([r"\\", *map(re.escape, controls)]))
        self._turns = re.compile(f"{re.escape(TURN)}(.*?){re.escape(SAYS)}(.*?){re.escape(END)}", re.S)

    def escape(self, text: str) -> str:
        return self._control.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"(.)\\", r"\1", text, flags=re.S)

    def render(self, turns: list[tuple[str, str]]) -> tuple[str, list[int]]:
        """The string, and where the learned texts start and end in it, in order."""
        parts, spans, at = [], [], 0
        for role, text in turns:
            head, body = f"{TURN}{self.escape(role)}{SAYS}", self.escape(text)
            if role == LEARNED:
                spans += [at + len(head), at + len(head) + len(body)]
            parts += [head, body, END]
            at += len(head) + len(body) + len(END)
        return "".join(parts), spans

    def read(self, formatted: str) -> list[tuple[str, str]]:
        return [(self.unescape(role), self.unescape(text)) for role, text in self._turns.findall(formatted)]


class Encoder:
    """Token ids, offsets and loss masks of rendered conversations."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, processors
        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.template = Template(special)
        self.tokenizer.add_special_tokens([TURN, SAYS, END])
        # Tokens keep the blanks they begin with.
        self.tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)

    def encode(self, texts: list[str], spans: list[list[int]]) -> list[tuple[np.ndarray, ...]]:
        """``ids, starts, ends, loss`` for each text; ``loss`` marks the tokens within its spans."""
        found = []
        for one, own in zip(self.tokenizer.encode_batch(texts, add_special_tokens=False), spans):
            places = np.array(one.offsets, np.int32).reshape(-1, 2)
            starts, ends = places[:, 0], places[:, 1]
            edges = np.array(own, np.int32).reshape(-1, 2)
            first, last = np.searchsorted(ends, edges[:, 0], "right"), np.searchsorted(starts, edges[:, 1], "left")
            change = np.zeros(len(starts) + 1, np.int32)
            np.add.at(change, first, 1)
            np.add.at(change, last, -1)
            found.append((np.array(one.ids, np.int32), starts, ends, np.cumsum(change)[:-1] > 0))
        return found


def masked(formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> list[str]:
    """The stretches of the string that marked tokens cover."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], loss.astype(np.int8), [0]])))
    return [formatted[starts[a]:ends[b - 1]] for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.append(0, np.cumsum([len(p) for p in parts])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts), kind))


def _formatted(path: str):
    """Rows sorted by conversation, segment and turn to one row a segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache(("chat", path), lambda: Encoder(path))
        keys: list[tuple] = []
        turns: list[list[tuple[str, str]]] = []
        size, kind = 0, None

        def given() -> pa.RecordBatch:
            texts, spans = zip(*map(encoder.template.render, turns))
            ids, starts, ends, loss = zip(*encoder.encode(list(texts), list(spans)))
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], kind), pa.array([k[1] for k in keys], pa.int64()), pa.array(texts, pa.string()),
                 *(_lists(list(part), pa.int32()) for part in (ids, starts, ends)), _lists(list(loss), pa.bool_())],
                ["conv_id", "segment", "formatted", "ids", "starts", "ends", "loss"])

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for conv, segment, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "role", "text"))):
                if not keys or keys[-1] != (conv, segment):
                    if size >= BATCH:
                        yield given()
                        keys, turns, size = [], [], 0
                    keys.append((conv, segment))
                    turns.append([])
                turns[-1].append((role, text))
                size += len(role) + len(text)
        if keys:
            yield given()
    return run


def _read(path: str):
    """Rows sorted by conversation and segment to what stands in them; one segment is held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = worker_cache(("chat", path), lambda: Encoder(path)).template
        done: list[tuple] = []
        open_: list = []
        kind = None

        def closed() -> None:
            if open_:
                conv, count, told, chars, learned, size = open_
                done.append((conv, count, told.hexdigest(), chars, learned.hexdigest(), size))

        def given() -> pa.RecordBatch:
            columns = zip(*done)
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                              ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for at in range(batch.num_rows):
                conv, formatted = batch.column("conv_id")[at].as_py(), batch.column("formatted")[at].as_py()
                if not open_ or open_[0] != conv:
                    closed()
                    open_ = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in template.read(formatted):
                    open_[1] += 1
                    open_[2].update(f"{role}\n{text}\n".encode())
                starts, ends, loss = (batch.column(c)[at].values.to_numpy(zero_copy_only=False) for c in ("starts", "ends", "loss"))
                for part in masked(formatted, starts, ends, loss):
                    text = template.unescape(part)
                    open_[3] += len(text)
                    open_[4].update(text.encode())
                open_[5] += len(formatted)
            if done:
                yield given()
                done.clear()
        closed()
        if done:
            yield given()
    return run


def _turns(conversations: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"),
                                F.xxhash64(text).alias("code"))


_ORDER = ["turn", "role", "code", "text"]


def _segmented(rows: DataFrame, whole: int) -> DataFrame:
    """Adds ``segment``: the characters before a turn in its conversation by ``whole``; conversations may lie on many tasks."""
    keys = ["conv_id", "turn", "role", "code"]
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage(rows.withColumn("size", F.length("role") + F.length("text")).repartitionByRange(count, *keys)
                  .sortWithinPartitions("conv_id", *_ORDER)
                  .withColumn("part", F.spark_partition_id()).withColumn("seat", F.monotonically_increasing_id()), "chat-long")
    earlier = Window.partitionBy("conv_id").orderBy("part")
    runs = (dealt.groupBy("conv_id", "part").agg(F.sum("size").alias("held"))
            .select(F.col("conv_id").alias("own"), F.col("part").alias("at"), (F.sum("held").over(earlier) - F.col("held")).alias("start")))
    inside = Window.partitionBy("conv_id", "part").orderBy("seat")
    before = dealt.withColumn("before", F.sum("size").over(inside) - F.col("size"))
    joined = before.join(runs, F.col("conv_id").eqNullSafe(F.col("own")) & (F.col("part") == F.col("at")))
    return joined.select("conv_id", *_ORDER, F.floor((F.col("start") + F.col("before")) / whole).alias("segment"))


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(count, *keys)


def _parts(conversations: DataFrame, path: str, whole: int) -> tuple[DataFrame, DataFrame | None]:
    """Segments of conversations up to ``whole`` characters, and those of longer ones, if there are any."""
    rows = _turns(conversations)
    work, kind = _formatted(path), f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, {_PIECE}"
    sizes = rows.groupBy("conv_id").agg(F.sum(F.length("role") + F.length("text")).alias("size"))
    long = stage(sizes.filter(F.col("size") > whole).select(F.col("conv_id").alias("own")), "chat-sizes")
    if long.isEmpty():
        small, large = rows, None
    else:
        same = F.col("conv_id").eqNullSafe(F.col("own"))
        small, large = (rows.join(broadcast_if_small(long, 64), same, how) for how in ("left_anti", "left_semi"))
    small = (_dealt(small.withColumn("segment", F.lit(0).cast("long")), "conv_id").sortWithinPartitions("conv_id", *_ORDER)
             .select("conv_id", "segment", "role", "text").mapInArrow(work, kind))
    if large is not None:
        large = (_dealt(_segmented(large, whole), "conv_id", "segment").sortWithinPartitions("conv_id", "segment", *_ORDER)
                 .select("conv_id", "segment", "role", "text").mapInArrow(work, kind))
    return small, large


def format_conversations(conversations: DataFrame, path: str | None = None, whole: int = WHOLE) -> DataFrame:
    """``conv_id, segment, formatted, ids, starts, ends, loss``: every conversation rendered and encoded whole.

    ``starts`` and ``ends`` are the tokens' places in ``formatted``, in code points; ``loss`` marks the tokens of
    assistant texts, and only those. Control strings in roles and texts are escaped, so ``Template.read``
    gives both back. A conversation of over ``whole`` characters has several segments, cut between turns; marks are
    tokens of their own, so the segments' tokens are those of the whole. Turns go by ``turn``, nulls first,
    equal ones by role and text; repeated rows are turns each. Null roles and texts are empty, rows without
    ``conv_id`` are one conversation, an empty table gives no rows; further columns are not read.
    """
    small, large = _parts(conversations, path or public_tokenizers.path("byte_bpe_50k.json"), whole)
    return small if large is None else small.unionByName(large)


def read_back(conversations: DataFrame, path: str | None = None, whole: int = WHOLE) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, read from ``format_conversations``.

    Long conversations' segments are streamed through one digest each; the others are read where they are made.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    small, large = _parts(conversations, path, whole)
    kind = f"conv_id {small.schema['conv_id'].dataType.simpleString()}, {_READ}"
    found = small.mapInArrow(_read(path), kind)
    if large is None:
        return found
    streamed = _dealt(large, "conv_id").sortWithinPartitions("conv_id", "segment")
    return found.unionByName(streamed.mapInArrow(_read(path), kind))
