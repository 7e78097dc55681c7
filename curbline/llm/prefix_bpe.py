"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a byte string its encoding ends in exactly one token. That token is the one
which, put after the last token of the rest of the prefix, is left alone by the merges. Keeping
the last token of each prefix makes appends exact and lets an edit stop where the old state returns.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import schema_with, text_rows, worker_cache

# What a worker remembers at most: words, matches, pairs of tokens.
WORDS_KEPT = 300_000
MATCHES_KEPT = 300_000
PAIRS_KEPT = 500_000
PREFIXES_KEPT = 500_000
# Byte strings up to this length are worked out from their prefixes as these are needed.
SHORT = 64
_NEVER = 1 << 40


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Ranks of tokens, and which two tokens may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        # The two tokens whose merge gave a token; a token the merges never give has none and is left out.
        self.halves: dict[int, tuple[int, int]] = {}
        self.made: dict[bytes, int] = {}
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            if len(token) == 1:
                self.halves[rank] = (rank, rank)
                self.made[token] = rank
                continue
            parts = self._merged(token, rank)
            if len(parts) == 2:
                self.halves[rank] = (ranks[parts[0]], ranks[parts[1]])
                self.made[token] = rank
        self._fits: dict[int, bool] = {}
        self._last: dict[bytes, int] = {}

    def _merged(self, piece: bytes, below: int) -> list[bytes]:
        """``piece`` after all merges of a rank under ``below``."""
        parts = [piece[k:k + 1] for k in range(len(piece))]
        while len(parts) > 1:
            best, at = min((self.ranks.get(parts[k] + parts[k + 1], _NEVER), k) for k in range(len(parts) - 1))
            if best >= below:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` as they are when they stand side by side."""
        key = left << 32 | right
        known = self._fits.get(key)
        if known is None:
            known = self._stay(left, right)
            if len(self._fits) < PAIRS_KEPT:
                self._fits[key] = known
        return known

    def _stay(self, a: int, b: int) -> bool:
        # Undo the later of the two tokens' last merges, step by step back in time. At each step the
        # parts that touch must not have a merge that would have come before the one undone next.
        tokens, ranks, halves = self.tokens, self.ranks, self.halves
        limit = _NEVER
        while True:
            across = ranks.get(tokens[a] + tokens[b])
            if across is not None and across < limit:
                return False
            single_a, single_b = len(tokens[a]) == 1, len(tokens[b]) == 1
            if single_a and single_b:
                return True
            # Of equal merges the left one comes first, so the right one is undone first.
            if single_a or (not single_b and b >= a):
                # Before b was made, a merge across of the same rank stood further left and came first.
                limit, b = b + 1, halves[b][0]
            else:
                limit, a = a, halves[a][1]


    def last(self, prefix: bytes) -> int:
        """The last token of a short byte string; strings that begin alike share what was found for their prefixes."""
        token = self._last.get(prefix)
        if token is not None:
            return token
        made, end = self.made, len(prefix)
        for start in range(max(0, end - self.longest), end):
            token = made.get(prefix[start:])
            if token is not None and (start == 0 or self.fits(self.last(prefix[:start]), token)):
                if len(self._last) >= PREFIXES_KEPT:
                    self._last.clear()
                self._last[prefix] = token
                return token
        raise ValueError(f"byte {prefix[-1]:#x} is not in the vocabulary")

    def encode(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) > SHORT:
            return PrefixEncoding(self, data).ids()
        found, end = [], len(data)
        while end:
            token = self.last(data[:end])
            found.append(token)
            end -= len(self.tokens[token])
        return found[::-1]


class PrefixEncoding:
    """The encoding of a byte string that can grow and be edited; ``last[i]`` ends the prefix of ``i + 1`` bytes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        for end in range(len(self.last) + 1, len(self.data) + 1):
            self.last.append(self._last_at(end))

    def _last_at(self, end: int) -> int:
        made, longest, fits, data, last = self.vocabulary.made, self.vocabulary.longest, self.vocabulary.fits, self.data, self.last
        for start in range(max(0, end - longest), end):
            token = made.get(data[start:end])
            if token is not None and (start == 0 or fits(last[start - 1], token)):
                return token
        raise ValueError(f"byte {data[end - 1]:#x} is not in the vocabulary")

    def edit(self, start: int, end: int, new: bytes) -> int:
        """Replaces ``data[start:end]``; returns how many prefixes were worked out anew.

        A last token follows from the bytes and last tokens one longest token back, so once that
        many in a row are as before, all that follow are.
        """
        old, moved = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[:start]
        settled = self.vocabulary.longest
        same = 0
        for at in range(start, len(self.data)):
            token = self._last_at(at + 1)
            self.last.append(token)
            before = at - moved
            same = same + 1 if before >= end and old[before] == token else 0
            if same >= settled:
                self.last += old[before + 1:]
                return at + 1 - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        """Tokens of the whole string; one that is a token itself stays whole."""
        whole = self.vocabulary.ranks.get(self.data)
        if whole is not None:
            return [whole]
        found, end, tokens = [], len(self.data), self.vocabulary.tokens
        while end:
            token = self.last[end - 1]
            found.append(token)
            end -= len(tokens[token])
        return found[::-1]


class TextEncoder:
    """Encodes texts match by match and remembers what words and matches encode to.

    The pattern never matches across the place before a blank that follows a character other
    than white space, so what stands between two such places is matched by itself.
    """

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.find = vocabulary, regex.compile(pattern).findall
        self.ends_blank = regex.compile(r"\s\Z").search
        self.known: dict[str, bytes] = {}
        # Taken tokens lie one after another in one buffer.
        tokens = vocabulary.tokens
        self.table = pa.array([tokens.get(k) for k in range(max(tokens) + 1)], pa.binary())
        self.words: dict[str, bytes] = {}

    def _matches(self, text: str) -> bytes:
        known, parts = self.known, []
        for match in self.find(text):
            ids = known.get(match)
            if ids is None:
                tokens = self.vocabulary.encode(match.encode())
                ids = struct.pack(f"<{len(tokens)}I", *tokens)
                if len(known) < MATCHES_KEPT and len(match) < 64:
                    known[match] = ids
            parts.append(ids)
        return b"".join(parts)

    def _fill(self, rest: list[str], found: list[bytes | None]) -> int:
        """Ids of the words not found, up to the first one that does not stand by itself; the number of words when all do."""
        for at in [k for k, ids in enumerate(found) if ids is None]:
            word = rest[at]
            ids = self.words.get(word)
            if ids is None:
                blank = not word or self.ends_blank(word)
                if blank and at + 1 < len(rest):
                    return at
                ids = self._matches(" " + word)
                if not blank and len(self.words) < WORDS_KEPT and len(word) < 64:
                    self.words[word] = ids
            found[at] = ids
        return len(rest)

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        first, *rest = text.split(" ")
        words = self.words
        found = list(map(words.get, rest))
        if first and not self.ends_blank(first):
            at = self._fill(rest, found)
            if at == len(rest):
                return self._matches(first) + b"".join(found)
        parts, waiting = [], first
        for word, ids in zip(rest, found):
            if waiting is not None and (not waiting or self.ends_blank(waiting)):
                waiting += " " + word
                continue
            if waiting is not None:
                parts.append(self._matches(waiting))
                waiting = None
            if ids is None:
                ids = words.get(word)
            if ids is None and (not word or self.ends_blank(word)):
                waiting = " " + word
                continue
            if ids is None:
                ids = self._matches(" " + word)
                if len(words) < WORDS_KEPT and len(word) < 64:
                    words[word] = ids
            parts.append(ids)
        if waiting is not None:
            parts.append(self._matches(waiting))
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        if not ids:
            return b""
        return self.table.take(pa.array(np.frombuffer(ids, "<u4"))).buffers()[2].to_pybytes()


class TextEncoding:
    """The ids of a text that can be appended to and edited; matches away from the change are kept."""

    def __init__(self, vocabulary: Vocabulary, text: str = "", pattern: str = public_tokenizers.PATTERN):
        self.vocabulary, self.pattern = vocabulary, regex.compile(pattern)
        self.text, self.starts, self.parts = "", [], []
        self.edit(0, 0, text)

    def append(self, more: str) -> int:
        return self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, new: str) -> int:
        """Replaces ``text[start:end]``; returns how many matches were encoded anew.

        A match looks at most three characters past its start or one past its end, so those that
        end earlier stay. Matching goes on from there until an old start after the edit comes up.
        """
        ends = [*self.starts[1:], len(self.text)] if self.starts else []
        keep = 0
        while keep < len(ends) and ends[keep] + 3 <= start:
            keep += 1
        old_starts, old_parts, moved = self.starts, self.parts, len(new) - (end - start)
        later = {at + moved: k for k, at in enumerate(old_starts) if at >= end}
        self.text = self.text[:start] + new + self.text[end:]
        begin = ends[keep - 1] if keep else 0
        self.starts, self.parts = old_starts[:keep], old_parts[:keep]
        fresh = 0
        for match in self.pattern.finditer(self.text, begin):
            again = later.get(match.start())
            if again is not None:
                self.starts += [at + moved for at in old_starts[again:]]
                self.parts += old_parts[again:]
                break
            self.starts.append(match.start())
            self.parts.append(PrefixEncoding(self.vocabulary, match.group().encode()).ids())
            fresh += 1
        return fresh

    def ids(self) -> list[int]:
        return [token for part in self.parts for token in part]


def _mapped(path: str, source: str, name: str, kind: pa.DataType, work):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache(("prefix_bpe", path), lambda: TextEncoder(Vocabulary(read_ranks(path)), public_tokenizers.PATTERN))
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                made = [work(encoder, value) for value in batch.column(source).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in batch.schema.names if c != source), pa.array(made, kind)],
                    [*(c for c in batch.schema.names if c != source), name])
    return run


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``rid, doc_id, ids``: ids of every row's whole text as little-endian unsigned 32-bit numbers.

    Null and empty texts have no ids; repeated rows are encoded each. An empty table gives no rows.
    """
    rows = text_rows(docs)
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    work = _mapped(path, "text", "ids", pa.binary(), TextEncoder.encode)
    return rows.mapInArrow(work, schema_with(rows, ["rid", "doc_id"], "ids binary"))


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, encoded and decoded in one task.

    The digests cover the little-endian unsigned 32-bit ids and the bytes decoded from them.
    """
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

    def digests(encoder: TextEncoder, text: str) -> dict:
        ids = encoder.encode(text)
        return {"n_tokens": len(ids) // 4, "ids_sha256": hashlib.sha256(ids).hexdigest(),
                "decoded_sha256": hashlib.sha256(encoder.decode(ids)).hexdigest()}

    rows = text_rows(docs)
    kind = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    schema = schema_with(rows, ["rid", "doc_id"], "found struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>")
    return rows.mapInArrow(_mapped(path, "text", "found", kind, digests), schema).select("doc_id", "found.*")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``ids`` replaced by ``data``, the decoded bytes; null ids stay null."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    kept = [c for c in encoded.columns if c != "ids"]

    def work(encoder: TextEncoder, ids: bytes | None) -> bytes | None:
        return None if ids is None else encoder.decode(ids)
    return encoded.mapInArrow(_mapped(path, "ids", "data", pa.binary(), work), schema_with(encoded, kept, "data binary"))
