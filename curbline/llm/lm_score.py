"""A hashed maximum-entropy language model with a class-factored softmax.

``P(word | history) = P(class | history) * P(subclass | class, history) * P(word | subclass)``.
The first two factors are softmaxes over sums of weight rows, found by hashing the features of the
history: the word before, the pair before, and the words two and three back alone (skips). They
are trained by gradient steps that tasks take on their share of the corpus; the steps are brought
together row by row. The last factor is the maximum-entropy solution for a bias alone, the smoothed
share of counts. Words beyond the most frequent ones form a class of their own, divided by spelling.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import numbered_rows, slices
from curbline.session import stage

# The most frequent words, which every task knows; all others are looked up by a join.
HOT_WORDS = 1 << 17
HOT_BYTES = 64
CLASSES = 32  # the last one holds all other words
SUBCLASSES = 32
CLASS_ROWS = 1 << 15
SUBCLASS_ROWS = 1 << 16
ROUNDS = 2
RATE = 0.7
# Added to a row's sum of squared gradients; a rarely seen row moves by little.
DAMPING = 5.0
TOKENS = 1 << 14  # in a gradient step
SCORED_TOKENS = 1 << 12  # scored in one go
SCORED_TEXTS = 200  # whose scores are added up together
FEW = 8  # rows of a weight row's errors that are added one at a time
BLOCK_ROWS = 256
COUNTED_BYTES = 16 << 20  # of words that a task counts in one go
END = b""
_MIX = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def words_of(text: str) -> list[bytes]:
    """Words with A-Z in lower case, and the end."""
    return [*text.encode().lower().split(), END]


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The tokens of all texts, as numbers into the different words; where each text's tokens begin and the last one's end; the words."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = split.flatten().dictionary_encode()
    numbers, ends = coded.indices.to_numpy(), split.offsets.to_numpy()
    # Blanks around a text leave empty words, which are no tokens; the end is one.
    real = numbers != coded.dictionary.index("").as_py()
    ends = np.append(0, np.cumsum(real))[ends]
    kinds = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END], pa.binary())])
    return np.insert(numbers[real], ends[1:], len(kinds) - 1), ends + np.arange(len(ends)), kinds


@dataclass
class Vocabulary:
    """The frequent words with their places in the classes, and how other words are divided."""

    ids: dict[bytes, int]
    counts: np.ndarray
    classes: np.ndarray
    subclasses: np.ndarray
    inside: np.ndarray  # log10 P(word | subclass)
    bounds: list[bytes]  # spelling bounds of the subclasses of other words
    rare_total: np.ndarray  # (count + 1) over the other words of a subclass, and 1 for an unknown one
    class_bias: np.ndarray
    subclass_bias: np.ndarray
    # Count and spelling of the last frequent word.
    floor: int = 0
    border: bytes = b""

    @property
    def size(self) -> int:
        return len(self.counts)


def _shares(weights: np.ndarray, parts: int) -> np.ndarray:
    """Numbers 0 to ``parts - 1`` that rise along the array, with about the same weight each."""
    middle = np.cumsum(weights) - weights / 2
    return np.minimum(parts - 1, (middle * parts / max(1, weights.sum())).astype(np.int64))


def spelling_bounds(words: list[bytes], counts: np.ndarray) -> list[bytes]:
    """Bounds that divide the rarer half of the words by spelling into parts of about the same weight."""
    order = sorted(range(len(words) // 2, len(words)), key=lambda k: words[k])
    if not order:
        return []
    parts = _shares(counts[order].astype(float), SUBCLASSES)
    starts = np.flatnonzero(parts[1:] != parts[:-1]) + 1
    return [words[order[k]] for k in starts]


def vocabulary(words: list[bytes], counts: np.ndarray, bounds: list[bytes], rare_count: np.ndarray, rare_words: np.ndarray) -> Vocabulary:
    """Classes by frequency, subclasses within a class by spelling; ``words`` in order of descending count."""
    weights = counts.astype(float) + 1
    classes = _shares(weights, CLASSES - 1) if len(words) else np.zeros(0, np.int64)
    subclasses = np.zeros(len(words), np.int64)
    for number in range(CLASSES - 1):
        members = np.flatnonzero(classes == number)
        if len(members):
            members = np.array(sorted(members, key=lambda k: words[k]))
            subclasses[members] = np.arange(len(members)) if len(members) <= SUBCLASSES else _shares(weights[members], SUBCLASSES)
    leaf = classes * SUBCLASSES + subclasses
    totals = np.bincount(leaf, weights, CLASSES * SUBCLASSES)
    rare_total = rare_count + rare_words + 1.0
    totals[(CLASSES - 1) * SUBCLASSES:(CLASSES - 1) * SUBCLASSES + len(bounds) + 1] = rare_total[:len(bounds) + 1]
    table = totals.reshape(CLASSES, SUBCLASSES)
    with np.errstate(divide="ignore"):
        class_bias = np.log(table.sum(axis=1) / table.sum())
        subclass_bias = np.where(table > 0, np.log(table / np.maximum(table.sum(axis=1, keepdims=True), 1e-300)), -np.inf)
    return Vocabulary({w: k for k, w in enumerate(words)}, counts, classes, subclasses, np.log10(weights / totals[leaf]) if len(words) else weights,
                      bounds, rare_total, class_bias.astype(np.float32), subclass_bias.astype(np.float32))


class Weights:
    """Hashed weight rows of the two softmaxes, with the sums of squares their steps are scaled by."""

    def __init__(self, classes: np.ndarray | None = None, subclasses: np.ndarray | None = None):
        self.classes = np.zeros((CLASS_ROWS, CLASSES), np.float32) if classes is None else classes
        self.subclasses = np.zeros((SUBCLASS_ROWS, SUBCLASSES), np.float32) if subclasses is None else subclasses


def features(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the four features for every token of an array with three start symbols before each text.

    Returns them by feature and token; rows at start symbols are to be left out.
    """
    s = symbols.astype(np.uint64) + np.uint64(1)
    one, two, three = (np.concatenate([np.zeros(k, np.uint64), s[:-k]]) for k in (1, 2, 3))
    hashed = np.stack([one * _MIX[0], (one * _MIX[1]) ^ (two * _MIX[2] + np.uint64(7)), two * _MIX[3] + np.uint64(3), three * _MIX[4] + np.uint64(5)])
    hashed ^= hashed >> np.uint64(31)
    return hashed * _MIX[2]


def _rows(hashed: np.ndarray, count: int) -> np.ndarray:
    return (hashed >> np.uint64(64 - (count - 1).bit_length())).astype(np.int64)


def _powers_of(logits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numerators of the softmax by row, in place, and their sums. Sums of trained rows stay far below what a float can take."""
    np.exp(np.minimum(logits, np.float32(80), out=logits), out=logits)
    return logits, logits @ np.ones(logits.shape[1], np.float32)


def _shares_of(logits: np.ndarray) -> np.ndarray:
    """Softmax by row, in place."""
    powers, total = _powers_of(logits)
    powers /= total[:, None]
    return powers


def _share_at(logits: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """One column of the softmax for each row."""
    powers, total = _powers_of(logits)
    return powers[np.arange(len(columns)), columns] / total


def summed(error: np.ndarray, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of the error rows ``order[start:start + size]`` for each start."""
    sums = error.take(order.take(starts), axis=0)
    # Most rows of rare features come once; only the others have to be added up.
    several = np.flatnonzero((sizes > 1) & (sizes <= FEW))
    if len(several):
        # The largest first, so that those with one more to add are always the first ones.
        several = several.take(np.argsort(FEW - sizes.take(several).astype(np.uint8), kind="stable"))
        first, left = starts.take(several), np.bincount(sizes.take(several), minlength=FEW + 1)[::-1].cumsum()[::-1]
        added = sums.take(several, axis=0)
        for size in range(2, FEW + 1):
            count = left[size]
            if not count:
                break
            added[:count] += error.take(order.take(first[:count] + (size - 1)), axis=0)
        _set_rows(sums, several, added)
    many = np.flatnonzero(sizes > FEW)
    if len(many):
        length = sizes.take(many)
        ends = np.cumsum(length)
        held = error.take(order.take(np.arange(ends[-1]) + np.repeat(starts.take(many) - ends + length, length)), axis=0)
        ones = np.ones(length.max(), np.float32)
        for k, size, end in zip(many.tolist(), length.tolist(), ends.tolist()):
            sums[k] = ones[:size] @ held[end - size:end]
    return sums


def _set_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    # A row is set as one value, which numpy copies faster than a row of numbers.
    whole = np.dtype((np.void, table.strides[0]))
    table.view(whole)[at, 0] = rows.view(whole)[:, 0]


def _step(table: np.ndarray, squares: np.ndarray, touched: np.ndarray, rows: np.ndarray, error: np.ndarray, rate: float) -> None:
    """One gradient step: adds up the error by weight row and moves each row by its own scale."""
    keys = rows.astype(np.uint16) if len(table) <= 1 << 16 else rows
    order = np.argsort(keys, kind="stable")
    ordered = keys.take(order)
    starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    sizes = np.diff(np.append(starts, len(rows)))
    sums = summed(error, order, starts, sizes)
    at = ordered.take(starts).astype(np.int64)
    scale = squares.take(at) + np.einsum("ij,ij->i", sums, sums)
    squares[at] = scale
    touched[at] += sizes
    sums *= (np.float32(rate) / np.sqrt(scale + np.float32(DAMPING)))[:, None]
    moved = table.take(at, axis=0)
    moved -= sums
    _set_rows(table, at, moved)


class Scorer:
    """Symbols, probabilities and gradient steps for lists of texts."""

    def __init__(self, words: Vocabulary, weights: Weights):
        self.words, self.weights = words, weights
        self.hot = pa.array(words.ids, pa.binary())
        self.start = words.size + SUBCLASSES
        self.leaf_class = np.concatenate([words.classes, np.full(SUBCLASSES, CLASSES - 1)])
        self.leaf_subclass = np.concatenate([words.subclasses, np.arange(SUBCLASSES)])
        inside = np.zeros(SUBCLASSES)
        inside[:len(words.rare_total)] = -np.log10(words.rare_total)
        # For other words without the count, which is joined later.
        self.inside = np.concatenate([words.inside, inside])
        self.squares = [np.zeros(len(weights.classes), np.float32), np.zeros(len(weights.subclasses), np.float32)]
        self.touched = [np.zeros(len(weights.classes), np.int64), np.zeros(len(weights.subclasses), np.int64)]

    def symbols(self, tokens: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """The tokens as numbers, other words by their subclass, and the other words themselves."""
        found, other = self.kinds(pa.array(tokens, pa.binary()))
        return found, [token for token, is_other in zip(tokens, other.tolist()) if is_other]

    def kinds(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of words, other words by their subclass, and which ones are other words."""
        found = pc.fill_null(pc.index_in(words, self.hot), -1).to_numpy().astype(np.int64)
        other = found < 0
        bounds = self.words.bounds
        found[other] = self.words.size + np.array([bisect_right(bounds, word) for word in words.filter(pa.array(other)).to_numpy(zero_copy_only=False)], np.int64)
        return found, other

    def padded(self, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """All texts after one another, three start symbols before each, and where the tokens are."""
        pad = np.full(3, self.start)
        joined = np.concatenate([x for part in parts for x in (pad, part)])
        return joined, np.flatnonzero(joined != self.start)

    def _hashes(self, joined: np.ndarray, at: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashed = features(joined)[:, at]
        below = (hashed[:3] ^ (classes.astype(np.uint64) * _MIX[4])) * _MIX[1]
        return _rows(hashed, CLASS_ROWS), _rows(below ^ (below >> np.uint64(32)) * _MIX[0], SUBCLASS_ROWS)

    def _logits(self, rows: np.ndarray, table: np.ndarray, bias: np.ndarray) -> np.ndarray:
        total = table.take(rows[0], axis=0)
        for more in rows[1:]:
            total += table.take(more, axis=0)
        total += bias
        return total

    def log10(self, parts: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each text's tokens, but for the counts of other words."""
        out = np.zeros(len(parts))
        joined, places = self.padded(parts)
        sums = np.empty(len(places))
        for begin in range(0, len(places), SCORED_TOKENS):
            at = places[begin:begin + SCORED_TOKENS]
            low, high = max(0, at[0] - 3), at[-1] + 1
            sums[begin:begin + SCORED_TOKENS] = self._log10(joined[low:high], at - low)
        lengths = np.array([len(p) for p in parts])
        ends = np.cumsum(lengths)
        running = np.concatenate([[0.0], np.cumsum(sums)])
        out[:] = running[ends] - running[ends - lengths]
        return out

    def _log10(self, joined: np.ndarray, at: np.ndarray) -> np.ndarray:
        symbols = joined[at]
        classes, subclasses = self.leaf_class[symbols], self.leaf_subclass[symbols]
        upper, lower = self._hashes(joined, at, classes)
        of_class = _share_at(self._logits(upper, self.weights.classes, self.words.class_bias), classes)
        of_subclass = _share_at(self._logits(lower, self.weights.subclasses, self.words.subclass_bias.take(classes, axis=0)), subclasses)
        return np.log10(of_class.astype(float)) + np.log10(of_subclass.astype(float)) + self.inside[symbols]

    def train(self, parts: list[np.ndarray], rate: float) -> None:
        joined, places = self.padded(parts)
        for begin in range(0, len(places), TOKENS):
            at = places[begin:begin + TOKENS]
            low, high = max(0, at[0] - 3), at[-1] + 1
            self._train(joined[low:high], at - low, rate)

    def _train(self, joined: np.ndarray, at: np.ndarray, rate: float) -> None:
        symbols = joined[at]
        classes, subclasses = self.leaf_class[symbols], self.leaf_subclass[symbols]
        line = np.arange(len(at))
        for level, (rows, table, bias, wanted) in enumerate(zip(
                self._hashes(joined, at, classes), (self.weights.classes, self.weights.subclasses),
                (self.words.class_bias, self.words.subclass_bias.take(classes, axis=0)), (classes, subclasses))):
            error = _shares_of(self._logits(rows, table, bias))
            error[line, wanted] -= 1
            for feature in rows:
                _step(table, self.squares[level], self.touched[level], feature, error, rate)


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, texts = [], 0

    def counted() -> pa.RecordBatch:
        found = pc.value_counts(pa.chunked_array(held, pa.string()))
        found = found.filter(pc.not_equal(found.field("values"), ""))
        return pa.RecordBatch.from_arrays([pa.concat_arrays([found.field("values").cast(pa.binary()), pa.array([END], pa.binary())]),
                                           pa.concat_arrays([found.field("counts"), pa.array([texts], pa.int64())])], ["word", "n"])

    for batch in batches:
        held.append(pc.ascii_split_whitespace(pc.ascii_lower(batch.column("text"))).flatten())
        texts += batch.num_rows
        if sum(words.nbytes for words in held) >= COUNTED_BYTES:
            yield counted()
            held, texts = [], 0
    if texts:
        yield counted()


def count_tokens(rows: DataFrame) -> DataFrame:
    """``word, c`` over the texts of ``rows``; the end is the empty word."""
    return rows.select("text").mapInArrow(_token_counts, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _spelling_subclass(bounds: list[bytes]) -> Column:
    """Number of bounds at or below the word."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col("word")))


def build_vocabulary(counts: DataFrame, hot_words: int = HOT_WORDS) -> Vocabulary:
    """The most frequent words come to the driver, at most ``hot_words`` of at most 64 bytes; of the others, sums."""
    top = counts.filter((F.octet_length("word") <= HOT_BYTES) & (F.octet_length("word") > 0)).orderBy(F.desc("c"), "word").limit(hot_words)
    end = counts.filter(F.octet_length("word") == 0).agg(F.sum("c")).first()[0] or 0
    table = top.toArrow()
    hot = sorted([*zip(table.column("word").to_pylist(), table.column("c").to_pylist()), *([(END, end)] if end else [])],
                 key=lambda x: (-x[1], x[0]))
    words, weights = [w for w, _ in hot], np.array([c for _, c in hot], np.int64)
    bounds = spelling_bounds(words, weights)
    rare_count, rare_words = np.zeros(SUBCLASSES), np.zeros(SUBCLASSES)
    floor = min((c for w, c in hot if w), default=0)
    border = max((w for w, c in hot if w and c == floor), default=b"")
    rare = counts.filter(rare_filter(floor, border))
    for row in rare.groupBy(_spelling_subclass(bounds).alias("part")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        rare_count[row["part"]], rare_words[row["part"]] = row["c"], row["n"]
    found = vocabulary(words, weights, bounds, rare_count, rare_words)
    found.floor, found.border = floor, border
    return found


def rare_filter(floor: int, border: bytes) -> Column:
    """Counted words that are not among the frequent ones."""
    return (F.octet_length("word") > HOT_BYTES) | ((F.octet_length("word") > 0) & (
        (F.col("c") < floor) | ((F.col("c") == floor) & (F.col("word") > F.lit(border)))))


def _trained(words, weights, rate: float):
    """Trains a copy of the weights on the task's texts; gives the moves of the rows it touched, by blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = weights.value
        scorer = Scorer(words.value, Weights(before.classes.copy(), before.subclasses.copy()))
        waiting, size = [], 0
        for batch in batches:
            numbers, ends, kinds = tokens_of(batch.column("text"))
            for part in np.split(scorer.kinds(kinds)[0][numbers], ends[1:-1]):
                waiting.append(part)
                size += len(part)
                if size >= 4 * TOKENS:
                    scorer.train(waiting, rate)
                    waiting, size = [], 0
        if waiting:
            scorer.train(waiting, rate)
        for level, (old, new, touched) in enumerate(zip((before.classes, before.subclasses),
                                                        (scorer.weights.classes, scorer.weights.subclasses), scorer.touched)):
            moved = (new - old) * np.minimum(touched, 1 << 20)[:, None]
            for block in range(0, len(old), BLOCK_ROWS):
                part = touched[block:block + BLOCK_ROWS]
                if part.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([level], pa.int32()), pa.array([block], pa.int32()),
                         pa.array([np.minimum(part, 1 << 20).astype("<f4").tobytes()], pa.binary()),
                         pa.array([moved[block:block + BLOCK_ROWS].astype("<f4").tobytes()], pa.binary())],
                        ["level", "block", "touched", "moved"])
    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the moves of each block, in order of blocks; memory for one block."""
    key, sums = None, None

    def out():
        touched, moved = sums
        mean = moved / np.maximum(touched, 1)[:, None]
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                                           pa.array([mean.astype("<f4").tobytes()], pa.binary())], ["level", "block", "moved"])

    for batch in batches:
        for level, block, touched, moved in zip(*[batch.column(c).to_pylist() for c in ("level", "block", "touched", "moved")]):
            if key != (level, block):
                if key is not None:
                    yield out()
                width = CLASSES if level == 0 else SUBCLASSES
                key, sums = (level, block), [np.zeros(BLOCK_ROWS), np.zeros((BLOCK_ROWS, width))]
            sums[0] += np.frombuffer(touched, "<f4")
            sums[1] += np.frombuffer(moved, "<f4").reshape(sums[1].shape)
    if key is not None:
        yield out()


def train(rows: DataFrame, words: Vocabulary, rounds: int = ROUNDS, rate: float = RATE) -> Weights:
    """One pass over all rows in ``rounds`` parts; each part starts from the steps of all tasks on the one before."""
    spark = rows.sparkSession
    context = spark.sparkContext
    sent, weights = context.broadcast(words), Weights()
    tasks = max(1, context.defaultParallelism)
    for number in range(rounds):
        part = rows.filter(F.pmod(F.xxhash64("rid"), F.lit(rounds)) == number).select("text").coalesce(tasks)
        base = context.broadcast(weights)
        moves = (part.mapInArrow(_trained(sent, base, rate / (1 + number)), "level int, block int, touched binary, moved binary")
                 .repartition(tasks, "level", "block").sortWithinPartitions("level", "block")
                 .mapInArrow(_averaged, "level int, block int, moved binary"))
        weights = Weights(weights.classes.copy(), weights.subclasses.copy())
        for row in moves.collect():  # as large as the weights
            table = weights.classes if row["level"] == 0 else weights.subclasses
            table[row["block"]:row["block"] + BLOCK_ROWS] += np.frombuffer(row["moved"], "<f4").reshape(-1, table.shape[1])
    return weights


def _scored(words, weights):
    """A row with the sums of each text, and a row for each of its other words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(words.value, weights.value)
        seen = np.concatenate([np.log10(words.value.counts + 1.0), np.zeros(SUBCLASSES)])
        for batch in slices(batches, 1000):
            rids, size = batch.column("rid").to_numpy(), batch.num_rows
            numbers, ends, kinds = tokens_of(batch.column("text"))
            found, other = scorer.kinds(kinds)
            parts = np.split(found[numbers], ends[1:-1])
            scores = np.concatenate([scorer.log10(parts[start:start + SCORED_TEXTS]) for start in range(0, size, SCORED_TEXTS)])
            # Each text's other words, with their times.
            at = np.flatnonzero(other[numbers])
            text = np.searchsorted(ends, at, side="right") - 1
            pair, times = np.unique(text * len(kinds) + numbers[at], return_counts=True)
            # No word holds a blank, so these keys match no count and are dealt evenly.
            word = pa.concat_arrays([pa.array([b" %d" % rid for rid in rids.tolist()], pa.binary()), kinds.take(pa.array(pair % len(kinds)))])
            none, nothing, n_tokens = np.zeros(len(pair), np.int64), np.zeros(len(pair)), np.diff(ends)
            columns = [np.concatenate([rids, rids[pair // len(kinds)]]), word, np.concatenate([np.zeros(size, np.int64), times]),
                       np.concatenate([n_tokens, none]), np.concatenate([n_tokens - np.bincount(text, minlength=size), none]),
                       np.concatenate([[seen[part].sum() for part in parts], nothing]), np.concatenate([scores, nothing])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns],
                                             ["rid", "word", "times", "n_tokens", "n_hot", "base", "score"])
    return run


def score_documents(docs: DataFrame, held_out: Column, hot_words: int = HOT_WORDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    The rows where ``held_out`` is not true are learned from. Null text counts as empty and has the
    end as its only token; ``held_out`` counts as false where null; repeated rows are counted and
    scored each. Without rows to learn from every token is unknown. An empty table gives no rows.
    """
    spark = docs.sparkSession
    told = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    rows = numbered_rows(told, carry=True).select("rid", "doc_id", "text", F.col("rest.held_out").alias("held_out"))
    learned = rows.filter("not held_out")
    counts = stage(count_tokens(learned), "token-counts")
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    words = build_vocabulary(counts, hot_words)
    weights = train(learned, words)
    context = spark.sparkContext
    scored = rows.select("rid", "text").mapInArrow(
        _scored(context.broadcast(words), context.broadcast(weights)),
        "rid long, word binary, times long, n_tokens long, n_hot long, base double, score double")
    rare = counts.filter(rare_filter(words.floor, words.border))
    joined = scored.join(rare, "word", "left")
    seen = F.coalesce("c", F.lit(0))
    sums = joined.groupBy("rid").agg(
        F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("n_hot") + F.when(seen > 0, F.col("times")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.col("times") * F.log10(seen + 1)).alias("base"),
        F.sum(F.col("score") + F.col("times") * F.log10(seen + 1)).alias("score"))
    floor = float(np.log10(tokens + distinct + 1))
    return rows.select("rid", "doc_id", "held_out").join(sums, "rid").select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(floor)).alias("base_score"), "score")
