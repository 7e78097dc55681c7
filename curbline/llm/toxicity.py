"""Toxicity by a weighted finite-state grammar over the words of a clause.

A lexicon learned from labelled rows tags words; transducers for negation, reported speech and
targets are composed into one machine that turns a clause into weighted events; the events of all
clauses of a text, not its single words, make its score.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import lean, restored, schema_with, text_rows
from curbline.session import stage

# Labelled rows used at most: patterns, weights and calibration are fitted on those with the least hash of their id.
FIT_ROWS = 20_000
# Lengths of stems; a stem stands for longer words that begin with it, not for itself.
STEMS = (3, 4, 5, 6, 7, 8)
MAX_PATTERNS = 2_000
MIN_TOXIC = 5
MIN_PRECISION = 0.6
# A pattern counts when it is found in this share of the toxic rows, or adds that many rows to those covered.
MIN_SHARE = 0.02
MIN_GAIN = 3
THRESHOLD = 0.7
WORDS_KEPT = 300_000

# Closed classes of words in the languages of the corpus.
NEGATIONS = frozenset("not no never neither nor isn't aren't don't nicht kein keine nie pas ni jamais nunca tampoco".split())
REPORTS = frozenset("said says told wrote called claims sagte sagt schrieb dit disait dijo dice escribió quoted".split())
TARGETS = frozenset("you your you're yourself he she they them him her du dich ihr euch sie tu toi vous eux ellos usted ustedes tú".split())
THREATS = frozenset("kill hurt destroy murder beat töten umbringen schlagen tuer frapper matar golpear".split())
QUOTES = frozenset('"“”„«»')

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|[\"“”„«»]")
CLAUSE_END = re.compile(r"[.,;:!?\n]+")

# Word tags: insult, threat, target, negation, report, quotation mark, other.
TAGS = "IHTNRQo"
EVENTS = ("insult", "aimed", "negated", "reported", "threat")


@dataclass
class Transducer:
    """States, and per state and symbol the next state, the symbol put out and a weight; missing symbols pass as they are."""

    start: int
    moves: dict[tuple[int, str], tuple[int, str, float]] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        return self.moves.get((state, symbol), (state, symbol, 0.0))


def compose(first: Transducer, second: Transducer, symbols: Iterable[str]) -> Transducer:
    """The machine that feeds what ``first`` puts out into ``second``; weights add up."""
    numbers, moves, open_pairs = {(first.start, second.start): 0}, {}, [(first.start, second.start)]
    while open_pairs:
        a, b = pair = open_pairs.pop()
        for symbol in symbols:
            next_a, middle, weight_a = first.step(a, symbol)
            next_b, out, weight_b = second.step(b, middle)
            target = (next_a, next_b)
            if target not in numbers:
                numbers[target] = len(numbers)
                open_pairs.append(target)
            moves[numbers[pair], symbol] = (numbers[target], out, weight_a + weight_b)
    return Transducer(0, moves)


def negation(scope: int = 3) -> Transducer:
    """Insults and threats up to ``scope`` words after a negation come out as ``n``."""
    moves = {}
    for left in range(scope + 1):
        moves[left, "N"] = (scope, "o", 0.0)
        for symbol in "HITRQo":
            out = "n" if left and symbol in "IH" else symbol
            moves[left, symbol] = (max(0, left - 1), out, 0.0)
    return Transducer(0, moves)


def reported_speech() -> Transducer:
    """Insults and threats after a verb of saying, or between quotation marks, come out as ``r``."""
    moves = {}
    for said in (0, 1):
        for quoted in (0, 1):
            state = said * 2 + quoted
            moves[state, "R"] = (2 + quoted, "o", 0.0)
            moves[state, "Q"] = (said * 2 + 1 - quoted, "o", 0.0)
            for symbol in "IH":
                moves[state, symbol] = (state, "r" if state else symbol, 0.0)
    return Transducer(0, moves)


def targets() -> Transducer:
    """Insults beside a target in the clause come out as ``a``; a threat counts double when aimed."""
    moves = {}
    for seen in (0, 1):
        moves[seen, "T"] = (1, "o", 0.0)
        moves[seen, "I"] = (seen, "a" if seen else "I", 0.0)
        moves[seen, "H"] = (seen, "t", 2.0 if seen else 0.5)
    return Transducer(0, moves)


GRAMMAR = compose(compose(negation(), reported_speech(), TAGS), targets(), TAGS)
_EVENT_OF = {"I": 0, "a": 1, "n": 2, "r": 3, "t": 4}
# What words are tagged with that are no insults; all of a class share one pair.
_CLASSES = [((tag, 0.0), words) for tag, words in (("H", THREATS), ("T", TARGETS), ("N", NEGATIONS), ("R", REPORTS), ("Q", QUOTES))]
_OTHER = ("o", 0.0)


class Lexicon:
    """Tags words and weighs insults by the learned patterns: whole words, and stems written ``stem*``."""

    def __init__(self, patterns: dict[str, float]):
        self.words = {p: w for p, w in patterns.items() if not p.endswith("*")}
        self.stems = {p[:-1]: w for p, w in patterns.items() if p.endswith("*")}
        self.known: dict[str, tuple[str, float]] = {}

    def tag(self, word: str) -> tuple[str, float]:
        found = self.known.get(word)
        if found is None:
            weights = [self.words.get(word, 0.0), *(self.stems.get(word[:n], 0.0) for n in STEMS if len(word) > n)]
            weight = max(weights)
            if weight > 0:
                found = ("I", weight)
            else:
                found = next((tagged for tagged, words in _CLASSES if word in words), _OTHER)
            if len(self.known) < WORDS_KEPT:
                self.known[word] = found
        return found


def events(text: str, lexicon: Lexicon) -> np.ndarray:
    """Weight of each kind of event over the clauses of the text."""
    total = np.zeros(len(EVENTS))
    tag = lexicon.tag
    text = text.lower()
    if not any(tag(word)[0] in "IH" for word in WORD.findall(text)):
        return total
    for clause in CLAUSE_END.split(text):
        tagged = [tag(word) for word in WORD.findall(clause)]
        if not any(t in "IH" for t, _ in tagged):
            continue
        state = GRAMMAR.start
        for symbol, weight in tagged:
            state, out, bonus = GRAMMAR.step(state, symbol)
            if out in _EVENT_OF:
                total[_EVENT_OF[out]] += weight + bonus
    return total


@dataclass
class Model:
    """Learned patterns with their weights, and the weights of the events in a text's log odds."""

    patterns: dict[str, float]
    bias: float
    weights: list[float]

    def score(self, found: np.ndarray) -> float:
        odds = self.bias + float(np.dot(self.weights, np.log1p(found)))
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, odds))))


@lean
def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``text, toxic`` to ``word, toxic, rows``, summed over each batch; a text counts once for a word."""
    for whole in batches:
        for start in range(0, whole.num_rows, 500):
            batch = whole.slice(start, 500)
            toxic, rows = Counter(), Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                words = set(WORD.findall(text.lower()))
                rows.update(words)
                if label:
                    toxic.update(words)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows), pa.string()), pa.array([toxic[w] for w in rows], pa.int64()),
                 pa.array(list(rows.values()), pa.int64())], ["word", "toxic", "rows"])


def pattern_counts(held: DataFrame) -> DataFrame:
    """``pattern, toxic, rows`` of words and stems; a text counts once for each different word."""
    words = (held.select("text", "toxic").mapInArrow(_count_words, "word string, toxic long, rows long")
             .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("rows").alias("rows")))
    lengths = F.filter(F.array(*[F.lit(n) for n in STEMS]), lambda n: n < F.length("word"))
    stems = F.transform(lengths, lambda n: F.concat(F.substring("word", F.lit(1), n), F.lit("*")))
    return (words.select(F.explode(F.concat(F.array("word"), stems)).alias("pattern"), "toxic", "rows")
            .groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("rows").alias("rows")))


def _occurrences(patterns: frozenset[str]):
    """Which patterns a row holds, each with a hash of the words around its first place."""
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, found, around = [], [], []
            for rid, text in zip(batch.column("rid").to_pylist(), batch.column("text").to_pylist()):
                words, seen = WORD.findall(text.lower()), set()
                for at, word in enumerate(words):
                    for pattern in (word, *(f"{word[:n]}*" for n in STEMS if len(word) > n)):
                        if pattern in patterns and pattern not in seen:
                            seen.add(pattern)
                            row.append(rid)
                            found.append(pattern)
                            around.append(zlib.crc32(" ".join(words[max(0, at - 1):at] + ["_"] + words[at + 1:at + 2]).encode()))
            yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(found, pa.string()), pa.array(around, pa.int64())],
                                             ["rid", "pattern", "around"])
    return run


def choose_patterns(found: list[tuple[int, str, int]], toxic: set[int]) -> dict[str, float]:
    """Patterns with weights from their places ``(row, pattern, words around)`` and the rows that are toxic.

    A word that is put into texts stands between many different words; one that only a group of
    copies repeats does not, and is left out. Of patterns in the same rows the longest is taken.
    """
    held: dict[str, set[int]] = {}
    clean: Counter = Counter()
    places: dict[str, set[int]] = {}
    for row, pattern, around in found:
        if row in toxic:
            held.setdefault(pattern, set()).add(row)
            places.setdefault(pattern, set()).add(around)
        else:
            clean[pattern] += 1
    varied = [p for p in held if len(held[p]) >= MIN_TOXIC and len(places[p]) >= MIN_TOXIC - 1 and 3 * len(places[p]) >= len(held[p])
              and len(held[p]) >= MIN_PRECISION * (len(held[p]) + clean[p])]
    chosen: dict[frozenset, str] = {}
    covered: set[int] = set()
    for pattern in sorted(varied, key=lambda p: (-len(held[p]), -len(p), p)):
        rows = frozenset(held[pattern])
        if rows not in chosen and (len(rows) >= MIN_SHARE * len(toxic) or len(rows - covered) >= MIN_GAIN):
            chosen[rows] = pattern
            covered |= rows
    return {p: math.log((len(rows) + 0.5) / (clean[p] + 0.5)) for rows, p in chosen.items()}


def fit_events(found: np.ndarray, toxic: np.ndarray) -> tuple[float, list[float]]:
    """Bias and event weights of a logistic regression, drawn towards what the grammar means."""
    start = np.array([-3.0, 2.0, 2.5, 0.5, 0.5, 1.0])
    x = np.hstack([np.ones((len(found), 1)), np.log1p(found)])
    pull = np.array([0.01, 1.0, 1.0, 1.0, 1.0, 1.0])
    w = start.copy()
    for _ in range(50 if len(found) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - toxic) + pull * (w - start)
        change = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), gradient)
        w -= np.clip(change, -2, 2)
        if np.abs(change).max() < 1e-6:
            break
    # An event never speaks for a clean text.
    return float(w[0]), np.maximum(w[1:], 0).tolist()


def _events_of(patterns: dict[str, float]):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(patterns)
        for batch in batches:
            rows = [events(text, lexicon).tolist() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "found"])
    return run


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Patterns and weights from at most ``rows`` labelled documents.

    ``labels`` has ``doc_id`` and ``toxic``, and only rows that may be learned from. Null ids and
    null labels are not used; of repeated ids any label above zero counts. Without usable rows the
    model has no patterns and scores threats alone.
    """
    known = (labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id")
             .agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # The sample's size is fixed, so it is sent to where the documents are.
    held = stage(text_rows(docs).join(F.broadcast(sample), "doc_id").select("rid", "text", F.col("toxic").cast("long").alias("toxic")),
                 "toxicity-sample")
    counts = pattern_counts(held)
    table = [r[0] for r in counts.filter((F.col("toxic") >= MIN_TOXIC) & (F.col("toxic") >= MIN_PRECISION * F.col("rows")))
             .orderBy(F.desc("toxic"), "pattern").limit(MAX_PATTERNS).select("pattern").collect()]
    patterns: dict[str, float] = {}
    if table:
        found = held.select("rid", "text").mapInArrow(_occurrences(frozenset(table)), "rid long, pattern string, around long").collect()
        toxic = {r[0] for r in held.filter("toxic > 0").select("rid").collect()}
        patterns = choose_patterns([tuple(r) for r in found], toxic)
    rows_of = held.select("text", "toxic").mapInArrow(_events_of(patterns), "toxic long, found array<double>").collect()
    matrix = np.array([r["found"] for r in rows_of]).reshape(-1, len(EVENTS))
    bias, weights = fit_events(matrix, np.array([min(1, r["toxic"]) for r in rows_of], float))
    return Model(patterns, bias, weights)


def _scored(model: Model):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.patterns)
        for batch in batches:
            scores = [model.score(events(text, lexicon)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])
    return run


def score_documents(docs: DataFrame, model: Model, carry: bool = False) -> DataFrame:
    """``rid, doc_id, text, score`` (and ``rest``) of every row; null and empty texts have no event and the base score."""
    rows = text_rows(docs, carry)
    return rows.mapInArrow(_scored(model), schema_with(rows, rows.columns, "score double"))


def clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all columns."""
    scored = score_documents(docs, fit(docs, labels), carry=True)
    return restored(scored.filter(F.col("score") < threshold), docs)
