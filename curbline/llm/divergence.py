"""Source divergence audit: how the word shares of each source of a language differ from the others'.

Every partition folds whole documents into stripes, one hash entry a term that holds the term's
document frequency and its counts by source. Full tables of stripes are spilled, stripes of one
term are merged by key, and the merged stripes give the divergences of all groups at once.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbline.session import stage

# Terms in fewer documents of their language than this are left out.
LEAST_DOCUMENTS = 30
# Terms listed for each group.
TERMS_LISTED = 50
# Added to every count.
PRIOR = 5
# Entries of stripes a task holds before it spills them; an entry takes up to about 300 bytes.
ENTRIES_HELD = 400_000
# Stripes of a term that one merge brings together come from at most so many tasks.
FAN = 64
# Counts that are compared in one go, and sources whose rows of differences are made together.
CELLS = 1 << 16
SOURCES = 512

_STRIPE = "lang string, term string, part int, documents long, sources array<struct<source: string, count: long>>"
_SOURCES = pa.list_(pa.struct([("source", pa.string()), ("count", pa.int64())]))
# Letters and bytes of longer characters stay, A-Z in lower case; all else separates.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and characters beyond ASCII, with A-Z in lower case."""
    return text.translate(_LETTERS).split()


def _rows(lang: pa.Array, term: pa.Array, part: int, documents: np.ndarray, at: np.ndarray, source: pa.Array, count: np.ndarray) -> pa.RecordBatch:
    """Stripes from entries: entry k gives ``source[k]`` and ``count[k]`` to the stripe ``at[k]``; ``at`` ascends."""
    ends = np.searchsorted(at, np.arange(len(term) + 1)).astype(np.int32)
    pairs = pa.StructArray.from_arrays([source, pa.array(count, pa.int64())], fields=list(_SOURCES.value_type))
    return pa.RecordBatch.from_arrays(
        [lang, term.cast(pa.string()), pa.array(np.full(len(term), part, np.int32)), pa.array(documents, pa.int64()),
         pa.ListArray.from_arrays(pa.array(ends), pairs, type=_SOURCES)], ["lang", "term", "part", "documents", "sources"])


class _Stripes:
    """The stripes of one language: how many documents hold a term, and its counts by source."""

    def __init__(self):
        self.documents: Counter = Counter()
        self.sources: defaultdict[str, Counter] = defaultdict(Counter)

    def fold(self, source: str, words: list[bytes]) -> int:
        """Adds a document; returns how many entries that made. The empty term counts the documents of every source."""
        own = self.sources[source]
        before = len(own)
        self.documents.update(set(words))
        own.update(words)
        self.documents[b""] += 1
        own[b""] += 1
        return len(own) - before

    def rows(self, lang: str, part: int) -> pa.RecordBatch:
        place = {term: k for k, term in enumerate(self.documents)}
        at, names, counts = [], [], []
        for name, own in self.sources.items():
            at.append(np.fromiter(map(place.__getitem__, own), np.int64, len(own)))
            counts.append(np.fromiter(own.values(), np.int64, len(own)))
            names.append(np.full(len(own), len(names), np.int32))
        order = np.argsort(np.concatenate(at), kind="stable")
        source = pa.array(list(self.sources), pa.string()).take(pa.array(np.concatenate(names)[order]))
        return _rows(pa.array([lang] * len(place), pa.string()), pa.array(list(place), pa.binary()), part,
                     np.fromiter(self.documents.values(), np.int64, len(place)), np.concatenate(at)[order], source,
                     np.concatenate(counts)[order])


def _folded(entries: int):
    """Whole documents to stripes, spilled when a task holds ``entries`` entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: defaultdict[str, _Stripes] = defaultdict(_Stripes)
        size = 0
        for batch in batches:
            columns = (batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist())
            for lang, source, text in zip(*columns):
                size += held[lang].fold(source, terms(text))
                if size >= entries:
                    yield from (own.rows(name, part) for name, own in held.items())
                    held.clear()
                    size = 0
        yield from (own.rows(name, part) for name, own in held.items())
    return run


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    """Which rows differ from the row before; the first one counts."""
    return np.append(True, pc.not_equal(column[1:], column[:-1]).to_numpy().astype(bool))


def _sum(rows: pa.Table, least: int) -> Iterator[pa.RecordBatch]:
    """Adds up rows sorted by ``part, lang, term``; terms in fewer than ``least`` documents go."""
    rows = rows.combine_chunks()
    first = _changes(rows["part"]) | _changes(rows["lang"]) | _changes(rows["term"])
    starts = np.flatnonzero(first)
    documents = np.add.reduceat(rows["documents"].to_numpy(), starts)
    stays = (documents >= least) | (pc.binary_length(rows["term"].take(pa.array(starts))).to_numpy() == 0)
    if not stays.any():
        return
    chosen = rows.filter(pa.array(stays[np.cumsum(first) - 1]))
    heads, group = rows.take(pa.array(starts[stays])), np.cumsum(first[stays[np.cumsum(first) - 1]]) - 1
    lists = chosen["sources"].combine_chunks()
    flat = lists.flatten()
    names = flat.field("source").dictionary_encode()
    width = max(1, len(names.dictionary))
    key = np.repeat(group, pc.list_value_length(lists).to_numpy()) * width + names.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    key = key[order]
    begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    counts = np.add.reduceat(flat.field("count").to_numpy()[order], begins)
    key = key[begins]
    # Rows of a part follow each other; nearly always there is only one.
    part = heads["part"].to_numpy()
    edges = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part))
    for a, b in zip(edges[:-1], edges[1:]):
        own = slice(*np.searchsorted(key, [a * width, b * width]))
        yield _rows(heads["lang"][a:b].combine_chunks(), heads["term"][a:b].combine_chunks(), int(part[a]), documents[stays][a:b],
                    key[own] // width - a, names.dictionary.take(pa.array(key[own] % width)), counts[own])


def _merged(least: int):
    """Rows sorted by ``part, lang, term`` to one stripe for each; the rows of a batch and one stripe's are held at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if kept is not None:
                rows = pa.concat_tables([kept, rows])
            if not rows.num_rows:
                continue
            # The last stripe may go on in the next batch.
            cut = int(np.flatnonzero(_changes(rows["part"]) | _changes(rows["lang"]) | _changes(rows["term"]))[-1])
            if cut:
                yield from _sum(rows[:cut], least)
            kept = rows[cut:]
        if kept is not None and kept.num_rows:
            yield from _sum(kept, least)
    return run


def merged_stripes(docs: DataFrame, least: int = LEAST_DOCUMENTS, entries: int = ENTRIES_HELD, fan: int = FAN) -> DataFrame:
    """``lang, term, documents, sources``: a stripe for each term in at least ``least`` documents of its language.

    ``sources`` holds a count for each source the term occurs in. The empty term stands for the
    documents themselves, so every group is found in it. Null columns are empty.
    """
    spark = docs.sparkSession
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    found = stage(rows.mapInArrow(_folded(entries), _STRIPE), "stripes")
    parts = (found.agg(F.max("part")).first()[0] or 0) + 1
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while True:
        # A hot term has a stripe from every task; they come together by rounds.
        last = parts <= fan
        found = found.withColumn("part", F.lit(0) if last else F.floor(F.col("part") / fan).cast("int"))
        found = (found.repartition(count, "lang", "term", "part").sortWithinPartitions("part", "lang", "term")
                 .mapInArrow(_merged(least if last else 0), _STRIPE))
        parts = -(-parts // fan)
        if last:
            return stage(found.drop("part"), "stripes-kept")


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """``1 + floor(10**9 * counts / totals)``, exact for totals below 9 * 10**15, by long division."""
    whole, rest = np.zeros(np.broadcast(counts, totals).shape, np.int64), counts
    for _ in range(3):
        rest = rest * 1000
        digit = rest // totals
        rest = rest - digit * totals
        whole = whole * 1000 + digit
    return whole + 1


def _divergences(listed: int):
    def run(key: tuple, stripes: pa.Table, groups: pa.Table) -> pa.Table:
        groups = groups.sort_by("source")
        names, size = groups.column("source").combine_chunks(), groups.column("terms")[0].as_py()
        block = groups.column("own").to_numpy()
        totals = groups.column("total").to_numpy() + PRIOR * size
        words = stripes.column("term").to_pylist()
        lists = stripes.column("sources").combine_chunks()
        flat = lists.flatten()
        counts = np.zeros((len(words), len(names)), np.int64)
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        counts[np.repeat(np.arange(len(words)), lengths), pc.index_in(flat.field("source"), names).to_numpy(zero_copy_only=False)] = \
            flat.field("count").to_numpy(zero_copy_only=False)
        if len(words):
            own = shares(counts + PRIOR, totals)
            whole = shares(counts.sum(axis=1) + PRIOR, np.int64(totals.sum() - PRIOR * size * (len(names) - 1)))
        else:
            own, whole = counts, np.zeros(0, np.int64)
        source, part, item, value = [], [], [], []
        names = names.to_pylist()
        for k in np.flatnonzero(block):
            apart = np.abs(own - own[:, k:k + 1]).sum(axis=0).tolist()
            source += [names[k]] * (len(names) - 1)
            part += ["pair"] * (len(names) - 1)
            item += names[:k] + names[k + 1:]
            value += apart[:k] + apart[k + 1:]
            more = own[:, k] - whole
            at = np.flatnonzero((counts[:, k] > 0) & (more > 0))
            if len(at) > listed:
                at = at[more[at] >= np.partition(more[at], -listed)[-listed]]
            best = sorted(((-int(more[t]), words[t].encode()) for t in at))[:listed]
            source += [names[k]] * len(best)
            part += ["term"] * len(best)
            item += [word.decode() for _, word in best]
            value += [-v for v, _ in best]
        return pa.table({"lang": pa.array([key[0].as_py()] * len(source), pa.string()), "source": pa.array(source, pa.string()),
                         "part": pa.array(part, pa.string()), "item": pa.array(item, pa.string()), "value": pa.array(value, pa.int64())})
    return run


def source_divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, listed: int = TERMS_LISTED, cells: int = CELLS,
                      sources: int = SOURCES, entries: int = ENTRIES_HELD, fan: int = FAN) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) group of ``docs``.

    A language keeps the terms in at least ``least`` of its documents. A group gives each kept
    term the share ``1 + floor(10**9 * (count + 5) / (N + 5 * V))``, N being its occurrences of
    all V kept terms. Part ``pair`` compares the group with every other source of the language:
    the absolute differences of their shares, summed (0 without terms). Part ``term`` lists the
    ``listed`` terms that occur in the group and whose share exceeds the whole language's most.
    Ranks go by value, then by the UTF-8 bytes of the item. Null lang, source and text are empty;
    repeated rows count each; a language's only source has no pairs; an empty table gives no rows.
    Documents need the columns lang, source and text; others are not read.
    """
    spark = docs.sparkSession
    kept = merged_stripes(docs, least, entries, fan)
    counted = kept.select("lang", "term", F.explode("sources").alias("one")).select("lang", "term", "one.*")
    totals = (counted.groupBy("lang", "source").agg(F.sum(F.when(F.col("term") != "", F.col("count")).otherwise(0)).alias("total")))
    sizes = kept.groupBy("lang").agg(F.sum((F.col("term") != "").cast("long")).alias("terms"), F.max(F.size("sources")).alias("most"))
    largest, widest = stage(sizes, "stripe-sizes").agg(F.max(F.col("terms") * F.col("most")), F.max("most")).first()
    slices, blocks = -(-(largest or 1) // cells) or 1, -(-(widest or 1) // sources)
    # Every slice of a language's terms meets the list of its groups; a slice gives its share of all differences.
    place = Window.partitionBy("lang").orderBy("source")
    groups = (stage(totals.join(sizes.select("lang", "terms"), "lang"), "stripe-groups").withColumn("at", F.floor((F.row_number().over(place) - 1) / sources))
              .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
              .select("lang", "slice", "block", "source", "total", "terms", (F.col("at") == F.col("block")).alias("own")))
    sliced = (kept.filter("term <> ''").withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(slices)).cast("int"))
              .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
              .select("lang", "slice", "block", "term", "sources"))
    keys = ["lang", "slice", "block"]
    found = (sliced.groupBy(*keys).cogroup(groups.groupBy(*keys))
             .applyInArrow(_divergences(listed), "lang string, source string, part string, item string, value long"))
    found = stage(found, "divergences")
    pairs = (found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    terms_found = found.filter("part = 'term'").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= listed)
    return pairs.withColumn("rank", F.row_number().over(order)).unionByName(terms_found)


# The regular expression is that of ``terms``; shares are worked out in 128 bits.
ORACLE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS word FROM docs),
low AS (
  SELECT rid, lang, source, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM words),
kept AS (
  SELECT lang, term, count(*) AS whole FROM low GROUP BY lang, term HAVING count(DISTINCT rid) >= 30),
sizes AS (SELECT lang, count(*) AS v, sum(whole) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT l.lang, l.source, l.term, count(*) AS c FROM low l JOIN kept k ON k.lang = l.lang AND k.term = l.term GROUP BY l.lang, l.source, l.term),
totals AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
         1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.c, 0) + 5)) // (coalesce(t.n, 0) + 5 * s.v) AS p,
         1 + (CAST(1000000000 AS HUGEINT) * (k.whole + 5)) // (s.n + 5 * s.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY a.lang, a.source, b.source),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(d.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN apart d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST(p - q AS BIGINT) AS value FROM shares WHERE c > 0 AND p > q),
ranked AS (
  SELECT lang, source, part, item, value,
         CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
