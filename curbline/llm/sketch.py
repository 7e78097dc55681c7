"""Document fingerprints: every shingle hash below a fixed fraction of the hash range."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbline.llm.common import BLANK_RUN, text_rows
from curbline.session import stage

WORDS = 5
FRACTION = 1 / 4


def with_sketch(rows: DataFrame, text: str, name: str, words: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """Adds ``name``: the sorted distinct shingle hashes of the text in the lowest ``fraction`` of the range.

    Shingles are runs of ``words`` lower-case words; a text with fewer words is one shingle, a
    text without words has none. Sketches of parts unite to the sketch of the whole (but for
    shingles across the seam), and sketches of texts of any two lengths can be compared.
    """
    if not 0 < fraction <= 0.5:
        raise ValueError("fraction must be above 0 and at most 0.5")
    limit = F.lit(int(fraction * 2.0 ** 64) - 1)
    rows = rows.withColumn(f"_{name}_words", F.transform(
        F.filter(F.split(F.lower(text), BLANK_RUN), lambda word: word != ""), lambda word: F.xxhash64(word)))
    hashes, size = F.col(f"_{name}_words"), F.size(f"_{name}_words")
    shingles = (F.when(size >= words, F.transform(
        F.sequence(F.lit(0), size - words), lambda at: F.xxhash64(*[F.get(hashes, at + k) for k in range(words)])))
        .when(size > 0, F.array(F.xxhash64(hashes)))
        .otherwise(F.array().cast("array<bigint>")))
    kept = F.filter(shingles, lambda h: (h >= 0) & (h <= limit))
    return rows.withColumn(name, F.array_sort(F.array_distinct(kept))).drop(f"_{name}_words")


def fingerprint(sketch: Column, text: Column) -> Column:
    """The low 32 bits of each retained hash in hexadecimal; where none is retained, ``=`` and a hash of the text."""
    digits = F.array_join(F.transform(sketch, lambda h: F.right(F.hex(h + F.lit(1 << 62)), F.lit(8))), "")
    return F.when(F.size(sketch) > 0, digits).otherwise(F.concat(F.lit("="), F.lower(F.hex(F.xxhash64(text)))))


def containment(a: Column, b: Column, a_print: Column, b_print: Column) -> Column:
    """Share of the smaller sketch found in the other; without retained hashes 1 for equal fingerprints, else 0."""
    smaller = F.least(F.size(a), F.size(b))
    return (F.when(a_print == b_print, F.lit(1.0)).when(smaller == 0, F.lit(0.0))
            .otherwise(F.size(F.array_intersect(a, b)) / smaller))


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many bounds are below ``key``, by halving."""
    if not bounds:
        return F.lit(0)
    table, size = F.array(*[F.lit(b) for b in bounds]), len(bounds)
    steps = [1 << k for k in reversed(range(size.bit_length()))]
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, step: F.when(
        (at + step <= size) & (F.get(table, F.least(at + step, F.lit(size)) - 1) < key), at + step).otherwise(at))


def with_next(rows: DataFrame, key: str, tie: str, columns: list[str], buckets: int,
              derived: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """Adds ``next_<c>`` for each column: its value in the next row by descending ``key``, after the last the first.

    ``derived`` adds columns that follow from a row, which may be among those. Rows are dealt to ranges of the key. The first rows of a range are also given to the range
    before it, as its end; they are found from one number a range, so no task sorts all rows.
    """
    spark = rows.sparkSession
    shares = [k / buckets for k in range(1, buckets)]
    bounds = (rows.agg(F.percentile_approx(key, shares, 10000)).first()[0] or []) if shares else []
    bounds = sorted(set(bounds))
    dealt = rows.withColumn("_bucket", _bucket(F.col(key), bounds))
    tops = sorted(dealt.groupBy("_bucket").agg(F.max(key).alias("top")).collect(), key=lambda r: -r[0])
    ends = [(tops[(k + 1) % len(tops)][1], top[0]) for k, top in enumerate(tops)]
    follows = spark.createDataFrame(ends, "_top long, _before int")
    copies = dealt.join(F.broadcast(follows), F.col(key) == F.col("_top"), "left").withColumn(
        "_at", F.explode(F.filter(F.array(F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("extra")),
                                          F.struct(F.col("_before").alias("bucket"), F.lit(True).alias("extra"))),
                                  lambda at: at["bucket"].isNotNull())))
    placed = copies.withColumns({"_bucket": F.col("_at.bucket"), "_extra": F.col("_at.extra")}).drop("_top", "_before", "_at")
    # Dealt here, so that what is derived from a text does not move with it.
    placed = derived(placed.repartition("_bucket"))
    order = Window.partitionBy("_bucket").orderBy("_extra", F.desc(key), tie)
    following = F.lead(F.struct(*columns)).over(order)
    return placed.withColumn("_next", following).filter("not _extra").select(
        *[c for c in placed.columns if not c.startswith("_")], *[F.col("_next")[c].alias(f"next_{c}") for c in columns])


def edited_fingerprints(docs: DataFrame, words: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """``doc_id, text, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next`` per row.

    The edited text has the last ``floor(n_chars / 2)`` code points replaced by the first as many
    of the next document's text by descending ``doc_id``; after the last comes the first, and a
    sole document follows itself. Null text counts as empty; null ids come last; rows with equal
    ids are ordered by text. Texts of equal words have equal sketches. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = text_rows(docs).withColumn("key", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))))
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    paired = with_next(rows, "key", "text", ["text", "sketch"], buckets,
                       lambda dealt: with_sketch(dealt, "text", "sketch", words, fraction))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = paired.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)))
    edited = with_sketch(edited, "edited", "edited_sketch", words, fraction)
    return (edited.withColumn("fingerprint", fingerprint(F.col("sketch"), F.col("text")))
            .withColumn("edited_fingerprint", fingerprint(F.col("edited_sketch"), F.col("edited")))
            .withColumn("next_fingerprint", fingerprint(F.col("next_sketch"), F.col("next_text")))
            .select("doc_id", "text", F.length("text").cast("long").alias("n_chars"), "edited", "fingerprint",
                    "edited_fingerprint",
                    containment(F.col("sketch"), F.col("edited_sketch"), F.col("fingerprint"),
                                F.col("edited_fingerprint")).alias("near_edited"),
                    containment(F.col("sketch"), F.col("next_sketch"), F.col("fingerprint"),
                                F.col("next_fingerprint")).alias("near_next")))
