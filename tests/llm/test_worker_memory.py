"""What a Python worker holds at once in the passage operators."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
from curbline import session
from curbline.llm import common, line_dedup, suffix_dedup


def test_texts_are_taken_in_slices():
    many = 2 * line_dedup.TEXTS + 1
    texts = pa.RecordBatch.from_arrays([pa.array(range(many)), pa.array(["a\nb\nc\nd"] * many)], ["rid", "text"])
    chunks = list(line_dedup._chunks(True, line_dedup.WINDOW, line_dedup.MIN_LINES)(iter([texts])))
    assert len(chunks) == 3 and sum(b.num_rows for b in chunks) >= many
    drops = pa.array([None] * many, pa.list_(pa.struct([("at", pa.int32()), ("size", pa.int32())])))
    kept = list(line_dedup._without(iter([texts.append_column("drops", drops)])))
    assert [b.num_rows for b in kept] == [line_dedup.TEXTS, line_dedup.TEXTS, 1]
    found = list(suffix_dedup._find_anchors(400, 64)(iter([texts])))
    assert len(found) == 3


def test_windows_are_sorted_in_little_memory():
    rng = np.random.default_rng(5)
    middle = rng.integers(0, 256, 480, np.uint8).tobytes()
    ends = [rng.integers(0, 256, 120, np.uint8).tobytes() for _ in range(900)]
    contexts = [a + middle + b for a, b in zip(ends, ends[1:] + ends[:1])]
    seen = Counter(c[n:n + 400] for c in contexts for n in range(len(c) - 399))
    tracemalloc.start()
    flags = suffix_dedup.repeated_windows(np.zeros(900, np.int64), np.full(900, 325), contexts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all([seen[c[n:n + 400]] > 1 for n in range(len(c) - 399)] == own.tolist() for c, own in zip(contexts, flags))
    # An index for every byte beside every window took 32 MB here, and grew with the buckets sorted together.
    assert most < 20 << 20


def test_texts_go_to_workers_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    docs = spark.range(4000, numPartitions=1).selectExpr("id as doc_id", "concat('text ', id) as text")
    was = spark.conf.get(session.ARROW_ROWS_KEY)
    try:
        for rows in (common.numbered_rows, common.text_rows):
            for before, most in (("10000", session.ARROW_ROWS), ("0", session.ARROW_ROWS), ("300", 300)):
                spark.conf.set(session.ARROW_ROWS_KEY, before)
                found = [r["n"] for r in rows(docs).mapInArrow(sizes, "n long").collect()]
                assert sum(found) == 4000 and max(found) <= most
    finally:
        spark.conf.set(session.ARROW_ROWS_KEY, was)
