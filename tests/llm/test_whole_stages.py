"""Stages of the pipeline against planted copies that smaller settings miss."""

import random
import re
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from curbline.llm import line_dedup, lm_score, packing, simhash, suffix_dedup
from curbline.llm.common import numbered_rows


def _words(rng, count, most=7):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, most))) for _ in range(count)]


def _fingerprint(text):
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    shingles = [" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) > 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_near_stage_keeps_one_of_each_group(spark):
    rng = random.Random(4)
    texts = ["", None, "one two", " one  TWO", "", "one two"]
    for _ in range(12):
        words = _words(rng, 300)
        texts.append(" ".join(words))
        for edits in (0, 1, 2, 4, 20):
            copy = list(words)
            for at in rng.sample(range(300), edits):
                copy[at] = "changed"
            texts.append(" ".join(copy))
    ids = [*range(len(texts) - 2), None, 5]
    codes, label = [_fingerprint(t or "") for t in texts], list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        if (codes[a] ^ codes[b]).bit_count() <= 3:
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = [new if x == old else x for x in label]
    rows = [(i, t, 1, "r", "c", 0) for i, t in zip(ids, texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rid long, rest string, code string, n_chars long")
    found = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert found.columns == docs.columns
    firsts = {}
    for i, root in zip(ids, label):
        firsts[root] = min(firsts.get(root, (True, 0)), (i is None, i or 0))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in found.collect()) == sorted(firsts.values())
    assert len(firsts) < len(texts) - 24


@pytest.fixture
def splits(spark):
    """Sets how many tasks a scan has from then on."""
    names = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")

    def split(tasks):
        spark.conf.set(names[0], str(tasks))
        spark.conf.set(names[1], "1")
    yield split
    for name in names:
        spark.conf.unset(name)


def _stored(spark, folder):
    rng = random.Random(9)
    line = lambda: " ".join(_words(rng, 12))
    passage = "\n".join(line() for _ in range(14))
    rows = []
    for k in range(480):
        text = f"{line()}\n{passage}\n{line()}" if k % 10 == 0 else "\n".join(line() for _ in range(4))
        rows.append((k, rows[k - 5][1] if k % 30 == 7 else text, "en", "s", len(text)))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(8).write.parquet(folder)
    return spark.read.parquet(folder)


STEPS = {
    "line_dedup": lambda spark, docs: line_dedup.line_dedup(docs).select("doc_id", "text"),
    "line stage": lambda spark, docs: corpus_pipeline.drop_repeated_lines(spark, docs, ""),
    "simhash": lambda spark, docs: simhash.near_groups(docs).select("doc_id", "code", "first.doc_id"),
    "near stage": lambda spark, docs: corpus_pipeline.drop_near_copies(spark, docs, ""),
    "suffix_dedup": lambda spark, docs: suffix_dedup.suffix_dedup(docs).select("doc_id", F.hex("kept")),
    "passage stage": lambda spark, docs: corpus_pipeline.drop_repeated_passages(spark, docs, ""),
    "packing": lambda spark, docs: packing.packed_documents(docs).select("doc_id", "piece", "ids_crc32"),
    "lm_score": lambda spark, docs: lm_score.score_documents(docs, F.col("doc_id") % 7 == 2).select("doc_id", "n_tokens", "n_known", F.round("base_score", 6)),
}


@pytest.mark.parametrize("step", STEPS)
def test_results_do_not_follow_the_split(spark, tmp_path, splits, step):
    """The scan is split otherwise between the jobs of a call and the last one, as when executors come or go."""
    docs = _stored(spark, str(tmp_path / "docs"))
    splits(3)
    expected = sorted(map(str, STEPS[step](spark, docs).collect()))
    other = STEPS[step](spark, docs)
    splits(40)
    assert sorted(map(str, other.collect())) == expected
    if step in ("line_dedup", "line stage", "suffix_dedup", "passage stage"):
        assert sum(len(r[1]) for r in other.collect()) < 0.95 * sum(len(r[1]) for r in docs.select(
            "doc_id", F.hex("text") if step == "suffix_dedup" else "text").collect())
    if step == "near stage":
        assert 440 < len(expected) <= 464  # 16 exact copies; rows with the passage may be near


def test_rows_are_numbered_alike(spark, tmp_path, splits):
    docs = _stored(spark, str(tmp_path / "docs"))
    plain = spark.createDataFrame([(1, "a", 7), (1, "a", 7)], "doc_id long, text string, rid int")
    for frame in (docs, docs.filter("doc_id % 3 > 0").select("text", "doc_id"), docs.repartition(4), docs.unionByName(docs), plain):
        rows = numbered_rows(frame, carry=True)
        splits(2)
        one = {r.rid: (r.doc_id, r.text) for r in rows.collect()}
        splits(30)
        assert one == {r.rid: (r.doc_id, r.text) for r in rows.collect()}
        assert len(one) == frame.count()


def test_passage_stage_drops_short_passages_of_many_words(spark):
    rng = random.Random(5)
    gone = [_words(rng, 51), _words(rng, 51, 1), _words(rng, 80, 9), ["é" * 150 + "x" * 150]]  # the last is long in bytes only
    stay = _words(rng, 50)
    assert len(" ".join(gone[0])) < 400 and len(" ".join(gone[1])) == 101 and len(" ".join(stay)) < 400
    texts, expected = [], []
    for passage in [*gone, stay]:
        for _ in range(2):
            before, after = _words(rng, 60), _words(rng, 60)
            texts.append(" ".join([*before, f"b{len(texts)}", *passage, f"{len(texts)}a", *after]))
            expected.append([*before, f"b{len(expected)}", *(passage if passage is stay else []), f"{len(expected)}a", *after])
    docs = spark.createDataFrame(list(enumerate(texts)) + [(99, None)], "doc_id long, text string")
    found = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_passages(spark, docs, "").collect()}
    # A repeated string of 400 bytes goes with the blanks on both sides.
    assert ["".join(found[k].split()) for k in range(len(texts))] == ["".join(words) for words in expected] and found[99] == ""


def test_packing_keeps_special_tokens():
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = ["x <|endoftext|> y", "a<|endoftext|>b", "A <|ENDOFTEXT|> b", "<|startoftext|><|endoftext|>.", "", "plain text, only.",
             "ab.<|endoftext|>'s", "x<|endoftext|>, <|endoftext|"]
    encoder = packing.WordEncoder(path)
    for _ in range(2):  # the second time from the words it remembers
        found = [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)]
        assert found == [tokenizer.encode(text, add_special_tokens=False).ids for text in texts]
