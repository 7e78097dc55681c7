"""Divergence, manifest and chat operators against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from curbline.llm import chat, divergence, merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, term string, part int, leaf string, place int, `own` string"


def _documents(count=240):
    rng = random.Random(5)
    words = ["Über", "it's", "a", "B", "b", "naïve", "日本", "x1y", "\x00q", "[z", "end\n", "{", "É"]
    rows = []
    for k in range(count):
        text = rng.choice([" ", "\n", "_"]).join(rng.choices(words, k=rng.choice([0, 1, 6, 30])))
        rows.append((rng.choice([k, k, None, 7]), rng.choice([text, text, text, None]), rng.choice(["en", "en", "de", "", None]),
                     rng.choice(["s0", "s0", "s0", "s1", "s2", "é", "", None]), rng.choice([k, None])))
    rows += [rows[3], rows[3], (900, "long " * 20_000, "en", "s0", 1), (901, "only", "it", "s9", 1), (902, "", "it", "s8", 1)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return _documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "t", 1, "l", 2, "o") for r in rows], DOCS).repartition(5)


def _divergence(rows, least, listed):
    found = defaultdict(Counter)
    documents = defaultdict(Counter)
    for _, text, lang, source, _ in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        found[lang or "", source or ""].update(words)
        documents[lang or ""].update(set(words))
    out = set()
    for lang, source in found:
        kept = [t for t, n in documents[lang].items() if n >= least]
        groups = {s: c for (g, s), c in found.items() if g == lang}
        whole = sum(groups.values(), Counter())

        def share(counts):
            total = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10 ** 9 * (counts[t] + 5) // total for t in kept}
        p, q = share(groups[source]), share(whole)
        pairs = [(-sum(abs(p[t] - o[t]) for t in kept), s) for s, o in ((s, share(c)) for s, c in groups.items()) if s != source]
        terms = [(q[t] - p[t], t) for t in kept if groups[source][t] and p[t] > q[t]]
        for part, items in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))),
                            ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:listed])):
            out |= {(lang, source, part, item, -value, k) for k, (value, item) in enumerate(items, 1)}
    return out


@pytest.mark.parametrize("sizes", [{}, {"cells": 10, "sources": 2, "entries": 5, "fan": 2}])
def test_source_divergence(docs, rows, sizes):
    for least, listed in ((12, 3), (10_000, 50)):
        found = [tuple(r) for r in divergence.source_divergence(docs, least, listed, **sizes).collect()]
        assert len(found) == len(set(found))
        assert set(found) == _divergence(rows, least, listed)


def test_shares_of_large_counts():
    counts, totals = np.array([9 * 10 ** 14, 5, 123_456_789_012]), np.array([9 * 10 ** 14 + 7, 9 * 10 ** 15, 987_654_321_012_345])
    assert divergence.shares(counts, totals).tolist() == [1 + 10 ** 9 * c // t for c, t in zip(counts.tolist(), totals.tolist())]


def _digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row, text):
    doc_id, _, lang, source, size = row
    return _digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, size, text)))


def _proved(leaves):
    """The root and, for each leaf, its place and siblings in every level."""
    nodes, paths = [(leaf, [k]) for k, leaf in enumerate(leaves)], [[] for _ in leaves]
    while len(nodes) > 1:
        above = []
        for k in range(0, len(nodes), 3):
            run = nodes[k:k + 3]
            for at, (_, members) in enumerate(run):
                for m in members:
                    paths[m].append((at, [h for j, (h, _) in enumerate(run) if j != at]))
            above.append((_digest("".join(h for h, _ in run)), [m for _, members in run for m in members]))
        nodes = above
    return nodes[0][0], paths


def _manifest(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        groups[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r, r[1])))
        trees[source] = _proved([_leaf(r, r[1]) for r in groups[source]])
    root, upper = _proved([trees[s][0] for s in order])
    out = []
    for source, top in zip(order, upper):
        for row, path in zip(groups[source], trees[source][1]):
            text = row[1]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = _leaf(row, text)
            for at, others in path + top:
                node = _digest("".join([*others[:at], node, *others[at:]]))
            proof = _digest("".join(o for _, others in path + top for o in others))
            out.append((row[0], _leaf(row, row[1]), trees[source][0], root, proof, node, node == root))
    return sorted(out, key=str)


def _tampered(docs, height):
    return sorted((tuple(r) for r in merkle.manifest(
        docs, altered={"text": F.replace("text", F.lit("\n"), F.lit(""))},
        where=F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0, height=height).collect()), key=str)


@pytest.mark.parametrize("height", [0, 1, 2, 7])
def test_manifest(docs, rows, height):
    found = _tampered(docs, height)
    assert found == _manifest(rows)
    assert {r[-1] for r in found} == {True, False}


@pytest.mark.parametrize("sizes", [[1], [9], [10], [1, 1], [28, 1, 4, 3, 2, 82, 9, 27, 1, 1, 5]])
def test_butterfly_of_uneven_groups(spark, sizes):
    rows = [(k * 1000 + n, f"t{n}\n", "en", f"s{k:02}", n) for k, size in enumerate(sizes) for n in range(size)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert _tampered(docs, 0) == _manifest(rows)


TURNS = "conv_id long, turn long, role string, text string, ids string, segment int, size int"


def _conversations():
    rng = random.Random(8)
    pieces = ["<turn>", "</turn>", "<says>", "<|endoftext|>", "\\", "<", "é", "日本", "\U0001F600", " ", "\n\n", "word", "  two words"]
    rows = []
    for conv in range(30):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "system", "a\nb", None]),
                         rng.choice(["".join(rng.choices(pieces, k=rng.randint(0, 12))), "", None])))
    rows += [(31, k, ("user", "assistant")[k % 2], f"turn {k} " * 9) for k in range(300)]
    rows += [(None, 1, "user", "no id"), (None, None, "assistant", "no turn"), (32, 0, "assistant", "x " * 30_000),
             (33, 2, "assistant", "same"), (33, 2, "assistant", "same"), (33, 2, "assistant", "other")]
    return rows


def _told(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = set()
    for conv, turns in held.items():
        turns = _with_ties(turns)
        learned = "".join(text for role, text in turns if role == "assistant")
        out.add((conv, len(turns), _digest("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), _digest(learned)))
    return out


def _with_ties(turns):
    import xxhash
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    return [(r, t) for *_, r, t in sorted(turns, key=lambda x: (*x[:3], signed(xxhash.xxh64_intdigest(x[3].encode(), 42))))]


@pytest.mark.parametrize("whole", [chat.WHOLE, 200])
def test_chat(spark, whole):
    rows = _conversations()
    stored = spark.createDataFrame([(*r, "i", 3, 4) for r in rows], TURNS).repartition(4)
    found = chat.read_back(stored, whole=whole).collect()
    assert len(found) == 34
    assert {tuple(r)[:5] for r in found} == _told(rows)
    pieces = chat.format_conversations(stored, whole=whole).collect()
    assert sum(len(p.formatted) for p in pieces) == sum(r.formatted_chars for r in found)
    assert (len(pieces) > 34) == (whole == 200)
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for p in pieces:
        if p.conv_id == 32:
            continue
        # The template has marks of three more ids; between them are the tokens of the texts alone.
        marks = {mark: [plain.get_vocab_size() + k] for k, mark in enumerate(("<turn>", "<says>", "</turn>"))}
        parts = re.split("(<turn>|<says>|</turn>)", p.formatted)
        ids = [i for part in parts for i in marks.get(part) or plain.encode(part, add_special_tokens=False).ids]
        assert ids == p.ids
        assert all(not p.loss[k] for k, i in enumerate(p.ids) if i >= plain.get_vocab_size())


def test_segments_give_the_tokens_of_the_whole(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f" {k}\n") for k in range(200)]
    stored = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = chat.format_conversations(stored).collect()
    cut = sorted(chat.format_conversations(stored, whole=100).collect(), key=lambda r: r.segment)
    assert len(whole) == 1 and len(cut) > 5
    assert [i for p in cut for i in p.ids] == whole[0].ids
    assert [i for p in cut for i in p.loss] == whole[0].loss


_PIECES = st.sampled_from(["<turn>", "</turn>", "<says>", "<|endoftext|>", "\\", "<", ">", "/turn>", "<\\turn>", "a", "\n", "é"])
_TEXT = st.lists(_PIECES, max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(_TEXT, _TEXT), max_size=4))
def test_template_reads_back(turns):
    template = chat.Template(["<|endoftext|>"])
    formatted, spans = template.render([*turns, ("assistant", "ok")])
    assert template.read(formatted) == [*turns, ("assistant", "ok")]
    assert template.unescape(formatted[spans[-2]:spans[-1]]) == "ok"
    assert "<|endoftext|>" not in formatted


def test_empty_and_null_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    assert divergence.source_divergence(empty).collect() == []
    assert merkle.manifest(empty).collect() == []
    assert chat.format_conversations(spark.createDataFrame([], TURNS)).collect() == []
    assert chat.read_back(spark.createDataFrame([], TURNS)).collect() == []
    nulls = spark.createDataFrame([(None,) * 10] * 4, DOCS)
    assert divergence.source_divergence(nulls).collect() == []
    found = merkle.manifest(nulls).collect()
    assert len(found) == 4 and all(r.verified and r.leaf == _digest("-----") for r in found)
    bare = chat.read_back(spark.createDataFrame([(None,) * 7] * 2, TURNS)).collect()
    assert [tuple(r)[:5] for r in bare] == [(None, 2, _digest("\n\n" * 2), 0, _digest(""))]
