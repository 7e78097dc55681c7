"""Operators against plain Python on small tables with nulls, empty and long texts, ties, repeated rows and clashing names."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from curbline.llm import exact_dedup, line_dedup, lm_score, packing, prefix_bpe, sharding, simhash, sketch, suffix_dedup, toxicity
from curbline.llm.catalog import catalog

SCHEMA = "doc_id long, text string, rid string, rest int, bucket int, n_chars long, code string, size string"


def _texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghié") for _ in range(rng.randint(1, 7)))
    line = lambda: " ".join(word() for _ in range(rng.randint(3, 12)))
    passage = "\n".join(line() for _ in range(14))
    texts = ["\n".join(line() for _ in range(rng.randint(1, 12))) for _ in range(24)]
    texts += [f"{line()}\n{line()}\n{passage}\n{line()}" for _ in range(4)]
    texts += [texts[0], texts[0], texts[1].replace(" ", "  "), texts[2] + " x", "", None, " \t\n", "One", "ab ab ab ab",
              "xy" * 700, "a" * 900, "你好 世界  ok\x1c\x85 don't ́x", (passage + "\n") * 3, line() * 200]
    return texts


@pytest.fixture(scope="module")
def rows():
    texts = _texts()
    ids = [*range(10, 10 + len(texts)), 12, None, None, 12]
    texts += [texts[2], texts[3], None, "other text of a repeated id"]
    return list(zip(ids, texts))


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "r", 1, 2, 0 if t is None else len(t), "c", "s") for i, t in rows], SCHEMA).repartition(3).transform(_kept)


def _kept(df):
    path_rows = df.collect()
    return df.sparkSession.createDataFrame(path_rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(spark, empty):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    for found in (exact_dedup.exact_dedup(empty), line_dedup.line_dedup(empty), packing.packed_documents(empty),
                  prefix_bpe.round_trip(empty), simhash.near_groups(empty), sketch.edited_fingerprints(empty),
                  sharding.shard_documents(empty), suffix_dedup.suffix_dedup(empty),
                  lm_score.score_documents(empty, F.lit(False)), toxicity.clean(empty, labels)):
        assert found.count() == 0


def test_exact_dedup(docs, rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()].append(i)
    found = exact_dedup.exact_dedup(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        group = groups[r.text_sha256]
        known = [i for i in group if i is not None]
        assert r.keep_id == (min(known) if known else None) and r.group_size == len(group)
    assert sum(r.kept for r in found) == len(groups)


def test_sharding(docs, rows):
    found = sharding.shard_documents(docs).collect()
    assert Counter(r.text_crc32 for r in found) == Counter(zlib.crc32((t or "").encode()) for _, t in rows)
    slots, by_id = defaultdict(list), defaultdict(set)
    for r in found:
        slots[r.shard].append(r.slot)
        by_id[r.doc_id].add(r.shard)
        assert r.grown_shard in (r.shard, sharding.SHARDS)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in by_id.values())


def test_sharding_weights(spark):
    placed = spark.range(20000).select(sharding.rendezvous(F.col("id"), [1.0, 0.0, 3.0]).alias("s")).groupBy("s").count().collect()
    share = {r["s"]: r["count"] / 20000 for r in placed}
    assert set(share) == {0, 2} and abs(share[2] - 0.75) < 0.02


def test_sketch(docs, rows):
    order = sorted([(i if i is not None else -(1 << 63), t or "") for i, t in rows], key=lambda r: (-r[0], r[1]))
    expected = []
    for k, (_, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        expected.append((len(text), text[:len(text) - half] + following[:half]))
    found = sketch.edited_fingerprints(docs).collect()
    assert Counter((r.n_chars, r.edited) for r in found) == Counter(expected)
    prints = defaultdict(set)
    for r in found:
        prints[r.text].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.edited == r.text:
            assert r.near_edited == 1 and r.fingerprint == r.edited_fingerprint
    assert all(len(p) == 1 for p in prints.values())


def test_sketch_estimates_containment(spark):
    words = [f"w{k}" for k in range(6000)]
    whole, part = " ".join(words), " ".join(words[:600] + [f"x{k}" for k in range(600)])
    found = sketch.with_sketch(sketch.with_sketch(spark.createDataFrame([(whole, part)], "a string, b string"), "a", "sa"), "b", "sb")
    share = found.select(sketch.containment(F.col("sa"), F.col("sb"), F.col("a"), F.col("b"))).first()[0]
    assert abs(share - 0.5) < 0.12


def test_line_dedup(docs, rows):
    found = {(r.rid): r for r in line_dedup.line_dedup(docs).collect()}
    order = sorted(range(len(rows)), key=lambda k: (docs_id(docs, k) is None, docs_id(docs, k) or 0, k))
    texts = [r.text or "" for r in docs.collect()]
    seen, expected = set(), {}
    for k in order:
        lines, gone = texts[k].split("\n"), set()
        units = [(a, n, "\n".join(lines[a:a + n])) for a, n in line_dedup.chunk_spans(lines) if n >= 2]
        units += [(a, n, "\n".join(lines[a:a + 2])) for a, n in line_dedup.run_spans(lines)]
        for a, n, body in sorted(units):
            if body in seen:
                gone |= set(range(a, a + n))
            seen.add(body)
        expected[k] = "\n".join(line for n, line in enumerate(lines) if n not in gone)
    assert [found[rid].text for rid in sorted(found)] == [expected[k] for k in range(len(rows))]
    assert sum(r.n_removed for r in found.values()) > 0


def test_repeated_lines_by_brute_force(spark):
    """Without chunks: which lines must go, which may, and what has to stay."""
    rng = random.Random(11)
    line = lambda: " ".join(str(rng.randint(0, 999)) for _ in range(4))
    passages = [[line() for _ in range(n)] for n in (2, 3, 4, 5, 6, 7, 9, 15) for _ in range(5)]
    texts = [[line() for _ in range(rng.randint(0, 6))] + (rng.choice(passages) if rng.random() < 0.8 else [])
             + [line() for _ in range(rng.randint(0, 3))] + rng.choice(passages)[rng.randint(0, 2):] for _ in range(120)]
    texts += [["same"] * 7, [line(), *["same"] * 4, line()], ["a b", "c d"] * 5, [line(), "", "", "", line()], ["", "", ""], ["one"], []]
    table = spark.createDataFrame([(k, "\n".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: r for r in line_dedup.line_dedup(table.repartition(4)).collect()}
    texts = [t or [""] for t in texts]
    gone, left = {}, set()
    for k, lines in enumerate(texts):
        kept, at = found[k].text.split("\n"), 0
        gone[k] = set()
        # What is left is a subsequence; lines within a text differ but in the made-up runs.
        for n, text in enumerate(lines):
            if len(lines) - n > len(kept) - at and (at == len(kept) or kept[at] != text or not kept[at:]):
                gone[k].add(n)
            else:
                at += 1
        left |= set(kept)
        assert found[k].n_lines == len(lines) and found[k].n_removed == (len(lines) if found[k].text == "" and len(lines) > 1 else len(lines) - len(kept))
    assert {line for lines in texts for line in lines if line} <= left

    def windows(size):
        return [(tuple(t[n:n + size]), k, n) for k, t in enumerate(texts) for n in range(len(t) - size + 1)]

    def lone(k, n):
        around = texts[k][max(n - 1, 0):n + 6]
        return len(set(around)) == len(around)

    fives, pairs, must = {}, {}, 0
    for body, k, n in windows(2):
        pairs.setdefault(body, []).append((k, n))
    for body, k, n in windows(5):
        if lone(k, n):
            fives.setdefault(body, []).append((k, n))
    for places in fives.values():
        for k, n in places[1:]:
            must += 1
            assert found[k].text == "" or {n + 1, n + 2, n + 3} <= gone[k]
    assert must > 100
    for k, lines in enumerate(texts):
        if len(set(lines)) == len(lines):
            for n in gone[k]:
                near = [(tuple(lines[m:m + 2]), m) for m in (n - 1, n) if 0 <= m < len(lines) - 1]
                assert any(pairs[body][0] < (k, m) for body, m in near)
    run = len(texts) - 7
    assert found[run].text == "same\nsame" and "same" not in found[run + 1].text
    assert found[run + 3].n_removed == 0 and found[run + 4].n_removed == 0


def docs_id(docs, k, cache={}):
    if id(docs) not in cache:
        cache[id(docs)] = [r.doc_id for r in docs.collect()]
    return cache[id(docs)][k]


def test_line_chunks_resist_shifts():
    lines = [f"line {k} {k * k}" for k in range(60)]
    cut = lambda ls: {"\n".join(ls[a:a + n]) for a, n in line_dedup.chunk_spans(ls)}
    assert len(cut(lines) - cut(["new", *lines[:30], "also new", *lines[30:]])) <= 6


def test_stages_keep_columns(docs):
    for stage in (line_dedup.deduplicated, simhash.deduplicated, suffix_dedup.deduplicated):
        found = stage(docs)
        assert found.columns == docs.columns
        assert all(r.n_chars == len(r.text) and r.rid == "r" and r.code == "c" for r in found.collect())


def _simhash(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _roots(codes, distance):
    root = list(range(len(codes)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in range(len(codes)):
        for b in range(a):
            if (codes[a] ^ codes[b]).bit_count() <= distance:
                root[top(a)] = top(b)
    return [top(k) for k in range(len(codes))]


def test_simhash(docs, rows):
    found = simhash.near_groups(docs).collect()
    codes = {(i, _simhash(t or "")) for i, t in rows}
    assert {(r.doc_id, r.code % (1 << 64)) for r in found} == codes and len(found) == len(rows)
    listed = [_simhash(t or "") for _, t in rows]
    roots = _roots(listed, 3)
    least = {}
    for (i, _), root in zip(rows, roots):
        if i is not None:
            least[root] = min(i, least.get(root, i))
    expected = Counter((i, least.get(root)) for (i, _), root in zip(rows, roots))
    assert Counter((r.doc_id, r["first"]["doc_id"]) for r in found) == expected
    assert simhash.deduplicated(docs).count() == len(set(roots))


def test_gray_index_and_pieces(spark, monkeypatch):
    rng = random.Random(5)
    codes = []
    for _ in range(60):
        base = rng.getrandbits(64)
        codes += [base] + [base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for _ in range(6)]
    codes += [0xFFFF << 48 | k for k in range(120)]
    codes = sorted(set(codes))
    array = np.array(codes, np.uint64)
    index = simhash.GrayIndex(array)
    pairs = {tuple(sorted((int(index.order[x]), int(index.order[y])))) for a, b in index.pairs(3) for x, y in zip(a, b)}
    assert pairs == {(b, a) for a in range(len(codes)) for b in range(a) if (codes[a] ^ codes[b]).bit_count() <= 3}
    monkeypatch.setattr(simhash, "PIECE", 8)
    frame = spark.createDataFrame([(int(c),) for c in array.view(np.int64)], "code long")
    roots = {r.node: r.root for r in simhash.components(simhash.near_links(frame)).collect()}
    groups = defaultdict(set)
    for code, signed in zip(codes, array.view(np.int64).tolist()):
        groups[roots.get(signed, signed)].add(code)
    expected = defaultdict(set)
    for code, root in zip(codes, _roots(codes, 3)):
        expected[root].add(code)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def _covered(texts, length):
    starts = Counter(t[k:k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        mask = np.zeros(len(t), bool)
        for k in range(len(t) - length + 1):
            if starts[t[k:k + length]] > 1:
                mask[k:k + length] = True
        out.append(np.frombuffer(t, np.uint8)[~mask].tobytes())
    return out


@pytest.mark.parametrize("crowd", [1000, 1])
def test_suffix_dedup(docs, rows, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    texts = [(t or "").encode() for _, t in rows]
    for length, gram in ((400, 64), (120, 16)):
        found = suffix_dedup.suffix_dedup(docs, length, gram).collect()
        kept = _covered(texts, length)
        assert Counter((r.doc_id, r.n_bytes, bytes(r.kept)) for r in found) == Counter(
            (i, len(t), k) for (i, _), t, k in zip(rows, texts, kept))
        assert all(r.n_removed == r.n_bytes - len(r.kept) and (r.n_spans > 0) == (r.n_removed > 0) for r in found)


def test_packing(docs, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    expected = Counter()
    total = 0
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        for piece in range(0, len(ids), 256):
            part = np.array(ids[piece:piece + 256], "<u4")
            expected[i, piece // 256, piece, len(part), zlib.crc32(part.tobytes())] += 1
    found = packing.packed_documents(docs, 256).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    assert len(bins) <= -(-total // 256) + 2


def test_packing_over_rounds(spark):
    items = spark.range(4000).select(F.col("id").alias("item"), (F.pmod(F.xxhash64("id"), F.lit(900)) + 1).alias("length")).repartition(16)
    items = spark.createDataFrame(items.collect(), "item long, length long").repartition(16)
    found = packing.pack(spark.createDataFrame(items.collect(), "item long, length long"), 2048, group=300)
    lengths = {r["item"]: r["length"] for r in items.collect()}
    placed = found.collect()
    assert sorted(r["item"] for r in placed) == sorted(lengths)
    assert found.select("sequence_id").distinct().count() <= 1.01 * sum(lengths.values()) / 2048 + 1


def test_bpe_round_trip_and_edits(docs, rows):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = Counter()
    for i, t in rows:
        ids = np.array(library.encode_ordinary(t or ""), "<u4").tobytes()
        expected[i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in prefix_bpe.round_trip(docs).collect()) == expected
    decoded = prefix_bpe.decode_documents(prefix_bpe.encode_documents(docs)).collect()
    assert Counter((r.doc_id, bytes(r.data)) for r in decoded) == Counter((i, (t or "").encode()) for i, t in rows)

    vocabulary = prefix_bpe.Vocabulary(prefix_bpe.read_ranks(path))
    rng, letters = random.Random(1), "aab bc\n\t'srelve  été日本語123!?.. \x85ñ😀theTHE"
    encoder = prefix_bpe.TextEncoder(vocabulary, public_tokenizers.PATTERN)
    for _ in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode_ordinary(text)
        growing = prefix_bpe.TextEncoding(vocabulary, text)
        for _ in range(3):
            a = rng.randint(0, len(growing.text))
            growing.edit(a, rng.randint(a, min(len(growing.text), a + 6)), "".join(rng.choice(letters) for _ in range(rng.randint(0, 5))))
            assert growing.ids() == library.encode_ordinary(growing.text)
    long = prefix_bpe.PrefixEncoding(vocabulary, b"the" * 500)
    assert long.edit(700, 702, b"xy") < 400
    assert long.last == prefix_bpe.PrefixEncoding(vocabulary, long.data).last


def test_lm_base_score(docs, rows):
    held = F.coalesce(F.pmod("doc_id", F.lit(5)) == 2, F.lit(False))
    tokens = [[*(t or "").encode().lower().split(), b""] for _, t in rows]
    counts = Counter(w for (i, _), ws in zip(rows, tokens) if not (i is not None and i % 5 == 2) for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    expected = Counter((i, len(ws), sum(counts[w] > 0 for w in ws),
                        round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws), 6)) for (i, _), ws in zip(rows, tokens))
    for hot in (lm_score.HOT_WORDS, 20):
        found = lm_score.score_documents(docs, held, hot).collect()
        assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found) == expected
        assert all(r.train_tokens == total and r.score < 0 for r in found)


def test_lm_is_a_distribution():
    words = [w.encode() for w in "the of and cat dog sat mat on a in".split()]
    counts = np.array([50, 40, 30, 9, 8, 7, 6, 5, 4, 3])
    bounds = lm_score.spelling_bounds(words, counts)
    rare_count, rare_words = np.zeros(lm_score.SUBCLASSES), np.zeros(lm_score.SUBCLASSES)
    rare_count[0], rare_words[0] = 2, 2
    vocabulary = lm_score.vocabulary(words, counts, bounds, rare_count, rare_words)
    scorer = lm_score.Scorer(vocabulary, lm_score.Weights())
    texts = [[b"the", b"cat", b"sat"], [b"the", b"dog", b"sat", b"on"]] * 40
    parts = [scorer.symbols(t)[0] for t in texts]
    before = scorer.log10(parts).sum()
    scorer.train(parts, 0.5)
    assert scorer.log10(parts).sum() > before
    total = 0.0
    for symbol in range(vocabulary.size + len(bounds) + 1):
        part = np.array([0, 3, symbol])
        share = 10 ** (scorer.log10([part])[0] - scorer.log10([part[:2]])[0])
        if symbol >= vocabulary.size:  # all words of the subclass, and an unknown one
            share *= vocabulary.rare_total[symbol - vocabulary.size]
        total += share
    assert abs(total - 1) < 1e-4


def test_grammar():
    lexicon = toxicity.Lexicon({"idiot": 2.0, "vequ*": 1.0})
    kinds = lambda text: dict(zip(toxicity.EVENTS, toxicity.events(text, lexicon)))
    assert kinds("What an idiot.")["insult"] == 2
    assert kinds("You idiot!")["aimed"] == 2
    assert kinds("not an idiot")["negated"] == 2
    assert kinds("somebody said idiot")["reported"] == 2
    assert kinds("not now. idiot")["insult"] == 2
    assert kinds("un vequ")["insult"] == 0 and kinds("un vequno")["insult"] == 1
    assert kinds("I will hurt you")["threat"] > 0
    assert not toxicity.events("", lexicon).any()


def test_toxicity_learns(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    rows, labels = [], []
    for k in range(400):
        words = [word() for _ in range(30)]
        if k % 8 == 0:
            for _ in range(2):
                words.insert(rng.randrange(30), rng.choice(["zorg", "zorg", "plixa" + word()]))
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 8 == 0)))
    rows += [(None, None), (400, ""), (0, rows[0][1])]
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, table.filter("doc_id % 3 <> 1"))
    scored = toxicity.score_documents(docs, model).collect()
    assert len(scored) == len(rows)
    wrong = sum((r.score >= 0.7) != (r.doc_id % 8 == 0) for r in scored if r.doc_id is not None and r.doc_id < 400)
    assert wrong <= 4
    kept = toxicity.clean(docs, table)
    assert kept.columns == docs.columns and 350 <= kept.count() <= 356
    none = toxicity.fit(docs, table.filter("false"))
    assert none.patterns == {} and all(r.score < 0.7 for r in toxicity.score_documents(docs, none).collect())


def test_pipeline(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(function(spark, docs, sf).collect(), docs.schema)
        assert docs.columns == columns
    assert 150 < docs.count() <= 200
    packed = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_every_query_returns_its_rows(spark):
    sf = "/root/testdata/sf0.001"
    count = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name, query in catalog().items():
        assert query(spark, sf).select("doc_id").distinct().count() == count, name
