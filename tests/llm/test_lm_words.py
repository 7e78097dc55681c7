"""Words of whole batches against word by word: each different word is looked up and counted once for many texts."""

from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from curbline.llm import lm_score

TEXTS = ["The sun  the", "", " \t\n", "a\x0bb\x0cc\rd ", " É é \x85 x\x1cy 　 the", "moon " * 40, "the end", "\x00 a\x00"]


def test_tokens_of_batches_are_those_of_each_text():
    for texts in (TEXTS, TEXTS[1:2], []):
        numbers, ends, kinds = lm_score.tokens_of(pa.array(texts, pa.string()))
        assert len(ends) == len(texts) + 1
        words = kinds.to_pylist()
        assert [[words[k] for k in numbers[a:b]] for a, b in zip(ends, ends[1:])] == [lm_score.words_of(t) for t in texts]


def test_words_of_several_batches_are_counted_together(monkeypatch):
    batches = [pa.RecordBatch.from_pydict({"text": TEXTS[k:k + 2]}) for k in range(0, len(TEXTS), 2)]
    expected = Counter(w for t in TEXTS for w in lm_score.words_of(t))
    found = [x for b in lm_score._token_counts(iter(batches)) for x in zip(*b.to_pydict().values())]
    assert dict(found) == expected and len(found) == len(expected)
    monkeypatch.setattr(lm_score, "COUNTED_BYTES", 1)
    parts = [Counter(dict(zip(*b.to_pydict().values()))) for b in lm_score._token_counts(iter(batches))]
    assert len(parts) == len(batches) and sum(parts, Counter()) == expected


def test_scored_rows_hold_each_other_word_once():
    words = [b"the", b"moon", b""]
    found = lm_score.vocabulary(words, np.array([9, 8, 7]), [b"c"], np.zeros(lm_score.SUBCLASSES), np.zeros(lm_score.SUBCLASSES))
    weights = lm_score.Weights()
    batch = pa.RecordBatch.from_pydict({"rid": [10 * k for k in range(len(TEXTS))], "text": TEXTS})
    rows = [r for b in lm_score._scored(SimpleNamespace(value=found), SimpleNamespace(value=weights))(iter([batch])) for r in b.to_pylist()]
    scorer = lm_score.Scorer(found, weights)
    for rid, text in zip(batch.column("rid").to_pylist(), TEXTS):
        tokens = lm_score.words_of(text)
        others = Counter(t for t in tokens if t not in words)
        own = [r for r in rows if r["rid"] == rid]
        assert sorted((r["word"], r["times"]) for r in own if r["times"]) == sorted(others.items())
        one, = [r for r in own if not r["times"]]
        assert (one["word"], one["n_tokens"], one["n_hot"]) == (b" %d" % rid, len(tokens), len(tokens) - others.total())
        assert np.isclose(one["score"], scorer.log10([scorer.symbols(tokens)[0]])[0])
        assert np.isclose(one["base"], sum(np.log10(found.counts[found.ids[t]] + 1) for t in tokens if t in found.ids))
