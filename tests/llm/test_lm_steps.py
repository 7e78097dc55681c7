"""Sums, shares and symbols of the language model against plain loops."""

from bisect import bisect_right

import numpy as np
from curbline.llm import lm_score


def test_errors_are_added_up_by_weight_row():
    rng = np.random.default_rng(3)
    rows = np.concatenate([np.arange(40), np.repeat(np.arange(100, 112), np.arange(1, 13)), np.full(700, 7)])
    rng.shuffle(rows)
    error = rng.random((len(rows), lm_score.CLASSES), dtype=np.float32)
    order = np.argsort(rows, kind="stable")
    kept, starts, sizes = np.unique(rows[order], return_index=True, return_counts=True)
    found = lm_score.summed(error, order, starts, sizes)
    assert np.allclose(found, [error[rows == k].sum(axis=0) for k in kept], rtol=1e-5)
    few = np.flatnonzero(sizes <= lm_score.FEW)
    # Few rows are added one after another, to the last bit.
    for k in few:
        total = np.zeros(lm_score.CLASSES, np.float32)
        for one in error[rows == kept[k]]:
            total += one
        assert (found[k] == total).all()
    assert lm_score.summed(error[:0], order[:0], starts[:0], sizes[:0]).shape == (0, lm_score.CLASSES)


def test_share_of_one_column_is_that_of_the_softmax():
    logits = np.random.default_rng(4).normal(0, 30, (500, 32)).astype(np.float32)
    columns = np.arange(500) % 32
    whole = lm_score._shares_of(logits.copy())
    assert (lm_score._share_at(logits.copy(), columns) == whole[np.arange(500), columns]).all()


def test_symbols_of_known_and_other_words():
    words, counts = [b"the", b"of", b"sun", b"moon", b""], np.array([9, 8, 7, 6, 5])
    bounds = [b"f", b"q"]
    found = lm_score.vocabulary(words, counts, bounds, np.zeros(lm_score.SUBCLASSES), np.zeros(lm_score.SUBCLASSES))
    scorer = lm_score.Scorer(found, lm_score.Weights())
    tokens = lm_score.words_of("The zebra OF q f a moon ä")
    symbols, others = scorer.symbols(tokens)
    assert others == [b"zebra", b"q", b"f", b"a", "ä".encode()]
    assert symbols.tolist() == [found.ids[t] if t in found.ids else len(words) + bisect_right(bounds, t) for t in tokens]
    assert scorer.symbols([b""])[1] == [] and scorer.symbols([])[0].shape == (0,)
