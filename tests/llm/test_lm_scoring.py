"""Numbering of a block's words and pairs (operator 7): right, and in little memory."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from skein.llm import lm_scoring
from skein.llm.lm_scoring import START, grams
from skein.llm.words import texts_of


def texts(n: int, size: int) -> pa.Array:
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 9))) for _ in range(20000)]
    return pa.array([None, "", " ", *(" ".join(rng.choices(words, k=size)) for _ in range(n)), "x", " \n"])


def test_grams_number_words_and_pairs(monkeypatch):
    some = texts(30, 40)
    for hashed in (1, 500, 1 << 20):
        monkeypatch.setattr(lm_scoring, "HASHED", hashed)
        g = grams(texts_of(some))
        split = [(t or "").split() for t in some.to_pylist()]
        flat, before = [w for t in split for w in t], [b for t in split for b in [None, *t][: len(t)]]
        assert np.diff(g.offsets).tolist() == [len(t) for t in split]
        assert len(set(zip(flat, g.word.tolist()))) == len(set(flat)) == len(g.words) - 1
        assert len(set(zip(before, flat, g.pair.tolist()))) == len(set(zip(before, flat))) == len(g.pairs)
        assert (g.words[g.before] == START).tolist() == [b is None for b in before]
        assert (np.diff(g.words.astype(object)) > 0).all() and (np.diff(g.pairs.astype(object)) > 0).all()
        assert len(g.word) == len(flat) + sum(map(bool, split))


def test_grams_of_nothing():
    g = grams(texts_of(pa.array([None, ""], pa.string())))
    assert not len(g.words) and not len(g.pair) and g.offsets.tolist() == [0, 0, 0]


def test_grams_hold_little_at_once():
    data = texts_of(texts(1500, 400))
    grams(texts_of(pa.array(["a b"])))
    tracemalloc.start()
    g = grams(data)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(g.pair) and peak < 11 * len(data.data) and held < 4 * len(data.data)  # 14.9 and 5.2 times before
