"""Periodic runs against a brute-force search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from skein.llm.period_runs import _runs_of, grammar, period_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, start string, period string, n_runs string"


def brute(words, least=12):
    """All maximal stretches of each period; of equal stretches the smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def bent(words, doc_id):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def some_words(rng):
    k = rng.choice([1, 2, 3, 6, 30])
    words = [rng.randrange(k) for _ in range(rng.randint(0, 140))]
    while rng.random() < 0.6 and words:
        a, p, times = rng.randrange(len(words)), rng.randint(1, 20), rng.randint(2, 8)
        words = words[:a] + words[a : a + p] * times + words[a + p :]
    if words and rng.random() < 0.2:  # Fibonacci words have many overlapping runs
        a, b = [0], [0, 1]
        while len(b) < len(words):
            a, b = b, b + a
        words = b[: len(words)]
    return words


@pytest.mark.parametrize("seed,least", [(1, 12), (2, 12), (3, 5), (4, 20)])
def test_runs_of_many_documents(seed, least):
    rng = random.Random(seed)
    for _ in range(80):
        docs = [some_words(rng) for _ in range(rng.randint(1, 6))]
        offs = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        word = np.array([w for d in docs for w in d], np.int64)
        got = _runs_of(word, offs, 31, (least + 1) // 2, least) if len(word) else {}
        assert [got.get(i, []) for i in range(len(docs))] == [brute(d, least) for d in docs]


def test_grammar_leaves_no_pair_twice_and_knows_all_places():
    rng = np.random.default_rng(3)
    symbols = np.concatenate([np.tile(rng.integers(0, 5, 9), 30), rng.integers(0, 5, 400)]).astype(np.int64)
    nodes = grammar(symbols, np.array([0, len(symbols)]))
    rules = np.flatnonzero(nodes.rule >= 0)
    assert len(rules) > 20
    for r in rules.tolist():
        own = symbols[nodes.low[r] : nodes.high[r]].tolist()
        assert nodes.low[r] < nodes.middle[r] < nodes.high[r]
        places = nodes.used_at[nodes.used[nodes.rule[r]] : nodes.used[nodes.rule[r] + 1]].tolist()
        assert nodes.low[r] in places
        assert all(symbols[p : p + len(own)].tolist() == own for p in places)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    texts = [rng.choice([" ", "\n", "\t ", "\x0b"]).join(f"w{w}é" if w % 2 else f"W{w}" for w in some_words(rng)) for _ in range(150)]
    texts += [None, "", "  \n", "one", "a b " * 4000, "x " * 11, "x " * 12, " ".join(str(i) for i in range(5000)), "中 " * 30]
    out = [(i * 3 - 4, t, "s", "p", "n") for i, t in enumerate(texts)]
    return [*out, out[2], out[2], (None, "r s t " * 9, None, None, None)]


@pytest.mark.parametrize("bend", [True, False])
def test_period_runs(spark, rows, bend):
    want = []
    for doc_id, text, *_ in rows:
        words = WORD.findall(text or "")
        words = bent(words, doc_id) if bend else words
        found = brute(words) if len(words) < 3000 else brute_long(words)
        gone = [False] * len(words)
        for s, m, q in found:
            gone[s + q : s + m] = [True] * (m - q)
        top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        want.append((doc_id, len(found), *((*top, 1000 * top[1] // top[2]) if top else (None,) * 4), hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(), len(words), len(words) - sum(gone)))
    got = [tuple(r) for r in period_runs(spark, spark.createDataFrame(rows, SCHEMA), bend=bend).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in got) > 40


def brute_long(words):
    """The same for long texts: numpy compares a whole period at once."""
    own = np.unique(np.array(words), return_inverse=True)[1]
    n, found = len(own), {}
    for q in range(1, n // 2 + 1):
        same = np.concatenate([[False], own[:-q] == own[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if e + q - s >= max(12, 2 * q):
                found.setdefault((s, e + q), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def test_period_runs_of_nothing(spark):
    assert period_runs(spark, spark.createDataFrame([], SCHEMA)).collect() == []
