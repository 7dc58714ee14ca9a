"""The byte model of operator 5, counted and looked up in parts, against a recursion over dictionaries; no two bytes are one symbol."""

import math
import random
from collections import Counter

import pytest

from skein.llm.perplexity import ngram_keys, perplexities, quality_rules
from skein.llm.words import texts_of


def brute(texts: list[bytes]):
    """Mean loss a byte of any of the texts."""
    grams = [[(b"   " + t)[i : i + 4] for i in range(len(t))] for t in texts]
    tables = {4: Counter(g for one in grams for g in one)}
    for order in (3, 2, 1):
        tables[order] = Counter(g[1:] for g in tables[order + 1])
    cut, own, whole = {}, {}, {}
    for order, table in tables.items():
        n = [sum(c == k for c in table.values()) for k in range(5)]
        y = n[1] / max(1.0, n[1] + 2.0 * n[2])
        raw = (1 - 2 * y * n[2] / max(1, n[1]), 2 - 3 * y * n[3] / max(1, n[2]), 3 - 4 * y * n[4] / max(1, n[3]))
        cut[order] = [0.0] + [min(0.95 * (i + 1), max(0.1, d)) for i, d in enumerate(raw)]
        off = lambda c, order=order: min(cut[order][min(c, 3)], c)
        for g, c in table.items():
            whole[g[:-1]] = whole.get(g[:-1], 0) + c
            own[g[:-1]] = own.get(g[:-1], 0) + off(c)

    def p(g):
        if not g:
            return 1 / 256
        c = tables[len(g)][g]
        return (c - min(cut[len(g)][min(c, 3)], c)) / whole[g[:-1]] + own[g[:-1]] / whole[g[:-1]] * p(g[1:])

    return [-sum(math.log(p(g)) for g in one) / len(one) if one else None for one in grams]


def test_perplexities_equal_the_recursion(spark):
    rng = random.Random(5)
    letters = "abcdeABC019 .,;#|\n\tабвгдежзиклмнопрст日本語文字éü€😀"
    words = ["".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(60)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40))), "xy"[i % 2]) for i in range(90)] + [(90, None, None), (90, "ab", None), (None, "", "x"), (None, "x", "x")]
    got = perplexities(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)).collect()
    want = brute([(t or "").encode() for _, t, _ in rows])
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0.0)
    have = sorted(((r.doc_id, r.log_perplexity) for r in got), key=key)
    assert [h[0] for h in have] == [w[0] for w in sorted(((r[0], w) for r, w in zip(rows, want, strict=True)), key=key)]
    for (_, a), (_, b) in zip(have, sorted(((r[0], w) for r, w in zip(rows, want, strict=True)), key=key), strict=True):
        assert a == pytest.approx(b, rel=1e-5) if b is not None else a is None


def test_every_byte_is_a_symbol_of_its_own():
    import pyarrow as pa

    text = "".join(map(chr, range(128))) + "".join(chr(0x80 + 64 * k) for k in range(30)) + "ёжик日本"
    raw = text.encode()
    keys = ngram_keys(texts_of(pa.array([text])))
    assert len({k & 255 for k in keys.tolist()}) == len(set(raw)) and keys[-1] == int.from_bytes(raw[-4:], "big")


def test_shuffled_letters_of_another_script_are_rejected(spark):
    """Half the letters moved by seven places in their alphabet: bytes of one class in the model before, which scored the text as if they were not."""
    rng = random.Random(4)
    words = ["".join(rng.choices("абвгде", k=rng.randint(2, 7))) for _ in range(300)]
    rows = [(i, " ".join(rng.choices(words, k=120)), "ru") for i in range(300)]
    moved = [(1000 + i, "".join(chr(ord(c) + 7 * rng.randrange(2)) if c != " " else c for c in rows[i][1]), "ru") for i in range(3)]
    got = {r.doc_id: r for r in quality_rules(spark, spark.createDataFrame(rows + moved, "doc_id long, text string, lang string")).collect()}
    assert all(not got[i].base_failed and not got[i].kept for i, *_ in moved)
    assert sum(not got[i].kept for i, *_ in rows) < 6
