"""Modified Kneser-Ney with back-off against a plain recursion, unseen n-grams included; the bands by language and length."""

import random

import numpy as np
import pytest

from skein.llm.perplexity import ORDER, HashArrays, _history, kneser_ney_orders, quality_rules


def brute(counts: dict[int, int]):
    """Probability of any n-gram by the recursion over dictionaries."""
    tables = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        tables[order] = {}
        for key in tables[order + 1]:
            short = int(_history(np.array([key]), order)[0])
            tables[order][short] = tables[order].get(short, 0) + 1

    def cuts(order):
        n = [sum(c == k for c in tables[order].values()) for k in range(5)]
        y = n[1] / max(1.0, n[1] + 2.0 * n[2])
        raw = (1 - 2 * y * n[2] / max(1, n[1]), 2 - 3 * y * n[3] / max(1, n[2]), 3 - 4 * y * n[4] / max(1, n[3]))
        return [0.0] + [min(0.95 * (i + 1), max(0.1, d)) for i, d in enumerate(raw)]

    cut = {order: cuts(order) for order in tables}

    def p(key, order):
        if order == 0:
            return 1 / 64
        short = int(_history(np.array([key]), order - 1)[0]) if order > 1 else key
        own = {k: c for k, c in tables[order].items() if k >> 6 == key >> 6}
        if not own:
            return p(short, order - 1)
        whole, off = sum(own.values()), lambda c: min(cut[order][min(c, 3)], c)
        mine = own.get(key, 0)
        return (mine - off(mine) if mine else 0) / whole + sum(off(c) for c in own.values()) / whole * p(short, order - 1)

    return lambda key: p(key, ORDER)


@pytest.mark.parametrize("seed", [1, 2])
def test_look_up_equals_the_recursion(seed):
    rng = random.Random(seed)
    some = lambda: sum(rng.randrange(4) << (6 + 5 * i) for i in range(ORDER - 1)) + rng.randrange(5)
    counts = {k: rng.choice([1, 1, 1, 2, 2, 3, 4, 9]) for k in sorted({some() for _ in range(120)})}
    model = HashArrays.of(kneser_ney_orders(np.array(list(counts)), np.array(list(counts.values()))))
    unseen = sorted({some() for _ in range(300)} - set(counts))
    asked = [*counts, *unseen, 63, (31 << 16) + 7]
    p = brute(counts)
    np.testing.assert_allclose(np.exp(model.look_up(np.array(asked))), [p(k) for k in asked], rtol=1e-5)
    context = next(iter(counts)) >> 6 << 6
    assert np.exp(model.look_up(context + np.arange(64))).sum() == pytest.approx(1, rel=1e-5)


def test_bands_reject_junk_of_each_length(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("abdeilmnorst", k=rng.randint(2, 9))) for _ in range(500)]
    text = lambda n: " ".join(rng.choices(words, k=n))
    rows = [(i, text(rng.choice([60, 400])), "xy"[i % 2]) for i in range(600)]
    junk = [(1000 + i, " ".join(w + rng.choice(["%%%", "###", " |"]) for w in text(n).split()), "x") for i, n in enumerate([70, 90, 380, 420])]
    got = {r.doc_id: r for r in quality_rules(spark, spark.createDataFrame(rows + junk, "doc_id long, text string, lang string")).collect()}
    assert not any(got[i].kept for i, *_ in junk) and sum(not got[i].kept for i, *_ in rows) < 12
