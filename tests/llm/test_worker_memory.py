"""What the pipeline leaves in executors and their Python workers stays small, with the same results."""

import os
import random
import tracemalloc

import pyarrow as pa
import pytest

from skein.llm import components as rounds
from skein.llm import packing
from skein.llm.components import components
from skein.llm.packing import TokenIds
from skein.llm.queries import vocabulary_path
from skein.llm.words import texts_of
from skein.session import shared_dir


def _encoded(encoder, texts):
    ids, bounds = encoder.encode(texts_of(pa.array(texts, pa.string())), 1)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def test_known_words_are_held_in_little_memory(monkeypatch):
    monkeypatch.setattr(packing.TokenIds, "PIECES", 1000, raising=False)
    rng = random.Random(1)
    encoder = TokenIds(vocabulary_path())
    held = []
    tracemalloc.start()
    try:
        for _ in range(6):
            _encoded(encoder, [" ".join("".join(rng.choices("abcdefghij", k=9)) for _ in range(20_000))])
            held.append(tracemalloc.get_traced_memory()[0])
    finally:
        tracemalloc.stop()
    assert held[-1] - held[0] < 100 * 100_000, held  # bytes for 100,000 more words


def test_ids_are_the_tokenizers_though_words_and_pieces_are_forgotten(monkeypatch):
    monkeypatch.setattr(packing.TokenIds, "LIMIT", 40)
    monkeypatch.setattr(packing.TokenIds, "PIECES", 10, raising=False)
    rng = random.Random(2)
    words = ["the", "The", "THE.", "naïve", "中文", "x1y2", "it's", "<|end|>", *("".join(rng.choices("abcé", k=4)) for _ in range(90))]
    encoder = TokenIds(vocabulary_path())
    for size in (0, 1, 5, 30, 30, 200, 3, 30, 0, 30):
        texts = [" ".join(rng.choices(words, k=size)), "", None, " ".join(rng.choices(words, k=3))]
        want = [[*encoder.full.encode(" ".join((t or "").split()), add_special_tokens=False).ids, 1] for t in texts]
        assert _encoded(encoder, texts) == want


def _links():
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    return [*chain, *((1000, 1000 + i) for i in range(50)), *((rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150))]


def _smallest(links):
    low = {x: x for link in links for x in link if link[0] != link[1]}
    while True:
        new = {**low}
        for a, b in links:
            if a != b:
                new[a] = new[b] = min(new[a], new[b], low[a], low[b])
        if new == low:
            return low
        low = new


@pytest.mark.parametrize("edges", [1 << 18, 7])
def test_rounds_of_few_links_are_few_files(spark, monkeypatch, edges):
    monkeypatch.setattr(rounds, "EDGES", edges, raising=False)
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    top = shared_dir(spark).removeprefix("file:")

    def files():
        return {f"{d}/{x}" for d, _, names in os.walk(top) for x in names if x.startswith("part-") and "/rdd-" in d}

    there = files()
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        rows = components(spark, spark.createDataFrame(_links(), "a long, b long")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.node: r.component for r in rows} == _smallest(_links()) and len(rows) == len(_smallest(_links()))
    if edges > 7:
        assert len(files() - there) <= 40 + 20  # the links as they come, and one file a round
