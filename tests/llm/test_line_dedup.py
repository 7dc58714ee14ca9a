"""Line dedup against brute force: every line of a run of two or more that occurs earlier goes, no other."""

import random

import pytest

from skein.llm.line_dedup import line_dedup

SCHEMA = "doc_id long, text string, f_id string, hash string, i string, k string, d string, numbers string, n_lines string"


def brute(rows):
    """(kept text, lines, removed) of each row by comparing every two neighbouring lines with words, and the blanks between, with all others."""
    first, units = {}, []
    for n, (doc_id, text, *_) in enumerate(rows):
        lines = (text or "").split("\n")
        full = [i for i, x in enumerate(lines) if x.strip(" \t\r\x0b\x0c")]
        own = [(a, b, "\n".join(lines[a : b + 1])) for a, b in zip(full, full[1:], strict=False)]
        units.append((lines, own))
        if doc_id is not None:
            for _, _, u in own:
                first[u] = min(doc_id, first.get(u, doc_id))
    out = []
    for (doc_id, text, *_), (lines, own) in zip(rows, units, strict=True):
        gone, seen = set(), set()
        for a, b, u in own:
            if u in seen or doc_id is not None and first[u] < doc_id:
                gone.update(range(a, b + 1))
            seen.add(u)
        kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
        out.append((doc_id, None if text is None else kept, 0 if text is None else len(lines), len(gone)))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    lines = ["", " ", "x", "é", "same line", *[f"line {i} " + "w " * rng.randint(0, 9) for i in range(60)]]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(1, 14))) for _ in range(300)]
    block = [f"block {i}" for i in range(9)]
    texts += ["\n".join([f"own {i}", *block[i % 4 : 4 + i % 6], f"tail {i}"]) for i in range(40)]
    texts += [None, "", "\n\n", "alone", "a\nb", "a\nb\n", "z\n" * 3000 + "end", "\n".join(f"l{i}" for i in range(5000)), "\r\n".join(block)]
    out = [(i * 2 - 9, t, "f", "h", "i", "k", "d", "n", "nl") for i, t in enumerate(texts)]
    rng.shuffle(out)
    return [*out, out[0], out[0], out[7], (None, "block 0\nblock 1\nnew\nblock 0\nblock 1", *[None] * 7), (out[3][0], out[4][1], *[None] * 7)]


def test_line_dedup_equals_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = line_dedup(spark, docs)
    assert got.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_removed"]
    got = got.collect()
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in got), key=str) == sorted(brute(rows), key=str)
    assert sum(r.n_removed for r in got) > 500 and {r.f_id for r in got} == {"f", None}


def test_every_column_comes_through(spark):
    docs = spark.createDataFrame([(1, "a b\nc", "x", {"u": 1})], "doc_id long, text string, `t.1``` string, d map<string,int>")
    assert tuple(line_dedup(spark, docs).collect()[0]) == (1, "a b\nc", "x", {"u": 1}, 2, 0)
    assert line_dedup(spark, docs.limit(0)).count() == 0


def test_blank_lines_are_part_of_a_stretch(spark):
    texts = ["a\n \n\nb", "a\n\n \nb", "a\n \n\nb", "a\nb"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in line_dedup(spark, docs).collect()} == {0: 0, 1: 0, 2: 4, 3: 0}
