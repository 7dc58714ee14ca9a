"""The training-data operators against brute force on small tables with nulls,
empty and long texts, repeated rows, and extra columns with clashing names."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm.components import components
from skein.llm.embedding_dedup import embedding_dedup
from skein.llm.language_id import identify_languages
from skein.llm.line_crf import score_quality
from skein.llm.line_dedup import line_dedup
from skein.llm.lm_scoring import cross_entropy_difference
from skein.llm.minmax_dedup import common, minmax_dedup
from skein.llm.mixing import mix_sources
from skein.llm.packing import first_fit_decreasing, pack, pack_group
from skein.llm.perplexity import kneser_ney, quality_rules
from skein.llm.queries import vocabulary_path
from skein.llm.substring_dedup import levels, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, tkey string, score string, n_words string, held_out string"


def _texts() -> list[str | None]:
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeéü", k=rng.randint(1, 12))) for _ in range(400)]
    line = lambda n: " ".join(rng.choices(vocabulary, k=n))
    base = [line(rng.randint(5, 40)) + "\n" + line(30) + ".\n" + line(25) for _ in range(30)]
    shared = line(70)
    near = [" ".join(w if i != k else "changed" for i, w in enumerate(base[0].split(" "))) for k in (3, 40)]
    block = "\n".join(line(8) for _ in range(12))
    return [*base, base[0], base[1], *near, f"{line(9)} {shared} {line(4)}", f"{shared}", f"{line(3)}\n{shared}\tx", None, "", "  \n ", "a", "A a\x0ba",
            "1 2 3", "中文 文字 字", f"{block}\n{line(5)}", f"{line(5)}\n{block}", line(6000), "same words " * 60, "THIS IS SHOUTING!! " * 30]


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, "xy"[i % 2] if i % 7 else None, [None, "b", "a", "ä"][i % 4], "t", "s", "n", "h") for i, t in enumerate(_texts())]
    return [*out, (None, out[0][1], "x", "a", None, None, None, None), out[2], out[2]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_components(spark):
    links = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (7, 7), (None, 1), (3, 1), (8, 20)], "a long, b long")
    got = {r.node: r.component for r in components(spark, links).collect()}
    assert got == {5: 1, 4: 1, 3: 1, 1: 1, 9: 8, 8: 8, 20: 8}
    assert components(spark, links.limit(0)).count() == 0


def test_levels():
    assert levels(50, 25) == [25, 50] and levels(200, 25) == [25, 50, 100, 200] and levels(60, 25) == [25, 50, 60] and levels(5, 9) == [5]


@pytest.mark.parametrize("window,start", [(50, 25), (50, 7), (50, 6), (8, 2), (3, 3)])
def test_substring_dedup(spark, docs, rows, empty, window, start):
    first = {}
    words = [(r[0], WORD.findall(r[1] or "")) for r in rows]
    for i, w in words:
        for j in range(len(w) - window + 1 if i is not None else 0):
            key = tuple(w[j : j + window])
            first[key] = min(i, first.get(key, i))
    want = []
    for i, w in words:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[j : j + window])] < i:
                gone[j : j + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want.append((str(i), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = [(str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(spark, docs, window, start).collect()]
    assert sorted(got) == sorted(want)
    assert sum(w[2] for w in want) > 60
    assert substring_dedup(spark, empty, window, start).count() == 0


def _shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_minmax_dedup(spark, docs, rows, empty):
    sets = [_shingles(r[1]) for r in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                group[top(i)] = top(j)
    least = collections.defaultdict(list)
    for i, r in enumerate(rows):
        least[top(i)].append(r[0])
    smallest = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    want = [(str(r[0]), len(sets[i]), str(smallest[top(i)]), r[0] == smallest[top(i)]) for i, r in enumerate(rows)]
    got = [(str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in minmax_dedup(spark, docs).collect()]
    assert sorted(got) == sorted(want)
    assert minmax_dedup(spark, empty).count() == 0


def test_minmax_common_elements():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 30000, n).astype(np.uint64)) for n in (0, 1, 500, 20000, 20000, 3)] + [np.arange(9, dtype=np.uint64)] * 2
    want = [[len(np.intersect1d(x, y)) for y in sets] for x in sets]
    assert all(common(sets)[i, j] == want[i][j] for i in range(len(sets)) for j in range(len(sets)) if i != j)


def test_minmax_dedup_group_below_the_limit(spark):
    """Copies of one text, mostly less alike than the limit, in buckets of several blocks: every link counts."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(300)]
    texts = []
    for i in range(700):
        words = list(base)
        for place in [*random.Random(i % 40).sample(range(4, 296), 6), rng.randint(4, 295)]:
            words[place] = f"y{i}"
        texts.append(" ".join(words))
    sets = [_shingles(t) for t in texts]
    group = list(range(len(texts)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                x, y = sorted((top(i), top(j)))
                group[y] = x
    got = {r.doc_id: r.component_id for r in minmax_dedup(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {i: top(i) for i in range(len(texts))}
    assert len(set(got.values())) > 1


def test_embedding_dedup(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(6, 24))
    vectors = [c + 0.1 * rng.normal(size=24) for c in centre for _ in range(12)] + list(rng.normal(size=(40, 24)))
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)]
    rows += [(900, rows[0][1], 2), (901, [2 * x for x in rows[0][1]], 2), (None, rows[12][1], 0), (902, None, 0), (903, [0.0] * 24, 0), (904, [], 0),
             (905, [float("nan")] * 24, 0), (906, [1.0, None], 0), (907, [3.0, 4.0], 0), (908, [6.0, 8.0], 0), (909, [float("inf")] * 24, 0), (910, [5.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    unit = [np.array(v) / np.linalg.norm(v) if v and None not in v and np.isfinite(v).all() and any(v) else None for _, v, _ in rows]
    linked = [[j for j in range(len(rows)) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9] for i in range(len(rows))]
    got = {r.vec_id: r for r in embedding_dedup(spark, frame).collect()}
    assert len(got) == len(rows)
    for i, r in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        assert (got[r[0]].n_links, got[r[0]].component_id, got[r[0]].kept) == (len(linked[i]), least, r[0] == least), r[0]
    assert embedding_dedup(spark, frame.limit(0)).count() == 0


def test_line_dedup(spark, docs, rows, empty):
    out = line_dedup(spark, docs).collect()
    assert len(out) == len(rows) and set(docs.columns) - {"tkey"} <= set(out[0].asDict())
    by = collections.defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    texts = {r[0]: r[1] for r in rows}
    for i, t in texts.items():
        for r in by[i]:
            assert r.n_lines == (0 if t is None else len(t.split("\n")))
            assert (r.text is None) == (t is None)
            if r.n_removed == 0:
                assert r.text == t
            else:  # what is left is the text's lines in order
                left = iter(t.split("\n"))
                assert all(line in left for line in (r.text.split("\n") if r.text else []))
    one, two = [i for i, t in texts.items() if t and t.count("\n") == 12]
    assert by[one][0].n_removed == 0 and by[two][0].n_removed >= 6  # most chunks of the block found behind another line
    assert line_dedup(spark, empty).count() == 0


def test_mix_sources(spark, docs, rows, empty):
    size = collections.Counter()
    for r in rows:
        size[r[3]] += len(WORD.findall(r[1] or ""))
    sources = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    total, capped = 1.5 * sum(size.values()), set()
    while True:
        free = [s for s in sources if s not in capped]
        level = (total - sum(2 * size[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        if not over:
            break
        capped |= over
    target = {s: 2 * size[s] if s in capped else level * weight[s] for s in sources}
    mixed = mix_sources(spark, docs).collect()
    assert len(mixed) == len(rows)
    taken = collections.Counter()
    for r in mixed:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
    largest = max(len(WORD.findall(r[1] or "")) for r in rows)
    assert all(abs(taken[s] - target[s]) <= largest / 2 for s in sources)
    again = mix_sources(spark, docs.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken)
    assert sorted(map(key, mixed)) == sorted(map(key, again))
    assert mix_sources(spark, empty).count() == 0


def test_first_fit_decreasing():
    sizes = [5, 7, 5, 2, 4, 2, 5, 1, 6]
    want, room = [], []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        for b, r in enumerate(room):
            if r >= sizes[i]:
                want[b].append(i)
                room[b] -= sizes[i]
                break
        else:
            want.append([i])
            room.append(10 - sizes[i])
    assert first_fit_decreasing(sizes, 10) == want
    assert first_fit_decreasing([], 10) == [] and pack_group([], 8) == []


def test_pack(spark, docs, rows, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    want = collections.Counter()
    for i, t, *_ in rows:
        want[(i, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]))] += 1
    pieces = pack(spark, docs, vocabulary_path(), 64).collect()
    ids = {i: x for i, x in want}
    for r in pieces:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(part.tobytes())
    held = collections.Counter((r.doc_id, k) for r in pieces for k in range(r.start, r.start + r.length))
    assert held == collections.Counter({(i, k): n for (i, x), n in want.items() for k in range(len(x))})
    rooms = collections.defaultdict(list)
    for r in pieces:
        rooms[r.sequence_id].append((r.offset, r.length))
    padding = 0
    for parts in rooms.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
        padding += 0 if at & (at - 1) == 0 else 64 - at
    assert padding <= 0.15 * sum(len(x) for _, x in want)
    assert pack(spark, empty, vocabulary_path()).count() == 0


def test_quality_rules(spark, docs, rows, empty):
    got = collections.defaultdict(list)
    for r in quality_rules(spark, docs).collect():
        got[r.doc_id].append(r)
    for i, t, *_ in rows:
        t = t or ""
        w = WORD.findall(t)
        count = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        again = {k + o for k in range(len(w) - 2) if count[tuple(w[k : k + 3])] > 1 for o in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
        for r in got[i]:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (
                len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again), failed), i
            assert r.kept == (not failed and r.lower <= r.log_perplexity <= r.upper)
    assert quality_rules(spark, empty).count() == 0


def test_kneser_ney_sums_to_one():
    rng = np.random.default_rng(2)
    keys = np.unique((rng.integers(0, 4, (4000, 4)) * np.array([1, 64, 64 * 32, 64 * 32 * 32])).sum(1))
    seen, p = kneser_ney(keys, rng.integers(1, 9, len(keys)))
    context = collections.Counter()
    for k, x in zip(seen, p, strict=True):
        context[k >> 6] += x
    # symbols never seen keep some probability, so what is seen stays below 1, and near it where all four symbols were
    assert all(x <= 1 + 1e-9 for x in context.values()) and max(context.values()) > 0.9


def test_identify_languages(spark, empty):
    rng = random.Random(1)
    syllables = {"one": ["ka", "ro", "mi"], "two": ["the", "ing", "ly"]}
    text = lambda lang, n=30: " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(n))
    rows = [(i, text(lang), lang, "extra") for i in range(120) for lang in [["one", "two"][i % 2]]]
    rows += [(500, None, "one", ""), (501, "12 34 !?", "two", ""), (502, "", None, ""), (None, text("two"), None, ""), (503, text("one", 60) + " " + text("two", 20), None, "")]
    out = {r.doc_id: r for r in identify_languages(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")).collect()}
    for i, _, lang, _ in rows[:120]:
        assert out[i].lang_pred == lang and out[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
    assert [out[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3 and out[500].score == 0
    assert out[None].lang_pred == "two" and not out[None].held_out
    assert out[503].lang_pred == "one" and out[503].n_spans == 2 and 0.5 < out[503].score < 1
    assert identify_languages(spark, empty).count() == 0
    assert identify_languages(spark, spark.createDataFrame([(1, "word")], "doc_id long, text string").withColumn("lang", F.lit(None).cast("string"))).first().lang_pred == "und"


def test_score_quality(spark, docs, rows, empty):
    rng = random.Random(4)
    good = lambda: "\n".join(" ".join(rng.choices(["the", "word", "is", "plain", "here"], k=9)) + "." for _ in range(4))
    bad = lambda: "\n".join("$$$ ".join(rng.choices(["BUY", "NOW", "###"], k=9)) for _ in range(4))
    many = [(i, good() if i % 3 else bad(), i) for i in range(150)] + [(1000, None, 0), (1001, "", 0), (None, good(), 0)]
    frame = spark.createDataFrame(many, "doc_id long, text string, score long")
    labels = spark.createDataFrame([(i, int(bool(i % 3))) for i in range(150)] + [(None, 1), (3, None)], "doc_id long, quality int")
    out = {r.doc_id: r for r in score_quality(spark, frame, labels).collect()}
    held = [i for i in range(150) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert held and all(out[i].held_out for i in held)
    assert all(out[i].predicted == int(bool(i % 3)) for i in range(150))
    assert all(0 <= r.score <= 1 for r in out.values()) and out[1000].score == out[1001].score
    lines = score_quality(spark, frame, labels, with_lines=True, carry=["score", "text"]).where("doc_id = 1").first()
    assert len(lines.line_scores) == 4 and lines.text == many[1][1] and lines.score == 1
    assert score_quality(spark, empty, labels).count() == 0
    assert all(r.score == pytest.approx(0.5) for r in score_quality(spark, frame, labels.limit(0)).collect())


def test_cross_entropy_difference(spark, docs, rows, empty):
    rng = random.Random(6)
    text = lambda words, n=40: " ".join(rng.choices(words, k=n))
    many = [(i, text(["red", "green", "blue"] if i % 2 else ["up", "down", "left"]), 1.0) for i in range(40)] + [(100, None, 1.0), (101, " ", 1.0), (None, "red red", 1.0)]
    frame = spark.createDataFrame(many, "doc_id long, text string, score double")
    targets = spark.createDataFrame([(i,) for i in range(1, 20, 2)] + [(1,), (None,)], "doc_id long")
    out = {r.doc_id: r for r in cross_entropy_difference(spark, frame, targets).collect()}
    assert min(out[i].score for i in range(1, 40, 2)) > max(out[i].score for i in range(0, 40, 2))
    assert out[100].n_tokens == 0 and out[100].score == 0 and out[None].n_tokens == 2
    for r in out.values():
        assert r.score == pytest.approx(r.loss_background - r.loss_target)
    assert cross_entropy_difference(spark, empty, targets).count() == 0


def test_cross_entropy_difference_counts_every_word_and_pair(spark, docs, rows):
    """More words than the models once held, most of them seen once, in several blocks: losses as counted by hand."""
    targets = {1, 3, 35, 2000}
    many = [(r[0], r[1]) for r in rows] + [(2000 + k, " ".join(f"w{k}x{i % 36000} z{i % 7}" for i in range(36000))) for k in range(2)]
    words, pairs, before = ([collections.Counter(), collections.Counter()] for _ in range(3))
    tokens = [(i, WORD.findall(t or "")) for i, t in many]
    for i, w in tokens:
        for k in (0, 1) if i in targets else (0,):
            words[k].update(w)
            pairs[k].update(zip([None, *w], w, strict=False))
            before[k].update([None, *w] if w else [])
    size = len(words[0])
    assert size > 1 << 16

    totals = [sum(c.values()) for c in words]

    def loss(k, i, w, prior=50.0):
        """By the counts of model k without the text's own, if it is one of the model's."""
        mine = w if k == 0 or i in targets else []
        own, own_pairs, own_before = collections.Counter(mine), collections.Counter(zip([None, *mine], mine, strict=False)), collections.Counter([None, *mine] if mine else [])
        whole = totals[k] - len(mine) + 0.5 * size
        p = [(pairs[k][x, y] - own_pairs[x, y] + prior * (words[k][y] - own[y] + 0.5) / whole) / (before[k][x] - own_before[x] + prior) for x, y in zip([None, *w], w, strict=False)]
        return -float(np.log(p).sum()) / max(1, len(w))

    chosen = spark.createDataFrame([(i,) for i in targets], "doc_id long")
    got = cross_entropy_difference(spark, spark.createDataFrame(many, "doc_id long, text string").repartition(5), chosen, prior=50.0).collect()
    key = lambda x: (str(x[0]), x[1])
    want = sorted(((i, len(w), loss(1, i, w), loss(0, i, w)) for i, w in tokens), key=lambda x: (*key(x), x[3]))
    got = sorted(((r.doc_id, r.n_tokens, r.loss_target, r.loss_background) for r in got), key=lambda x: (*key(x), x[3]))
    assert [key(x) for x in got] == [key(x) for x in want]
    assert np.allclose([x[2:] for x in got], [x[2:] for x in want])


def test_being_a_target_gives_a_text_nothing_by_itself(spark):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = [(i, " ".join(rng.choices(vocabulary, k=200))) for i in range(200)]
    targets = spark.createDataFrame([(i,) for i in range(0, 200, 2)], "doc_id long")
    out = cross_entropy_difference(spark, spark.createDataFrame(texts, "doc_id long, text string"), targets).toPandas()
    of = [out[out.doc_id % 2 == k].score for k in (0, 1)]
    assert abs(of[0].median() - of[1].median()) < 0.2 * of[0].std()


def test_near_copies_leave_one_row(spark):
    """Null ids and repeated rows: one row of each group stays, and every row without a word."""
    import corpus_pipeline

    text = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcdef"}
    near = {c: text[c].replace(f"{c}59", "changed") for c in "abe"}
    rows = [(5, text["a"]), (None, near["a"]), (None, text["b"]), (None, text["b"]), (None, near["b"]), (7, text["c"]), (7, text["c"]), (7, text["d"]),
            (9, text["e"]), (9, near["e"]), (None, text["f"]), (None, ""), (None, ""), (8, None)]
    left = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    letter = collections.Counter((r.doc_id, (r.text or "-")[0]) for r in left)
    assert letter == {(5, "a"): 1, (None, "b"): 1, (7, "c"): 1, (7, "d"): 1, (9, "e"): 1, (None, "f"): 1, (None, "-"): 2, (8, "-"): 1}


def test_identify_languages_in_other_scripts(spark):
    rng = random.Random(3)
    start = {"am": 0x1200, "chr": 0x13A0, "dv": 0x0780, "en": 0x61, "got": 0x10330, "ka": 0x10D0, "km": 0x1780, "my": 0x1000, "nko": 0x07CA, "syr": 0x0712, "zgh": 0x2D30}
    text = lambda lang: " ".join("".join(chr(start[lang] + rng.randrange(16)) for _ in range(5)) for _ in range(20)) + " \u201cabc\u201d" * (lang == "en")
    rows = [(i, text(lang), lang) for i, lang in enumerate(list(start) * 12)]
    out = {r.doc_id: r for r in identify_languages(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert sum(r.held_out for r in out.values()) > 20
    assert all(out[i].lang_pred == lang and out[i].score == 1 for i, _, lang in rows)
