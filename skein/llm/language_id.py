"""Language spans by Viterbi over per-word scores (operator 10).

Script ranges narrow each word's candidate languages; the candidates are
scored by naive Bayes over hashed letter trigrams and whole words; a dynamic
programme with a penalty for each switch labels spans of mixed-language text.
The document's language is the one whose spans hold most letters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import is_held_out, prepare
from .words import FIRST, LOWER, Texts, distinct, doc_index, text_slices, texts_of

SLOTS = 1 << 17
NEVER = -1e4
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: UTF-8 lead bytes of the Unicode blocks of each script.
SCRIPTS = {
    "latin": [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0xCC)], "greek": range(0xCD, 0xD0), "cyrillic": range(0xD0, 0xD4),
    "armenian": range(0xD4, 0xD6), "hebrew": range(0xD6, 0xD8), "arabic": range(0xD8, 0xDC), "south asian": [0xE0], "east asian": range(0xE3, 0xEA),
    "hangul": range(0xEA, 0xEE), "other": range(0xDC, 0xE0),
}
SCRIPT_OF = np.zeros(256, np.int8)  # 0: no letter
for _number, _leads in enumerate(SCRIPTS.values(), 1):
    SCRIPT_OF[list(_leads)] = _number
#: Lead bytes whose blocks hold several scripts, or letters next to punctuation, by the byte after them: the ranges that have letters.
BY_SECOND = {
    0xE1: {"other": range(0x80, 0xC0), "hangul": range(0x84, 0x88), "latin": range(0xB8, 0xBC), "greek": range(0xBC, 0xC0)},
    0xE2: {"other": range(0xB0, 0xB8)},
    0xEF: {"east asian": [*range(0xA4, 0xAC), *range(0xBC, 0xBF)], "arabic": [*range(0xAC, 0xB8), 0xB9, 0xBA]},
    0xF0: {"other": [*range(0x90, 0x9D), 0x9E], "east asian": range(0xA0, 0xB4)},
}
SCRIPT_OF_TWO = np.repeat(SCRIPT_OF[:, None], 256, 1)
for _lead, _ranges in BY_SECOND.items():
    for _name, _seconds in _ranges.items():
        SCRIPT_OF_TWO[_lead, list(_seconds)] = list(SCRIPTS).index(_name) + 1


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # SLOTS x languages, log P(feature | language)
    candidates: np.ndarray  # scripts x languages, bool
    prior: np.ndarray


SLICE = 4 << 20  # bytes of text looked at together; words repeat, and each distinct one is scored once


@dataclass
class DistinctWords:
    """The words of a slice, and what is needed of each distinct one (A-Z lower-cased)."""

    offsets: np.ndarray  # words of each document
    which: np.ndarray  # distinct word of each word
    script: np.ndarray  # of each distinct word
    letters: np.ndarray  # code points in it
    slots: np.ndarray  # its features
    bounds: np.ndarray  # limits of its features


def distinct_words(texts: Texts) -> DistinctWords:
    """Features of a word: letter trigrams over its bytes with an edge on both sides, and the whole word."""
    data = LOWER[texts.data]
    starts, ends, offs = texts.words()
    hashes = FIRST.segments(data, starts, ends)
    hashes, one, which = distinct(hashes)
    starts, ends = starts[one], ends[one]
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) + np.repeat(starts - first, lengths)
    inside = data[place]
    mid = inside.astype(np.uint32)
    before, after = np.empty_like(mid), np.empty_like(mid)
    before[1:], after[:-1] = mid[:-1], mid[1:]
    before[first] = after[first + lengths - 1] = 0x20
    grams = (((before << np.uint32(16)) | (mid << np.uint32(8)) | after) * np.uint32(0x9E3779B1)) >> np.uint32(32 - 17)
    bounds = np.concatenate([[0], np.cumsum(lengths + 1)])
    slots = np.empty(bounds[-1], np.uint32)
    slots[np.arange(len(grams)) + np.repeat(np.arange(len(starts)), lengths)] = grams
    slots[bounds[1:] - 1] = hashes >> np.uint64(64 - 17)
    script = np.maximum.reduceat(SCRIPT_OF_TWO[inside, after], first) if len(first) else np.zeros(0, np.int8)
    points = np.add.reduceat(((inside & 0xC0) != 0x80).astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    return DistinctWords(offs, which, script, points, slots, bounds)


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature counts (slot), and letters by script (slot = -1 - script), of each language."""
    total: dict[str, np.ndarray] = {}
    for batch in text_slices(batches, max_bytes=SLICE):
        f = distinct_words(texts_of(batch.column("text")))
        langs = batch.column("lang").to_pylist()
        number = {lang: i for i, lang in enumerate(dict.fromkeys(langs))}
        of_word = np.repeat(np.array([number[x] for x in langs]), np.diff(f.offsets))
        lettered = f.script > 0
        for lang, i in number.items():
            times = np.bincount(f.which[of_word == i], minlength=len(f.script)) * lettered
            counts = total.setdefault(lang, np.zeros(SLOTS + len(SCRIPTS) + 1, np.int64))
            counts[:SLOTS] += np.bincount(f.slots, np.repeat(times, np.diff(f.bounds)), SLOTS).astype(np.int64)
            counts[SLOTS:] += np.bincount(f.script, f.letters * times, len(SCRIPTS) + 1).astype(np.int64)
    for lang, counts in total.items():
        at = np.flatnonzero(counts)
        slot = np.where(at < SLOTS, at, SLOTS - 1 - at)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(slot.astype(np.int32)), pa.array(counts[at])],
                                         ["lang", "slot", "n"])


def learn(spark: SparkSession, labelled: DataFrame, most_languages: int = 256) -> LanguageModel:
    """Model from all rows of ``labelled`` (text, lang). At most ``most_languages`` x (SLOTS + scripts) sums come to the driver."""
    counted = labelled.mapInArrow(_learn, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    found = counted.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), "lang").limit(most_languages + 1).collect()
    if len(found) > most_languages:
        raise ValueError(f"more than {most_languages} languages; raise most_languages")
    languages = sorted(r[0] for r in found)
    counts = np.zeros((SLOTS, len(languages)))
    script = np.zeros((len(SCRIPTS) + 1, len(languages)))
    rows = counted.toPandas()
    number = rows["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64)
    slot, n = rows["slot"].to_numpy(np.int64), rows["n"].to_numpy(np.float64)
    feature = slot >= 0
    counts[slot[feature], number[feature]] = n[feature]
    script[-1 - slot[~feature], number[~feature]] = n[~feature]
    smooth = counts + 0.5
    table = np.log(smooth / smooth.sum(0)) if languages else counts
    # a language is a candidate for a script that makes up a hundredth of its letters; a script of no language leaves all of them
    share = script / np.maximum(script.sum(0), 1)
    candidates = share >= 0.01
    candidates[~candidates.any(1)] = True
    candidates[len(SCRIPTS)] = True  # other letters: many scripts, told apart by their words
    prior = np.log(np.maximum(counts.sum(0), 1) / max(1.0, counts.sum())) if languages else np.zeros(0)
    return LanguageModel(languages, table.astype(np.float32), candidates, prior)


def viterbi(scores: np.ndarray, offsets: np.ndarray, penalty: float) -> np.ndarray:
    """Best state of every word; all documents of the slice advance together, one word a step."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    lengths, first = lengths[order], offsets[:-1][order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), "left")  # documents with more than t words
    stays = np.zeros(scores.shape, bool)
    switch = np.zeros(len(scores), np.int32)
    value = np.zeros((len(lengths), scores.shape[1]), np.float32)
    for t in range(steps):
        a = active[t]
        at = first[:a] + t
        now = value[:a]
        if t:
            best = now.argmax(1)
            jump = now[np.arange(a), best] - penalty
            stay = now >= jump[:, None]
            stays[at], switch[at] = stay, best
            now = np.where(stay, now, jump[:, None])
        value[:a] = now + scores[at]
    out = np.zeros(len(scores), np.int32)
    state = value.argmax(1)
    for t in reversed(range(steps)):
        a = active[t]
        at = first[:a] + t
        here = state[:a]
        out[at] = here
        if t:
            state[:a] = np.where(stays[at, here], here, switch[at])
    return out


def word_scores(f: DistinctWords, model: LanguageModel, temper: float) -> np.ndarray:
    """Score of each distinct word in each language, 0 for the best one."""
    out = np.empty((len(f.script), len(model.languages)), np.float32)
    for at in range(0, len(out), 1 << 16):  # the features of so many words at a time
        part = f.bounds[at : at + (1 << 16) + 1]
        slots, begin = f.slots[part[0] : part[-1]], part[:-1] - part[0]
        for k in range(out.shape[1]):
            out[at : at + len(begin), k] = np.add.reduceat(model.table[:, k][slots], begin)
    out *= temper
    out[~model.candidates[f.script]] = NEVER
    out -= out.max(1, keepdims=True)
    out[f.script == 0] = 0
    return out


def word_labels(f: DistinctWords, model: LanguageModel, penalty: float, temper: float) -> np.ndarray:
    """Language number of every word.

    Staying in the language with the largest sum is a best path wherever no
    stretch of words gains more than one penalty in any other language, since
    every stretch elsewhere pays at least one switch. That holds for most
    documents and is seen from running sums; only the others are searched.
    """
    scores = word_scores(f, model, temper)
    offs, docs = f.offsets, len(f.offsets) - 1
    running = [np.concatenate([[0.0], np.cumsum(scores[:, k][f.which], dtype=np.float64)]) for k in range(scores.shape[1])]
    sums = np.stack([r[offs[1:]] - r[offs[:-1]] for r in running], 1)
    best = sums.argmax(1)
    counts = np.diff(offs)
    label = np.repeat(best, counts)
    doc = doc_index(offs)
    own = np.zeros(len(f.which) + 1)
    own[1:] = np.cumsum(scores[f.which, label], dtype=np.float64)
    mixed = np.zeros(docs, bool)
    for r in running:
        gain = r - own
        # the largest gain of a stretch: running sum minus its lowest value before, each document below the one before it
        low_step = 4 * (np.abs(gain).max() + 1) * doc
        lowest = np.minimum.accumulate(gain[:-1] - low_step) + low_step
        stretch = gain[1:] - lowest
        mixed |= np.bincount(doc[stretch > penalty], minlength=docs) > 0
    some = np.flatnonzero(mixed)
    if len(some):
        chosen = np.repeat(mixed, counts)
        label[chosen] = viterbi(scores[f.which[chosen]], np.concatenate([[0], np.cumsum(counts[some])]), penalty)
    return label


def _predicted(model, penalty: float, temper: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: LanguageModel = model.value
        for batch in text_slices(batches, max_bytes=SLICE):
            column = batch.column("text")
            texts = texts_of(column)
            f = distinct_words(texts)
            size = len(known.languages)
            spans = np.zeros(texts.size, np.int64)
            held = np.zeros((texts.size, max(size, 1)))
            if size and len(f.which):
                label = word_labels(f, known, penalty, temper)
                doc = doc_index(f.offsets)
                weight = np.where(f.script > 0, f.letters, 0)[f.which]
                held = np.bincount(doc * size + label, weight, texts.size * size).reshape(texts.size, size)
                change = np.ones(len(label), bool)
                change[1:] = (label[1:] != label[:-1]) | (doc[1:] != doc[:-1])
                spans = np.bincount(doc[change], minlength=texts.size)
            best = held.argmax(1)
            whole = held.sum(1)
            letters = np.concatenate([[0], np.cumsum(ASCII_LETTER[texts.data])])
            has = letters[texts.offsets[1:]] > letters[texts.offsets[:-1]]
            for i in np.flatnonzero(~has):  # rare: ask Unicode
                has[i] = any(c.isalpha() for c in column[i].as_py() or "")
            has &= size > 0
            named = [known.languages[b] if h else "und" for b, h in zip(best, has, strict=True)]
            share = np.where(has & (whole > 0), held[np.arange(texts.size), best] / np.maximum(whole, 1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(named, pa.string()), pa.array(share), pa.array(spans.astype(np.int64))],
                                             ["doc_id", "held_out", "lang_pred", "score", "n_spans"])

    return run


def identify_languages(spark: SparkSession, docs: DataFrame, fold: int = 3, held_out: int = 1,
                       penalty: float = 12.0, temper: float = 0.5) -> DataFrame:
    """Language of every document, learnt from the rows outside the held-out fold.

    ``docs`` needs doc_id, text and lang. The fold is crc32 of the id as text
    modulo ``fold``; only text and lang of the other rows with a language are
    learnt from, all of them. Returns doc_id, held_out, lang_pred, score (the
    share of letters in spans of that language), n_spans.

    Defined cases: null texts and texts without a letter are ``und`` with
    score 0, as is every text when there is nothing to learn from; null ids
    are not held out; words without letters follow their neighbours; ties go
    to the language first in code point order; repeated rows are predicted
    each and learnt each. Extra columns are ignored.
    """
    prepare(spark)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
                       is_held_out("doc_id", fold, held_out).alias("held_out"))
    model = learn(spark, rows.where("not held_out and lang is not null").select("text", "lang"))
    shared = spark.sparkContext.broadcast(model)  # SLOTS x languages of 4 bytes
    return rows.drop("lang").mapInArrow(_predicted(shared, penalty, temper),
                                        "doc_id long, held_out boolean, lang_pred string, score double, n_spans long")
