"""Substring dedup by level-wise doubling (operator 9).

A window of ``window`` consecutive words is judged on ever longer pieces of
itself: first on a piece of ``start`` words, then only where that piece occurs
in two documents on one of twice the length, until the whole window is
compared or no candidate is left. The piece that stands for a window at a
level is the one with the smallest hash among all pieces of that length inside
the window, so equal windows always choose equal pieces and few distinct
pieces (about ``2 / (window - length)`` a word) are shuffled. Windows travel as
spans: runs of neighbouring windows with one piece, cut to what the levels
before left. The runs of all levels come from one pass over the texts, and
texts move once, for the last level.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import prepare, saved
from .words import FIRST, Texts, doc_index, mix, text_slices, texts_of, window_starts, windows


#: a piece's rows are counted and joined in this many parts, by document, as one passage may stand in a third of all documents
PARTS = 32


def levels(window: int, start: int) -> list[int]:
    """Piece lengths: ``start`` doubled while below ``window``, then ``window``."""
    out, length = [], min(start, window)
    while length < window:
        out.append(length)
        length *= 2
    return [*out, window]


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """best(values[i], ..., values[i + width - 1]) for each i; past the end fewer values count."""
    out, have = values.copy(), 1
    while have < width:
        step = min(have, width - have)
        if step < len(out):
            out[:-step] = best(out[:-step], out[step:])
        have += step
    return out


def chosen_pieces(hashes: np.ndarray, word_offsets: np.ndarray, window: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece, whole): for each word the hash of the piece that stands for the window starting there, and whether one does."""
    whole = window_starts(word_offsets, window)
    pieces = windows(hashes, length)
    pieces = np.concatenate([pieces, np.full(len(hashes) - len(pieces), np.uint64(2**64 - 1))])
    return _sliding(pieces, window - length + 1, np.minimum), whole


def joined_words(texts: Texts, starts: np.ndarray, ends: np.ndarray, word_offsets: np.ndarray,
                 keep: np.ndarray) -> list[bytes]:
    """Each document's kept words, joined by one space."""
    n = len(texts.data)
    step = np.zeros(n + 1, np.int8)
    step[starts[keep]] += 1
    step[ends[keep]] -= 1
    taken = np.cumsum(step[:-1]).astype(bool)
    out = texts.data.copy()
    doc_end = np.repeat(texts.offsets[1:], np.diff(word_offsets))
    gaps = ends[keep & (ends < doc_end)]
    taken[gaps] = True
    out[gaps] = 0x20
    bounds = np.concatenate([[0], np.cumsum(taken)])[texts.offsets]
    packed = out[taken].tobytes()
    return [packed[a:b].rstrip(b" ") for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


RUNS = "array<struct<piece: long, a: int, b: int>>"


def _first_pass(window: int, lengths: list[int]):
    """Marks of each text, and for each length the runs ``a <= place < b`` of windows that one piece stands for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = texts_of(batch.column("text"))
            starts, ends, offs = texts.words()
            hashes = FIRST.segments(texts.data, starts, ends)
            marks = [hashlib.sha256(x).hexdigest() for x in joined_words(texts, starts, ends, offs, np.ones(len(starts), bool))]
            one, two = _sequence(hashes, offs, 3), _sequence(hashes, offs, 4)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tkey"), pa.array(np.diff(offs)), pa.array(one.view(np.int64)),
                 pa.array(two.view(np.int64)), pa.array(marks, pa.string()), *[_runs(hashes, offs, window, length) for length in lengths]],
                ["doc_id", "tkey", "n_words", "seq1", "seq2", "sha", *[f"runs{length}" for length in lengths]])

    return run


def _runs(hashes: np.ndarray, offs: np.ndarray, window: int, length: int) -> pa.ListArray:
    piece, whole = chosen_pieces(hashes, offs, window, length)
    at = np.flatnonzero(whole)
    doc = doc_index(offs)[at]
    first = np.ones(len(at), bool)
    first[1:] = (piece[at][1:] != piece[at][:-1]) | (doc[1:] != doc[:-1])
    opens = np.flatnonzero(first)
    last = np.append(opens[1:], len(at)) - 1 if len(opens) else opens
    base, owner = offs[:-1], doc[opens]
    fields = {"piece": pa.array(piece[at[opens]].view(np.int64)), "a": pa.array((at[opens] - base[owner]).astype(np.int32)),
              "b": pa.array((at[last] + 1 - base[owner]).astype(np.int32))}
    counts = np.searchsorted(owner, np.arange(len(offs)))
    return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.StructArray.from_arrays(list(fields.values()), list(fields)))


def _fields(lists: pa.ListArray, base: np.ndarray) -> tuple[pa.StructArray, np.ndarray, np.ndarray, np.ndarray]:
    """(elements, their rows, a, b) of lists of spans, a and b moved by their row's base."""
    flat = lists.flatten()
    row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    a, b = (flat.field(n).to_numpy(zero_copy_only=False).astype(np.int64) + base[row] for n in ("a", "b"))
    return flat, row, a, b


def _left_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a level cut to the spans that the level before left (one row each)."""
    for batch in batches:
        # each row on its own stretch of one line, a gap after it, so spans of two rows never touch
        size = batch.column("n_words").to_numpy(zero_copy_only=False) + 1
        base = np.concatenate([[0], np.cumsum(size)[:-1]])
        flat, row, ra, rb = _fields(batch.column("runs"), base)
        _, _, sa, sb = _fields(batch.column("spans"), base)
        order = np.argsort(sa)
        sa, sb = sa[order], sb[order]
        apart = sa[1:] != sb[:-1]
        sa, sb = sa[np.append(True, apart)[: len(sa)]], sb[np.append(apart, True)[: len(sb)]]
        if not len(ra) or not len(sa):
            continue
        edges = np.unique(np.concatenate([ra, rb, sa, sb]))
        low, high = edges[:-1], edges[1:]
        r, s = (np.searchsorted(x, low, "right") - 1 for x in (ra, sa))
        both = (r >= 0) & (s >= 0) & (low < rb[r]) & (low < sb[s])
        low, high, r = low[both], high[both], r[both]
        owner = row[r]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(owner)), batch.column("tkey").take(pa.array(owner)), flat.field("piece").take(pa.array(r)),
             pa.array((low - base[owner]).astype(np.int32)), pa.array((high - base[owner]).astype(np.int32))],
            ["doc_id", "tkey", "piece", "a", "b"])


def _last_level(window: int):
    """Each document's distinct windows among its spans, with all their places: one row a window, however often the text repeats it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = texts_of(batch.column("text"))
            starts, ends, offs = texts.words()
            hashes = FIRST.segments(texts.data, starts, ends)
            _, _, a, b = _fields(batch.column("spans"), offs[:-1])
            step = np.zeros(len(starts) + 1, np.int64)
            np.add.at(step, a, 1)
            np.add.at(step, b, -1)
            at = np.flatnonzero(np.cumsum(step[:-1]) > 0)
            doc = doc_index(offs)[at]
            piece, check = windows(hashes, window)[at], windows(hashes, window, seed=2)[at] >> np.uint64(33)
            order = np.lexsort((at, check, piece, doc))
            at, doc, piece, check = (x[order] for x in (at, doc, piece, check))
            new = np.ones(len(at), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (piece[1:] != piece[:-1]) | (check[1:] != check[:-1])
            opens = np.flatnonzero(new)
            places = pa.ListArray.from_arrays(pa.array(np.append(opens, len(at)), pa.int32()), pa.array((at - offs[:-1][doc]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc[opens])), batch.column("tkey").take(pa.array(doc[opens])),
                 pa.array(piece[opens].view(np.int64)), pa.array(check[opens].astype(np.int32)), places],
                ["doc_id", "tkey", "piece", "check", "places"])

    return run


def _repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` whose keys stand in two documents or more, with the smallest of those ids (``lo``).

    Rows of one key are counted and joined in PARTS parts by document; the
    second side of the join holds a key once for each part that has it.
    """
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int"))
    parts = rows.groupBy(*keys, "part").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    mask = F.bit_or(F.expr("shiftleft(1L, part)")).alias("mask")
    found = parts.groupBy(*keys).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), mask).where("lo < hi")
    where = F.explode(F.filter(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.getbit("mask", p) == 1)).alias("part")
    return rows.join(found.select(*keys, "lo", where), [*keys, "part"]).drop("part")


def _sequence(hashes: np.ndarray, offs: np.ndarray, seed: int) -> np.ndarray:
    """One hash of each document's whole word sequence."""
    place = np.arange(len(hashes)) - np.repeat(offs[:-1], np.diff(offs))
    terms = mix(hashes + (place.astype(np.uint64) + np.uint64(seed * 2654435761)) * np.uint64(0x9E3779B97F4A7C15))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    return mix(total[offs[1:]] - total[offs[:-1]] + np.diff(offs).astype(np.uint64))


def _next_level(window: int, before: int, length: int):
    """Pieces of ``length`` words of the windows whose piece of ``before`` words survived."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = texts_of(batch.column("text"))
            starts, ends, offs = texts.words()
            hashes = FIRST.segments(texts.data, starts, ends)
            old, whole = chosen_pieces(hashes, offs, window, before)
            alive = whole & _member(old, doc_index(offs), batch.column("survivors"))
            new, _ = chosen_pieces(hashes, offs, window, length)
            at = np.flatnonzero(alive)
            doc = doc_index(offs)[at]
            check = windows(hashes, length, seed=2)
            check = np.concatenate([check, np.zeros(len(hashes) - len(check), np.uint64)])
            place = at - offs[:-1][doc]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc)), batch.column("tkey").take(pa.array(doc)),
                 pa.array(new[at].view(np.int64)), pa.array((check[at] >> np.uint64(33)).astype(np.int32)),
                 pa.array(place.astype(np.int32))],
                ["doc_id", "tkey", "piece", "check", "place"])

    return run


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            texts = texts_of(batch.column("text"))
            starts, ends, offs = texts.words()
            places = batch.column("places")
            at = np.repeat(offs[:-1], places.value_lengths().to_numpy(zero_copy_only=False)) + places.flatten().to_numpy(zero_copy_only=False)
            step = np.zeros(len(starts) + 1, np.int64)
            np.add.at(step, at, 1)
            np.add.at(step, np.minimum(at + window, len(starts)), -1)
            keep = np.cumsum(step[:-1]) == 0
            kept = joined_words(texts, starts, ends, offs, keep)
            gone = np.concatenate([[0], np.cumsum(~keep)])[offs]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tkey"), pa.array(np.diff(gone)),
                 pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                 pa.array([x.decode() for x in kept], pa.string())],
                ["doc_id", "tkey", "n_removed", "sha", "kept_text"])

    return run


def substring_dedup(spark: SparkSession, docs: DataFrame, window: int = 50, start: int = 7,
                    with_text: bool = False) -> DataFrame:
    """Remove words covered by a ``window``-word sequence that also starts in a document with a smaller id.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Returns
    doc_id, n_words, n_removed, kept_sha256 (lowercase hex of the kept words
    joined by one space), and ``kept_text`` if ``with_text`` (null where
    nothing is removed). Windows are judged on the input.

    Defined cases: null and empty texts have no words and keep nothing to
    remove; texts under ``window`` words are untouched; rows with a null id
    neither lose words nor count as an earlier document; repeated rows with
    one id are equals, so neither removes the other; a passage repeated only
    inside one document stays. Columns named like the working columns are
    harmless, since only the two input columns are read. Hashes: 64 bits for
    candidates, 95 for the final comparison.
    """
    prepare(spark)
    lengths = levels(window, start)[:-1] or [window]
    base = docs.select("doc_id", F.col("text").cast("string").alias("text"),
                       F.xxhash64("text").alias("tkey"))
    head = "doc_id long, tkey long, n_words long, seq1 long, seq2 long, sha string"
    runs = "".join(f", runs{length} {RUNS}" for length in lengths)
    first = saved(spark, base.mapInArrow(_first_pass(window, lengths), head + runs), "pieces")
    marks = first.select("doc_id", "tkey", "n_words", "seq1", "seq2", "sha")

    # documents with one word sequence: the smallest id stands for all of them
    key = ["seq1", "seq2", "n_words"]
    owner = (marks.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
             .groupBy(*key).agg(F.min("doc_id").alias("owner")))
    known = marks.join(owner, key, "left")
    stands = (first.where("doc_id is not null").select(*key, "doc_id", "tkey", f"runs{lengths[0]}").join(owner, key)
              .where("doc_id = owner"))

    rows = stands.select("doc_id", "tkey", F.inline(f"runs{lengths[0]}"))
    for length in lengths:
        spans = _repeated(rows, ["piece"]).groupBy("doc_id", "tkey").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
        if length != lengths[-1]:
            longer = lengths[lengths.index(length) + 1]
            level = first.select("doc_id", "tkey", "n_words", F.col(f"runs{longer}").alias("runs")).join(spans, ["doc_id", "tkey"])
            rows = saved(spark, level.mapInArrow(_left_over, "doc_id long, tkey long, piece long, a int, b int"), f"runs{longer}")
    outcome = saved(spark, base.join(spans, ["doc_id", "tkey"]).dropDuplicates(["doc_id", "tkey"]), "candidates")
    last = saved(spark, outcome.mapInArrow(_last_level(window), "doc_id long, tkey long, piece long, check int, places array<int>"), "windows")
    covered = (_repeated(last, ["piece", "check"]).where("lo < doc_id")
               .groupBy("doc_id", "tkey").agg(F.flatten(F.collect_list("places")).alias("places")))
    cut = (outcome.select("doc_id", "tkey", "text").join(covered, ["doc_id", "tkey"])
           .mapInArrow(_remove(window), "doc_id long, tkey long, n_removed long, sha string, kept_text string"))
    if not with_text:
        cut = cut.drop("kept_text")
    cut = cut.withColumnsRenamed({"n_removed": "cut_words", "sha": "cut_sha"})
    copy = F.coalesce(F.col("doc_id") > F.col("owner"), F.lit(False))
    nothing = hashlib.sha256(b"").hexdigest()
    out = known.join(cut, ["doc_id", "tkey"], "left").select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("cut_words", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(nothing)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"),
        *([F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text")] if with_text else []))
    return out
