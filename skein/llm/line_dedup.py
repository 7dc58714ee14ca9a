"""Line dedup over content-defined chunks of lines (operator 4).

A rolling hash is taken over the hashes of every two neighbouring lines that
have a word (blank lines between them belong to the stretch). It is counted
over the corpus, and a text is cut where it meets one that has not occurred
before: chunks are the stretches between such cuts, two lines long or more.
The cuts depend on the two lines alone, so lines inserted or deleted elsewhere
move none of them. A chunk's lines go, the first occurrence (smallest doc_id,
then place) stays. Equal hashes are not trusted: every stretch that one made a
candidate is compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import prepare, saved
from .words import SEPARATOR, Texts, mix, text_slices, texts_of


def stretches(texts: Texts) -> tuple[np.ndarray, ...]:
    """(first line, last line, document, start, end, hash) of every two neighbouring lines with a word.

    Lines are numbered over the slice; start and end are bytes, without the last newline.
    """
    starts, ends, offs = texts.lines()
    words = np.concatenate([[0], np.cumsum(~SEPARATOR[texts.data])])
    full = np.flatnonzero(words[ends] > words[starts])
    raw = texts.data.tobytes()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(starts[full].tolist(), ends[full].tolist(), strict=True)), np.uint64, len(full))
    doc = np.searchsorted(offs, full, "right") - 1
    at = np.flatnonzero(doc[1:] == doc[:-1])
    gap = np.ones(len(at), np.uint64)  # a newline, or blank lines
    blank = np.flatnonzero(full[at + 1] > full[at] + 1)
    gap[blank] = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(ends[full[at[blank]]].tolist(), starts[full[at[blank] + 1]].tolist(), strict=True)), np.uint64, len(blank))
    rolled = mix(hashes[at] * np.uint64(0x9E3779B97F4A7C15) + hashes[at + 1] + mix(gap))
    return full[at], full[at + 1], doc[at], starts[full[at]], ends[full[at + 1]], rolled.view(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Smallest doc_id and number of occurrences of each hash in a slice of texts."""
    none = np.iinfo(np.int64).max
    for batch in text_slices(batches, "t"):
        *_, doc, _, _, hashes = stretches(texts_of(batch.column("t")))
        if not len(hashes):
            continue
        ids = batch.column("i").fill_null(none).to_numpy()[doc]
        order = np.argsort(hashes)
        first = np.flatnonzero(np.diff(hashes[order], prepend=hashes[order[:1]] - 1))
        low = np.minimum.reduceat(ids[order], first)
        n = np.diff(np.append(first, len(order)))
        yield pa.RecordBatch.from_arrays([pa.array(hashes[order][first]), pa.array(low, mask=low == none), pa.array(n)], ["hash", "lo", "n"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every stretch: its text's key, its number in the text, and whether it came before in that text."""
    for batch in text_slices(batches, "t"):
        texts = texts_of(batch.column("t"))
        first, _, doc, _, _, hashes = stretches(texts)
        number = np.arange(len(doc)) - np.searchsorted(doc, np.arange(texts.size))[doc]
        order = np.lexsort([number, hashes, doc])
        again = np.zeros(len(doc), bool)
        again[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
        owner = pa.array(doc)
        yield pa.RecordBatch.from_arrays([batch.column("i").take(owner), batch.column("k").take(owner), pa.array(hashes),
                                          pa.array(number.astype(np.int32)), pa.array(again)], ["i", "k", "hash", "number", "again"])


def _picked(batch: pa.RecordBatch, doc: np.ndarray) -> np.ndarray:
    """Places, among the stretches of a slice, of those whose numbers the rows list."""
    numbers = batch.column("numbers").fill_null([])
    counts = numbers.value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(np.searchsorted(doc, np.arange(batch.num_rows)), counts) + numbers.flatten().to_numpy(zero_copy_only=False)


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the stretches that the rows list, each once a slice."""
    for batch in text_slices(batches, "t"):
        texts = texts_of(batch.column("t"))
        *_, doc, start, end, hashes = stretches(texts)
        raw, at = texts.data.tobytes(), _picked(batch, doc)
        found = {(h, raw[a:b]) for h, a, b in zip(hashes[at].tolist(), start[at].tolist(), end[at].tolist(), strict=True)}
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in found], pa.int64()), pa.array([x for _, x in found], pa.binary())], ["hash", "chunk"])


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines of the stretches that the rows list."""
    for batch in text_slices(batches, "t"):
        texts = texts_of(batch.column("t"))
        first, last, doc, *_ = stretches(texts)
        starts, ends, offs = texts.lines()
        at = _picked(batch, doc)
        change = np.zeros(len(starts) + 1, np.int64)
        np.add.at(change, first[at], 1)
        np.add.at(change, last[at] + 1, -1)
        stays = np.cumsum(change[:-1]) == 0
        raw, absent = texts.data.tobytes(), np.asarray(batch.column("t").is_null())
        cut = np.add.reduceat(~stays, offs[:-1]) if batch.num_rows else np.zeros(0, np.int64)
        kept = []
        for doc_no, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
            if not cut[doc_no]:
                kept.append(raw[starts[a] : ends[b - 1]].decode())
                continue
            kept.append(b"\n".join([raw[starts[j] : ends[j]] for j in (a + np.flatnonzero(stays[a:b])).tolist()]).decode())
        columns = [batch.column("d"), pa.array(kept, pa.string(), mask=absent), pa.array(np.where(absent, 0, np.diff(offs))), pa.array(cut.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["d", "t", "n_lines", "n_removed"])


def line_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Documents without the stretches of two or more lines that occur earlier, all columns kept, plus n_lines and n_removed (lines).

    ``docs`` needs ``doc_id`` and ``text``; other columns come through
    unchanged, whatever their names, but for n_lines and n_removed, which are
    replaced. Every line of a run of two or more lines with words that also
    stands in a document with a smaller id, or earlier in its own, is removed,
    and with it the blank lines inside the run. The other lines keep their
    order and their newlines.

    Defined cases: a null text stays null, with 0 lines; an empty text is one
    empty line; a line alone is never removed, however often it comes; a null
    id is no earlier occurrence for others, and its text loses only what came
    before in that text; of rows with the same id, each keeps its first; an
    empty table stays empty. Where different stretches share a 64-bit hash,
    all of them stay.
    """
    prepare(spark)
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    field = lambda c: F.col("`" + c.replace("`", "``") + "`")
    text = F.col("text").cast("string")
    others = F.struct(F.lit(0).alias("of"), *[field(c).alias(c) for c in names if c != "text"])  # never empty, one column whatever the names
    base = docs.select(F.col("doc_id").cast("long").alias("i"), F.xxhash64(text).alias("k"), text.alias("t"), others.alias("d"))
    thin = base.select("i", "k", "t")
    counted = thin.mapInArrow(_counted, "hash long, lo long, n long").groupBy("hash").agg(F.min("lo").alias("lo"), F.sum("n").alias("n"))
    repeated = saved(spark, counted.where("n > 1").select("hash", "lo"), "line-hashes")
    places = thin.mapInArrow(_placed, "i long, k long, hash long, number int, again boolean").hint("merge")
    found = saved(spark, places.join(repeated, "hash").where("again or coalesce(i > lo, false) or i = lo")
                  .select("i", "k", "hash", "number", (F.col("again") | F.coalesce(F.col("i") > F.col("lo"), F.lit(False))).alias("later")), "line-places")

    def listed(of: DataFrame) -> DataFrame:
        lists = of.groupBy("i", "k").agg(F.collect_set("number").alias("numbers")).select(F.col("i").alias("of_i"), F.col("k").alias("of_k"), "numbers")
        same = F.col("i").eqNullSafe(F.col("of_i")) & F.col("k").eqNullSafe(F.col("of_k"))
        return base.join(lists.hint("merge"), same, "left").select("d", "t", "numbers")

    shown = listed(found).where("numbers is not null").select("t", "numbers").mapInArrow(_bytes, "hash long, chunk binary")
    unlike = shown.groupBy("hash", "chunk").agg(F.lit(1).alias("one")).groupBy("hash").agg(F.count("*").alias("texts")).where("texts > 1").select("hash")
    unlike = saved(spark, unlike, "unlike-chunks")
    late = found.where("later").join(unlike, "hash", "left_anti")
    schema = base.select("d", "t").schema.add("n_lines", "long").add("n_removed", "long")
    out = listed(late).mapInArrow(_rewritten, schema)
    return out.select(*[F.col("t").alias("text") if c == "text" else F.col("d")[c].alias(c) for c in names], "n_lines", "n_removed")

