"""Quality rules with an n-gram perplexity band (operator 5).

A modified Kneser-Ney model of bytes is counted by Spark over all texts: a byte
is predicted from the three before it, each of the 256 told from every other,
and the model holds every n-gram met. It is spread over parts by the two bytes
before the predicted one, so all longer n-grams that back off to each other
share a part, of at most ``65536`` n-grams for each two bytes; shorter ones
(``65536`` at most) and the counts of counts are the same for all parts. Blocks
of texts send the parts their n-grams with counts; a part adds them up, looks
them up in its sorted hash arrays of all orders, where what was not counted
backs off to shorter n-grams, and answers each block, which then scores its
texts. Documents outside the band of log perplexity of their language and
length are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .groups import whole_groups
from .lm_scoring import squeezed, squeezed_keys, unsqueezed, unsqueezed_keys
from .store import prepare, saved
from .words import FIRST, Texts, doc_index, mix, per_doc, text_slices, texts_of, window_starts, windows

ORDER = 4
PARTS = 256
BLOCK_BYTES = 16 << 20
PART_OF = (mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(PARTS)).astype(np.int32)  # by the two bytes before the predicted one
IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(b"#*$%&|<>")] = True
BLOCK = "block long, part int, packed binary, n_keys long, keys binary, n binary"
ANSWER = "block long, part int, packed binary, n_keys long, keys binary, logs binary"


class Symbols(NamedTuple):
    """Bits of a predicted and of a remembered symbol in the key of an n-gram."""

    shown: int
    past: int


SMALL, BYTES = Symbols(6, 5), Symbols(8, 8)


def ngram_keys(texts: Texts) -> np.ndarray:
    """Key of the n-gram that ends at each byte: that byte, and above it those before, the nearest first. Before a text lies white space."""
    data = texts.data.astype(np.uint32)
    keys, n = data.copy(), len(data)
    for back in range(1, ORDER):
        past = np.full(n, ord(" "), np.uint32)
        past[back:] = data[: max(n - back, 0)]
        for k in range(back):
            at = texts.offsets[:-1] + k
            past[at[at < np.minimum(texts.offsets[1:], n)]] = ord(" ")
        keys |= past << np.uint32(8 * back)
    return keys


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys, ascending; the sum of each one's counts; which one each key is)."""
    known, which = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_inverse=True)
    # the sums pass through doubles, exact up to 2 ** 53
    return known, np.bincount(which, np.concatenate([np.zeros(0), *counts]), len(known)).astype(np.int64), which


def _block(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """A block's texts, compressed, and for each part the block's n-grams with their counts."""
    rows = pa.Table.from_batches(held).combine_chunks()
    counted = [np.unique(ngram_keys(texts_of(x.column("text"))), return_counts=True) for x in text_slices(rows.to_batches())]
    keys, n, _ = _added([k.astype(np.int64) for k, _ in counted], [c for _, c in counted])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as writer:
        writer.write_table(rows)
    part = PART_OF[keys >> 8 & 0xFFFF]
    order = np.argsort(part, kind="stable")
    some, begin = np.unique(part[order], return_index=True)
    runs = np.split(order, begin[1:]) if len(some) else []
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(some) + 1, number)), pa.array([-1, *some.tolist()], pa.int32()),
         pa.array([sink.getvalue().to_pybytes(), *[None] * len(some)], pa.binary()), pa.array([0, *map(len, runs)], pa.int64()),
         pa.array([None, *(squeezed_keys(keys[x].astype(np.uint64)) for x in runs)], pa.binary()), pa.array([None, *(squeezed(n[x]) for x in runs)], pa.binary())],
        [x.split()[0] for x in BLOCK.split(", ")])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, held, size = TaskContext.get().partitionId() << 32, [], 0
    for batch in text_slices(batches, max_bytes=BLOCK_BYTES >> 2, max_rows=1 << 20):
        held.append(batch)
        size += int(texts_of(batch.column("text")).offsets[-1])
        if size >= BLOCK_BYTES:
            yield _block(number, held)
            number, held, size = number + 1, [], 0
    if held:
        yield _block(number, held)


def _of_part(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the n-grams of a part, their counts, which one each n-gram of each block is)."""
    sizes = rows.column("n_keys").to_pylist()
    keys = [unsqueezed_keys(x, k).astype(np.int64) for x, k in zip(rows.column("keys"), sizes, strict=True)]
    return _added(keys, [unsqueezed(x, k) for x, k in zip(rows.column("n"), sizes, strict=True)])


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What all parts must know of each: how often two symbols follow different ones, and how many longer n-grams count 1, 2, 3 and 4."""
    for table, bounds in whole_groups(batches, ["part"]):
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            keys, n, _ = _of_part(table.slice(a, b - a))
            three, n_three = np.unique(_history(keys, 3, BYTES), return_counts=True)
            two, n_two = np.unique(_history(three, 2, BYTES), return_counts=True)
            few = np.arange(1, 5)
            kinds = [np.full(len(two), 2), np.full(4, 3), np.full(4, 4)]
            out = [kinds, [two, few, few], [n_two, *(np.array([(c == k).sum() for k in few]) for c in (n_three, n))]]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in out], ["kind", "key", "n"])


@dataclass
class HashArrays:
    """Sorted hashes of the n-grams of all orders and, in the same order, their probabilities;
    the same for contexts and the mass they leave to shorter n-grams."""

    hashes: np.ndarray
    probabilities: np.ndarray
    contexts: np.ndarray
    spare: np.ndarray
    symbols: Symbols = SMALL

    @classmethod
    def of(cls, orders: list[Order], symbols: Symbols = SMALL) -> HashArrays:
        def arranged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            hashes = np.concatenate([_hashed(k, order) for order, (k, _) in enumerate(parts, 1)])
            order = np.argsort(hashes)
            return hashes[order], np.concatenate([v for _, v in parts]).astype(np.float32)[order]

        return cls(*arranged([(o.keys, o.probabilities) for o in orders]), *arranged([(o.contexts, o.spare) for o in orders]), symbols)

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """Log probability of each n-gram; one that was not counted backs off to its shorter ones, at last to all symbols alike."""
        left, weight = np.arange(len(keys)), np.ones(len(keys))
        out = np.zeros(len(keys))
        for order in range(ORDER, 0, -1):
            own = _history(keys[left], order, self.symbols)
            value, found = _find(self.hashes, self.probabilities, _hashed(own, order))
            out[left[found]] = weight[left[found]] * value[found]
            left, own = left[~found], own[~found]
            spare, known = _find(self.contexts, self.spare, _hashed(own >> self.symbols.shown, order))
            weight[left] *= np.where(known, spare, 1.0)
        out[left] = weight[left] / (1 << self.symbols.shown)
        return np.log(out).astype(np.float32)


def _hashed(keys: np.ndarray, order: int) -> np.ndarray:
    return mix(keys.astype(np.uint64) * np.uint64(8) + np.uint64(order))


def _find(hashes: np.ndarray, values: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, found) of each hash asked for."""
    if not len(hashes):
        return np.zeros(len(asked)), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(hashes, asked), len(hashes) - 1)
    return values[at], hashes[at] == asked


@dataclass
class Order:
    """The n-grams of one length with their probabilities, and their contexts with the mass left over."""

    keys: np.ndarray
    probabilities: np.ndarray
    contexts: np.ndarray
    spare: np.ndarray


def _history(keys: np.ndarray, order: int, symbols: Symbols = SMALL) -> np.ndarray:
    """Keys of the same n-grams cut to ``order`` symbols."""
    return keys & ((1 << (symbols.shown + symbols.past * (order - 1))) - 1)


def _cuts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """What is taken off a count of 0, 1, 2 and 3 or more, by how many n-grams have each count."""
    y = n1 / max(1.0, n1 + 2.0 * n2)
    return np.array([0.0, *(min(0.95 * (i + 1), max(0.1, d)) for i, d in enumerate(
        (1 - 2 * y * n2 / max(1, n1), 2 - 3 * y * n3 / max(1, n2), 3 - 4 * y * n4 / max(1, n3))))])


def _order(own: np.ndarray, n: np.ndarray, cut: np.ndarray, lower: np.ndarray, symbols: Symbols) -> Order:
    """The n-grams ``own`` with counts ``n``, where ``lower`` is the probability of each one's shorter n-gram."""
    discount = np.minimum(cut[np.minimum(n, 3).astype(int)], n)
    context, which = np.unique(own >> symbols.shown, return_inverse=True)
    whole = np.bincount(which, n, len(context))
    spare = np.bincount(which, discount, len(context)) / whole
    return Order(own, (n - discount) / whole[which] + spare[which] * lower, context, spare)


def kneser_ney_orders(keys: np.ndarray, counts: np.ndarray, symbols: Symbols = SMALL, longest: int = ORDER) -> list[Order]:
    """Interpolated modified Kneser-Ney estimates of every seen n-gram of 1 to ``longest`` symbols (``keys`` sorted)."""
    tables = {longest: (keys, counts.astype(np.float64))}
    longer = keys
    for order in range(longest - 1, 0, -1):  # continuation counts: different symbols before
        longer, n = np.unique(_history(longer, order, symbols), return_counts=True)
        tables[order] = (longer, n.astype(np.float64))
    below_keys, below = np.arange(1 << symbols.shown), np.full(1 << symbols.shown, 1 / (1 << symbols.shown))
    out = []
    for order in range(1, longest + 1):
        own, n = tables[order]
        lower = below[np.searchsorted(below_keys, _history(own, order - 1, symbols) if order > 1 else own)]
        out.append(_order(own, n, _cuts(*((n == c).sum() for c in (1, 2, 3, 4))), lower, symbols))
        below_keys, below = own, out[-1].probabilities
    return out


def kneser_ney(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, probability) of every seen n-gram of the full length."""
    last = kneser_ney_orders(keys, counts)[-1]
    return last.keys, last.probabilities


class Shared(NamedTuple):
    """The n-grams of one and two symbols, and what is taken off the counts of longer ones."""

    orders: list[Order]
    cuts: dict[int, np.ndarray]


def shared_orders(parts: DataFrame) -> Shared:
    """At most 65,544 sums come to the driver."""
    found = parts.mapInArrow(_summary, "kind long, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")).toPandas().sort_values(["kind", "key"])
    two = found[found["kind"] == 2]
    cuts = {order: _cuts(*(found[found["kind"] == order]["n"].tolist() or [0] * 4)) for order in (3, 4)}
    return Shared(kneser_ney_orders(two["key"].to_numpy(np.int64), two["n"].to_numpy(np.int64), BYTES, 2), cuts)


def part_logs(keys: np.ndarray, counts: np.ndarray, shared: Shared) -> np.ndarray:
    """Log probability of each n-gram of a part."""
    one, two = shared.orders
    short, n = np.unique(_history(keys, 3, BYTES), return_counts=True)
    three = _order(short, n, shared.cuts[3], two.probabilities[np.searchsorted(two.keys, _history(short, 2, BYTES))], BYTES)
    four = _order(keys, counts, shared.cuts[4], three.probabilities[np.searchsorted(short, _history(keys, 3, BYTES))], BYTES)
    return HashArrays.of([one, two, three, four], BYTES).look_up(keys)


def _answers(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["part"]):
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                rows = table.slice(a, b - a)
                keys, n, which = _of_part(rows)
                logs = part_logs(keys, n, shared.value)[which]
                ends = np.cumsum(rows.column("n_keys").to_numpy())
                blobs = [x.tobytes() for x in np.split(logs, ends[:-1])]
                yield pa.RecordBatch.from_arrays([*(rows.column(c).combine_chunks() for c in ("block", "part")), pa.nulls(b - a, pa.binary()),
                                                  *(rows.column(c).combine_chunks() for c in ("n_keys", "keys")), pa.array(blobs, pa.binary())],
                                                 [x.split()[0] for x in ANSWER.split(", ")])

    return run


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each document."""
    starts, ends, offs = texts.words()
    data, docs = texts.data, texts.size
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    symbols = np.concatenate([[0], np.cumsum(IS_SYMBOL[data])])
    hashes = FIRST.segments(data, starts, ends)

    at = np.flatnonzero(window_starts(offs, 3))
    doc = doc_index(offs)
    three = mix(windows(hashes, 3)[at] + mix(doc[at].astype(np.uint64)))
    order = np.argsort(three)
    same = three[order[1:]] == three[order[:-1]]
    often = np.zeros(len(at), bool)
    often[order[1:]] |= same
    often[order[:-1]] |= same
    covered = np.zeros(len(starts) + 3, bool)
    for k in range(3):
        covered[at[often] + k] = True

    begin, end, line_offs = texts.lines()
    in_words = np.concatenate([[0], np.cumsum(np.bincount(starts, minlength=len(data)))]) if len(data) else np.zeros(1, int)
    # a line has a word if one starts in it: line ends are separators, so no word reaches over them
    some = np.flatnonzero(in_words[end] > in_words[begin])
    owner = np.searchsorted(line_offs, some, "right") - 1
    line = mix(FIRST.segments(data, begin[some], end[some]) + mix(owner.astype(np.uint64)))
    _, first = np.unique(line, return_index=True)
    again = np.ones(len(some), bool)
    again[first] = False
    return {
        "n_words": np.diff(offs),
        "word_chars": per_doc(points[ends] - points[starts], offs),
        "n_symbols": symbols[texts.offsets[1:]] - symbols[texts.offsets[:-1]],
        "n_dup_lines": np.bincount(owner[again], minlength=docs),
        "n_repeat_words": per_doc(covered[: len(starts)], offs),
    }


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, bounds in whole_groups(batches, ["block"]):
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            answers = table.slice(a + 1, b - a - 1)  # the block's own row comes first
            known = np.concatenate([np.zeros(0, np.uint64), *(unsqueezed_keys(x, k) for x, k in zip(answers.column("keys"), answers.column("n_keys").to_pylist(), strict=True))]).astype(np.uint32)
            values = np.frombuffer(b"".join(answers.column("logs").to_pylist()), np.float32)
            order = np.argsort(known)
            known, values = known[order], values[order]
            for batch in text_slices(pa.ipc.open_stream(table.column("packed")[a].as_buffer())):
                texts = texts_of(batch.column("text"))
                logs = values[np.searchsorted(known, ngram_keys(texts))]
                total = np.concatenate([[0.0], np.cumsum(logs, dtype=np.float64)])
                size = np.diff(texts.offsets)
                loss = -(total[texts.offsets[1:]] - total[texts.offsets[:-1]]) / np.maximum(size, 1)
                base = base_counts(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("lang"), pa.array(np.frexp(size.astype(np.float64))[1].astype(np.int32)), *(pa.array(v.astype(np.int64)) for v in base.values()), pa.array(loss, mask=size == 0)],
                    ["doc_id", "lang", "length", *base, "log_perplexity"])


def perplexities(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, lang, length class, base counts and log_perplexity of every document."""
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    blocks = saved(spark, rows.mapInArrow(_blocks, BLOCK), "ngram-blocks")
    asked = blocks.where("part >= 0").select("block", "part", "n_keys", "keys", "n").repartition(PARTS, "part").sortWithinPartitions("part")
    shared = spark.sparkContext.broadcast(shared_orders(asked))
    texts = blocks.where("part < 0").select("block", "part", "packed")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), texts.count())
    return (texts.unionByName(asked.mapInArrow(_answers(shared), ANSWER), allowMissingColumns=True)
            .repartition(tasks, "block").sortWithinPartitions("block", "part")
            .mapInArrow(_scored, "doc_id long, lang string, length int, n_words long, word_chars long, n_symbols long, "
                        "n_dup_lines long, n_repeat_words long, log_perplexity double"))


def quality_rules(spark: SparkSession, docs: DataFrame, spread: float = 1.75, least: int = 64) -> DataFrame:
    """Base counts, base verdict and perplexity verdict of every document.

    ``docs`` needs doc_id, text and lang. Returns doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, log_perplexity
    (mean loss a byte, null for empty texts), lower and upper (the band of its
    language and length: bytes to the next power of two, since the mean of a
    short text varies more). A band reaches ``spread`` interquartile ranges beyond
    the quartiles of those of its documents that pass the base rules; fewer than
    ``least`` such documents take the quartiles of their whole language.

    On the labelled documents of sf0.1 that pass the base rules, bands reject of
    bad and good ones: spread 1.25 58 % and 1.4 %, 1.5 54 % and 0.5 %, 1.75 48 %
    and 0.2 %, 2 42 % and 0.2 %, 3 25 % and none.

    Defined cases: null and empty texts have no words and fail the base rules;
    a null language has bands of its own; a language and length none of whose
    documents passes has no band, which only documents that failed anyway notice; rows
    that repeat are counted each. Extra columns are ignored.
    """
    scored = saved(spark, perplexities(spark, docs), "perplexities")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = scored.withColumn("base_failed", failed)
    passed, quartiles = scored.where("not base_failed"), F.percentile_approx("log_perplexity", [0.25, 0.75], 10000)
    whole = passed.groupBy("lang").agg(quartiles.alias("all_q")).withColumnRenamed("lang", "band")
    own = passed.groupBy("lang", "length").agg(quartiles.alias("own_q"), F.count("*").alias("n")).toDF("of", "of_length", "own_q", "n")
    q = F.when(F.col("n") >= least, F.col("own_q")).otherwise(F.col("all_q"))
    reach = spread * (q[1] - q[0])
    bands = (whole.join(own, F.col("band").eqNullSafe(F.col("of")))
             .select("band", F.col("of_length").alias("band_length"), (q[0] - reach).alias("lower"), (q[1] + reach).alias("upper")))
    inside = F.coalesce(F.col("log_perplexity").between(F.col("lower"), F.col("upper")), F.lit(False))
    return (scored.join(bands, F.col("lang").eqNullSafe(F.col("band")) & (F.col("length") == F.col("band_length")), "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & inside).alias("kept"), "log_perplexity", "lower", "upper"))
