"""Scoring documents by cross-entropy difference of two n-gram models (operator 7).

Target and background models have one form and one vocabulary, every word of
all texts. A word's probability after the word before is its pair's count, with
``prior`` further occurrences of the word before followed as words occur in
general. So both are proper distributions over the same words and the end of a
text, and pairs count for more as texts grow.

Nothing of the models is held in one place: they grow with the texts. Blocks of
texts ask for their distinct words and pairs, with their own counts, in hash
parts; a part adds up what all blocks sent it and answers each block with the
whole counts in the order it asked. The block then scores its texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .groups import whole_groups
from .store import prepare, saved
from .words import FIRST, Texts, distinct, mix, per_doc, text_slices, texts_of

BLOCK_BYTES, PART_BYTES, LEAST_PARTS = 16 << 20, 16 << 20, 64  # bytes of text in a block, and behind a part's counts
TOKENS = 1 << 18  # tokens scored at once
HASHED = 1 << 20  # bytes of text hashed at once
START = np.uint64(0x9E3779B97F4A7C15)  # stands before a text's first word
TEXT, PLACES = -2, -1  # the parts of a block's own row and of the row with the places of its target texts
BLOCK = "block long, part int, bytes long, ids array<long>, packed binary"
ASKED = "part int, block long, n_words long, n_pairs long, words binary, pairs binary, n binary, n_target binary"
ANSWER = "block long, part int, packed binary, n_words long, n_pairs long, n binary, n_target binary, vocabulary long, total long, total_target long"


def squeezed(numbers: np.ndarray) -> bytes:
    """64-bit numbers, their first bytes together, then their second ones, and so on, compressed."""
    return pa.compress(numbers.view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True) if len(numbers) else b""


def unsqueezed(packed: pa.Scalar, size: int) -> np.ndarray:
    if not size:
        return np.zeros(0, np.int64)
    raw = pa.decompress(packed.as_buffer(), 8 * size, "zstd")
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, size).T).view(np.int64).ravel()


def squeezed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys, as differences."""
    return squeezed(np.diff(keys, prepend=np.uint64(0)))


def unsqueezed_keys(packed: pa.Scalar, size: int) -> np.ndarray:
    return np.cumsum(unsqueezed(packed, size).view(np.uint64), dtype=np.uint64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a block: its doc_id and text, compressed."""
    number = TaskContext.get().partitionId() << 32
    for batch in text_slices(batches, max_bytes=BLOCK_BYTES, max_rows=1 << 20):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 9))) as writer:
            writer.write_batch(batch)
        size = int(texts_of(batch.column("text")).offsets[-1])
        ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("doc_id"))
        yield pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([TEXT], pa.int32()), pa.array([size]), ids, pa.array([sink.getvalue().to_pybytes()], pa.binary())],
            ["block", "part", "bytes", "ids", "packed"])
        number += 1


def _opened(block: pa.Table) -> tuple[pa.RecordBatch, np.ndarray, pa.Table]:
    """(texts, which of them are target texts, the other rows) of a block's rows, its own first."""
    rows = pa.ipc.open_stream(block.column("packed")[0].as_buffer()).read_next_batch()
    chosen, rest = np.zeros(rows.num_rows, bool), block.slice(1)
    if rest.num_rows and rest.column("part")[0].as_py() == PLACES:
        chosen[np.array(rest.column("places")[0].as_py(), np.int64)] = True
        rest = rest.slice(1)
    return rows, chosen, rest


@dataclass
class Grams:
    """Distinct words and pairs of a block, both ascending; START is a word, once for each text with words."""

    words: np.ndarray
    word: np.ndarray  # of each token, then START of each text with words
    pairs: np.ndarray
    pair: np.ndarray  # of each token
    before: np.ndarray  # which word stands before each token
    offsets: np.ndarray  # tokens of each text


def token_hashes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each token, tokens of each text), about HASHED bytes of text at a time: only the hashes stay."""
    hashes, offs, i = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)], 0
    while i < texts.size:
        j = min(max(i + 1, int(np.searchsorted(texts.offsets, texts.offsets[i] + HASHED, "right")) - 1), texts.size)
        some = Texts(texts.data[texts.offsets[i] : texts.offsets[j]], texts.offsets[i : j + 1] - texts.offsets[i])
        starts, ends, bounds = some.words()
        hashes.append(FIRST.segments(some.data, starts, ends))
        offs.append(bounds[1:] + offs[-1][-1])
        i = j
    return np.concatenate(hashes), np.concatenate(offs)


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, ascending; which one each key is), as ``distinct``, with less held at once."""
    order = np.argsort(keys)
    ranked = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    known = ranked[fresh]
    del ranked
    kind = np.int32 if len(known) < 1 << 31 else np.int64
    which = np.empty(len(keys), kind)
    which[order] = np.cumsum(fresh, dtype=kind)
    which -= 1
    return known, which


def grams(texts: Texts) -> Grams:
    hashes, offs = token_hashes(texts)
    first, tokens = offs[:-1][np.diff(offs) > 0], len(hashes)
    words, word = _numbered(np.concatenate([hashes, np.full(len(first), START)]))
    before = np.concatenate([word[:1], word[:tokens][:-1]])
    before[first] = word[tokens:]
    hashes += words[before] * np.uint64(31)
    pairs, pair = _numbered(mix(hashes))
    return Grams(words, word, pairs, pair, before, offs)


def part_limits(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part of the ascending ``keys`` begins, and the end of the last."""
    limits = np.array([(p << 64) // parts for p in range(parts)], np.uint64)
    return np.append(np.searchsorted(keys, limits), len(keys))


def _asked(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["block"]):
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                rows, chosen, _ = _opened(table.slice(a, b - a))
                g = grams(texts_of(rows.column("text")))
                count = np.diff(g.offsets)
                target = np.concatenate([np.repeat(chosen, count), chosen[count > 0]])
                counts = [[np.bincount(x[target[: len(x)]] if k else x, minlength=len(keys)) for x, keys in ((g.word, g.words), (g.pair, g.pairs))] for k in (0, 1)]
                w, p = part_limits(g.words, parts), part_limits(g.pairs, parts)
                # every part is asked, even for nothing, as its answer also holds its share of the totals
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(parts, dtype=np.int32)), pa.array(np.full(parts, table.column("block")[a].as_py())),
                     pa.array(np.diff(w)), pa.array(np.diff(p)),
                     *(pa.array([squeezed_keys(x[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary()) for x, at in ((g.words, w), (g.pairs, p))),
                     *(pa.array([squeezed(np.concatenate([c[0][w[i] : w[i + 1]], c[1][p[i] : p[i + 1]]])) for i in range(parts)], pa.binary()) for c in counts)],
                    ["part", "block", "n_words", "n_pairs", "words", "pairs", "n", "n_target"])

    return run


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, bounds in whole_groups(batches, ["part"]):
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            rows = table.slice(a, b - a)
            n_words, n_pairs = (rows.column(c).to_pylist() for c in ("n_words", "n_pairs"))
            known, _, word = distinct(np.concatenate([unsqueezed_keys(x, k) for x, k in zip(rows.column("words"), n_words, strict=True)]))
            some, _, pair = distinct(np.concatenate([unsqueezed_keys(x, k) for x, k in zip(rows.column("pairs"), n_pairs, strict=True)]))
            w, p = np.cumsum([0, *n_words]), np.cumsum([0, *n_pairs])
            blobs, totals = [], [int((known != START).sum())]
            for column in ("n", "n_target"):
                own = [unsqueezed(x, i + j) for x, i, j in zip(rows.column(column), n_words, n_pairs, strict=True)]
                # the sums pass through doubles, exact up to 2 ** 53
                of_words = np.bincount(word, np.concatenate([x[:i] for x, i in zip(own, n_words, strict=True)]), len(known)).astype(np.int64)
                of_pairs = np.bincount(pair, np.concatenate([x[i:] for x, i in zip(own, n_words, strict=True)]), len(some)).astype(np.int64)
                totals.append(int(of_words[known != START].sum()))
                blobs.append([squeezed(np.concatenate([of_words[word[w[i] : w[i + 1]]], of_pairs[pair[p[i] : p[i + 1]]]])) for i in range(b - a)])
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c).combine_chunks() for c in ("block", "part")), pa.nulls(b - a, pa.binary()), pa.array(n_words, pa.int64()), pa.array(n_pairs, pa.int64()),
                 *(pa.array(x, pa.binary()) for x in blobs), *(pa.array(np.full(b - a, x, np.int64)) for x in totals)],
                [x.split()[0] for x in ANSWER.split(", ")])


def _own(key: np.ndarray, text: np.ndarray, kinds: int) -> np.ndarray:
    """How often each item's key comes in the item's own text."""
    _, which, n = np.unique(text * kinds + key, return_inverse=True, return_counts=True)
    return n[which]


@dataclass
class OwnCounts:
    """What each token's own text holds: of the token, of the word before, of the pair; and the text's tokens."""

    word: np.ndarray
    before: np.ndarray
    pair: np.ndarray
    tokens: np.ndarray

    @classmethod
    def of(cls, g: Grams) -> OwnCounts:
        count, n = np.diff(g.offsets), len(g.pair)
        text = np.repeat(np.arange(len(count)), count)
        word = _own(g.word[:n], text, len(g.words)) if n else np.zeros(0, np.int64)
        before = np.concatenate([word[:1], word[:-1]])
        before[g.offsets[:-1][count > 0]] = 1  # START
        return cls(word, before, _own(g.pair, text, len(g.pairs)) if n else word, count[text])


@dataclass
class Counts:
    """What one model holds of each token of some texts, each text's own counts taken out where the text is part of the model."""

    word: np.ndarray
    before: np.ndarray
    pair: np.ndarray
    total: np.ndarray

    @classmethod
    def without(cls, own: OwnCounts, counted: np.ndarray | bool, g: Grams, words: np.ndarray, pairs: np.ndarray, total: int) -> Counts:
        whole = (words[g.word[: len(g.pair)]], words[g.before], pairs[g.pair], np.full(len(g.pair), total))
        return cls(*(x - np.where(counted, y, 0) for x, y in zip(whole, (own.word, own.before, own.pair, own.tokens), strict=True)))


def log_probabilities(model: Counts, vocabulary: int, prior: float) -> np.ndarray:
    """Of each token: its pair's count and ``prior`` times the word's share, where words have half a count added."""
    single = (model.word + 0.5) / (model.total + 0.5 * vocabulary)
    return np.log((model.pair + prior * single) / (model.before + prior))


def _some_texts(g: Grams) -> Iterator[tuple[Grams, int, int]]:
    """The texts of a block in runs of about TOKENS tokens: (grams of the run, its first text, the text after its last)."""
    texts, i = len(g.offsets) - 1, 0
    while i < texts:
        j = min(max(i + 1, int(np.searchsorted(g.offsets, g.offsets[i] + TOKENS, "right")) - 1), texts)
        a, b = g.offsets[i], g.offsets[j]
        yield Grams(g.words, g.word[a:b], g.pairs, g.pair[a:b], g.before[a:b], g.offsets[i : j + 1] - a), i, j
        i = j


def _losses(g: Grams, sums: list[tuple], chosen: np.ndarray, vocabulary: int, prior: float) -> list[np.ndarray]:
    """Losses of some texts under the target model and the background model."""
    own, count = OwnCounts.of(g), np.diff(g.offsets)
    out = []
    for (words, pairs, total), counted in zip(sums, (np.repeat(chosen, count), True), strict=True):
        model = Counts.without(own, counted, g, words, pairs, total)
        out.append(-per_doc(log_probabilities(model, vocabulary, prior), g.offsets) / np.maximum(count, 1))
    return out


def _scored(prior: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["block"]):
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                rows, chosen, answers = _opened(table.slice(a, b - a))
                g = grams(texts_of(rows.column("text")))
                count = np.diff(g.offsets)
                n_words, n_pairs = (answers.column(c).to_pylist() for c in ("n_words", "n_pairs"))
                vocabulary = sum(answers.column("vocabulary").to_pylist())
                sums = []
                for name, whole in (("n_target", "total_target"), ("n", "total")):
                    own = [unsqueezed(x, i + j) for x, i, j in zip(answers.column(name), n_words, n_pairs, strict=True)]
                    words, pairs = (np.concatenate(x) for x in zip(*((x[:i], x[i:]) for x, i in zip(own, n_words, strict=True)), strict=True))
                    sums.append((words, pairs, sum(answers.column(whole).to_pylist())))
                del own
                parts = [_losses(x, sums, chosen[i:j], vocabulary, prior) for x, i, j in _some_texts(g)]
                losses = [np.concatenate([np.zeros(0), *x]) for x in zip(*parts, strict=True)] if parts else [np.zeros(0)] * 2
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(count.astype(np.int64)), *(pa.array(x) for x in losses), pa.array(losses[1] - losses[0])],
                                                 ["doc_id", "n_tokens", "loss_target", "loss_background", "score"])

    return run


def cross_entropy_difference(spark: SparkSession, docs: DataFrame, targets: DataFrame, prior: float = 100000.0) -> DataFrame:
    """Loss of every document under the background model less its loss under the target model, per token.

    ``docs`` needs doc_id and text; ``targets`` holds the doc_id of target
    documents. The background model is counted on all documents, the target
    model on the target documents' whole texts, both over every word and pair
    of words. Returns doc_id, n_tokens, loss_target, loss_background, score
    (higher: more like the target).

    Defined cases: null, empty and wordless texts have 0 tokens and losses
    and score 0; null target ids are ignored and repeated ones count once;
    rows that repeat a target id are all target texts; without target
    documents the target model is the uniform start of its counts. Extra
    columns are ignored.
    """
    prepare(spark)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    blocks = saved(spark, rows.mapInArrow(_blocks, BLOCK), "text-blocks")
    size, n = blocks.agg(F.sum("bytes"), F.count("*")).first()
    parts = max(LEAST_PARTS, -(-(size or 0) // PART_BYTES))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n)  # a named number of tasks is not coalesced: a task holds few blocks
    chosen = targets.select("doc_id").where("doc_id is not null").distinct()
    places = (blocks.select("block", F.posexplode("ids").alias("place", "doc_id")).join(chosen.hint("merge"), "doc_id")
              .groupBy("block").agg(F.collect_list("place").alias("places")))
    text = blocks.select("block", "part", "packed")
    marked = text.unionByName(places.withColumn("part", F.lit(PLACES)), allowMissingColumns=True)
    answers = (marked.repartition(tasks, "block").sortWithinPartitions("block", "part").mapInArrow(_asked(parts), ASKED)
               .repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_answers, ANSWER))
    return (marked.unionByName(answers, allowMissingColumns=True).repartition(tasks, "block").sortWithinPartitions("block", "part")
            .mapInArrow(_scored(prior), "doc_id long, n_tokens long, loss_target double, loss_background double, score double"))
