"""Quality classifier: a linear-chain CRF over lines (operator 1).

Every line is good or bad. Its features are ranges of simple measures of the
line and of both neighbouring lines; transitions tie neighbours. Marginals
from the forward-backward recursion, weighted by line length, make the
document's quality, which a logistic step calibrates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import is_held_out, prepare
from .words import FIRST, Texts, mix, text_slices, texts_of

RANGES = 8
#: Upper limits of the ranges of each measure (a value beyond the last limit is in the last range).
SHARES = [0.0, 0.01, 0.03, 0.08, 0.2, 0.4, 0.7]
LIMITS = {
    "bytes": [0, 10, 30, 80, 200, 500, 1200], "words": [0, 1, 3, 8, 20, 60, 200], "word_bytes": [0, 2, 4, 5, 6, 8, 12],
    "upper": SHARES, "digits": SHARES, "stops": SHARES, "shouts": SHARES, "pipes": SHARES, "signs": SHARES, "other": SHARES,
    "repeats": [0.0, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75], "copies": [0, 1, 2, 3, 5, 10, 20],
}
MEASURES = list(LIMITS)
WIDTH = len(MEASURES) * RANGES


def _is(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_KINDS = {"upper": _is(bytes(range(65, 91))), "digits": _is(b"0123456789"), "stops": _is(b".,;:?"), "shouts": _is(b"!"),
          "pipes": _is(b"|"), "signs": _is(b"#*$%&<>@^~=+\\/_{}[]"), "other": _is(bytes(range(128, 256)))}
KIND_OF = np.zeros(256, np.int64)  # 0: none of them
for _number, _table in enumerate(_KINDS.values(), 1):
    KIND_OF[_table] = _number


def line_ranges(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ranges, bytes, line_offsets): for each line the range of each measure, and its length."""
    begin, end, offs = texts.lines()
    starts, ends, _ = texts.words()
    size = end - begin
    word = np.searchsorted(starts, np.concatenate([begin, end]))
    first, last = word[: len(begin)], word[len(begin) :]
    words = last - first
    letters = np.concatenate([[0], np.cumsum(ends - starts)])
    in_words = letters[last] - letters[first]
    columns = {"bytes": size, "words": words, "word_bytes": in_words / np.maximum(words, 1)}
    # newlines between lines are of no kind, so each byte up to the next line's begin may count
    held = np.diff(np.append(begin, len(texts.data)))
    many = len(_KINDS) + 1
    per_kind = np.bincount(np.repeat(np.arange(len(begin)) * many, held) + KIND_OF[texts.data], minlength=len(begin) * many).reshape(-1, many)
    for number, kind in enumerate(_KINDS, 1):
        columns[kind] = per_kind[:, number] / np.maximum(in_words, 1)
    line_of = np.repeat(np.arange(len(begin)), words)
    key = np.sort(mix(FIRST.segments(texts.data, starts, ends) + mix(line_of.astype(np.uint64))) >> np.uint64(24) | (line_of.astype(np.uint64) << np.uint64(40)))
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[fresh] >> np.uint64(40)).astype(np.int64), minlength=len(begin))
    columns["repeats"] = 1 - distinct / np.maximum(words, 1)
    columns["repeats"][words == 0] = 0
    doc = np.repeat(np.arange(texts.size), np.diff(offs))
    same = mix(FIRST.segments(texts.data, begin, end) + mix(doc.astype(np.uint64)))
    _, which, count = np.unique(same, return_inverse=True, return_counts=True)
    columns["copies"] = count[which] - 1
    out = np.stack([np.searchsorted(LIMITS[m], columns[m], "left") for m in MEASURES], 1)
    return out.astype(np.uint8), size, offs


@dataclass
class Crf:
    own: np.ndarray  # WIDTH weights for "good" of the line's own ranges
    before: np.ndarray
    after: np.ndarray
    edge: np.ndarray  # no line before, no line after
    chain: np.ndarray  # 2 x 2
    slope: float = 1.0
    shift: float = 0.0


def _neighbours(offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """True where a line has one before (after) in its document."""
    before, after = np.ones(offs[-1], bool), np.ones(offs[-1], bool)
    before[offs[:-1]] = False
    after[offs[1:] - 1] = False
    return before, after


def emissions(crf: Crf, ranges: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Score for "good" of every line."""
    at = ranges + np.arange(len(MEASURES)) * RANGES
    before, after = _neighbours(offs)
    back, ahead = crf.before[at].sum(1), crf.after[at].sum(1)
    out = crf.own[at].sum(1) + crf.edge[0] * ~before + crf.edge[1] * ~after
    out[1:] += np.where(before[1:], back[:-1], 0)
    out[:-1] += np.where(after[:-1], ahead[1:], 0)
    return out


def forward_backward(good: np.ndarray, offs: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(marginals of "good", expected transitions 2 x 2, log partition of each document); all documents advance together."""
    lengths = np.diff(offs)
    order = np.argsort(-lengths, kind="stable")
    lengths, first = lengths[order], offs[:-1][order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), "left")
    score = np.stack([np.zeros(len(good)), good], 1)
    ahead, back = np.zeros((len(good), 2)), np.zeros((len(good), 2))
    for t in range(steps):
        at = first[: active[t]] + t
        ahead[at] = score[at] + (np.logaddexp(ahead[at - 1, 0, None] + chain[0], ahead[at - 1, 1, None] + chain[1]) if t else 0)
    for t in reversed(range(steps - 1)):
        at = first[: active[t + 1]] + t
        follows = back[at + 1] + score[at + 1]
        back[at] = np.logaddexp(follows[:, 0, None] + chain[:, 0], follows[:, 1, None] + chain[:, 1])
    last = offs[1:] - 1
    whole = np.logaddexp(ahead[last, 0], ahead[last, 1])
    per_line = np.repeat(whole, np.diff(offs))
    marginal = np.exp(ahead[:, 1] + back[:, 1] - per_line)
    _, after = _neighbours(offs)
    at = np.flatnonzero(after)
    joint = np.exp(ahead[at][:, :, None] + chain + (back[at + 1] + score[at + 1])[:, None, :] - per_line[at][:, None, None])
    return marginal, joint.sum(0), whole


def document_scores(crf: Crf, ranges: np.ndarray, size: np.ndarray, offs: np.ndarray) -> np.ndarray:
    marginal, _, _ = forward_backward(emissions(crf, ranges, offs), offs, crf.chain)
    weight = np.maximum(size, 1)
    mean = np.add.reduceat(marginal * weight, offs[:-1]) / np.add.reduceat(weight, offs[:-1]) if len(offs) > 1 else np.zeros(0)
    mean = np.clip(mean, 1e-6, 1 - 1e-6)
    return 1 / (1 + np.exp(-(crf.slope * np.log(mean / (1 - mean)) + crf.shift)))


def fit(ranges: np.ndarray, size: np.ndarray, offs: np.ndarray, quality: np.ndarray, rounds: int = 150, ridge: float = 2e-3) -> Crf:
    """Maximum conditional likelihood (a document's label holds for its lines), by Adam; then the logistic step."""
    count = max(1, len(size))
    label = np.repeat(quality, np.diff(offs)).astype(float)
    before, after = _neighbours(offs)
    at = ranges + np.arange(len(MEASURES)) * RANGES
    theta = np.zeros(3 * WIDTH + 2 + 4)
    cuts = np.cumsum([WIDTH, WIDTH, WIDTH, 2])

    def unpack(x: np.ndarray) -> Crf:
        own, back, ahead, edge, chain = np.split(x, cuts)
        return Crf(own, back, ahead, edge, chain.reshape(2, 2))

    def spread(delta: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.bincount(at[rows].ravel(), np.repeat(delta, at.shape[1]), WIDTH)

    seen = np.zeros((2, 2))
    inner = np.flatnonzero(after)
    np.add.at(seen, (label[inner].astype(int), label[inner + 1].astype(int)), 1)
    everything, has_before, has_after = np.arange(len(size)), np.flatnonzero(before), np.flatnonzero(after)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        crf = unpack(theta)
        marginal, joint, _ = forward_backward(emissions(crf, ranges, offs), offs, crf.chain)
        delta = label - marginal
        gradient = np.concatenate([spread(delta, everything), spread(delta[has_before], has_before - 1), spread(delta[has_after], has_after + 1),
                                   [delta[~before].sum(), delta[~after].sum()], (seen - joint).ravel()]) / count - ridge * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    crf = unpack(theta)
    raw = document_scores(crf, ranges, size, offs)
    x = np.log(np.clip(raw, 1e-6, 1 - 1e-6) / np.clip(1 - raw, 1e-6, 1 - 1e-6))
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton's method, with a little shrinkage
        p = 1 / (1 + np.exp(-(slope * x + shift)))
        w = p * (1 - p) + 1e-6
        g = np.array([((quality - p) * x).sum() - (slope - 1) * 1.0, (quality - p).sum() - shift * 0.1])
        h = np.array([[(w * x * x).sum() + 1.0, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        move = np.clip(np.linalg.solve(h, g), -1, 1)
        slope, shift = max(0.05, slope + move[0]), shift + move[1]
    crf.slope, crf.shift = float(slope), float(shift)
    return crf


def _training(batches: Iterator[pa.RecordBatch], most_lines: int) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches):
        ranges, size, offs = line_ranges(texts_of(batch.column("text")))
        rows = [(i, ranges[offs[i] : offs[i + 1]].tobytes(), size[offs[i] : offs[i + 1]].astype("<i4").tobytes()) for i in range(len(offs) - 1)
                if offs[i + 1] - offs[i] <= most_lines]
        at = pa.array([r[0] for r in rows], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("quality").take(at), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())],
                                         ["quality", "ranges", "sizes"])


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = 4000, most_lines: int = 400) -> Crf:
    """Fit on at most ``sample`` labelled documents (the first by hash of the id) of at most ``most_lines`` lines each."""
    key = F.xxhash64(F.col("doc_id"), F.lit(3))
    chosen = (labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
              .orderBy(key, "doc_id").limit(sample))
    rows = (docs.join(F.broadcast(chosen), "doc_id").select("text", F.col("quality").cast("int").alias("quality"))  # at most `sample` rows
            .mapInArrow(lambda it: _training(it, most_lines), "quality int, ranges binary, sizes binary")
            .orderBy("quality", "sizes", "ranges").limit(2 * sample).collect())
    if len({r["quality"] for r in rows}) < 2:
        only = float(rows[0]["quality"]) if rows else 0.5
        flat = np.zeros(WIDTH)
        return Crf(flat, flat, flat, np.zeros(2), np.zeros((2, 2)), 1.0, 4 * (2 * only - 1))
    ranges = np.concatenate([np.frombuffer(r["ranges"], np.uint8).reshape(-1, len(MEASURES)) for r in rows])
    sizes = [np.frombuffer(r["sizes"], "<i4").astype(np.int64) for r in rows]
    offs = np.concatenate([[0], np.cumsum([len(s) for s in sizes])])
    return fit(ranges, np.concatenate(sizes), offs, np.array([float(r["quality"] > 0) for r in rows]))


def _scored(model, with_lines: bool, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf: Crf = model.value
        for batch in text_slices(batches):
            ranges, size, offs = line_ranges(texts_of(batch.column("text")))
            columns = {n: batch.column(n) for n in batch.schema.names if n != "text" or with_text}
            columns["score"] = pa.array(document_scores(crf, ranges, size, offs))
            if with_lines:
                marginal, _, _ = forward_backward(emissions(crf, ranges, offs), offs, crf.chain)
                columns["line_scores"] = pa.ListArray.from_arrays(pa.array(offs, pa.int32()), pa.array(marginal))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def score_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, fold: int = 4, held_out: int = 2,
                  threshold: float = 0.7, sample: int = 4000, with_lines: bool = False,
                  carry: list[str] | None = None) -> DataFrame:
    """Quality of every document, learnt from labelled rows outside the held-out fold.

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality (1 good, 0
    bad). Returns doc_id, held_out (crc32 of the id as text modulo ``fold`` is
    ``held_out``), score, predicted (1 if score >= ``threshold``); with
    ``with_lines`` also line_scores, the marginal of "good" of each line; and
    the input columns named in ``carry`` (where a name clashes with the
    operator's own, the input's is carried). The score depends on the text
    alone. The fit uses at most ``sample``
    labelled documents; scores cover every whole text.

    Defined cases: null and empty texts are one empty line and scored so; a
    null id is not held out and not learnt from; an id labelled twice counts
    as its larger label; with no labels, or of one class only, the score is
    the same for all (0.5 without any). Extra columns are ignored.
    """
    prepare(spark)
    carry = [c for c in carry or [] if c != "doc_id"]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    known = labels.select("doc_id", "quality").where(~is_held_out("doc_id", fold, held_out))
    model = spark.sparkContext.broadcast(train(spark, rows, known, sample))
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"), *(F.col(f"`{c}`").alias(f"in_{c}") for c in carry if c != "text"))
    kept = source if "text" in carry else source.drop("text")
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])
    if with_lines:
        schema.add("line_scores", T.ArrayType(T.DoubleType()))
    scored = source.mapInArrow(_scored(model, with_lines, "text" in carry), schema)
    own = {"held_out": is_held_out("doc_id", fold, held_out), "score": F.col("score"), "predicted": (F.col("score") >= threshold).cast("int")}
    if with_lines:
        own["line_scores"] = F.col("line_scores")
    return scored.select("doc_id", *(v.alias(k) for k, v in own.items() if k not in carry),
                         *((F.col("text") if c == "text" else F.col(f"`in_{c}`")).alias(c) for c in carry))
