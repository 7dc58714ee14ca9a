"""Periodic run detection (operator 13): Re-Pair, runs across each nonterminal's boundary once, merged in the text.

A slice of documents is compressed together, but a word counts as another
symbol in every document, so no rule spans two of them. Rounds of Re-Pair
replace pairs that come twice or more, the more frequent first. What is left
of a document is joined by a balanced tree whose nodes occur once.

A run lies across the boundary of the lowest node that contains it. Each
rule's boundary is looked at once, where the rule first occurs: a period is
the distance from a boundary word to one of its other occurrences, and how far
it holds to both sides is found by comparing hashes of doubling stretches.
The runs found are shifted to all places where the rule was used, and
intervals of one period that overlap by the period or more are merged.
Stretches are compared by hash; every run is then checked word by word.

Texts without six consecutive words that come twice have no run (a run's first
six words come again one period later) and are not compressed.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import prepare
from .words import SEPARATOR, _powers, doc_index, mix, text_slices, texts_of, windows

LEAST = 12  # words of the shortest run
CANDIDATES = 1 << 20  # periods tried at once
BASES = (0x5851F42D4C957F2D, 0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


@dataclass
class Nodes:
    """Boundaries to look at: a node's first word, its boundary, its end (word numbers of one occurrence), and the occurrences of its rule."""

    low: np.ndarray
    middle: np.ndarray
    high: np.ndarray
    rule: np.ndarray  # number of its rule, -1 of a tree node
    used_at: np.ndarray  # all places where rules were used, by rule
    used: np.ndarray  # first place of each rule in used_at


def _ranges(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value) of all ``starts[i] ... starts[i] + counts[i] - 1``."""
    owner = np.repeat(np.arange(len(starts)), counts)
    first = np.cumsum(counts) - counts
    return owner, np.arange(len(owner)) - first[owner] + starts[owner]


def grammar(symbols: np.ndarray, offsets: np.ndarray) -> Nodes:
    """Re-Pair of ``symbols`` (no symbol in two documents), and a balanced tree over what is left of each document.

    In a round, a pair wins its place if it comes more often than the pairs
    that overlap it there (of equals, the one with the smaller number); of
    overlapping equal pairs every second wins. All winners of a pair become
    one new symbol. Rounds go on while a pair comes twice.
    """
    n = len(symbols)
    seq, pos = symbols.astype(np.int64), np.arange(n)
    fresh, spans, places, rules = (int(seq.max()) + 1 if n else 0), [], [], 0
    while len(seq) > 1:
        size = np.diff(np.append(pos, n))
        uses = np.bincount(seq, minlength=fresh) > 1
        at = np.flatnonzero(uses[seq[:-1]] & uses[seq[1:]])  # pairs of symbols that each come twice
        key = seq[at] * fresh + seq[at + 1]
        pair, which, count = np.unique(key, return_inverse=True, return_counts=True)
        at, which = at[count[which] > 1], which[count[which] > 1]
        if not len(at):
            break
        rank = np.empty(len(pair), np.int64)
        rank[np.lexsort((np.arange(len(pair)), -count))] = np.arange(len(pair))  # 0: the most frequent
        best = np.full(len(seq) + 1, len(pair))
        best[at + 1] = rank[which]  # of the pair that starts one before
        mine, before = best[1:], best[:-1]
        same_start = np.flatnonzero((mine != before) & (mine < len(pair)))
        group = np.searchsorted(same_start, at, "right") - 1
        even = (at - same_start[group]) % 2 == 0
        after = np.append(mine[1:], len(pair))
        # a stretch of equal overlapping pairs competes as a whole at its two ends
        wins = even & (mine[at] <= before[at]) & (mine[at] <= after[at])
        ends = at[wins]
        won = which[wins]
        rule, number = np.unique(won, return_inverse=True)
        order = np.argsort(number, kind="stable")
        first = np.flatnonzero(np.diff(number[order], prepend=-1))
        spans.append(np.stack([pos[ends[order[first]]], pos[ends[order[first]] + 1], pos[ends[order[first]] + 1] + size[ends[order[first]] + 1]]))
        places.append((pos[ends[order]], number[order] + rules))
        seq[ends] = number + fresh
        keep = np.ones(len(seq), bool)
        keep[ends + 1] = False
        seq, pos = seq[keep], pos[keep]
        fresh, rules = fresh + len(rule), rules + len(rule)
        if fresh > 1 << 31:
            seq, fresh = _renumbered(seq)
    used_at = np.concatenate([np.zeros(0, np.int64), *[p[0] for p in places]])
    by_rule = np.concatenate([np.zeros(0, np.int64), *[p[1] for p in places]])
    used = np.searchsorted(by_rule, np.arange(rules + 1))
    low, middle, high = np.concatenate([np.zeros((3, 0), np.int64), *spans], axis=1)

    # what is left: symbol number j of a document ends at a node of 2 * (lowest set bit of j) symbols around it
    starts = np.searchsorted(pos, offsets)
    own = doc_index(starts)
    j = np.arange(len(pos)) - starts[own]
    inner = np.flatnonzero(j > 0)
    j, begin, end, bit = j[inner], starts[own[inner]], starts[own[inner] + 1], j[inner] & -j[inner]
    limits = np.append(pos, n)
    tree = (limits[begin + j - bit], limits[begin + j], limits[np.minimum(begin + j + bit, end)])
    rule = np.concatenate([np.arange(rules), np.full(len(inner), -1)])
    return Nodes(*(np.concatenate(x) for x in zip((low, middle, high), tree, strict=True)), rule, used_at, used)


def _renumbered(seq: np.ndarray) -> tuple[np.ndarray, int]:
    known, out = np.unique(seq, return_inverse=True)
    return out, len(known)


class Stretches:
    """How far two places of a symbol sequence agree, forwards and backwards."""

    def __init__(self, symbols: np.ndarray, base: int):
        self.power = _powers(base, len(symbols) + 1)
        value = mix(symbols.astype(np.uint64) + np.uint64(base))
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * self.power[: len(symbols)], dtype=np.uint64)])

    def same(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """``length`` symbols from a and from b (a <= b) agree."""
        return (self.total[a + length] - self.total[a]) * self.power[b - a] == self.total[b + length] - self.total[b]

    def agree(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """Symbols that agree from a and b on (or before a and b), ``most`` at most."""
        out = np.zeros(len(a), np.int64)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step:
            fits = np.flatnonzero(out + step <= most)
            shift = -out[fits] - step if back else out[fits]
            ok = self.same(a[fits] + shift, b[fits] + shift, np.full(len(fits), step))
            out[fits[ok]] += step
            step >>= 1
        return out


def _crossing(symbols: np.ndarray, nodes: Nodes, pick: np.ndarray, base: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(node, start, end, period) of runs across the boundaries of the nodes ``pick``, inside their own words."""
    by_symbol = np.argsort(symbols, kind="stable")
    n = len(symbols)
    place = np.empty(n, np.int64)
    place[by_symbol] = np.arange(n)
    ranked = symbols[by_symbol] * n + by_symbol
    stretches = Stretches(symbols, base)
    out = [np.zeros((4, 0), np.int64)]
    for right in (True, False):
        low, middle, high = nodes.low[pick], nodes.middle[pick], nodes.high[pick]
        furthest = (high - low) // 2
        if right:  # the run holds a whole period after the boundary: its last word before comes again
            at = middle - 1
            last = np.searchsorted(ranked, symbols[at] * n + np.minimum(at + furthest, high - 1), "right")
            first, count = place[at] + 1, last - place[at] - 1
        else:  # a whole period before: the first word after has come before
            at = middle
            first = np.searchsorted(ranked, symbols[at] * n + np.maximum(at - furthest, low))
            count = place[at] - first
        order = np.cumsum(count)
        done = 0
        while done < len(pick):
            upto = max(done + 1, int(np.searchsorted(order, (order[done - 1] if done else 0) + CANDIDATES, "right")))
            owner, where = _ranges(first[done:upto], count[done:upto])
            owner += done
            other = by_symbol[where]
            done = upto
            q = np.abs(other - at[owner])
            b, lo, hi = middle[owner], low[owner], high[owner]
            a = b if right else b - q  # compared with q words on
            # six neighbouring words agree at this distance, so one more does next to the boundary's
            forth = (a + q < hi) & (symbols[np.minimum(a, n - 1)] == symbols[np.minimum(a + q, n - 1)])
            back = (a - 1 >= lo) & (symbols[a - 1] == symbols[a - 1 + q])
            second = np.where(right, (a - 2 >= lo) & (symbols[a - 2] == symbols[a - 2 + q]), (a + 1 + q < hi) & (symbols[np.minimum(a + 1, n - 1)] == symbols[np.minimum(a + 1 + q, n - 1)]))
            ok = np.flatnonzero(forth & back | second)
            owner, a, q, lo, hi = owner[ok], a[ok], q[ok], lo[ok], hi[ok]
            more = stretches.agree(a, a + q, hi - a - q)
            less = stretches.agree(a, a + q, a - lo, back=True)
            start, end = a - less, a + q + more
            ok = np.flatnonzero(end - start >= np.maximum(2 * q, least))
            out.append(np.stack([pick[owner[ok]], start[ok], end[ok], q[ok]]))
    return tuple(np.concatenate(out, axis=1))


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal intervals: one period's overlapping by the period or more become one; of equal intervals the smallest period stays."""
    if not len(start):
        return start, end, period
    order = np.lexsort((end, start, period))
    start, end, period = start[order], end[order], period[order]
    # running maximum of ends inside each period: periods are lifted apart by more than any end
    lift = np.cumsum(np.diff(period, prepend=period[:1]) != 0) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift) - lift
    new = np.ones(len(start), bool)
    new[1:] = (period[1:] != period[:-1]) | (start[1:] > reach[:-1] - period[1:])
    first = np.flatnonzero(new)
    start, period = start[first], period[first]
    end = reach[np.append(first[1:], len(reach)) - 1]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    only = np.ones(len(start), bool)
    only[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[only], end[only], period[only]


def runs(symbols: np.ndarray, offsets: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of the documents in ``symbols``, by start, then end.

    Document i has the symbols ``offsets[i]`` to ``offsets[i + 1]``; no symbol
    may be in two documents. A run is a stretch with smallest period q, of
    max(``least``, 2 * q) words at least, that cannot be extended.
    """
    nodes = grammar(symbols, offsets)
    pick = np.flatnonzero(nodes.high - nodes.low >= least)
    for base in BASES:
        node, start, end, period = _crossing(symbols, nodes, pick, base, least)
        rule = nodes.rule[node]
        lone, shared = np.flatnonzero(rule < 0), np.flatnonzero(rule >= 0)
        first, count = nodes.used[rule[shared]], np.diff(nodes.used)[rule[shared]]
        owner, use = _ranges(first, count)
        owner = shared[owner]
        shift = nodes.used_at[use] - nodes.low[node[owner]]
        every = (np.concatenate([start[lone], start[owner] + shift]), np.concatenate([end[lone], end[owner] + shift]), np.concatenate([period[lone], period[owner]]))
        found = _merged(*every)
        if all((symbols[a : b - q] == symbols[a + q : b]).all() for a, b, q in zip(*(x.tolist() for x in found), strict=True)):
            return found
    raise RuntimeError("no base tells the stretches apart")


def _bent(word: np.ndarray, h: int) -> np.ndarray:
    """The words of a document that the query makes periodic (h: crc32 of its id): every word from a on becomes word a + (i - a) % p."""
    g, n = h // 10, len(word)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return word[at]


def _found(batches: Iterator[pa.RecordBatch], least: int, bend: bool) -> Iterator[pa.RecordBatch]:
    need = (least + 1) // 2  # words of a run that come again one period later, at least
    for batch in text_slices(batches, max_bytes=1 << 21):
        texts = texts_of(batch.column("text"))
        starts, ends, offs = texts.words()
        inside = ~SEPARATOR[texts.data]
        limits = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(limits), pa.py_buffer(texts.data[inside])])
        coded = words.dictionary_encode()
        word, distinct = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        doc_ids = batch.column("doc_id").to_pylist()
        if bend:
            word = word.copy()
            for i, doc_id in enumerate(doc_ids):
                h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
                if h % 10 == 0 and offs[i + 1] > offs[i]:
                    word[offs[i] : offs[i + 1]] = _bent(word[offs[i] : offs[i + 1]], h)
        n_words = np.diff(offs)
        by_doc = _runs_of(word, offs, len(distinct), need, least)
        yield _rows(batch.column("doc_id"), doc_ids, word, offs, n_words, distinct, by_doc)


def _runs_of(word: np.ndarray, offs: np.ndarray, known: int, need: int, least: int) -> dict[int, list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each document that has some, by start, then period."""
    doc = doc_index(offs)
    symbol = doc * known + word
    gram = windows(mix(symbol.astype(np.uint64)), need)
    inner = doc[: len(gram)] == doc[need - 1 :] if len(gram) else np.zeros(0, bool)
    gram, of = gram[inner], doc[: len(gram)][inner]
    order = np.argsort(gram)
    again = gram[order[1:]] == gram[order[:-1]]
    suspects = np.unique(of[order[1:]][again])
    if not len(suspects):
        return {}
    _, at = _ranges(offs[suspects], np.diff(offs)[suspects])
    _, symbols = np.unique(symbol[at], return_inverse=True)
    own = np.concatenate([[0], np.cumsum(np.diff(offs)[suspects])])
    start, end, period = runs(symbols, own, least)
    of = np.searchsorted(own, start, "right") - 1
    out: dict[int, list[tuple[int, int, int]]] = {}
    for d, a, length, q in zip(suspects[of].tolist(), (start - own[of]).tolist(), (end - start).tolist(), period.tolist(), strict=True):
        out.setdefault(d, []).append((a, length, q))
    for found in out.values():
        found.sort(key=lambda r: (r[0], r[2]))
    return out


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli"]


def _rows(doc_id: pa.Array, doc_ids: list, word: np.ndarray, offs: np.ndarray, n_words: np.ndarray, distinct: pa.Array, by_doc: dict) -> pa.RecordBatch:
    rows, digests, collapsed, kept_n = [], [], [], []
    nothing = hashlib.sha256(b"").hexdigest()
    text = distinct.to_pylist()
    for i in range(len(doc_ids)):
        found, own = by_doc.get(i, []), word[offs[i] : offs[i + 1]]
        if found:
            a, length, q = min(found, key=lambda r: (-r[1], r[0], r[2]))
            rows.append((len(found), a, length, q, 1000 * length // q))
            digests.append(hashlib.sha256("".join([f"{s},{m},{p}\n" for s, m, p in found]).encode()).hexdigest())
            change = np.zeros(len(own) + 1, np.int64)
            for s, m, p in found:
                change[s + p] += 1
                change[s + m] -= 1
            own = own[np.cumsum(change[:-1]) == 0]
        else:
            rows.append((0, None, None, None, None))
            digests.append(nothing)
        kept_n.append(len(own))
        collapsed.append(hashlib.sha256(b" ".join([text[w] for w in own.tolist()])).hexdigest())
    arrays = [doc_id, *(pa.array(c, pa.int64()) for c in zip(*rows, strict=True)), pa.array(digests), pa.array(collapsed), pa.array(n_words, pa.int64()), pa.array(kept_n, pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", *COLUMNS, "runs_sha256", "collapsed_sha256", "n_words", "n_kept"])


def period_runs(spark: SparkSession, docs: DataFrame, least: int = LEAST, bend: bool = False) -> DataFrame:
    """Periodic stretches of words of every text.

    ``docs`` needs doc_id and text. A run is a stretch of consecutive words
    whose smallest period is q, of max(``least``, 2 * q) words or more, that no
    neighbouring word extends; a word is dropped if a run holds it after that
    run's first q words. Returns doc_id, n_runs; start, length, period and
    exponent_milli of the longest run (of equals the first, then the smallest
    period; null without a run); runs_sha256 (of all runs' lines
    ``start,length,period``), collapsed_sha256 (of the words kept, joined by
    one space), n_words, n_kept. ``bend`` first makes about a tenth of the
    documents periodic, by their ids, as the query asks.

    Documents are looked at one by one inside their task, without a shuffle;
    memory follows the longest text (some 200 bytes a word of it).

    Defined cases: null, empty and blank texts have no words, no run and the
    digests of nothing; repeated rows and ids are rows each; a null id is never
    bent; an empty table gives no rows; extra columns are ignored.
    """
    prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_words long, n_kept long"
    return rows.mapInArrow(lambda it: _found(it, least, bend), schema)
