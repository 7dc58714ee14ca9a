"""Words, lines and their hashes over Arrow text columns, in numpy.

Every operator that walks whole texts inside a task uses these helpers. A
text column is looked at as its UTF-8 byte buffer; a word is a maximal run of
bytes other than ``0x20`` and ``0x09-0x0D`` (the same words as the pattern
``[^\\x20\\x09-\\x0D]+`` finds, since those bytes never occur inside a longer
UTF-8 sequence). Null texts have no words. Work is cut into slices of about
``max_bytes`` so that memory follows the slice (or the one longest text), not
the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
NEWLINE = ord("\n")

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


#: keeps the first n bytes of a little-endian 8-byte load
_FIRST_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


@dataclass(frozen=True)
class Hasher:
    """Hash of byte segments, 8 bytes at a time; two of them give 128 independent bits."""

    seed: int

    def segments(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of ``data[starts[i]:ends[i]]`` for each i."""
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(data) + 1,), np.uint64, padded, strides=(1,))
        lengths = ends - starts
        out = mix(lengths.astype(np.uint64) * _GOLDEN + np.uint64(self.seed))
        out = self._absorb(out, eight[starts] & _FIRST_BYTES[np.minimum(lengths, 8)])
        todo, done = np.flatnonzero(lengths > 8), 8
        while len(todo):
            left = lengths[todo] - done
            out[todo] = self._absorb(out[todo], eight[starts[todo] + done] & _FIRST_BYTES[np.minimum(left, 8)])
            done += 8
            todo = todo[left > 8]
        return mix(out)

    @staticmethod
    def _absorb(state: np.ndarray, part: np.ndarray) -> np.ndarray:
        state = (state ^ (part * _GOLDEN)) * np.uint64(0xD1342543DE82EF95)
        return state ^ (state >> np.uint64(31))


FIRST, SECOND = Hasher(11), Hasher(29)


@dataclass
class Texts:
    """The texts of one slice: bytes, document offsets, and word bounds."""

    data: np.ndarray  # uint8
    offsets: np.ndarray  # int64, one more than documents

    @property
    def size(self) -> int:
        return len(self.offsets) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, word_offsets): byte bounds of words, and each document's first word."""
        n = len(self.data)
        inside = ~SEPARATOR[self.data]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        edge = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        begins[edge] |= inside[edge]
        stops[edge - 1] |= inside[edge - 1]
        starts = np.flatnonzero(begins)
        return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, self.offsets)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, line_offsets): ``\\n``-split lines; a text has one line more than newlines, an empty or null one a single empty line."""
        breaks = np.flatnonzero(self.data == NEWLINE)
        per_doc = np.searchsorted(breaks, self.offsets)
        counts = np.diff(per_doc) + 1
        line_offsets = np.concatenate([[0], np.cumsum(counts)])
        starts = np.empty(line_offsets[-1], np.int64)
        ends = np.empty(line_offsets[-1], np.int64)
        is_first = np.zeros(line_offsets[-1], bool)
        is_first[line_offsets[:-1]] = True
        is_last = np.zeros(line_offsets[-1], bool)
        is_last[line_offsets[1:] - 1] = True
        starts[is_first] = self.offsets[:-1]
        starts[~is_first] = breaks + 1
        ends[is_last] = self.offsets[1:]
        ends[~is_last] = breaks
        return starts, ends, line_offsets


def texts_of(column: pa.Array) -> Texts:
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(raw[off[0] : off[-1]], off - off[0])


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 1 << 20,
                max_rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each piece holds about ``max_bytes`` of text (one text may be longer)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(lengths.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + max_bytes, "right")))
            end = min(end, at + max_rows, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values, a place of each, which one each place has)."""
    order = np.argsort(values)
    ranked = values[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = ranked[1:] != ranked[:-1]
    which = np.empty(len(values), np.int64)
    which[order] = np.cumsum(fresh) - 1
    return ranked[fresh], order[fresh], which


def windows(hashes: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Hash of every ``width`` consecutive items (shorter input: none)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = _powers(0x5851F42D4C957F2D + 2 * seed, len(hashes))
    # inverse-free rolling sum: differences of prefix sums share the factor base**i, removed by its inverse
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * base, dtype=np.uint64)])
    inverse = _powers(pow(0x5851F42D4C957F2D + 2 * seed, -1, 1 << 64), len(hashes))
    return mix((total[width:] - total[:-width]) * inverse[:n])


def window_starts(word_offsets: np.ndarray, width: int) -> np.ndarray:
    """True for each item that starts a whole window inside its own document."""
    n = int(word_offsets[-1])
    ok = np.ones(n, bool)
    ends = word_offsets[1:]
    for back in range(1, width):
        at = ends - back
        at = at[at >= np.maximum(word_offsets[:-1], 0)]
        ok[at] = False
    return ok


def doc_index(word_offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(word_offsets) - 1), np.diff(word_offsets))


def per_doc(values: np.ndarray, word_offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each document's items."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[word_offsets[1:]] - total[word_offsets[:-1]]
