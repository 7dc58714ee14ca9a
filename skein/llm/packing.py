"""Packing documents into token sequences (operator 8).

Documents are dealt at random (by hash) into groups; each group is packed on
its own by first-fit decreasing, where a tournament tree over the bins' free
room finds the first bin that fits in logarithmic time. Pieces of full
length are sequences of their own. What first-fit leaves open beyond a small
tolerance is filled with cuts from the emptiest bins, and the last open bin of
a group becomes sequences whose lengths are powers of two.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import prepare
from .words import FIRST, Texts, distinct, text_slices, texts_of

GROUP_DOCS, TOLERANCE = 1024, 8
FLUSH_TOKENS = 1 << 22  # a group is packed in parts beyond so many tokens


class TokenIds:
    """Ids of whole texts, one vocabulary look-up a distinct word.

    White space always ends a token of this vocabulary, so a slice's texts are
    cut into words, each distinct word is looked up (and remembered by its
    64-bit hash), and the ids are gathered. Words of ASCII and Latin-1 letters
    are cut by the tokenizer's own pattern and handed to its BPE model; any
    other word goes through the whole tokenizer. Known words are held in
    arrays, some 30 bytes a word, and forgotten beyond ``LIMIT``; known pieces
    in two dictionaries of at most ``PIECES``, where those not asked for while
    the newer one fills are forgotten. The worker process keeps both, so their
    size stays small for whatever it runs next.
    """

    LIMIT, PIECES = 500_000, 1 << 15
    PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
    SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    # Fixed value: the split pattern of the vocabulary, for the simple alphabet.
    PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        # byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes follow from 256 on
        shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in shown]
        self.alphabet = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, np.uint64)  # hashes of the known words, ascending
        self.number = np.empty(0, np.int32)  # the number of each
        self.ids = np.empty(1 << 16, np.uint32)  # of all known words, one after the other
        self.first = np.zeros(self.LIMIT + 1, np.int64)  # limits of each word's ids

    def encode(self, texts: Texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): every text's ids and then ``end_id``; text i has ids[bounds[i]:bounds[i + 1]]."""
        starts, ends, offs = texts.words()
        hashes, one, which = distinct(FIRST.segments(texts.data, starts, ends))
        if len(self.known) + len(hashes) > self.LIMIT:
            self._forget()
            if len(hashes) > self.LIMIT:  # one very long text
                self.first = np.zeros(len(hashes) + 1, np.int64)
        at = np.searchsorted(self.known, hashes)
        met = np.zeros(len(hashes), bool)
        inside = at < len(self.known)
        met[inside] = self.known[at[inside]] == hashes[inside]
        number = np.empty(len(hashes), np.int64)
        number[met] = self.number[at[met]]
        missing = np.flatnonzero(~met)
        if len(missing):
            raw, known = texts.data.tobytes(), len(self.known)
            new = [self._word(raw[a:b].decode()) for a, b in zip(starts[one[missing]].tolist(), ends[one[missing]].tolist(), strict=True)]
            number[missing] = np.arange(known, known + len(new))
            self.known = np.insert(self.known, at[missing], hashes[missing])
            self.number = np.insert(self.number, at[missing], number[missing])
            lengths = np.array([len(x) for x in new], np.int64)
            flat = np.fromiter(chain.from_iterable(new), np.uint32, int(lengths.sum()))
            used = int(self.first[known])
            self.first[known + 1 : known + len(new) + 1] = used + np.cumsum(lengths)
            while used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            self.ids[used : used + len(flat)] = flat
        word = number[which]
        lengths = self.first[word + 1] - self.first[word]
        total = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.ids[np.arange(total[-1]) + np.repeat(self.first[word] - total[:-1], lengths)]
        bounds = total[offs] + np.arange(texts.size + 1)  # each text before has one id more
        out = np.full(len(ids) + texts.size, end_id, "<u4")
        inner = np.ones(len(out), bool)
        inner[bounds[1:] - 1] = False
        out[inner] = ids
        return out, bounds

    def _word(self, word: str) -> tuple[int, ...]:
        plain = self.PLAIN.match(word)
        rest = len(word) - plain.end() if plain else -1
        if rest == 0:
            return self._known(word.lower())
        if rest == 1 and word[-1] in ".,;:!?":  # most words: letters, and perhaps one mark
            return self._known(word[:-1].lower()) + self._known(word[-1])
        if self.SIMPLE.fullmatch(word) and "<|" not in word:
            return tuple(chain.from_iterable([self._known(p) for p in self.PIECE.findall(word.lower())]))
        return tuple(self.full.encode(word, add_special_tokens=False).ids)

    def _known(self, piece: str) -> tuple[int, ...]:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.older.get(piece)
            if ids is None:
                shown = piece if piece.isascii() else "".join([self.alphabet[b] for b in piece.encode()])
                ids = tuple([t.id for t in self.model.tokenize(shown)])
            if len(self.pieces) >= self.PIECES:
                self.older, self.pieces = self.pieces, {}
            self.pieces[piece] = ids
        return ids


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers; every item (at most ``capacity``) goes to the first bin with room, largest first."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    leaves = 1
    while leaves < max(1, len(sizes)):
        leaves *= 2
    room = [capacity] * (2 * leaves)  # of a node: the most room in any bin below it
    bins: list[list[int]] = []
    for i in order:
        size, at = sizes[i], 1
        while at < leaves:
            at = 2 * at if room[2 * at] >= size else 2 * at + 1
        place = at - leaves
        if place == len(bins):
            bins.append([])
        bins[place].append(i)
        room[at] -= size
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
    return bins


def pack_group(lengths: list[int], capacity: int, tolerance: int = TOLERANCE) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length) that hold every token of ``lengths`` once."""
    full: list[list[tuple[int, int, int]]] = []
    items: list[tuple[int, int, int]] = []
    for doc, length in enumerate(lengths):
        whole = length // capacity
        full += [[(doc, k * capacity, capacity)] for k in range(whole)]
        if length % capacity:
            items.append((doc, whole * capacity, length % capacity))
    bins = [[items[i] for i in b] for b in first_fit_decreasing([x[2] for x in items], capacity)]
    room = [capacity - sum(x[2] for x in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda i: (room[i], i))
    low, high = 0, len(order) - 1
    while low < high:
        to, source = order[low], order[high]
        if room[to] <= tolerance:
            low += 1
            continue
        doc, start, length = bins[source].pop()
        taken = min(length, room[to])
        bins[to].append((doc, start, taken))
        room[to] -= taken
        room[source] += taken
        if taken < length:
            bins[source].append((doc, start + taken, length - taken))
        if not bins[source]:
            high -= 1
    out = full
    for b in (bins[i] for i in order[: high + 1]):
        used = sum(x[2] for x in b)
        out += [b] if capacity - used <= tolerance else _powers_of_two(b, used)
    return out


def _powers_of_two(pieces: list[tuple[int, int, int]], used: int) -> list[list[tuple[int, int, int]]]:
    out: list[list[tuple[int, int, int]]] = []
    queue = list(reversed(pieces))
    for bit in reversed(range(used.bit_length())):
        left = used & (1 << bit)
        row: list[tuple[int, int, int]] = []
        while left:
            doc, start, length = queue.pop()
            taken = min(length, left)
            row.append((doc, start, taken))
            left -= taken
            if taken < length:
                queue.append((doc, start + taken, length - taken))
        if row:
            out.append(row)
    return out


_ENCODERS: dict[str, TokenIds] = {}  # one a worker process: the words it has met stay known


def _packed(batches: Iterator[pa.RecordBatch], vocabulary: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = TokenIds(vocabulary)
    encoder = _ENCODERS[vocabulary]
    held: list[tuple[int | None, np.ndarray]] = []
    group, tokens, next_id = None, 0, 0

    def flush() -> pa.RecordBatch:
        nonlocal next_id, tokens, held
        rows: list[tuple] = []
        for sequence in pack_group([len(ids) for _, ids in held], capacity):
            offset = 0
            for doc, start, length in sequence:
                doc_id, ids = held[doc]
                rows.append((doc_id, start, length, zlib.crc32(ids[start : start + length]), len(ids), next_id, offset))
                offset += length
            next_id += 1
        held, tokens = [], 0
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        columns = zip(*rows, strict=True) if rows else [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    for batch in text_slices(batches):
        groups, doc_ids = batch.column("group").to_pylist(), batch.column("doc_id").to_pylist()
        ids, bounds = encoder.encode(texts_of(batch.column("text")), end_id)
        for i, (g, doc_id) in enumerate(zip(groups, doc_ids, strict=True)):
            if held and (g != group or tokens >= FLUSH_TOKENS or len(held) >= 8 * GROUP_DOCS):
                yield flush()
            if g != group:
                group, next_id = g, g << 31
            own = ids[bounds[i] : bounds[i + 1]]
            tokens += len(own)
            held.append((doc_id, own))
    if held:
        yield flush()


def pack(spark: SparkSession, docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """Pieces of every document's ids (its text's, then ``end_id``) placed into sequences of ``capacity``.

    ``docs`` needs doc_id and text. Returns doc_id, start (ids of the document
    before the piece), length, ids_crc32 (of its little-endian unsigned 32-bit
    ids), doc_tokens, sequence_id, offset. ``vocabulary`` is the path of a
    tokenizer file that every executor can read.

    Groups have about 1024 documents and are formed by a hash of id and text,
    so no group grows with the input; a group that repeated rows make large is
    packed in parts. Defined cases: null and empty texts are just ``end_id``;
    rows that repeat an id are packed each for itself; longer documents than
    ``capacity`` fill sequences and leave one piece to pack; an empty table
    gives no pieces. Extra columns are ignored.
    """
    prepare(spark)
    groups = max(1, -(-docs.count() // GROUP_DOCS))
    key = F.xxhash64("doc_id", "text")
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .withColumn("key", key).withColumn("group", F.pmod("key", F.lit(groups))))
    dealt = rows.repartition("group").sortWithinPartitions("group", "key", "doc_id").drop("key")
    return dealt.mapInArrow(lambda it: _packed(it, vocabulary, capacity, end_id),
                            "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
