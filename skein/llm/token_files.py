"""Token ids in binary files (operator 12): frequency-ranked, byte-aligned variable-length coding.

Every id of the corpus is counted, and an id is written as its rank by
frequency, so the commonest 256 ids take one byte. Lengths stand apart from
the bytes: a control byte holds the lengths (less one) of four numbers in two
bits each, its numbers' little-endian bytes follow in a stream of their own.
Reading is a table look-up: the control byte gives four lengths, their running
sum the places, and a mask by length cuts each number out of a 4-byte load.

A folder of token files has ``ranks`` (one file: the ids in rank order, in the
same coding) and ``shards``: documents in ascending doc_id order, about two
million ids a shard. All numbers in a shard's head are little-endian:

    4s magic, u4 partition, u8 ids before in the partition, u4 documents, u8 ids, u4 crc32 of the rest,
    i8 doc_id a document, u1 has-an-id a document, coded ids a document, coded ranks

Files go through Spark's own text committer (one record a file, so each file
ends with one newline) and come back through ``binaryFile``; both work on any
file system that Spark reads, and a failed or repeated task leaves no file.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .store import prepare, saved
from .words import SEPARATOR, text_slices, texts_of

SHARD_IDS = 1 << 21
PARTITION_IDS = 1 << 25
MAGIC = b"SKT1"
HEAD = struct.Struct("<4sIQIQI")

#: lengths of the four numbers of each control byte, and the bits that a number of each length keeps
LENGTHS = (np.arange(256, dtype=np.uint8)[:, None] >> np.array([0, 2, 4, 6], np.uint8) & 3) + 1
KEEPS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def encode_numbers(numbers: np.ndarray) -> bytes:
    """Control bytes, then data bytes, of unsigned 32-bit numbers."""
    numbers = np.ascontiguousarray(numbers, "<u4")
    code = (numbers > 0xFF).astype(np.uint8) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    four = np.zeros((len(numbers) + 3) // 4 * 4, np.uint8)
    four[: len(code)] = code
    four = four.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = numbers.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) <= code[:, None]]
    return control.tobytes() + data.tobytes()


def decode_numbers(raw: np.ndarray, n: int) -> tuple[np.ndarray, int]:
    """(the ``n`` numbers at the start of ``raw``, bytes they take)."""
    controls = (n + 3) // 4
    lengths = LENGTHS[raw[:controls]].ravel()[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    size = int(ends[-1]) if n else 0
    data = np.concatenate([raw[controls : controls + size], np.zeros(4, np.uint8)])
    loads = np.ndarray((size + 1,), "<u4", data, strides=(1,))
    return loads[ends - lengths] & KEEPS[lengths], controls + size


class ByteLevelIds:
    """Ids of whole texts by a byte-level BPE tokenizer, one look-up a distinct word.

    The tokenizer's pattern never matches across the start of a stretch of
    white space, nor from an ASCII letter into an ASCII sign or digit, so texts
    are cut there and each distinct piece is encoded once and remembered. New
    pieces that start with white space and end without are encoded in long
    strings of many, and told apart by their tokens' bytes. A text with white
    space beyond ASCII, where the first rule does not hold for ASCII white
    space, or with a special token's string is encoded whole. Memory is
    bounded by forgetting.
    """

    LIMIT = 1_000_000
    TOGETHER = 4096  # pieces a string
    #: bits of each byte: white space, ASCII sign or digit, ASCII letter, start of what ODD finds
    KIND = bytes(SEPARATOR[b] + 2 * (33 <= b < 127 and not chr(b).isalpha()) + 4 * (b < 128 and chr(b).isalpha())
                 + 8 * (b in b"<\x1c\x1d\x1e\x1f\xc2\xe1\xe2\xe3\xef") for b in range(256))
    #: white space and separators beyond the ASCII ones, and what may start a special token
    ODD = re.compile(rb"<\||[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8f\xa8-\xaf]|\xe2\x81[\x9f\xa0]|\xe3\x80\x80|\xef\xbb\xbf")
    #: whether ODD may match at a byte, by the one after it
    SECOND = np.zeros((256, 256), bool)
    SECOND[0x1C:0x20] = True
    SECOND[[ord("<"), 0xC2, 0xC2, 0xE1, 0xE1, 0xE2, 0xE2, 0xE3, 0xEF], [ord("|"), 0x85, 0xA0, 0x9A, 0xA0, 0x80, 0x81, 0x80, 0xBB]] = True

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a worker a core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        known = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = np.zeros(max(known.values()) + 1, np.int64)  # a character of the byte-level alphabet stands for a byte
        self.bytes_of[list(known.values())] = [len(t) for t in known]
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.first = np.zeros(self.LIMIT + 1, np.int64)

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(pieces, first piece of each text, texts left whole)."""
        raw = data.tobytes()
        kind = np.frombuffer(raw.translate(self.KIND), np.uint8)
        before, here = kind[:-1], kind[1:]
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = (here & ~before & 1) | (here & (before >> 1) & 2)
        maybe = np.flatnonzero(kind & 8)
        maybe = maybe[self.SECOND[data[maybe], data[np.minimum(maybe + 1, len(data) - 1)]]]
        found = np.array([at for at in maybe.tolist() if self.ODD.match(raw, at)], np.int64)
        whole = np.unique(np.searchsorted(offsets, found, "right") - 1)
        for doc in whole.tolist():
            cut[offsets[doc] : offsets[doc + 1]] = False
        cut[offsets] = True
        cut[-1] = False
        starts = np.flatnonzero(cut)
        limits = np.append(starts, len(data)).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(limits), pa.py_buffer(raw)), np.searchsorted(starts, offsets), whole

    def encode(self, texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): text i has ids[bounds[i]:bounds[i + 1]], the last of them ``end_id``."""
        pieces, firsts, whole = self._pieces(texts.data, texts.offsets)
        coded = pieces.dictionary_encode()
        which = coded.indices.to_numpy()
        body, at = _flat(coded.dictionary.cast(pa.large_binary()))
        raw = body.tobytes()
        distinct = [raw[i:j] for i, j in pairwise(at.tolist())]
        if len(self.place) + len(distinct) > self.LIMIT or len(self.ids) > 1 << 23:
            self._forget()
            if len(distinct) > self.LIMIT:  # one very long text
                self.first = np.zeros(len(distinct) + 1, np.int64)
        number = np.fromiter(map(self.place.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(number < 0)
        if len(missing):
            odd = np.zeros(len(distinct), bool)
            odd[which[firsts[whole]]] = True
            size = np.diff(at)
            together = SEPARATOR[body[at[missing]]] & ~SEPARATOR[body[at[missing + 1] - 1]] & (size[missing] < 200) & ~odd[missing]
            joined, alone = missing[together], missing[~together]
            missing = np.concatenate([joined, alone])
            known, new = len(self.place), [distinct[i] for i in missing.tolist()]
            (flat, lengths), (rest, more) = self._joined(new[: len(joined)], size[joined]), self._alone([p.decode() for p in new[len(joined) :]])
            flat, lengths = np.concatenate([flat, rest]), np.concatenate([lengths, more])
            number[missing] = np.arange(known, known + len(new))
            self.place.update(zip(new, range(known, known + len(new)), strict=True))
            used = int(self.first[known])
            self.first[known + 1 : known + len(new) + 1] = used + np.cumsum(lengths)
            while used + len(flat) >= len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            self.ids[used : used + len(flat)] = flat
        # the known pieces' ids as byte strings, and last the end id's; one string is taken for each piece of the texts
        known = len(self.place)
        used = int(self.first[known])
        self.ids[used] = end_id
        limits = np.append(self.first[: known + 1], used + 1) * 4
        strings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), known + 1, [None, pa.py_buffer(limits), pa.py_buffer(self.ids[: used + 1])])
        taken = strings.take(pa.array(np.insert(number[which], firsts[1:], known)))
        _, ends, raw = taken.buffers()
        out = np.frombuffer(raw, np.uint32)
        bounds = np.frombuffer(ends, np.int64, len(taken) + 1)[np.concatenate([[0], firsts[1:] + np.arange(1, texts.size + 1)])] // 4
        return out, bounds

    def _alone(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, number of each)."""
        found = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        lengths = np.array([len(x) for x in found], np.int64)
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _joined(self, pieces: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces (of ``sizes`` bytes) that may stand one after the other in a text."""
        ids, _ = self._alone([b"".join(pieces[i : i + self.TOGETHER]).decode() for i in range(0, len(pieces), self.TOGETHER)])
        last = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(sizes)) + 1
        return ids, np.diff(last, prepend=0)


_ENCODERS: dict[str, ByteLevelIds] = {}  # one a worker process: the words it has met stay known


def _tokenised(batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int, kind: str) -> Iterator[pa.RecordBatch]:
    if vocabulary not in _ENCODERS:
        _ENCODERS[vocabulary] = ByteLevelIds(vocabulary)
    width = np.dtype(kind).itemsize
    for batch in text_slices(batches, max_bytes=1 << 22, max_rows=1 << 13):
        ids, bounds = _ENCODERS[vocabulary].encode(texts_of(batch.column("text")), end_id)
        limits = pa.py_buffer((bounds * width).astype(np.int32) if bounds[-1] * width < 1 << 31 else bounds * width)
        made = pa.BinaryArray if bounds[-1] * width < 1 << 31 else pa.LargeBinaryArray
        packed = made.from_buffers(pa.binary() if made is pa.BinaryArray else pa.large_binary(), len(bounds) - 1, [None, limits, pa.py_buffer(ids.astype(kind))])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), packed.cast(pa.binary())], ["doc_id", "ids"])


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, bounds) of a binary column."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def _occurrences(batches: Iterator[pa.RecordBatch], size: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Counts of all ids of a task's rows: one array of the vocabulary's size."""
    total = np.zeros(size, np.int64)
    for batch in batches:
        total += np.bincount(_flat(batch.column("ids"))[0].view(kind), minlength=size)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])


def _shards(batches: Iterator[pa.RecordBatch], rank: np.ndarray, kind: str, shard_ids: int) -> Iterator[pa.RecordBatch]:
    """Shards of a task's documents, in the order they come in."""
    partition, before = TaskContext.get().partitionId(), 0
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
    width = np.dtype(kind).itemsize

    def shard() -> pa.RecordBatch:
        nonlocal before, held
        doc_ids, has, lengths, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        rest = doc_ids.astype("<i8").tobytes() + has.astype(np.uint8).tobytes() + encode_numbers(lengths) + encode_numbers(rank[ids])
        head = HEAD.pack(MAGIC, partition, before, len(doc_ids), len(ids), zlib.crc32(rest))
        before, held = before + len(ids), []
        return pa.RecordBatch.from_arrays([pa.array([head + rest], pa.binary())], ["shard"])

    for batch in batches:
        raw, bounds = _flat(batch.column("ids"))
        ids, bounds = raw.view(kind), bounds // width
        doc_id = batch.column("doc_id")
        has, doc_ids = pc.is_valid(doc_id).to_numpy(zero_copy_only=False), pc.fill_null(doc_id, 0).to_numpy()
        at = 0
        while at < batch.num_rows:
            room = max(0, shard_ids - sum(len(h[3]) for h in held))
            end = min(max(at + (not held), int(np.searchsorted(bounds, bounds[at] + room, "right")) - 1), batch.num_rows)
            if end > at:
                held.append((doc_ids[at:end], has[at:end], np.diff(bounds[at : end + 1]), ids[bounds[at] : bounds[end]].copy()))
            if end < batch.num_rows:
                yield shard()
            at = end
    if held:
        yield shard()


def _documents(batches: Iterator[pa.RecordBatch], id_of: np.ndarray, with_ids: bool) -> Iterator[pa.RecordBatch]:
    """Documents of shards: their ids, looked up by rank."""
    names = ["doc_id", "partition", "place", "n_tokens", "ids_crc32", "ids"][: 6 if with_ids else 5]
    for batch in batches:
        for content in batch.column("content"):
            raw = np.frombuffer(content.as_buffer(), np.uint8)
            magic, partition, before, docs, n, crc = HEAD.unpack_from(raw)
            rest = raw[HEAD.size : -1]  # without the newline
            if magic != MAGIC or zlib.crc32(rest) != crc:
                raise ValueError("damaged token file")
            doc_ids, has = rest[: 8 * docs].view("<i8"), rest[8 * docs : 9 * docs].astype(bool)
            lengths, used = decode_numbers(rest[9 * docs :], docs)
            ranks, _ = decode_numbers(rest[9 * docs + used :], n)
            ids = id_of[ranks].astype("<u4")
            bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
            view = memoryview(ids).cast("B")
            checks = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            columns = [pa.array(doc_ids, pa.int64(), mask=~has), pa.array(np.full(docs, partition, np.int64)), pa.array(before + bounds[:-1]),
                       pa.array(lengths.astype(np.int64)), pa.array(checks, pa.int64())]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int64))))
            yield pa.RecordBatch.from_arrays(columns, names)


def write_token_files(spark: SparkSession, docs: DataFrame, vocabulary: str, folder: str, end_id: int = 0, shard_ids: int = SHARD_IDS) -> None:
    """Write the ids of every document (its text's, then ``end_id``) under ``folder``, a new folder on any file system.

    ``docs`` needs doc_id and text; ``vocabulary`` is the path of a byte-level
    BPE file that every executor can read. What the driver holds has the size
    of the vocabulary (its ids in rank order). Ids equally frequent rank by id.

    Defined cases: null and empty texts are just ``end_id``; documents with a
    null id come last, of equal ids those with the smaller hash of their ids
    first; repeated rows are written each; one document is never cut, so a
    very long one makes a long shard; an empty table gives a folder without
    shards; extra columns are ignored.
    """
    from tokenizers import Tokenizer

    prepare(spark)
    size = max(Tokenizer.from_file(vocabulary).get_vocab_size(with_added_tokens=True), end_id + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    tokens = saved(spark, rows.mapInArrow(lambda it: _tokenised(it, vocabulary, end_id, kind), "doc_id long, ids binary"), "token-ids", compression="zstd")
    counts = tokens.select("ids").mapInArrow(lambda it: _occurrences(it, size, kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    id_of = counts.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy().astype(np.uint32)
    rank = np.zeros(size, np.uint32)
    rank[id_of] = np.arange(len(id_of), dtype=np.uint32)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(counts["n"].sum()) // PARTITION_IDS))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("ids").asc()]
    in_order = tokens.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    shards = in_order.mapInArrow(lambda it: _shards(it, rank, kind, shard_ids), "shard binary")
    table = spark.createDataFrame([(bytearray(struct.pack("<I", len(id_of)) + encode_numbers(id_of)),)], "shard binary").coalesce(1)
    for df, name in ((shards, "shards"), (table, "ranks")):
        df.select(F.col("shard").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(f"{folder}/{name}")


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents of a folder of token files: doc_id, start, n_tokens, ids_crc32 and, if asked for, their ids.

    ``start`` counts the ids of all documents before, over all files; it is
    added up from one sum for each partition the folder was written in.
    """
    prepare(spark)
    files = spark.read.format("binaryFile")
    table = next(bytes(r.content) for r in files.load(f"{folder}/ranks").where("length > 0").select("content").collect())
    id_of, _ = decode_numbers(np.frombuffer(table, np.uint8)[4:], struct.unpack_from("<I", table)[0])
    schema = "doc_id long, partition long, place long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    rows = files.load(f"{folder}/shards").where("length > 0").select("content").mapInArrow(lambda it: _documents(it, id_of, with_ids), schema)
    rows = saved(spark, rows, "token-rows")
    sums = rows.groupBy("partition").agg(F.max(F.col("place") + F.col("n_tokens")).alias("ids_here"))
    first = sums.select("partition", (F.sum("ids_here").over(Window.orderBy("partition")) - F.col("ids_here")).alias("ids_before"))
    out = rows.join(first, "partition").withColumn("start", F.col("ids_before") + F.col("place"))
    return out.select("doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids)


def token_files(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Write the token files (to the shared folder unless named) and read them back."""
    folder = folder or scratch_path(spark, "llm-token-files") + "/files"
    write_token_files(spark, docs, vocabulary, folder, end_id)
    return read_token_files(spark, folder)
