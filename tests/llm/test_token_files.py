"""Token files: exact round trips, the ids of the tokenizers library, order, damaged files."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skein.llm.queries import vocabulary_path
from skein.llm.token_files import ByteLevelIds, decode_numbers, encode_numbers, read_token_files, token_files, write_token_files
from skein.llm.words import Texts
from skein.session import scratch_path

PATH = vocabulary_path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, ids string, shard string, partition string, start string"


@given(st.lists(st.integers(0, 2**32 - 1) | st.sampled_from([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24]), max_size=40))
@settings(max_examples=200, deadline=None)
def test_numbers_come_back(numbers):
    raw = encode_numbers(np.array(numbers, np.uint32))
    got, used = decode_numbers(np.frombuffer(raw + b"rest", np.uint8), len(numbers))
    assert got.tolist() == numbers and used == len(raw)
    assert len(raw) == (len(numbers) + 3) // 4 + sum(max(1, (x.bit_length() + 7) // 8) for x in numbers)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@given(st.lists(st.text(st.sampled_from("ab'sStre  \n\t\x0b\x0c\r\x1c\u0085  　.é中1<|x") | st.characters(exclude_categories=["Cs"]), max_size=30), max_size=5))
@settings(max_examples=300, deadline=None)
def test_ids_are_those_of_the_library(tokenizer, texts):
    raw = [t.encode() for t in texts]
    encoder = ByteLevelIds(PATH) if not hasattr(test_ids_are_those_of_the_library, "encoder") else test_ids_are_those_of_the_library.encoder
    test_ids_are_those_of_the_library.encoder = encoder
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, bounds = encoder.encode(Texts(data, np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)), 0)
    got = [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in texts]


@pytest.fixture(scope="module")
def rows():
    texts = ["plain words here", "  two  spaces\n\nand lines\t", "", None, "naïve 中文 ３４", "a<|endoftext|>b", "x  y", "it's 'RE we'll", "long text " * 9000, "!" * 3000]
    out = [(i * 7 % 40 - 5, t, "i", "s", "p", "st") for i, t in enumerate(texts * 3)]
    return [*out, out[0], out[0], (None, "no id", None, None, None, None), (None, None, None, None, None, None), (2**60, "far", None, None, None, None)]


def test_token_files_round_trip(spark, rows, tokenizer):
    docs = spark.createDataFrame(rows, SCHEMA)
    folder = scratch_path(spark, "test-tokens") + "/files"
    write_token_files(spark, docs, PATH, folder, shard_ids=300)
    got = sorted(read_token_files(spark, folder, with_ids=True).collect(), key=lambda r: r.start)
    ids = lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r.doc_id, tuple(r.ids)) for r in got), key=key) == sorted(((r[0], tuple(ids(r[1]))) for r in rows), key=key)
    assert [(r.doc_id is None, r.doc_id or 0) for r in got] == sorted((r[0] is None, r[0] or 0) for r in rows)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    assert spark.read.format("binaryFile").load(folder + "/shards").where("length > 0").count() > 8  # several partitions, and shards cut inside them
    again = token_files(spark, docs, PATH)
    assert sorted(map(tuple, again.collect()), key=lambda r: r[1]) == [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got]


def test_token_files_of_nothing(spark):
    assert token_files(spark, spark.createDataFrame([], SCHEMA), PATH).collect() == []
    one = token_files(spark, spark.createDataFrame([(3, None, "", "", "", "")], SCHEMA), PATH).collect()
    assert [tuple(r) for r in one] == [(3, 0, 1, zlib.crc32(bytes(4)))]


def test_damaged_shard_is_an_error(spark, tmp_path):
    folder = str(tmp_path / "files")
    write_token_files(spark, spark.createDataFrame([(1, "some words", "", "", "", "")], SCHEMA), PATH, folder)
    shard = next(p for p in (tmp_path / "files" / "shards").glob("part-*") if p.stat().st_size)
    raw = bytearray(shard.read_bytes())
    raw[-3] ^= 1
    shard.write_bytes(raw)
    (shard.parent / f".{shard.name}.crc").unlink()
    with pytest.raises(Exception, match="damaged token file"):
        read_token_files(spark, folder).collect()


def test_known_pieces_take_no_string_of_their_own(monkeypatch):
    """A slice is scanned for odd bytes once, and pieces met before are looked up by their bytes: no search for each piece."""
    import pyarrow as pa

    from skein.llm.words import texts_of

    coder = ByteLevelIds(PATH)
    texts = ["Plain words, 12 of them <b>.", "odd space and <|endoftext|> “quoted”", "", "　日本", "<", "| \x1c x", "café naïve e—f"]
    want = [coder.tokenizer.encode(t, add_special_tokens=False).ids + [0] for t in texts]

    class Once:
        tried = 0

        def __init__(self, pattern):
            self.match = lambda raw, at: self._match(pattern, raw, at)

        def _match(self, pattern, raw, at):
            Once.tried += 1
            return pattern.match(raw, at)

    monkeypatch.setattr(ByteLevelIds, "ODD", Once(ByteLevelIds.ODD))
    for _ in range(2):
        ids, bounds = coder.encode(texts_of(pa.array(texts)), 0)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want
    assert Once.tried <= 2 * 12 and all(isinstance(p, bytes) for p in coder.place)
