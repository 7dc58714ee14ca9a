"""The pipeline's stages: columns of any name, nulls, empty tables, and the whole run."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, copies string, k_row string, k_copy string, "
          "k_one string, d string, f_id string, component_id string, score string, predicted string, n_lines string")


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdeinorst", k=rng.randint(2, 8))) for _ in range(300)]
    line = lambda n: " ".join(rng.choices(words, k=n))
    texts = ["\n".join(line(rng.randint(5, 15)) for _ in range(rng.randint(1, 6))) for _ in range(60)]
    texts += [texts[0], texts[1], None, "", " ", "one"]
    rows = [(i, t, "en", f"s{i % 5}" if i % 7 else None, None if t is None else len(t), 7, "c", "r", "k", "o", "d", "f", "x", "y", "z", "l") for i, t in enumerate(texts)]
    rows += [rows[4], (None, texts[5], *[None] * 14), (None, None, *[None] * 14)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def sf_dir(spark, docs, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    docs.where("doc_id is not null").select("doc_id", (F.col("doc_id") % 4 > 0).cast("int").alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.mark.parametrize("name,stage", pipeline.STAGES[:-1])
def test_stages_keep_the_columns(spark, docs, sf_dir, name, stage):
    out = stage(spark, docs, sf_dir)
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    before = {tuple(r) for r in (docs.drop("text", "n_chars") if name == "line_dedup" else docs).collect()}
    after = [tuple(r) for r in (out.drop("text", "n_chars") if name == "line_dedup" else out).collect()]
    assert after and set(after) <= before
    assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_near_copies_and_mix(spark, docs, sf_dir):
    left = pipeline.drop_near_copies(spark, docs, sf_dir).collect()
    texts = [r.text for r in left if r.text and r.text.strip()]
    assert len(texts) == len(set(texts)) == docs.where("trim(text) != ''").select("text").distinct().count()
    taken = pipeline.mix(spark, docs.dropDuplicates(["doc_id", "text"]), sf_dir).groupBy("doc_id", "text").count().collect()
    assert max(r["count"] for r in taken) <= 2


def test_run(spark, sf_dir):
    pieces = pipeline.run(spark, sf_dir).collect()
    assert pieces and max(r.length for r in pieces) <= 2048
    by_sequence = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == by_sequence.get(r.sequence_id, 0)
        by_sequence[r.sequence_id] = r.offset + r.length
