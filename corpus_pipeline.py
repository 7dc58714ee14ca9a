"""The training-data pipeline: quality, line dedup, near-dedup, source mix, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, all but the last with the columns of documents.
``run`` writes each stage's rows in the shared folder and reads them back for
the next, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.llm.line_crf import score_quality
from skein.llm.line_dedup import line_dedup
from skein.llm.minmax_dedup import minmax_dedup
from skein.llm.mixing import mix_sources, words_in
from skein.llm.packing import pack
from skein.llm.queries import vocabulary_path
from skein.llm.store import saved, table


def _whole(docs: DataFrame, text_apart: bool = False) -> tuple[DataFrame, list]:
    """(each row as one struct, its columns back out of it): a stage's own columns then clash with none of the table's.

    ``text_apart`` leaves doc_id and text beside the struct, the text not in it, so that it moves once.
    """
    name = lambda c: "`" + c.replace("`", "``") + "`"
    inside = F.struct(*[F.col(name(c)).alias(c) for c in docs.columns if not (text_apart and c == "text")]).alias("d")
    columns = [F.col("text") if text_apart and c == "text" else F.col("d")[c].alias(c) for c in docs.columns]
    return docs.select(*["doc_id", "text"] * text_apart, inside), columns


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts good.

    Rows that repeat stay or go together; a null or empty text has a score as
    any other; an empty table stays empty.
    """
    whole, columns = _whole(docs, text_apart=True)
    good = score_quality(spark, whole, table(spark, sf_dir, "labels"), with_lines=False, carry=["text", "d"])
    return good.where("predicted = 1").select(*columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated multi-line chunks; n_chars follows the text.

    A null text stays null, with null n_chars; every row stays, though its
    text may be empty afterwards; an empty table stays empty.
    """
    whole, columns = _whole(docs, text_apart=True)
    size = F.length("text").cast("long").alias("n_chars")
    return line_dedup(spark, whole).select(*[size if c == "n_chars" else own for c, own in zip(docs.columns, columns, strict=True)])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group, the one with the smallest id.

    Rows are told apart by id and text. A null id counts as larger than any
    other; of rows with the smallest id one text stays, and of equal ids and
    texts one row. Rows without a word are in no group and all stay.
    """
    whole, columns = _whole(docs)
    row = F.xxhash64("d.doc_id", F.col("d.text").cast("string"))
    rows = whole.select("d", row.alias("k_row"))
    found = minmax_dedup(spark, rows.select(F.col("k_row").alias("doc_id"), "d.text")).select(F.col("doc_id").alias("k_row"), "component_id", "n_shingles").distinct()
    ids = rows.select("k_row", F.col("d.doc_id").alias("k_id")).distinct()
    best = (found.where("n_shingles > 0").join(ids.hint("merge"), "k_row").groupBy("component_id")
            .agg(F.min(F.struct(F.col("k_id").isNull().alias("none"), "k_id", "k_row")).alias("best")).select("best.k_row", F.lit(True).alias("k_one")))
    kept = best.unionByName(found.where("n_shingles = 0").select("k_row", F.lit(False).alias("k_one")))
    stays = rows.join(kept.hint("merge"), "k_row")
    stays = stays.withColumn("k_copy", F.when(F.col("k_one"), F.lit(0)).otherwise(F.monotonically_increasing_id()))
    return stays.dropDuplicates(["k_row", "k_copy"]).select(*columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it (0, 1 or 2 times).

    Documents without a word, null texts among them, have size 0. Rows equal
    in id, source and size share one fate; an empty table stays empty.
    """
    whole, columns = _whole(docs)
    rows = whole.select("d", F.col("d.doc_id").alias("i"), F.col("d.source").alias("s"), words_in("d.text").alias("n"))
    chosen = (mix_sources(spark, whole.select("d.doc_id", "d.text", "d.source")).where("copies > 0")
              .select(F.col("doc_id").alias("m_id"), F.col("source").alias("m_source"), F.col("size").alias("m_size"), "copies").distinct().hint("merge"))
    same = F.col("i").eqNullSafe(F.col("m_id")) & F.col("s").eqNullSafe(F.col("m_source")) & (F.col("n") == F.col("m_size"))
    return rows.join(chosen, same).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences of 2048; a null text is just its end id, an empty table gives no pieces."""
    return pack(spark, docs, vocabulary_path())


STAGES = [("quality", keep_good), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_copies), ("mix", mix), ("pack", pack_sequences)]

#: Not expressible: the classifier, the min-max groups and the packing are no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(spark, stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
