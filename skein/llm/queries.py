"""One query for each operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .divergence import SOURCE_DIVERGENCE_SQL, source_divergence
from .embedding_dedup import embedding_dedup
from .language_id import identify_languages
from .line_crf import score_quality
from .line_dedup import line_dedup
from .lm_scoring import cross_entropy_difference
from .minmax_dedup import minmax_dedup
from .mixing import mix_sources
from .packing import pack
from .period_runs import period_runs
from .perplexity import quality_rules
from .store import table
from .substring_dedup import substring_dedup
from .token_files import token_files

VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(spark, table(spark, sf_dir, "embeddings"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(spark, table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_lines", "n_removed", "text")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(spark, table(spark, sf_dir, "documents"))


def op6_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup(spark, table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0")
    return cross_entropy_difference(spark, table(spark, sf_dir, "documents"), good)


def op8_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"), vocabulary_path())


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark, table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(spark, table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(spark, table(spark, sf_dir, "documents"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(spark, table(spark, sf_dir, "documents"), vocabulary_path(BYTE_VOCABULARY))


def op13_period_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = period_runs(spark, table(spark, sf_dir, "documents"), bend=True)
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality, op2_embedding_dedup, op3_mix_sources, op4_line_dedup, op5_quality_rules,
                            op6_minmax_dedup, op7_lm_scoring, op8_pack, op9_substring_dedup, op10_language,
                            op11_source_divergence, op12_token_files, op13_period_runs)
}

#: DuckDB SQL of the queries that SQL expresses (the other operators are tested against brute force).
ORACLE: dict[str, str] = {"op11_source_divergence": SOURCE_DIVERGENCE_SQL}
