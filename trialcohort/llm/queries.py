"""The queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trialcohort.llm import oracle
from trialcohort.llm.circulant_minhash import near_duplicate_digest
from trialcohort.llm.common import new_path, table
from trialcohort.llm.decontaminate_prefix import contamination
from trialcohort.llm.filter_interaction import filter_interaction
from trialcohort.llm.line_windows import line_digest
from trialcohort.llm.pack_pow2 import pack
from trialcohort.llm.partenum_join import jaccard_join
from trialcohort.llm.ppm_scoring import model_scores
from trialcohort.llm.quality_divergence import quality_rules
from trialcohort.llm.recompression import repeat_digest
from trialcohort.llm.secret_entropy import secrets
from trialcohort.llm.source_divergence import source_divergence
from trialcohort.llm.token_orc import token_index, write_tokens
from trialcohort.llm.tokenizing import vocabulary
from trialcohort.llm.toxicity_nbsvm import toxicity


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), carry=["doc_id"])


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_scores(table(spark, sf_dir, "documents"))


def secret(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(table(spark, sf_dir, "documents"))


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), end=1)
    return token_index(spark, path)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digest(table(spark, sf_dir, "documents"))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end=0, with_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "bucket")


def repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digest(table(spark, sf_dir, "documents"))


def near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_digest(table(spark, sf_dir, "documents"))


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_interaction(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_divergence": quality,
        "op2_toxicity_nbsvm": toxic,
        "op3_prefix_decontamination": contaminated,
        "op4_ppm_score": scored,
        "op5_secret_entropy": secret,
        "op6_token_orc": token_files,
        "op7_line_windows": lines,
        "op8_power_of_two_packing": packed,
        "op9_recompression_dedup": repeats,
        "op10_circulant_minhash": near,
        "op11_partenum_join": joined,
        "op12_source_divergence": sources,
        "op13_filter_interaction": filters,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
