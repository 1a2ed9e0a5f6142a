"""From raw documents to packed sequences: quality rules, line dedup, near duplicates, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; docs and what all stages but
the last return have the columns of documents. run() writes each stage's rows as Parquet to the shared folder and reads
them again. Null or empty texts fail the first stage's base rules; extra columns of the input are left behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialcohort.llm.circulant_minhash import near_duplicates
from trialcohort.llm.common import row_key, stage, stage_few, table
from trialcohort.llm.decontaminate_prefix import hits
from trialcohort.llm.line_windows import line_dedup
from trialcohort.llm.pack_pow2 import pack
from trialcohort.llm.quality_divergence import quality_rules
from trialcohort.llm.tokenizing import vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules(docs.select(*COLUMNS)).filter("kept").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of repeated windows; n_chars is counted anew where lines went."""
    cut = line_dedup(docs.select(*COLUMNS))
    return cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least doc_id; documents without words stay as they are."""
    found = stage(near_duplicates(docs), "near")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "k1", "k2")).alias("first")
    one = found.filter(F.col("group_id").isNotNull()).groupBy("group_id").agg(first).select("first.k1", "first.k2", F.lit(True).alias("_one"))
    rest = found.filter(F.col("group_id").isNull()).select("k1", "k2", F.lit(False).alias("_one")).distinct()
    kept = stage_few(one.unionByName(rest), "kept").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "_one")
    k1, k2 = row_key()
    rows = docs.select(*COLUMNS, k1.alias("_k1"), k2.alias("_k2")).join(kept.hint("merge"), ["_k1", "_k2"])
    # of rows equal in doc_id and text, one stays in a group
    rows = rows.withColumn("_row", F.when(F.col("_one"), F.lit(0).cast("long")).otherwise(F.monotonically_increasing_id()))
    return rows.dropDuplicates(["_k1", "_k2", "_row"]).select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    found = stage_few(hits(docs, table(spark, sf_dir, "benchmark")).select("k1", "k2").distinct(), "contaminated")
    found = found.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"))
    k1, k2 = row_key()
    return docs.select(*COLUMNS, k1.alias("_k1"), k2.alias("_k2")).join(found.hint("merge"), ["_k1", "_k2"], "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, in buckets of equal power-of-two length."""
    return pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("lines", lines), ("near", near), ("benchmark", benchmark), ("packing", packing)]

#: Tokens, distances and permutations aren't SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
