"""Shared folder, staged tables and document keys for the operators of this subpackage."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialcohort.sources.shared import shared_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
FEW_FILES, FILES_PER_CORE = 32, 4


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet; it is removed when the driver's Python ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def remove() -> None:
        try:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
        except Exception:  # the session has ended, and its folder with it or by its owner
            pass

    atexit.register(remove)
    return path


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back.

    What was computed survives lost executors, later steps know its size, and the shuffle files that made it go at once.
    """
    spark = df.sparkSession
    path, before = new_path(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.options(**({"compression": "zstd"} | options)).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def stage_few(df: DataFrame, name: str) -> DataFrame:
    """stage() in a few files for each core, however many partitions the shuffles have.

    For rows that an aggregate has dealt out by their whole key, about as many as it read: its last step runs in as few
    tasks, so one that reads much and leaves little goes through stage(). So do a join's rows: what Spark has split of a hot key
    would meet again in one task here.
    """
    return stage(df.coalesce(max(FEW_FILES, FILES_PER_CORE * df.sparkSession.sparkContext.defaultParallelism)), name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(text: str = "text", doc_id: str = "doc_id") -> list[Column]:
    """Two columns that tell documents apart also where doc_id repeats or is null; equal rows share a key."""
    return [F.coalesce(F.col(doc_id), F.lit(0)).alias("k1"), F.xxhash64(F.col(doc_id), F.col(text)).alias("k2")]


def id_remainder(doc_id: str = "doc_id", modulus: int = 5) -> Column:
    """crc32 of doc_id as text, modulo `modulus`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus
