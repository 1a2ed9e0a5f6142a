"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or where that is unset a folder in the warehouse, which on a cluster must not lie on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and warehouse.startswith(("file:", "/")):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{warehouse}/_staged"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when each query ends, not when the driver's JVM finds them unused."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back; the files go when the driver's Python ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def remove() -> None:
        try:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(conf).delete(at, True)
        except Exception:  # the session has ended, and its folder with it or by its owner
            pass

    atexit.register(remove)
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
