"""Sinks: parquet, CSV, JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def flat(df: DataFrame) -> DataFrame:
    """Lists as JSON text, for sinks that only know plain cells."""
    return df.select(
        *[
            F.to_json(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def write_csv(df: DataFrame, path: str) -> None:
    """CSV part files with a header; quotes are doubled, line breaks and outer blanks stay in their cell."""
    flat(df).write.mode("overwrite").csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_requests(requests: DataFrame, path: str) -> None:
    """Request lines, one folder with one file per category and chunk; chunks are spread over the tasks."""
    rows = requests.select("category", "chunk", "value").repartition("category", "chunk")
    rows.write.mode("overwrite").partitionBy("category", "chunk").text(path)
