"""Tables written in between, where several later steps read the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trialcohort.sources.shared import shuffles_freed


def written(df: DataFrame, path: str) -> DataFrame:
    """Writes the rows as parquet and reads them back: computed once, read by column, short lineage.

    `path` lies in a folder that all executors share.
    """
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
