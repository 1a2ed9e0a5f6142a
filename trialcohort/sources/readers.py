"""Sources: database tables, CSV, TSV, parquet, JSON lines, keyword files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialcohort.sources.csv_records import numbered_lines, parsed, records
from trialcohort.sources.schemas import SCHEMAS

FETCH_ROWS = "10000"


def by_schema(df: DataFrame, table: str) -> DataFrame:
    """The columns of the declared schema, by name and in its types; text that does not fit becomes null."""
    schema = T.StructType.fromDDL(SCHEMAS[table])
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def bad_values(raw: DataFrame, table: str) -> DataFrame:
    """(table, column, count) of texts that don't fit the declared type and become null; columns without any left out."""
    schema = T.StructType.fromDDL(SCHEMAS[table])
    lost = [F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()) for f in schema]
    counts = raw.agg(F.array(*[F.struct(F.lit(f.name).alias("column"), n.alias("count")) for f, n in zip(schema, lost)]).alias("counts"))
    return counts.select(F.lit(table).alias("table"), F.inline("counts")).filter("count > 0")


def read_parquet(spark: SparkSession, path: str, table: str) -> DataFrame:
    return by_schema(spark.read.parquet(path), table)


def read_csv(spark: SparkSession, path: str, table: str, sep: str = ",") -> DataFrame:
    """A CSV file, or a folder of files, with a header; cells may hold line breaks and doubled quotes.

    Columns are taken by the header's names, so a table may have more columns or another order. All files of a folder
    must have the same header: reading one that differs fails. Its lines are staged in the shared folder, one task for
    each block of a file, since a block alone can't tell where its records begin; see csv_records.
    """
    return by_schema(raw_csv(spark, path, sep), table)


def raw_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    names = spark.read.csv(path, header=True, sep=sep, multiLine=True, quote='"', escape='"').columns
    return parsed(records(numbered_lines(spark, path)), names, sep)


def read_tsv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A tab-separated code map with a header. One line is one row, so files can be split among tasks."""
    return by_schema(spark.read.csv(path, header=True, sep="\t"), table)


def id_ranges(column: str, bounds: list[str]) -> list[str]:
    """WHERE conditions that cut a text key at the bounds into separate ranges, nulls in the first."""
    if not bounds:
        return ["1 = 1"]
    at = ["'" + b.replace("'", "''") + "'" for b in bounds]
    conditions = [f"{column} < {at[0]} OR {column} IS NULL"]
    conditions += [f"{column} >= {a} AND {column} < {b}" for a, b in zip(at, at[1:])]
    return conditions + [f"{column} >= {at[-1]}"]


def bounds_query(table: str, key: str, tasks: int) -> str:
    """SQL for the ids that cut a table into `tasks` ranges of about equal size, worked out by the database."""
    tiles = f"SELECT {key}, NTILE({int(tasks)}) OVER (ORDER BY {key}) AS tile FROM {table} WHERE {key} IS NOT NULL"
    return f"SELECT MIN({key}) AS bound FROM ({tiles}) t WHERE tile > 1 GROUP BY tile"


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    bounds: list[str],
    properties: dict[str, str],
    key: str = "nct_id",
    tasks: int = 32,
) -> DataFrame:
    """A registry table over JDBC, one task per range of trial ids; columns and filters are pushed down.

    Without bounds the database is asked for those of `tasks` ranges. Rows come in blocks, not all at once. Joins
    are left to Spark: the base tables are read side by side, not through one query's cursor.
    """
    properties = {"fetchsize": FETCH_ROWS, **properties}
    if not bounds:
        found = spark.read.jdbc(url, f"({bounds_query(table, key, tasks)}) bounds", properties=properties)
        bounds = sorted(r["bound"] for r in found.collect())
    raw = spark.read.jdbc(url, table, predicates=id_ranges(key, bounds), properties=properties)
    return by_schema(raw, table)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as text, so that bad lines are kept for counting."""
    return spark.read.text(path)


def keyword_list(df: DataFrame) -> list[str]:
    """The first column as a job parameter: the list of keywords to search for, a setting and not data."""
    words = df.select(F.col(df.columns[0]).alias("word")).filter("word is not null").distinct()
    return sorted(row["word"] for row in words.collect())


def read_keywords(spark: SparkSession, path: str) -> list[str]:
    """The first column of a CSV file with a header."""
    return keyword_list(spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"'))


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """Curated measure titles, one per line; blanks around a title are part of it."""
    return spark.read.text(path).select(F.col("value").alias("title")).filter("title != ''")
