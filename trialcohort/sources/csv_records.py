"""CSV files with line breaks in cells, each read by as many tasks as it has blocks.

A line with an odd number of quotes opens or closes a cell that goes on over lines. Each task numbers those lines within its
block of a file; the blocks' totals, few numbers, are added up in order, and then every line knows whether it lies in an
open cell. Lines that are whole records stay where they are. Only the lines of longer records are shuffled, by record.

A cell that holds a quote must be quoted and its quotes doubled, as all writers of such files do; a file whose quotes don't
pair up ends the job. Lines end with \\n or \\r\\n. Blank lines between records are skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trialcohort.sources.shared import staged

LINES = "path string, start long, place long, value string, odd boolean, before long"
BLANK = "value IN ('', '\\r')"


def numbering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds `before` to lines in their order: the odd lines of their block (path, start) before them."""
    last, count = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        odd = batch.column("odd").to_numpy(zero_copy_only=False).astype(np.int64)
        start, path = batch.column("start").to_numpy(), batch.column("path").dictionary_encode()
        name = path.indices.to_numpy()
        first = np.flatnonzero(np.append(True, (start[1:] != start[:-1]) | (name[1:] != name[:-1])))
        before = np.cumsum(odd) - odd
        own = before - np.repeat(before[first], np.diff(np.append(first, len(odd))))
        if (path.dictionary[name[0]].as_py(), start[0]) == last:
            stop = first[1] if len(first) > 1 else len(odd)
            own[:stop] += count
        last, count = (path.dictionary[name[-1]].as_py(), start[-1]), int(own[-1] + odd[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], names=[*batch.schema.names, "before"])


def numbered_lines(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """Staged (path, start, place, value, odd, before): every line, its block, and its place in the order of the block."""
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    rows = lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        "value",
        (quotes % 2 == 1).alias("odd"),
    )
    return staged(rows.mapInArrow(numbering, LINES), "lines")


def blocks(lines: DataFrame) -> DataFrame:
    """(path, start, ahead, at): odd lines of the file before the block, and block and place of the file's first line that isn't blank.

    One row for each block of the input.
    """
    first = F.min(F.when(~F.expr(BLANK), F.col("place")))
    found = lines.groupBy("path", "start").agg(F.count_if("odd").alias("n"), first.alias("first"))
    file = Window.partitionBy("path")
    before = F.sum("n").over(file.orderBy("start").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    at = F.min(F.when(F.col("first").isNotNull(), F.struct("start", F.col("first").alias("place")))).over(file)
    odd = F.concat(F.lit("quotes don't pair up in "), "path")
    checked = F.when(F.sum("n").over(file) % 2 == 1, F.raise_error(odd).cast("long")).otherwise(before)
    return staged(found.select("path", "start", checked.alias("ahead"), at.alias("at")), "blocks")


def records(lines: DataFrame) -> DataFrame:
    """(record, first): the text of each record, its own line breaks kept, and whether it is its file's first."""
    placed = lines.join(blocks(lines), ["path", "start"])
    placed = placed.withColumn("seen", F.col("ahead") + F.col("before"))
    inside = F.col("seen") % 2 == 1
    first = (F.col("start") == F.col("at.start")) & (F.col("place") == F.col("at.place"))
    whole = placed.filter(~inside & ~F.col("odd")).select(F.col("value").alias("record"), first.alias("first"))
    longer = placed.filter(inside | F.col("odd")).groupBy("path", F.expr("seen div 2").alias("number"))
    parts = longer.agg(F.sort_array(F.collect_list(F.struct("start", "place", "value"))).alias("parts"), F.max(first).alias("first"))
    rows = whole.unionByName(parts.select(F.array_join("parts.value", "\n").alias("record"), "first"))
    return rows.withColumn("record", F.regexp_replace("record", r"\r\z", "")).filter("record != ''")


def parsed(rows: DataFrame, names: list[str], sep: str = ",", quote: str = '"') -> DataFrame:
    """Columns of texts from (record, first); a first record that isn't the header `names` ends the job."""
    cells = [f"c{i}" for i in range(len(names))]
    schema = ", ".join(f"{c} string" for c in cells)
    text = F.when(F.col("first"), F.ltrim("record", F.lit("\ufeff"))).otherwise(F.col("record"))
    read = F.from_csv(text, schema, {"sep": sep, "quote": quote, "escape": quote})
    rows = rows.select(read.alias("cells"), "first")
    same: Column = F.lit(True)
    for cell, name in zip(cells, names):
        same = same & F.col(f"cells.{cell}").eqNullSafe(F.lit(name))
    wrong = F.raise_error(F.concat(F.lit("a header differs from the first: "), F.to_json("cells"))).cast("boolean")
    rows = rows.filter(F.when(~F.col("first"), True).when(same, False).otherwise(wrong))
    return rows.select(*[F.col(f"cells.{c}").alias(n) for c, n in zip(cells, names)])
