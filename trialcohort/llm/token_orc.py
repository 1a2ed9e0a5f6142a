"""Token ids of documents as ORC files, in ascending order of doc_id.

One row for each document: part (file), ordinal (row of the file), doc_id and ids. ORC encodes the integers by run
lengths, keeps minima and maxima for every stripe and every 10,000 rows, and a Bloom filter on doc_id; so a reader takes
stripes in parallel and skips those without a wanted document.

Null doc_ids come first. Rows with one doc_id stay next to each other, ordered by a hash of their text. A null or empty
text has the end id alone. Extra columns are ignored. An empty table gives files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trialcohort.llm.common import stage
from trialcohort.llm.tokenizing import encoder, together

STRIPE_BYTES = 64 << 20
INDEX_ROWS = 10_000
FILTER_ERROR = 0.01
FILE_SCHEMA = "part int, ordinal long, doc_id long, ids array<int>"


def encoding(vocabulary: str, end: int, leading_blank: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, done = encoder(vocabulary, leading_blank), TaskContext.get().partitionId(), 0
        for batch in together(batches):
            ids, offsets = known.encode(batch.column("text"), end)
            n = batch.num_rows
            yield pa.record_batch(
                {
                    "part": pa.array(np.full(n, part, np.int32)),
                    "ordinal": pa.array(np.arange(done, done + n)),
                    "doc_id": batch.column("doc_id"),
                    "ids": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32))),
                }
            )
            done += n

    return run


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end: int = 1, leading_blank: bool = False) -> None:
    """Writes the files below `path`. Texts, not ids, are shuffled: each task sorts, encodes and writes a range of ids."""
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranges = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    ranges.mapInArrow(encoding(vocabulary, end, leading_blank), FILE_SCHEMA).write.options(
        **{
            "compression": "zstd",
            "orc.create.index": "true",
            "orc.row.index.stride": str(INDEX_ROWS),
            "orc.stripe.size": str(STRIPE_BYTES),
            "orc.bloom.filter.columns": "doc_id",
            "orc.bloom.filter.fpp": str(FILTER_ERROR),
        }
    ).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).orc(path)


def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        at = ids.offsets.to_numpy()
        flat = ids.values.to_numpy(zero_copy_only=False).astype("<u4")
        crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.record_batch(
            {
                "part": batch.column("part"),
                "ordinal": batch.column("ordinal"),
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(np.diff(at).astype(np.int64)),
                "ids_crc32": pa.array(np.array(crc, np.int64)),
            }
        )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Ids are counted within each file, then the files' totals are added up; only those few totals meet in one task.
    The files are read once: what both steps need is staged.
    """
    rows = stage(read_tokens(spark, path).mapInArrow(sums, "part int, ordinal long, doc_id long, n_tokens long, ids_crc32 long"), "index")
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("ordinal")) - F.col("n_tokens")
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = F.sum("total").over(Window.orderBy("part")) - F.col("total")
    files = files.select("part", before.alias("before"))
    rows = rows.withColumn("inside", inside).join(files, "part")
    return rows.select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
