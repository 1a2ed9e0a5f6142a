"""Packing by power-of-two decomposition: every document is cut into pieces of binary length, each a sequence of its own.

A document of n tokens gives n // 1024 pieces of 1024 and one piece for each one bit of the rest, longest first. Pieces
of one length form a bucket, from which batches without padding are drawn; no sequence crosses documents.

A sequence's id holds its bucket (the logarithm of the length) above bit 59 and its row's number below, so buckets are
ranges of ids; a task that runs again over the same files gives the same ids. A null or empty text has the end id alone.
Repeated rows are packed each for itself, a null doc_id is kept, extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialcohort.llm.tokenizing import encoder, together

LONGEST = 1024
SCHEMA = "doc_id long, start long, length long, bucket int, ids_crc32 long, doc_tokens long"


def binary_lengths(n: int, longest: int) -> list[int]:
    """n as a sum of powers of two up to `longest`, itself one: as many of the longest as fit, then the bits of the rest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def cutting(vocabulary: str, end: int, leading_blank: bool, longest: int, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(vocabulary, leading_blank)
        for part in together(batches):
            ids, offsets = known.encode(part.column("text"), end)
            sizes = np.diff(offsets)
            lengths = [binary_lengths(n, longest) for n in sizes.tolist()]
            doc = np.repeat(np.arange(len(sizes)), [len(x) for x in lengths])
            length = np.array([x for each in lengths for x in each], np.int64)
            cuts = np.concatenate([[0], np.cumsum(length)])
            data = ids.astype("<u4")
            crc = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
            out = {
                "doc_id": part.column("doc_id").take(pa.array(doc)),
                "start": pa.array(cuts[:-1] - offsets[doc]),
                "length": pa.array(length),
                "bucket": pa.array(np.log2(length).astype(np.int32)),
                "ids_crc32": pa.array(np.array(crc, np.int64)),
                "doc_tokens": pa.array(sizes[doc].astype(np.int64)),
            }
            if with_ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.record_batch(out)

    return run


def pack(docs: DataFrame, vocabulary: str, end: int = 0, leading_blank: bool = True, longest: int = LONGEST, with_ids: bool = True) -> DataFrame:
    """Per piece: doc_id, start (its document's ids before it), length, bucket, ids_crc32, doc_tokens, sequence_id, offset (0), and its ids.

    `with_ids` set to false leaves the ids out, for a plan of the packing alone. No row is shuffled.
    """
    schema = SCHEMA + ", ids array<int>" * with_ids
    pieces = docs.select("doc_id", "text").mapInArrow(cutting(vocabulary, end, leading_blank, longest, with_ids), schema)
    number = F.shiftleft(F.col("bucket").cast("long"), 59).bitwiseOR(F.monotonically_increasing_id())
    return pieces.withColumns({"sequence_id": number, "offset": F.lit(0).cast("long")})
