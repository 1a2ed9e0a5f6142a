"""Line dedup by overlapping windows of three lines.

A text is cut into lines at each newline. Every three consecutive lines are a window, known by two 64-bit hashes, each made
of another hash of every line, so lines that one hash takes for equal are told apart by the other; a window found
more than once in all documents stays where it comes first, by (doc_id, a hash of the text, place), and each later
occurrence loses its lines. Later occurrences that overlap are merged: a line goes if any of them covers it. Windows of
blank lines alone don't count.

A null text has no lines, an empty one a single empty line; texts of fewer than three lines have no window. A null
doc_id counts as 0 in the order. Rows equal in doc_id and text can't be told apart: they are one document and come out
alike. Extra columns pass through, but for those named as what is added here (OWN).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from trialcohort.llm import textarrays as T
from trialcohort.llm.common import row_key, stage
from trialcohort.operators.joins import fresh

LINES = 3
OWN = ("n_lines", "n_removed", "_k1", "_k2", "_places")


def line_names(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray], np.ndarray]:
    """For each line: its text's index, its place, its two hashes, and whether it is blank."""
    n = len(offsets) - 1
    cut = np.flatnonzero(data == 0x0A)
    doc = np.concatenate([np.arange(n), np.searchsorted(offsets[1:], cut, side="right")])
    starts = np.concatenate([offsets[:-1], cut + 1])
    order = np.lexsort((starts, doc))  # a newline that ends a text opens an empty line there, not in the next text
    doc, starts = doc[order], starts[order]
    ends = np.append(starts[1:] - 1, 0)
    closes = np.append(doc[1:] != doc[:-1], True)
    ends[closes] = offsets[1:][doc[closes]]
    solid = np.concatenate([[0], np.cumsum(T.SOLID[data], dtype=np.int64)])
    first = np.searchsorted(doc, np.arange(n))
    return doc, np.arange(len(doc)) - first[doc], (T.hashes(data, starts, ends), T.second_hashes(data, starts, ends)), solid[ends] == solid[starts]


def line_windows(lines: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                doc, place, names, blank = line_names(*T.raw(part.column("text")))
                at, one = T.windows(T.mixed(names[0], 1), doc, lines)
                _, two = T.windows(T.mixed(names[1], 2), doc, lines)
                solid = np.zeros(len(at), bool)
                for k in range(lines):
                    solid |= ~blank[at + k]
                at, one, two = at[solid], one[solid], two[solid]
                k1, k2 = (part.column(x).to_numpy() for x in ("k1", "k2"))
                yield pa.record_batch(
                    {
                        "h1": pa.array(one.view(np.int64)),
                        "h2": pa.array(two.view(np.int64)),
                        "k1": pa.array(k1[doc[at]]),
                        "k2": pa.array(k2[doc[at]]),
                        "at": pa.array(place[at].astype(np.int32)),
                    }
                )

    return run


def removing(lines: int, columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def kept(text: str | None, places: list[int] | None) -> tuple[str | None, int, int]:
        if text is None:
            return None, 0, 0
        if not places:
            return text, text.count("\n") + 1, 0
        found = text.split("\n")
        gone = {a + k for a in places for k in range(lines)}
        return "\n".join(x for i, x in enumerate(found) if i not in gone), len(found), len(gone)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [kept(*x) for x in zip(batch.column("text").to_pylist(), batch.column("_places").to_pylist(), strict=True)]
            out = {x: batch.column(x) for x in columns}
            out["text"] = pa.array([x[0] for x in rows], pa.string())
            yield pa.record_batch({**out, "n_lines": pa.array([x[1] for x in rows], pa.int64()), "n_removed": pa.array([x[2] for x in rows], pa.int64())})

    return run


def repeated_line_windows(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """Rows (k1, k2, at), each once: later occurrences of windows.

    The first place and the number of occurrences are combined before the shuffle, so a window that a third of all
    documents holds is a few rows; the join back meets one row a window, shuffled anew so that adaptive execution can
    split a window's many places.
    """
    rows = stage(docs.select(*row_key(), "text").mapInArrow(line_windows(lines), "h1 long, h2 long, k1 long, k2 long, at int"), "lines")
    place = F.struct("k1", "k2", "at")
    repeated = rows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first != last").drop("last")
    repeated = repeated.withColumn("h1", fresh(F.col("h1")))
    return rows.join(repeated, ["h1", "h2"]).filter(place != F.col("first")).select("k1", "k2", "at")


def line_dedup(docs: DataFrame, lines: int = LINES, carry: list[str] | None = None) -> DataFrame:
    """Columns `carry` of docs (all by default) with text cut, n_lines (before) and n_removed. A document's places are at most its lines."""
    carry = [x for x in (docs.columns if carry is None else carry) if x not in OWN]
    needed = list(dict.fromkeys([*carry, "text"]))
    places = repeated_line_windows(docs, lines).groupBy("k1", "k2").agg(F.collect_set("at").alias("_places"))
    # places grow with the documents, so they are merged, not broadcast, at any size
    places = stage(places, "places").select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "_places")
    k1, k2 = row_key()
    keyed = docs.select(*needed, k1.alias("_k1"), k2.alias("_k2")).join(places.hint("merge"), ["_k1", "_k2"], "left")
    schema = StructType([docs.schema[x] for x in needed] + [StructField("n_lines", LongType()), StructField("n_removed", LongType())])
    return keyed.mapInArrow(removing(lines, needed), schema)


def line_digest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, kept_sha256 (of what is left, null: empty)."""
    rows = line_dedup(docs.select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
