"""Near duplicates by circulant MinHash.

A document's set holds the hashes of its distinct shingles of SHINGLE words (all its words as one if it has fewer); words
are runs of anything but ASCII white space, A-Z lower-cased. Two permutations of the numbers below 2**32 give all
coordinates of its signature: the first scatters the set, the second, shifted by k around the circle, gives coordinate k as
the least number it reaches. Coordinates are cut into BANDS bands of ROWS; with 32 bands of 4 rows two sets of similarity 0.8
share no band once in twenty million pairs.

Documents with equal sets form one class, so copies cost one row each and are linked by their set. Classes that share a
band are candidates; `linking` confirms their links on full sets and joins what is linked to components.

A document without words or with a null text has an empty set, linked with nothing. Rows equal in doc_id and text are
linked like any copies. A null doc_id takes part in links but names no component unless nothing else can; it is kept only
then. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialcohort.llm import textarrays as T
from trialcohort.llm.common import row_key, stage, stage_few
from trialcohort.llm.linking import linked_roots, shingle_sets, with_roots

SHINGLE = 5
BANDS, ROWS = 32, 4
PERCENT = 80
HELD = 16_384


def second(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """The second permutation of 32-bit numbers, in place; spare: room for as many."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        np.right_shift(x, np.uint32(shift), out=spare)
        x ^= spare
        if factor > 1:
            x *= np.uint32(factor)
    return x


def signatures(names: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """A row of `size` coordinates for each non-empty set."""
    first = (T.mixed(names, 41) >> T.U(32)).astype(np.uint32) * np.uint32(0x9E3779B1)
    first ^= first >> np.uint32(15)
    heads = begin[:-1][np.diff(begin) > 0]
    out = np.empty((len(heads), size), np.uint32)
    i = 0
    while i < len(heads):
        # sets of about HELD numbers at a time, or a larger one, so that the numbers stay in a core's cache
        j = max(i + 1, int(np.searchsorted(heads, heads[i] + HELD)))
        own = first[heads[i] : heads[j] if j < len(heads) else len(first)]
        moved, spare, at = np.empty_like(own), np.empty_like(own), heads[i:j] - heads[i]
        for k in range(size):
            np.add(own, np.uint32(k), out=moved)
            np.minimum.reduceat(second(moved, spare), at, out=out[i:j, k])
        i = j
    return out


def signing(shingle: int, bands: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (doc_id, k1, k2, n, cls, keys): size of the set, a 128-bit digest of it, and a key for each band; null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                names, begin = shingle_sets(T.of(part, T.SOLID, True), shingle)
                size = np.diff(begin)
                full = size > 0
                keys = np.zeros((len(size), bands), np.uint64)
                if full.any():
                    sign = signatures(names, begin, bands * rows).reshape(-1, bands, rows).astype(np.uint64)
                    key = np.broadcast_to(np.arange(bands, dtype=np.uint64), sign.shape[:2])
                    for k in range(rows):
                        key = T.mixed(key ^ sign[:, :, k], 42 + k)
                    keys[full] = key
                cls = [hashlib.blake2b(names[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
                yield pa.record_batch(
                    {
                        **{x: part.column(x) for x in ("doc_id", "k1", "k2")},
                        "n": pa.array(size.astype(np.int64)),
                        "cls": pa.array(cls, pa.binary()),
                        "keys": pa.ListArray.from_arrays(pa.array(np.arange(0, (len(size) + 1) * bands, bands, dtype=np.int32)), pa.array(keys.view(np.int64).ravel())),
                    }
                )

    return run


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row of docs: k1, k2 (its key), doc_id, n_shingles, group_id (null: empty set), component_id (the least doc_id that links reach, its own included), kept.

    Equal sets, bands and components are combined by aggregates with partial results, so copies never meet in one task.
    A component keeps one document, the one it is named after.
    """
    keyed = docs.select("doc_id", *row_key(), "text")
    signed = stage(keyed.mapInArrow(signing(shingle, bands, rows), "doc_id long, k1 long, k2 long, n long, cls binary, keys array<long>"), "signed")
    full = signed.filter(F.col("cls").isNotNull())
    classes = full.groupBy("cls").agg(F.min("doc_id").alias("id"), F.min(F.struct("k1", "k2")).alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    classes = stage(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = classes.select("cid", "n", F.explode("keys").alias("key"))
    roots = linked_roots(members, classes.select("cid", "rep.k1", "rep.k2"), keyed.select("k1", "k2", "text"), shingle, percent)
    roots = stage(with_roots(classes.select("cid", "cls", "id"), roots), "roots")
    names = stage_few(roots.groupBy("root").agg(F.min("id").alias("component_id")), "names")
    of = roots.join(names, "root").select("cls", F.col("root").alias("group_id"), "component_id")
    out = signed.drop("keys").join(of, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("k1", "k2", "doc_id", F.col("n").alias("n_shingles"), "group_id", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicate_digest(docs: DataFrame) -> DataFrame:
    """near_duplicates() on shingles of four words: doc_id, n_shingles, component_id, kept."""
    return near_duplicates(docs, shingle=4).select("doc_id", "n_shingles", "component_id", "kept")
