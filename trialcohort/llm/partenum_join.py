"""Jaccard join of documents on word shingles by PartEnum signatures.

A document's set holds the hashes of its distinct shingles of SHINGLE words (all its words as one if it has fewer); words are
runs of anything but ASCII white space, A-Z lower-cased. Two sets are linked when their intersection has at least `percent`
of 100 of their union; then they differ in at most k = 2 r (100 - percent) / (100 + percent) members, r the larger size.

Sizes are cut into bands. In a band whose sets differ in at most k members, the domain of hashes is cut into n1 parts, and
each part into n2 pieces: of two linked sets some part differs in at most k / n1 members, so of its n2 pieces all but
k2 = k // n1 agree. Every choice of n2 - k2 pieces of a part is enumerated, and what a set holds of them is hashed: linked
sets share a signature for certain. A set that may have a partner in the next band is signed for that one too.

Equal sets form one class, so copies cost one row each. Links are confirmed on full sets, with `linking`. A document without
words or with a null text is linked with nothing. Rows equal in doc_id and text are linked like any copies. A null doc_id
takes part in links but names no component unless nothing else can. Memory holds one text's set and signatures, about ten
times its bytes, and blocks of sets beside. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialcohort.llm import textarrays as T
from trialcohort.llm.common import row_key, stage, stage_few
from trialcohort.llm.linking import linked_roots, shingle_sets

SHINGLE, PERCENT = 3, 90
PIECES = 3  # second-level pieces of a part, where sets may differ at all


@cache
def band_starts(percent: int, largest: int = 1 << 40) -> np.ndarray:
    """The least size of each band.

    Bands grow by a quarter, or by as much as linked sizes may differ where that is more, so no link skips a band.
    """
    starts = [1]
    while starts[-1] <= largest:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * 5 // 4), starts[-1] * 100 // percent + 1 if percent < 80 else 0))
    return np.array(starts)


def partition_numbers(k: int) -> tuple[int, int, int]:
    """n1 parts, n2 pieces of each, and k2, the pieces that may differ in some part of two sets that differ in k members."""
    n1 = (k + 2) // 2
    return (1, 1, 0) if k == 0 else (n1, PIECES, k // n1)


def set_signatures(names: np.ndarray, band: int, most: int, percent: int) -> np.ndarray:
    """Signatures of one set in a band of sets of at most `most` members."""
    n1, n2, k2 = partition_numbers(2 * most * (100 - percent) // (100 + percent))
    spread = T.mixed(names, 61)
    cell = (spread % T.U(n1 * n2)).astype(np.int64)
    order = np.argsort(cell, kind="stable")
    sums = np.zeros(len(names) + 1, np.uint64)
    np.cumsum(T.mixed(names[order], 62), out=sums[1:])  # modulo 2**64, in any order
    at = np.searchsorted(cell[order], np.arange(n1 * n2 + 1))
    held = (sums[at[1:]] - sums[at[:-1]]).reshape(n1, n2)
    part = np.arange(n1, dtype=np.uint64) + T.U(band << 40)
    out = []
    for i, pieces in enumerate(combinations(range(n2), n2 - k2)):
        out.append(T.mixed(T.mixed(part, 63 + i) ^ held[:, list(pieces)].sum(axis=1, dtype=np.uint64), 64))
    return np.concatenate(out)


def signatures(names: np.ndarray, percent: int) -> np.ndarray:
    """All signatures of a set: those of its own band, and of the next one if a linked set may lie there."""
    n = len(names)
    starts = band_starts(percent)
    band = int(np.searchsorted(starts, n, side="right")) - 1
    bands = [band] + [band + 1] * (100 * n >= percent * int(starts[band + 1]))
    return np.concatenate([set_signatures(names, b, int(starts[b + 1]) - 1, percent) for b in bands])


def signing(shingle: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (doc_id, k1, k2, n, cls, keys): size of the set, a 128-bit digest of it, its signatures; null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                names, begin = shingle_sets(T.of(part, T.SOLID, True), shingle)
                sets = [names[a:b] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
                keys = [signatures(x, percent) if len(x) else np.empty(0, np.uint64) for x in sets]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in keys])]).astype(np.int32)
                flat = np.concatenate([*keys, np.empty(0, np.uint64)])
                yield pa.record_batch(
                    {
                        **{x: part.column(x) for x in ("doc_id", "k1", "k2")},
                        "n": pa.array(np.diff(begin).astype(np.int64)),
                        "cls": pa.array([hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets], pa.binary()),
                        "keys": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64))),
                    }
                )

    return run


def jaccard_join(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, class_id (equal sets; null: empty set), component_id (the least doc_id that links reach, its own included)."""
    keyed = docs.select("doc_id", *row_key(), "text")
    signed = stage(keyed.mapInArrow(signing(shingle, percent), "doc_id long, k1 long, k2 long, n long, cls binary, keys array<long>"), "signed")
    full = signed.filter(F.col("cls").isNotNull())
    classes = full.groupBy("cls").agg(F.min("doc_id").alias("id"), F.min(F.struct("k1", "k2")).alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"))
    classes = stage(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    members = classes.select("cid", "n", F.explode("keys").alias("key"))
    roots = linked_roots(members, classes.select("cid", "rep.k1", "rep.k2"), keyed.select("k1", "k2", "text"), shingle, percent)
    of = classes.select("cls", "cid", "id").join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    of = stage(of, "roots")
    names = stage_few(of.groupBy("root").agg(F.min("id").alias("component_id")), "names")
    of = stage(of.join(names, "root").select("cls", F.col("cid").alias("class_id"), "component_id"), "components")
    out = signed.drop("keys").join(of, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "class_id", component.alias("component_id"))
