"""How document filters overlap: what each removes in every order in which they may be applied.

A document's failures are a bit mask. A mask matrix holds 0 where a mask's document fails a filter and no number (a very
large one) elsewhere; a position matrix holds, for each order, every filter's step, which is the order's inverse
permutation. Their min-plus product is the step at which each order removes each mask's documents. Counts of documents by
mask, scattered to those steps, give what is removed, kept and lost; a failure whose filter comes later is redundant.

Filters: A under MIN_WORDS words (runs of anything but ASCII white space); B less than half of the words distinct; C more
than 3 of 100 characters are A-Z; D a character of SIGNS; E the text of a smaller doc_id, removed or not.

Only (part, mask, labels) counts leave the documents, combined within tasks, so neither a language nor a text that a third
of all documents share gathers anywhere. A null text is empty, a null lang is the part ''. A null doc_id is smaller than
none and has no label. Rows that repeat a doc_id count each; labels that repeat or contradict are merged, 1 wins. Words of
a very long text are split in blocks: memory holds the text and its distinct words. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialcohort.llm.common import stage
from trialcohort.llm.textarrays import slices
from trialcohort.llm.wordblocks import as_bytes, word_blocks

FILTERS = "ABCDE"
MIN_WORDS = 200
SIGNS = b"#$%&*|"
UPPER = bytes(range(0x41, 0x5B))
FOLLOWING = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no character
NEVER = 1 << 20


def text_mask(data: bytes) -> int:
    """Failures of A to D as bits, A the lowest."""
    n, distinct = 0, set()
    for words in word_blocks(data):
        n += len(words)
        distinct.update(words)
    upper = len(data) - len(data.translate(None, UPPER))
    characters = len(data.translate(None, FOLLOWING))
    signs = len(data) - len(data.translate(None, SIGNS))
    return (n < MIN_WORDS) | (100 * len(distinct) < 50 * n) << 1 | (100 * upper > 3 * characters) << 2 | (signs > 0) << 3


def measuring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, part, mask, digest): failures of A to D and a 128-bit digest of the text."""
    for batch in batches:
        for piece in slices(batch):
            texts = as_bytes(piece.column("text"))
            yield pa.record_batch(
                {
                    "doc_id": piece.column("doc_id"),
                    "part": piece.column("part"),
                    "mask": pa.array(map(text_mask, texts), pa.int32()),
                    "digest": pa.array([hashlib.blake2b(x, digest_size=16).digest() for x in texts], pa.binary()),
                }
            )


def failures(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, part (its lang), mask (bits of the failing filters, A the lowest)."""
    texts = docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("part"))
    rows = stage(texts.mapInArrow(measuring, "doc_id long, part string, mask int, digest binary"), "failures")
    copied = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")).filter("rows > 1")
    # staged, so that the join's shuffles are fresh ones and a text that very many documents share is split
    rows = rows.join(stage(copied.select("digest", "least"), "copied"), "digest", "left")
    later = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).cast("int")
    return rows.select("doc_id", "part", F.col("mask").bitwiseOR(F.shiftleft(later, 4)).alias("mask"))


def mask_counts(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, documents, good, toxic): documents with exactly these failures, and those of them labelled quality 1, toxic 1."""
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0))
    known = labels.groupBy("doc_id").agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    known = stage(known.filter("doc_id is not null and (good = 1 or toxic = 1)"), "labels")
    rows = failed.join(known, "doc_id", "left")
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("good", "toxic")]
    return rows.groupBy("part", "mask").agg(F.count("*").alias("documents"), *sums)


@cache
def positions(n: int) -> np.ndarray:
    """Orders x filters: the step of each filter, from 1, in every order of n filters."""
    return np.argsort(np.array(list(permutations(range(n)))), axis=1) + 1


def min_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least sum of a row of a and a row of b, for all pairs of rows."""
    return (a[:, None, :] + b[None, :, :]).min(axis=2)


@cache
def removal_steps(n: int) -> np.ndarray:
    """Masks x orders: the step that removes a mask's documents; n + 1 for those that fail nothing."""
    fails = np.arange(1 << n)[:, None] >> np.arange(n) & 1
    return np.minimum(min_plus(np.where(fails == 1, 0, NEVER), positions(n)), n + 1)


def scattered(steps: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Orders x steps x columns: sums of the masks' weights (masks x columns) at their steps; the last step holds what stays."""
    out = np.zeros((steps.shape[1], n + 2, weights.shape[1]), np.int64)
    np.add.at(out, (np.arange(steps.shape[1])[None, :], steps), weights[:, None, :])
    return out[:, 1:]


def part_counts(weights: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """The audit of one part as arrays of orders x steps. weights: masks x (documents, good, toxic)."""
    place, steps = positions(n), removal_steps(n)
    out = scattered(steps, weights, n)
    removed = out[:, :n, 0]
    redundant = np.zeros_like(removed)
    orders, masks = np.arange(len(place)), np.arange(1 << n)
    for f in range(n):
        late = (masks[:, None] >> f & 1 == 1) & (place[None, :, f] > steps)
        redundant[orders, place[:, f] - 1] = (late * weights[:, :1]).sum(axis=0)
    by_filter = np.argsort(place, axis=1)  # the filter of each step
    shapley = np.bincount(by_filter.ravel(), minlength=n) * 0
    np.add.at(shapley, by_filter, removed)
    return {
        "kept": weights[:, 0].sum() - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": redundant,
        "unique_fails": weights[1 << by_filter, 0],
        "good_lost": out[:, :n, 1],
        "toxic_lost": out[:, :n, 2],
        "shapley": shapley[by_filter],
    }


def auditing(names: str):  # noqa: ANN201
    """Rows of the audit from rows (part, cells), cells a list of (mask, documents, good, toxic)."""
    n = len(names)
    orders = ["".join(x) for x in permutations(names)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, cells in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                weights = np.zeros((1 << n, 3), np.int64)
                for x in cells:
                    weights[x["mask"]] = x["documents"], x["good"], x["toxic"]
                found = part_counts(weights, n)
                yield pa.record_batch(
                    {
                        "part": pa.array([part] * (n * len(orders)), pa.string()),
                        "filter_order": pa.array(np.repeat(orders, n).tolist(), pa.string()),
                        "step": pa.array(np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders))),
                        **{k: pa.array(x.ravel().astype(np.int64)) for k, x in found.items()},
                    }
                )

    return run


AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def interaction(counts: DataFrame, names: str = FILTERS) -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    counts: (part, mask, documents, good, toxic), one row for each mask of a part, so at most 2 ** filters rows meet.
    """
    cells = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "documents", "good", "toxic")).alias("cells"))
    return cells.mapInArrow(auditing(names), AUDIT)


def filter_interaction(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """interaction() of the filters A to E on docs (doc_id, text, lang), with labels (doc_id, quality, toxic)."""
    return interaction(mask_counts(failures(docs), labels))
