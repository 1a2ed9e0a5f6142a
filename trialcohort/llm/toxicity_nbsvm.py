"""Toxicity by a linear classifier over character n-grams whose features are scaled by naive Bayes log-count ratios.

A text is lower-cased (A-Z) and its runs of white space become one blank; its features are the hashed n-grams of its
UTF-8 bytes, each counted once. A feature's value is r = log((pos + 1) / (n_pos + 2)) - log((neg + 1) / (n_neg + 2)) from the
numbers of toxic and other texts with it, and a regularised logistic regression over these values weighs them.

Labels: a document is toxic if any of its label rows says 1; rows without doc_id or toxic don't count. The fit uses a
sample of at most about SAMPLE texts of each kind, picked by a hash of doc_id (where rows share a doc_id, the text with
the least hash stands for all), and the FEATURES most telling n-grams;
both bounds are parameters. Every document is scored over its whole text. Without toxic labels every score is 0, without
others 1. A null or empty text has no feature and gets the score of the intercept. Repeated rows are scored each for
itself. Languages, sources and ids are never features.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from trialcohort.llm import textarrays as T
from trialcohort.llm.common import id_remainder, stage

ORDERS = (4, 5, 6)
BITS = 20
SAMPLE = 5_000
FEATURES = 8_192
SEEN_IN = 3  # n-grams in fewer sampled texts aren't features
PENALTY = 1.0
STEPS = 300


def features(batch: pa.RecordBatch, orders: tuple[int, ...], bits: int, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (text, feature), each once. keep: booleans by feature."""
    data, offsets = T.raw(batch.column("text"))
    words = T.words(data, offsets, T.SOLID, False)
    # each word with one blank before it, each text with one more behind
    size = words.ends - words.starts
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    total = int(begin[-1])
    out = np.full(total, 0x20, np.uint8)
    solid = np.ones(total, bool)
    solid[begin[:-1]] = False
    inside = np.repeat(words.starts - begin[:-1] - 1, size + 1) + np.arange(total)
    out[solid] = T.LOWER[data[inside[solid]]]
    doc = np.repeat(words.doc, size + 1)
    value = T.mixed(np.arange(256, dtype=np.uint64))[out]
    pairs = []
    for n in orders:
        at, key = T.windows(value, doc, n)
        place = (key ^ T.U(n)) >> T.U(64 - bits)
        found = doc[at].astype(np.uint64)
        if keep is not None:
            mine = keep[place]
            found, place = found[mine], place[mine]
        pairs.append((found << T.U(bits)) | place)
    unique = np.unique(np.concatenate(pairs))
    return (unique >> T.U(bits)).astype(np.int64), (unique & T.U((1 << bits) - 1)).astype(np.int64)


def counting(orders: tuple[int, ...], bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((2, 1 << bits), np.int32)
        for batch in batches:
            for part in T.slices(batch):
                toxic = part.column("toxic").to_numpy(zero_copy_only=False)
                text, place = features(part, orders, bits)
                for k in (0, 1):
                    np.add(held[k], np.bincount(place[toxic[text] == k], minlength=1 << bits), out=held[k], casting="unsafe")
        found = np.flatnonzero(held.sum(0))
        for a in range(0, len(found), 100_000):
            at = found[a : a + 100_000]
            yield pa.record_batch({"feature": pa.array(at), "pos": pa.array(held[1, at].astype(np.int64)), "neg": pa.array(held[0, at].astype(np.int64))})

    return run


def listing(orders: tuple[int, ...], bits: int, chosen: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.zeros(1 << bits, bool)
        keep[chosen] = True
        for batch in batches:
            for part in T.slices(batch):
                text, place = features(part, orders, bits, keep)
                at = np.searchsorted(text, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.record_batch({"toxic": part.column("toxic"), "features": pa.ListArray.from_arrays(pa.array(at), pa.array(place.astype(np.int32)))})

    return run


@dataclass
class Model:
    """The weight of each feature that counts, and the intercept."""

    orders: tuple[int, ...]
    bits: int
    chosen: np.ndarray
    weights: np.ndarray
    intercept: float


def logistic(row: np.ndarray, column: np.ndarray, value: np.ndarray, y: np.ndarray, n: int, penalty: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression with an L2 penalty, both kinds weighted alike, by accelerated gradient descent."""
    m = len(y)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    x = np.zeros(n + 1)
    ahead, before = x.copy(), x.copy()
    square = max(1.0, float(np.max(np.bincount(row, value * value, minlength=m), initial=0)) + 1)
    pull = penalty / m
    rate = 1 / (0.25 * square + pull)
    for k in range(steps):
        margin = np.bincount(row, value * ahead[column], minlength=m) + ahead[n]
        wrong = share * (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - y)
        slope = np.append(np.bincount(column, value * wrong[row], minlength=n) + pull * ahead[:n], wrong.sum())
        before, x = x, ahead - rate * slope
        ahead = x + k / (k + 3) * (x - before)
    return x[:n], float(x[n])


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, orders: tuple[int, ...] = ORDERS, bits: int = BITS, sample: int = SAMPLE, chosen: int = FEATURES, penalty: float = PENALTY, steps: int = STEPS) -> Model:
    """The model of a sample of the labelled documents. usable: a condition on doc_id that label rows must meet.

    What reaches the driver is bounded by the parameters: labels of 2 * sample ids to broadcast, `chosen` counts, and
    the chosen features of 2 * sample texts. Rows that share a picked doc_id are reduced to one text before any of that.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = (known if usable is None else known.filter(usable)).groupBy("doc_id").agg((F.max("toxic") >= 1).cast("int").alias("toxic"))
    n = {x["toxic"]: x["n"] for x in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Model(orders, bits, np.empty(0, np.int64), np.empty(0), np.inf if n.get(1) else -np.inf)
    chance = F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(1 << 30))
    limit = F.when(F.col("toxic") == 1, min(1, sample / n[1])).otherwise(min(1, sample / n[0])) * (1 << 30)
    picked = F.broadcast(known.filter(chance < limit))
    rows = docs.select("doc_id", "text").join(picked, "doc_id")
    texts = stage(rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("toxic").alias("toxic")).select("text", "toxic"), "toxic")
    n = {x["toxic"]: x["n"] for x in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):  # labels without their documents
        return Model(orders, bits, np.empty(0, np.int64), np.empty(0), np.inf if n.get(1) else -np.inf)
    ratio = F.log((F.col("pos") + 1) / F.lit(n.get(1, 0) + 2)) - F.log((F.col("neg") + 1) / F.lit(n.get(0, 0) + 2))
    counts = texts.mapInArrow(counting(orders, bits), "feature long, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    counts = counts.filter(F.col("pos") + F.col("neg") >= SEEN_IN).withColumn("r", ratio)
    telling = F.abs("r") * F.sqrt(F.col("pos") + F.col("neg"))
    top = counts.orderBy(telling.desc(), "feature").limit(chosen).select("feature", "r").toPandas().sort_values("feature")
    places, r = top["feature"].to_numpy(np.int64), top["r"].to_numpy(float)
    rows = texts.mapInArrow(listing(orders, bits, places), "toxic int, features array<int>").toArrow()
    lists = rows.column("features").combine_chunks()
    size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    column = np.searchsorted(places, lists.flatten().to_numpy(zero_copy_only=False))
    weights, intercept = logistic(np.repeat(np.arange(len(size)), size), column, r[column], rows.column("toxic").to_numpy().astype(float), len(r), penalty, steps)
    return Model(orders, bits, places, weights * r, intercept)


def scoring(model: Model, columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep, weight = np.zeros(1 << model.bits, bool), np.zeros(1 << model.bits)
        keep[model.chosen], weight[model.chosen] = True, model.weights
        for batch in batches:
            for part in T.slices(batch):
                text, place = features(part, model.orders, model.bits, keep)
                margin = np.bincount(text, weight[place], minlength=part.num_rows) + model.intercept
                with np.errstate(over="ignore"):  # infinity gives 0, as it should
                    found = 1 / (1 + np.exp(-margin))
                yield pa.record_batch({**{x: part.column(x) for x in columns}, "score": pa.array(found)})

    return run


def score(docs: DataFrame, model: Model, carry: list[str] | None = None) -> DataFrame:
    """Columns `carry` of docs (all by default) and score, 0 to 1."""
    carry = [x for x in (docs.columns if carry is None else carry) if x != "score"]
    needed = docs.select(*dict.fromkeys([*carry, "text"]))
    schema = StructType([needed.schema[x] for x in carry] + [StructField("score", DoubleType())])
    return needed.mapInArrow(scoring(model, carry), schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out (crc32 of doc_id as text, modulo 5, is 0; its label isn't learned), score, predicted."""
    model = fit(docs, labels, id_remainder() != 0)
    held_out, predicted = id_remainder() == 0, (F.col("score") >= 0.5).cast("int")
    return score(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))
