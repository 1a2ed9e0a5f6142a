"""Benchmark decontamination by a prefix-filtered set join.

Benchmark items are cut into windows of WINDOW words (an item of fewer words is one window). A window is a set of
shingles of SHINGLE words, each with its place in the window. A text holds the window exactly only if it holds all its
shingles; so the necessary prefix is one shingle, and the rarest over all documents is joined. Bounds on length and
position (the window must lie within the text around the shingle) and then the words themselves decide.

One pass over the texts hashes every shingle and keeps those of the benchmark, each with the words around it. A Bloom
filter does the keeping; its size is bounded by a parameter, and hits that it lets through by mistake fall in the join.

Words are lower-cased (A-Z) runs of digits, letters a-z and characters beyond ASCII. A null or empty text has no words;
an item without words has no window. Equal rows count each for itself, items with one item_id count once. Rows with
a null item_id are left out. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from trialcohort.llm import textarrays as T
from trialcohort.llm.common import row_key, stage

WINDOW = 10
SHINGLE = 5
FILTER_BITS = 1 << 28  # at most; 32 MB
BITS_EACH = 16


def shingles(text: T.Words, window: int, shingle: int, lengths: list[int]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(size, starts, hashes) for the shingle size of whole windows and for items shorter than a shingle."""
    return [(n, *text.windows(n, salt=n)) for n in sorted({shingle, *(x for x in lengths if x < shingle)})]


def item_windows(window: int, shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (item_id, words, size, place, shingle): a window's words joined by blanks, their number, and each of its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                text = T.of(part, T.ALNUM, True)
                ids = part.column("item_id").to_pylist()
                rows = []
                for d, n in enumerate(text.counts.tolist()):
                    a, size = int(text.first[d]), min(n, window)
                    if not n:
                        continue
                    k = min(size, shingle)
                    names = dict(zip(*(x.tolist() for x in one_text(text, d).windows(k, salt=k)), strict=True))
                    for i in range(n - size + 1):
                        joined = b" ".join(text.word(a + i + j) for j in range(size)).decode()
                        rows += [(ids[d], joined, size, j, int(np.uint64(names[i + j]).astype(np.int64))) for j in range(size - k + 1)]
                if rows:
                    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64()]
                    columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=["item_id", "words", "size", "place", "shingle"])

    return run


def one_text(text: T.Words, d: int) -> T.Words:
    a, b = int(text.first[d]), int(text.first[d + 1])
    return T.Words(text.data, text.offsets[d : d + 2], text.starts[a:b], text.ends[a:b], np.zeros(b - a, np.int64), np.array([0, b - a]), text.hash[a:b])


def filter_places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(T.mixed(hashes, k) & T.U(bits - 1)).astype(np.int64) for k in (11, 12, 13)]


def seen_shingles(window: int, shingle: int, lengths: list[int], bits: int, held) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:  # noqa: ANN001
    """Rows (k1, k2, at, n_before, shingle, around): where a text may hold a shingle of the benchmark, and the words around."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, reach = np.frombuffer(held.value, np.uint8), window - shingle
        for batch in batches:
            for part in T.slices(batch):
                text = T.of(part, T.ALNUM, True)
                k1, k2 = (part.column(x).to_numpy() for x in ("k1", "k2"))
                for n, starts, hashes in shingles(text, window, shingle, lengths):
                    may = np.ones(len(hashes), bool)
                    for place in filter_places(hashes, bits):
                        may[may] = packed[place[may] >> 3] >> (place[may] & 7) & 1 > 0
                    at, found = starts[may], hashes[may]
                    if not len(at):
                        continue
                    doc = text.doc[at]
                    left = np.maximum(at - (reach if n == shingle else 0), text.first[doc])
                    right = np.minimum(at + n + (reach if n == shingle else 0), text.first[doc + 1])
                    around = [b" ".join(text.word(i) for i in range(a, b)).decode() for a, b in zip(left.tolist(), right.tolist(), strict=True)]
                    yield pa.record_batch(
                        {
                            "k1": pa.array(k1[doc]),
                            "k2": pa.array(k2[doc]),
                            "at": pa.array((at - text.first[doc]).astype(np.int32)),
                            "n_before": pa.array((at - left).astype(np.int32)),
                            "shingle": pa.array(found.view(np.int64)),
                            "around": pa.array(around, pa.string()),
                        }
                    )

    return run


def partial_filter(bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (word, held) of a bit array: each task's own, to be combined by or."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("shingle").to_numpy().view(np.uint64)
            places = np.concatenate(filter_places(hashes, bits))
            word, inverse = np.unique(places >> 6, return_inverse=True)
            held = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(held, inverse, T.U(1) << (places & 63).astype(np.uint64))
            yield pa.record_batch({"word": pa.array(word), "held": pa.array(held.view(np.int64))})

    return run


def shingle_filter(items: DataFrame, most_bits: int) -> tuple[int, bytes]:
    """A Bloom filter of the benchmark's shingles with BITS_EACH bits for each, `most_bits` at most."""
    names = items.select("shingle").distinct()
    n = names.count()
    bits = min(most_bits, max(1 << 10, 1 << (n * BITS_EACH).bit_length()))
    found = names.mapInArrow(partial_filter(bits), "word long, held long").groupBy("word").agg(F.bit_or("held").alias("held")).toPandas()
    whole = np.zeros(bits // 64, np.uint64)
    whole[found["word"].to_numpy(np.int64)] = found["held"].to_numpy(np.int64).view(np.uint64)
    return bits, whole.tobytes()


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, most_bits: int = FILTER_BITS) -> DataFrame:
    """Rows (k1, k2, start, size, item_id), each once: where a document holds a window of an item, exactly."""
    rows = items.filter(F.col("item_id").isNotNull()).select("item_id", "text").mapInArrow(item_windows(window, shingle), "item_id long, words string, size int, place int, shingle long")
    rows = stage(rows, "windows")
    lengths = [x["size"] for x in rows.filter(F.col("size") < shingle).select("size").distinct().collect()]
    bits, held = shingle_filter(rows, most_bits)
    shared = docs.sparkSession.sparkContext.broadcast(held)
    seen = docs.select(*row_key(), "text").mapInArrow(seen_shingles(window, shingle, lengths, bits, shared), "k1 long, k2 long, at int, n_before int, shingle long, around string")
    seen = stage(seen, "shingles")
    # rarity: the shingles' counts over all documents; a window whose shingle never occurs is nowhere
    count = seen.groupBy("shingle").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct("n", "shingle", "place")).alias("rarest")
    prefix = rows.join(count, "shingle", "left").withColumn("n", F.coalesce("n", F.lit(0))).groupBy("words", "size").agg(rarest)
    prefix = prefix.filter(F.col("rarest.n") > 0).select("words", "size", F.col("rarest.shingle").alias("shingle"), F.col("rarest.place").alias("place"))
    start = F.col("n_before") - F.col("place")
    held_words = F.array_join(F.slice(F.split("around", " "), start + 1, F.col("size")), " ")
    found = seen.join(prefix, "shingle").filter((start >= 0) & (F.col("words") == F.when(start >= 0, held_words)))
    places = found.select("k1", "k2", (F.col("at") - F.col("place")).alias("start"), "size", "words")
    names = rows.select("words", "size", "item_id").distinct()
    return places.join(names, ["words", "size"]).select("k1", "k2", "start", "size", "item_id")


@pandas_udf(LongType())
def covered(places: pd.Series) -> pd.Series:
    """How many words lie in any of the places (start, size)."""

    def size(rows: list) -> int:
        total = end = 0
        for a, n in sorted((x["start"], x["size"]) for x in rows):
            total += max(0, a + n - max(a, end))
            end = max(end, a + n)
        return total

    return places.map(lambda x: 0 if x is None else size(x))


@pandas_udf(LongType())
def n_words(texts: pd.Series) -> pd.Series:
    out = [T.of(x, T.ALNUM, True).counts for x in T.slices(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"]))]
    return pd.Series(np.concatenate(out) if out else np.empty(0, np.int64))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, most_bits: int = FILTER_BITS) -> DataFrame:
    """Per row of docs: k1, k2 (its key), doc_id, n_words, n_hit, items (ids with occurring windows, ascending), contaminated.

    Equal windows of one document are merged before its places are gathered; a document's places are at most its words.
    """
    found = hits(docs, items, window, shingle, most_bits)
    places = found.select("k1", "k2", "start", "size").distinct().groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "size")).alias("places"))
    ids = found.select("k1", "k2", "item_id").distinct().groupBy("k1", "k2").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    per_doc = places.join(ids, ["k1", "k2"]).select("k1", "k2", covered("places").alias("n_hit"), "items")
    rows = docs.select("doc_id", *row_key(), n_words("text").alias("n_words")).join(per_doc, ["k1", "k2"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    none = F.array().cast("array<bigint>")
    return rows.select("k1", "k2", "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("items", none).alias("items"), (n_hit > 0).alias("contaminated"))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The digest of decontaminate(): doc_id, n_words, n_hit, n_items, items_sha256 (of the ids sorted as strings), contaminated."""
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return decontaminate(docs, items).select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(names.cast("binary"), 256).alias("items_sha256"), "contaminated")
