"""Quality rules by distribution divergence.

Two histograms of each document are compared with those of all documents of its language, by Jensen-Shannon distance
(root of the divergence to base 2, 0 to 1): classes of characters, and common words. Lengths guard the comparisons: a
text too short for a steady histogram isn't judged by it, and a language with too little text gives no reference.

The common words of a language are its COMMON most frequent words (letters and digits, A-Z lower-cased; ties by hash),
counted over all its documents; a last bin holds all other words. The reference share of a class of characters is the
median of the shares in all documents of the language that are long enough to be judged: neither a few very long
documents nor a minority of junk moves it.

A null language is a language of its own. A null or empty text has no words and fails the base rules. Repeated rows
count and are judged each for itself; extra columns pass through, but for those named as a measure or beginning with _ref_.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from trialcohort.llm import textarrays as T
from trialcohort.llm.common import stage

COMMON = 50
MIN_CHARS, MIN_WORDS = 200, 100  # shorter texts aren't judged by characters, by words
STEADY_CHARS = 1000  # below, the limit grows with the root of the missing length, as sampling noise does
MIN_DOCS = 20  # languages with fewer documents give no reference
MAX_CLASS, MAX_WORD = 0.20, 0.42
BASE_WORDS, BASE_REPEAT = 10, 20
WINDOW = 5

# classes of bytes: lower-case, upper-case, digit, white space, sentence marks, other signs, first bytes beyond ASCII; the
# last class (bytes that go on a character) counts nothing
CLASSES = 7
KIND = np.full(256, 5, np.int64)
KIND[0x61:0x7B], KIND[0x41:0x5B], KIND[0x30:0x3A] = 0, 1, 2
KIND[[0x20, 9, 10, 11, 12, 13]] = 3
KIND[list(b".,;:!?'\"()-")] = 4
KIND[0x80:], KIND[0x80:0xC0] = 6, 7
# what a byte counts for: the classes, then signs, then characters of words (first bytes but white space)
COUNTS_FOR = np.zeros((256, CLASSES + 2), np.int64)
COUNTS_FOR[np.arange(256)[KIND < CLASSES], KIND[KIND < CLASSES]] = 1
COUNTS_FOR[list(b"#*$%&|<>"), CLASSES] = 1
COUNTS_FOR[T.SOLID & (KIND < CLASSES), CLASSES + 1] = 1
TEXTS = 4_096  # whose bytes are counted at a time


def per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values between the offsets."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def byte_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row for each text, a column for each of COUNTS_FOR."""
    n, at = len(offsets) - 1, offsets.tolist()
    out = np.empty((n, CLASSES + 2), np.int64)
    for i in range(0, n, TEXTS):
        j = min(n, i + TEXTS)
        held = np.empty((j - i, 256), np.int64)
        for k in range(i, j):
            held[k - i] = np.bincount(data[at[k] : at[k + 1]], minlength=256)
        out[i:j] = held @ COUNTS_FOR
    return out


def class_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row for each text, a column for each class."""
    return byte_counts(data, offsets)[:, :CLASSES]


def languages(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str | None]]:
    found = batch.column("lang").dictionary_encode()
    code = found.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    names = [*found.dictionary.to_pylist(), None]
    return np.where(code < 0, len(names) - 1, code), names


def corpus_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, word hash, count) and, for each document that is long enough, without a hash, its share of each class."""
    held: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            hashes, inverse = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
            n = np.bincount(inverse, np.concatenate([x for _, x in parts])).astype(np.int64)
            for a in range(0, len(hashes), 100_000):
                m = len(hashes[a : a + 100_000])
                yield pa.record_batch({"lang": pa.array([lang] * m, pa.string()), "word": pa.array(hashes[a : a + m].view(np.int64)), "n": pa.array(n[a : a + m]), "shares": pa.nulls(m, pa.list_(pa.float64()))})
        held.clear()

    for batch in batches:
        for part in T.slices(batch):
            code, names = languages(part)
            text = T.of(part, T.ALNUM, True)
            data, offsets = T.raw(part.column("text"))
            counts = class_counts(data, offsets)
            judged = np.flatnonzero(counts.sum(1) >= MIN_CHARS)
            shares = counts[judged] / counts[judged].sum(1, keepdims=True)
            m = len(judged)
            yield pa.record_batch({"lang": part.column("lang").take(pa.array(judged)), "word": pa.nulls(m, pa.int64()), "n": pa.array(np.ones(m, np.int64)), "shares": pa.ListArray.from_arrays(pa.array(np.arange(0, m * CLASSES + 1, CLASSES, dtype=np.int32)), pa.array(shares.ravel()))})
            for k, lang in enumerate(names):
                mine = code == k
                if not mine.any():
                    continue
                hashes, n = np.unique(text.hash[mine[text.doc]], return_counts=True)
                held.setdefault(lang, []).append((hashes, n))
                size += len(hashes)
            if size > 1_500_000:
                yield from out()
                size = 0
    yield from out()


def references(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """One row for each language: lang, docs, class_p, common (hashes of words) and word_p with a last bin for other words.

    Word counts are combined within tasks before they are shuffled; the most frequent are picked in parts of each
    language's vocabulary first, so that no task ranks a whole language.
    """
    counts = stage(docs.select("lang", "text").mapInArrow(corpus_counts, "lang string, word long, n long, shares array<double>"), "counts")
    classes = counts.filter(F.col("word").isNull()).groupBy("lang").agg(
        F.sum("n").alias("docs"), F.array(*[F.percentile_approx(F.col("shares")[k], 0.5, 10_000) for k in range(CLASSES)]).alias("shares")
    )
    words = counts.filter(F.col("word").isNotNull()).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    part = F.pmod("word", F.lit(64))
    first = Window.partitionBy("lang", "part").orderBy(F.desc("n"), "word")
    top = words.withColumn("part", part).withColumn("place", F.row_number().over(first)).filter(F.col("place") <= common)
    final = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = top.withColumn("place", F.row_number().over(final)).filter(F.col("place") <= common)
    lists = top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "word", "n"))).alias("top"))
    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    same = lambda a, b: a.join(b.withColumnRenamed("lang", "other"), F.col("lang").eqNullSafe(F.col("other")), "left").drop("other")
    share = F.transform("top", lambda x: x["n"] / F.col("total"))
    rest = F.greatest(F.lit(0.0), 1 - F.aggregate(share, F.lit(0.0), lambda a, x: a + x))
    return same(same(classes, lists), total).select(
        "lang",
        "docs",
        F.transform("shares", lambda x: x / F.aggregate("shares", F.lit(0.0), lambda a, y: a + y)).alias("class_p"),
        F.transform("top", lambda x: x["word"]).alias("common"),
        F.concat(share, F.array(rest)).alias("word_p"),
    )


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of p from q; rows of zeros give 0."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        one = np.where(p > 0, p * np.log2(p / m), 0.0).sum(1)
        two = np.where(q > 0, q * np.log2(q / m), 0.0).sum(1)
    return np.where(p.sum(1) > 0, np.sqrt(np.maximum((one + two) / 2, 0)), 0.0)


def repeated_window_words(text: T.Words, size: int) -> np.ndarray:
    """Per text, the words covered by windows that the text holds twice or more."""
    at, found = text.windows(size)
    key = found ^ T.mixed(text.doc[at].astype(np.uint64), 7)
    ordered = np.sort(key)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    twice, _ = T.places(again, key)
    step = np.zeros(len(text.hash) + size + 1, np.int64)
    np.add.at(step, at[twice], 1)
    np.add.at(step, at[twice] + size, -1)
    return per_text(np.cumsum(step)[: len(text.hash)] > 0, text.first)


def common_counts(text: T.Words, code: np.ndarray, lists: list[list[int]]) -> np.ndarray:
    """A row for each text: how often it holds each common word of its language, in a last column all its other words."""
    other, n = max((len(x) for x in lists), default=0), len(code)
    language = T.mixed(np.arange(len(lists), dtype=np.uint64), 9)
    keys = np.concatenate([np.array(x, np.int64).view(np.uint64) ^ y for x, y in zip(lists, language, strict=True)])
    order = np.argsort(keys)
    which, at = T.places(keys[order], text.hash ^ language[code][text.doc])
    column = np.full(len(text.hash), other)
    column[which] = np.concatenate([np.arange(len(x)) for x in lists])[order][at]
    return np.bincount(text.doc * (other + 1) + column, minlength=n * (other + 1)).reshape(n, other + 1)


def duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def measuring(columns: list[str], limits: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                data, offsets = T.raw(part.column("text"))
                text = T.words(data, offsets, T.SOLID, False)
                n = len(offsets) - 1
                repeat = repeated_window_words(text, WINDOW)
                n_words = text.counts
                failed = (n_words < limits["base_words"]) | (100 * repeat > limits["base_repeat"] * n_words)
                found = byte_counts(data, offsets)
                counts = found[:, :CLASSES]
                folded = T.words(data, offsets, T.ALNUM, True)
                class_js, word_js = np.zeros(n), np.zeros(n)
                code, names = languages(part)
                reference = lambda name, mine: part.column(f"_ref_{name}")[int(mine[0])].as_py() if len(mine) else None  # noqa: B023, E731
                of = [np.flatnonzero(code == k) for k in range(len(names))]
                of = [x if (reference("docs", x) or 0) >= limits["min_docs"] else x[:0] for x in of]
                lists = [reference("common", x) or [] for x in of]
                table = common_counts(folded, code, lists)
                for mine, common in zip(of, lists, strict=True):
                    class_p, word_p = reference("class_p", mine), reference("word_p", mine)
                    if class_p:
                        own = np.ascontiguousarray(counts[mine])
                        p = own / np.maximum(own.sum(1, keepdims=True), 1)
                        class_js[mine] = np.where(own.sum(1) >= limits["min_chars"], distance(p, np.array(class_p)), 0)
                    if common:
                        own = np.ascontiguousarray(table[mine][:, [*range(len(common)), -1]])
                        p = own / np.maximum(own.sum(1, keepdims=True), 1)
                        word_js[mine] = np.where(own.sum(1) >= limits["min_words"], distance(p, np.array(word_p)), 0)
                steady = np.sqrt(STEADY_CHARS / np.clip(counts.sum(1), 1, STEADY_CHARS))
                rejected = (class_js > limits["max_class"] * steady) | (word_js > limits["max_word"])
                yield pa.record_batch(
                    {
                        **{x: part.column(x) for x in columns},
                        "n_words": pa.array(n_words.astype(np.int64)),
                        "word_chars": pa.array(found[:, CLASSES + 1]),
                        "n_symbols": pa.array(found[:, CLASSES]),
                        "n_dup_lines": pa.array(np.array([duplicate_lines(x or "") for x in part.column("text").to_pylist()], np.int64)),
                        "n_repeat_words": pa.array(repeat),
                        "class_distance": pa.array(class_js),
                        "word_distance": pa.array(word_js),
                        "base_failed": pa.array(failed),
                        "kept": pa.array(~failed & ~rejected),
                    }
                )

    return run


def quality_rules(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_words: int = MIN_WORDS,
    min_docs: int = MIN_DOCS,
    max_class: float = MAX_CLASS,
    max_word: float = MAX_WORD,
    carry: list[str] | None = None,
) -> DataFrame:
    """Columns `carry` of docs (all by default) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, class_distance, word_distance, base_failed, kept.

    The references are a staged table of one row per language, so Spark knows its size: it broadcasts it while small,
    and shuffles otherwise, with adaptive execution splitting frequent languages.
    """
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_distance", "word_distance", "base_failed", "kept"]
    carry = [x for x in (docs.columns if carry is None else carry) if x not in measures and not x.startswith("_ref_")]
    refs = stage(references(docs), "references")
    refs = refs.select(*[F.col(x).alias(f"_ref_{x}") for x in refs.columns])
    needed = docs.select(*dict.fromkeys([*carry, "lang", "text"]))
    joined = needed.join(refs, F.col("lang").eqNullSafe(F.col("_ref_lang")), "left").drop("_ref_lang")
    limits = {"min_chars": min_chars, "min_words": min_words, "min_docs": min_docs, "max_class": max_class, "max_word": max_word, "base_words": BASE_WORDS, "base_repeat": BASE_REPEAT}
    kinds = [LongType()] * 5 + [DoubleType()] * 2 + [BooleanType()] * 2
    schema = StructType([needed.schema[x] for x in carry] + [StructField(x, kind) for x, kind in zip(measures, kinds, strict=True)])
    return joined.mapInArrow(measuring(carry, limits), schema)
