"""Removal of long repeats by recompression.

Each text is a sequence of word names. Rounds of recompression replace pairs (and, in higher rounds, runs) of neighbouring
symbols by new symbols: whether two neighbours merge, and what the new symbol is called, depends on their names alone.
A name is a hash of what it stands for, so all tasks on all executors give the same name to the same words without
asking each other, and equal stretches of words get equal symbols inside, wherever they stand.

- Three rounds of pairs: a symbol has at most eight words, and whether a border stands at a place depends on the five
  words before and after it. Every window of 35 words thus has a border at least 5 words from its ends. Of those borders
  the one whose ten words around have the least hash is the window's anchor, the same for every copy of the window.
- Spark counts the anchors' names: a window can be repeated only if its anchor's name is shared.
- Higher rounds, with runs: symbols of 35 words and more. One whose name and content hash are shared is verified at
  once, and all windows inside it are repeated.
- The windows at shared anchors which no verified symbol holds are compared by two 64-bit hashes of their whole content,
  with each other and with the windows of one occurrence, the first, of every verified symbol.

Names come from one hash of each word, contents and the second hash of a window from another that is unrelated to it, so
words that one hash takes for equal are told apart by the other.

A word goes if any window that covers it also starts elsewhere. Words are runs of anything but ASCII white space, compared
unchanged. A null or empty text has none; a text shorter than a window keeps all. Repeated rows are documents of their
own, so each loses what it repeats; rows equal in doc_id and text come out alike. Null ids are kept, extra columns ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialcohort.llm import textarrays as T
from trialcohort.llm.common import row_key, stage
from trialcohort.operators.joins import fresh

WINDOW = 35
LOW_ROUNDS = 3
MARGIN = 5  # words on either side that decide a border after LOW_ROUNDS rounds of pairs
TOP_ROUNDS = (14, 17, 20, 24)  # rounds whose long symbols are named globally


def pairs_round(names: np.ndarray, starts: np.ndarray, doc: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merges each neighbours (left, right), where a hash of its name makes every symbol a left or a right one."""
    right = (T.mixed(names, salt) >> T.U(63)).astype(bool)
    merge = ~right[:-1] & right[1:] & (doc[:-1] == doc[1:])
    first = np.flatnonzero(merge)
    out = names.copy()
    out[first] = T.mixed(T.mixed(names[first], 21) * T.U(T.BASE) + T.mixed(names[first + 1], 22), salt)
    stay = np.ones(len(names), bool)
    stay[first + 1] = False
    return out[stay], starts[stay], doc[stay]


def runs_round(names: np.ndarray, starts: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Replaces each run of equal symbols by one that is named by symbol and length."""
    begin = np.append(True, (names[1:] != names[:-1]) | (doc[1:] != doc[:-1]))
    at = np.flatnonzero(begin)
    length = np.diff(np.append(at, len(names)))
    out = names[at].copy()
    run = length > 1
    out[run] = T.mixed(out[run] + T.mixed(length[run].astype(np.uint64), 23), 24)
    return out, starts[at], doc[at]


def sliding(values: np.ndarray, size: int, least: bool) -> np.ndarray:
    """Minimum or maximum of every `size` consecutive values."""
    pick = np.minimum if least else np.maximum
    out, have = values, 1
    while have < size:
        step = min(have, size - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


class Parse:
    """The symbols of a run of texts: borders of the low rounds with their anchors, and long symbols of the top rounds."""

    def __init__(self, text: T.Words, window: int):
        self.text, self.window = text, window
        n = len(text.hash)
        names, starts, doc = text.hash, np.arange(n), text.doc
        for k in range(LOW_ROUNDS):
            if len(names) > 1:
                names, starts, doc = pairs_round(names, starts, doc, 100 + k)
        self.low = names, starts, doc
        # windows by their starts, and the value of each border: a hash of the words around, the highest number for no border
        self.fits = np.flatnonzero(text.doc[: max(0, n - window + 1)] == text.doc[window - 1 :]) if n >= window else np.empty(0, np.int64)
        self.value = np.full(n, ~T.U(0))
        border = np.zeros(n, bool)
        border[starts] = True
        at, around = text.windows(2 * MARGIN, salt=25)
        inner = border[at + MARGIN]
        self.value[at[inner] + MARGIN] = around[inner] >> T.U(1)
        # the least value of each window's borders; positions from start + MARGIN to start + window - MARGIN
        span = window - 2 * MARGIN + 1
        self.least = np.full(n, ~T.U(0))
        if len(self.fits):
            # positions at a text's end have no window, so values of other texts never count
            self.least[self.fits] = sliding(self.value, span, True)[self.fits + MARGIN]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Word index and name of each border that is the anchor of some window."""
        n, span = len(self.value), self.window - 2 * MARGIN + 1
        most = np.zeros(n, np.uint64)
        most[self.fits] = self.least[self.fits] + T.U(1)
        # a border at p serves windows that start from p - (window - MARGIN) to p - MARGIN
        padded = np.concatenate([np.zeros(self.window, np.uint64), most])
        reach = sliding(padded, span, False)
        p = np.flatnonzero(self.value != ~T.U(0))
        best = reach[p + self.window - (self.window - MARGIN)]
        chosen = p[best == self.value[p] + T.U(1)]
        return chosen, self.value[chosen]

    def symbols(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Word index, size, name and content hash of the symbols of a window or more, when a top round first has them."""
        names, starts, doc = self.low
        done = np.empty(0, np.int64)
        n = len(self.text.hash)
        sums = content_sums(self.text.second)
        for k in range(LOW_ROUNDS, max(TOP_ROUNDS)):
            if len(names) < 2:
                return
            names, starts, doc = pairs_round(*runs_round(names, starts, doc), 100 + k)
            if k + 1 in TOP_ROUNDS:
                last = np.append(doc[1:] != doc[:-1], True)
                ends = np.where(last, self.text.first[doc + 1], np.append(starts[1:], n))
                size = ends - starts
                long = np.flatnonzero(size >= self.window)
                code = starts[long] * (n + 1) + ends[long]
                new = ~np.isin(code, done)
                done = np.concatenate([done, code[new]])
                long = long[new]
                yield starts[long], size[long], T.mixed(names[long] + size[long].astype(np.uint64), 26), content(sums, starts[long], ends[long])


def content_sums(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums for hashes of any stretch of names, as of bytes in textarrays, and the inverse powers."""
    n = len(names)
    power = T.POW[:n] if n <= len(T.POW) else T.powers(T.BASE, n)
    back = T.INV[: n + 1] if n < len(T.INV) else T.powers(T.inverse(T.BASE), n + 1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(T.mixed(names, 27) * power)]), back


def content(sums: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return T.mixed((sums[0][ends] - sums[0][starts]) * sums[1][starts], 28)


def naming(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (name, content, k1, k2, at, size): anchors with size 0 and content 0, and long symbols."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                text = T.of(part)
                parse = Parse(text, window)
                at, name = parse.anchors()
                found = [(at, np.zeros(len(at), np.int64), name, np.zeros(len(at), np.uint64)), *parse.symbols()]
                at, size, name, inside = (np.concatenate(x) for x in zip(*found, strict=True))
                doc = text.doc[at]
                k1, k2 = (part.column(x).to_numpy() for x in ("k1", "k2"))
                yield pa.record_batch(
                    {
                        "name": pa.array(name.view(np.int64)),
                        "content": pa.array(inside.view(np.int64)),
                        "k1": pa.array(k1[doc]),
                        "k2": pa.array(k2[doc]),
                        "at": pa.array((at - text.first[doc]).astype(np.int32)),
                        "size": pa.array(size.astype(np.int32)),
                    }
                )

    return run


def mark(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """n booleans: which lie in any [start, end)."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    return np.cumsum(step)[:n] > 0


def checking(window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (h1, h2, k1, k2, at): windows at shared anchors which no verified symbol holds, or the first one of its name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in T.slices(batch):
                text = T.of(part)
                n = len(text.hash)
                parse = Parse(text, window)
                marks = part.column("marks")
                lists = marks.flatten()
                doc = np.repeat(np.arange(part.num_rows), marks.value_lengths().to_numpy(zero_copy_only=False))
                at = lists.field("at").to_numpy(zero_copy_only=False) + text.first[doc]
                size = lists.field("size").to_numpy(zero_copy_only=False)
                anchor, symbol = size == 0, size > 0
                # shared anchors by their values; equal values in one text have equal words around, and equal marks
                shared = np.zeros(n, bool)
                shared[at[anchor]] = True
                first = lists.field("first").to_numpy(zero_copy_only=False) & symbol
                verified, leads = (mark(n, at[x], at[x] + size[x] - window + 1) for x in (symbol, first))
                served = np.where(shared, parse.value, ~T.U(0))
                span = window - 2 * MARGIN + 1
                start = parse.fits[(~verified | leads)[parse.fits]]
                if not len(start):
                    continue
                start = start[sliding(served, span, True)[start + MARGIN] == parse.least[start]]
                hashes = content_at(text.hash, start, window, 31), content_at(text.second, start, window, 32)
                owner = text.doc[start]
                k1, k2 = (part.column(x).to_numpy() for x in ("k1", "k2"))
                yield pa.record_batch(
                    {
                        "h1": pa.array(hashes[0].view(np.int64)),
                        "h2": pa.array(hashes[1].view(np.int64)),
                        "k1": pa.array(k1[owner]),
                        "k2": pa.array(k2[owner]),
                        "at": pa.array((start - text.first[owner]).astype(np.int32)),
                    }
                )

    return run


def content_at(names: np.ndarray, starts: np.ndarray, size: int, salt: int) -> np.ndarray:
    _, found = T.windows(T.mixed(names, salt), np.zeros(len(names), np.int8), size)
    return found[starts]


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (k1, k2, marks): per document the stretches (at, size) of words which it shares, in any order and overlapping.

    Names are counted with partial sums; the joins back meet one row a name, shuffled anew, so a passage that a third of all
    documents hold can be split by adaptive execution. A document's marks are at most as many as its words.
    """
    keyed = docs.select(*row_key(), "text")
    rows = stage(keyed.mapInArrow(naming(window), "name long, content long, k1 long, k2 long, at int, size int"), "names")
    place = F.struct("k1", "k2", "at")
    shared = rows.groupBy("name", "content", "size").agg(F.count("*").alias("n"), F.min(place).alias("lead")).filter("n > 1").drop("n")
    shared = shared.withColumn("name", fresh(F.col("name")))
    found = rows.join(shared, ["name", "content", "size"]).select("k1", "k2", F.struct("at", "size", (place == F.col("lead")).alias("first")).alias("mark"))
    found = found.groupBy("k1", "k2").agg(F.collect_set("mark").alias("marks"))
    marks = stage(found, "marks")
    unsure = keyed.join(marks.hint("merge"), ["k1", "k2"])  # marks grow with the documents: never broadcast
    cand = stage(unsure.mapInArrow(checking(window), "h1 long, h2 long, k1 long, k2 long, at int"), "windows")
    twice = cand.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    twice = twice.withColumn("h1", fresh(F.col("h1")))
    windows = cand.join(twice, ["h1", "h2"]).groupBy("k1", "k2").agg(F.collect_set(F.struct("at", F.lit(window).alias("size"))).alias("marks"))
    whole = F.transform(F.filter("marks", lambda x: x["size"] > 0), lambda x: F.struct(x["at"], x["size"]))
    verified = marks.select("k1", "k2", whole.alias("marks"))
    both = verified.filter(F.size("marks") > 0).unionByName(windows)
    return both.groupBy("k1", "k2").agg(F.flatten(F.collect_list("marks")).alias("marks"))


def cutting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, marks in zip(batch.column("text").to_pylist(), batch.column("marks").to_pylist(), strict=True):
            words = (text or "").encode().split()
            n, gone = len(words), 0
            if marks:
                at = np.array([x["at"] for x in marks])
                out = mark(n, at, at + np.array([x["size"] for x in marks]))
                words, gone = [w for w, x in zip(words, out.tolist(), strict=True) if not x], int(out.sum())
            kept = b" ".join(words)
            rows.append((n, gone, kept.decode(), hashlib.sha256(kept).hexdigest()))
        n, gone, kept, digest = zip(*rows, strict=True) if rows else ([], [], [], [])
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "kept": pa.array(kept, pa.string()), "kept_sha256": pa.array(digest, pa.string())})


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed, kept (the words that stay, joined by one blank), kept_sha256."""
    marks = stage(repeats(docs, window), "repeats")
    rows = docs.select("doc_id", *row_key(), "text").join(marks.hint("merge"), ["k1", "k2"], "left").select("doc_id", "text", "marks")
    return rows.mapInArrow(cutting, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")


def repeat_digest(docs: DataFrame) -> DataFrame:
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
