"""Language-model scores by prediction by partial matching (PPM) over byte contexts, beside a unigram base score.

A text is its tokens: words (runs of anything but ASCII white space, A-Z lower-cased), each followed by one blank, and an end
mark. The model predicts byte after byte of this stream, the end mark too, from the ORDER bytes before, across words; before a
text's first byte stand blanks. Contexts are kept as a trie of reversed bytes with the counts of what follows. Where a byte
hasn't followed a context, the model escapes to the next shorter one: the escape counts as often as the context has distinct
followers (method C), and symbols that the longer context knows are excluded from the shorter ones. Below the empty context
all symbols left over are alike. Probabilities of all symbols thus add up to 1 in every context.

The base score takes tokens alone: words are counted over all training texts. So are events, pairs of context and symbol; a
text's score is the sum over its events, each with the cost worked out once for the corpus.

Frequent words and events reach the tasks as tables of at most HEAD and COSTS rows, bounds by parameter; the rest of each
document's words and events, summed per document, meet their counts and costs in a shuffled join. A null or empty text is the
end mark alone. Rows equal in doc_id and text get equal scores. Null ids are kept, extra columns ignored. Without training
texts every symbol has the same probability.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialcohort.llm import textarrays as T
from trialcohort.llm.common import id_remainder, row_key, stage

ORDER = 4
SYMBOLS = 257  # bytes and the end mark
END_MARK = 256
HEAD = 200_000
COSTS = 1_000_000  # so many of the most frequent (context, symbol) pairs are broadcast at most, 16 MB; others are joined
SLICE = 4 << 20
HELD = 400_000
WORD, EVENT = 1, 2  # kinds of rows that meet a count or a cost; a text's own row is of kind 0


def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (word, n): occurrences in training texts, 0 for words of other texts alone; summed over many texts of a task."""
    held: dict[bytes, int] = {}

    def out() -> Iterator[pa.RecordBatch]:
        words, counts = list(held), list(held.values())
        for a in range(0, len(words), 100_000):
            yield pa.record_batch({"word": pa.array(words[a : a + 100_000], pa.binary()), "n": pa.array(counts[a : a + 100_000], pa.int64())})
        held.clear()

    for batch in batches:
        for part in T.slices(batch, most=SLICE):
            text = T.of(part, T.SOLID, True)
            train = part.column("train").to_numpy(zero_copy_only=False)
            _, first, inverse = np.unique(text.hash, return_index=True, return_inverse=True)
            n = np.bincount(inverse, train[text.doc], minlength=len(first)).astype(np.int64)
            data = text.data.tobytes()
            for a, b, k in zip(text.starts[first].tolist(), text.ends[first].tolist(), n.tolist(), strict=True):
                word = data[a:b]
                held[word] = held.get(word, 0) + k
            if len(held) > HELD:
                yield from out()
    yield from out()


def stream(text: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts' streams, each with ORDER blanks before it and a place for the end mark; and each text's first event, one more at the end."""
    m = len(text.offsets) - 1
    ahead = np.concatenate([[0], np.cumsum(text.ends - text.starts + 1)])
    first = ahead[text.first] + np.arange(m + 1)
    out = np.full(int(first[-1]) + m * ORDER, 0x20, np.uint8)
    solid = np.ones(len(out), bool)
    solid[(first[:-1] + np.arange(m) * ORDER)[:, None] + np.arange(ORDER)] = False
    solid[ahead[1:] - 1 + text.doc + (text.doc + 1) * ORDER] = False
    solid[first[1:] - 1 + np.arange(1, m + 1) * ORDER] = False
    out[solid] = text.data[T.SOLID[text.data]]
    return out, first


def text_events(text: T.Words, most: int = T.BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each byte of each text's stream and the end mark: the text's index, and (reversed context << 9) + symbol; at most `most` at a time."""
    data, first = stream(text)
    for a in range(0, int(first[-1]), most):
        b = min(int(first[-1]), a + most)
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first.clip(a, b)))
        at = np.arange(a, b) + (owner + 1) * ORDER
        context = np.zeros(b - a, np.int64)
        for k in range(1, ORDER + 1):
            context = context << 8 | data[at - k]
        symbol = data[at].astype(np.int64)
        ends = first[1:] - 1
        symbol[ends[(ends >= a) & (ends < b)] - a] = END_MARK
        yield owner, context << 9 | symbol


def raw_words(column: pa.Array) -> pa.Array:
    """Binary words as an array whose buffers textarrays.raw reads; the bytes needn't be valid text."""
    column = column.cast(pa.large_binary())
    return pa.Array.from_buffers(pa.large_string(), len(column), column.buffers(), offset=column.offset)


def trie_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (event, n): occurrences in training texts, 0 for events of other texts; summed over many texts of a task."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        if held:
            event, n, _ = sum_by(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
            for a in range(0, len(event), 100_000):
                yield pa.record_batch({"event": pa.array(event[a : a + 100_000]), "n": pa.array(n[a : a + 100_000].astype(np.int64))})
        held.clear()

    for batch in batches:
        for part in T.slices(batch):
            train = part.column("train").to_numpy(zero_copy_only=False).astype(np.int64)
            for owner, event in text_events(T.of(part, T.SOLID, True)):
                unique, times = np.unique(event << 1 | train[owner], return_counts=True)
                held.append((unique >> 1, times * (unique & 1)))
                size += len(unique)
                if size > 3_000_000:
                    yield from out()
                    size = 0
    yield from out()


def sum_by(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, sums, and each row's place among the keys."""
    keys, inverse = np.unique(key, return_inverse=True)
    return keys, np.bincount(inverse, value, minlength=len(keys)), inverse


def code_lengths(event: np.ndarray, n: np.ndarray, one: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """log10 of the probability of each event.

    event, n: all events whose contexts share their last two bytes, for any such pairs of bytes. one, zero: counts after
    each last byte (256 x 257), and without context (257).
    """
    context, symbol = event >> 9, event & 511
    seen = []  # per order, longest first: each event's count, its context's total, distinct followers, and place
    for order in range(ORDER, 1, -1):
        own = context >> 8 * (ORDER - order)
        keys, count, place = sum_by(own << 9 | symbol, n)
        _, total, at = sum_by(keys >> 9, count)
        followers = np.bincount(at, count > 0, minlength=len(total))
        seen.append((count[place], total[at][place], followers[at][place], own << 9 | symbol, own))
    last = context >> 8 * (ORDER - 1)
    seen.append((one[last, symbol], one.sum(1)[last], (one > 0).sum(1)[last], None, last))
    seen.append((zero[symbol], np.broadcast_to(zero.sum(), len(event)), np.broadcast_to((zero > 0).sum(), len(event)), None, None))
    out, found = np.zeros(len(event)), np.zeros(len(event), bool)
    excluded, known = np.zeros(len(event)), np.zeros(len(event))
    for k, (count, total, followers, pair, own) in enumerate(seen):
        rest, new = total - excluded, followers - known
        with np.errstate(divide="ignore", invalid="ignore"):
            hit, escape = np.log10(count / (rest + new)), np.log10(new / (rest + new))
        here = ~found & (new > 0)
        out += np.where(here, np.where(count > 0, hit, escape), 0.0)
        found |= here & (count > 0)
        # what this context knows is excluded from the next shorter one: the counts there of this one's followers
        known = followers
        if k + 1 == len(seen):
            break
        below = seen[k + 1][0]
        if pair is not None:
            first = np.unique(pair, return_index=True)[1]
            keys, sums, _ = sum_by(own[first], np.where(count[first] > 0, below[first], 0))
            excluded = sums[np.searchsorted(keys, own)]
        else:
            excluded = ((one > 0) * zero).sum(1)[own]
    left = SYMBOLS - (zero > 0).sum()
    return np.where(found, out, out - np.log10(max(left, 1)))


def costing(one: np.ndarray, zero: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (event, n, cost) from events sorted within the task; events with equal last two bytes are looked at together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        event, n = np.empty(0, np.int64), np.empty(0, np.int64)

        def out(m: int) -> Iterator[pa.RecordBatch]:
            cost = code_lengths(event[:m], n[:m], one, zero)
            for a in range(0, m, 100_000):
                b = min(m, a + 100_000)
                yield pa.record_batch({"event": pa.array(event[a:b]), "n": pa.array(n[a:b]), "cost": pa.array(cost[a:b])})

        shift = 9 + 8 * (ORDER - 2)
        for batch in batches:
            event = np.concatenate([event, batch.column("event").to_numpy()])
            n = np.concatenate([n, batch.column("n").to_numpy()])
            m = int(np.searchsorted(event >> shift, event[-1] >> shift)) if len(event) else 0
            if m:
                yield from out(m)
                event, n = event[m:], n[m:]
        if len(event):
            yield from out(len(event))

    return run


def heads(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The first eight bytes of each word as one number; together with the hash they tell words apart."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at = np.arange(8)
    found = np.where(at < (ends - starts)[:, None], padded[starts[:, None] + at], 0).astype(np.uint8)
    return found.view(np.int64).ravel() if len(found) else np.empty(0, np.int64)


def keying(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, p, n) from (word, n)."""
    for batch in batches:
        data, offsets = T.raw(raw_words(batch.column("word")))
        h = T.hashes(data, offsets[:-1], offsets[1:])
        yield pa.record_batch({"h": pa.array(h.view(np.int64)), "p": pa.array(heads(data, offsets[:-1], offsets[1:])), "n": batch.column("n")})


def vocabulary(docs: DataFrame) -> DataFrame:
    """Staged (word, n) of all words; docs has text and train."""
    return stage(docs.select("text", "train").mapInArrow(counting, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")


def event_costs(docs: DataFrame) -> DataFrame:
    """Staged (event, n, cost) of all events: occurrences in training texts, and log10 of the probability. docs has text and train."""
    counts = docs.select("text", "train").mapInArrow(trie_counts, "event long, n long").groupBy("event").agg(F.sum("n").alias("n"))
    counts = stage(counts, "trie")
    # at most 256 x 257 sums, whatever the input
    short = counts.groupBy(F.shiftright("event", 9 + 8 * (ORDER - 1)).alias("last"), F.col("event").bitwiseAND(511).alias("symbol")).agg(F.sum("n").alias("n")).toPandas()
    one = np.zeros((256, SYMBOLS))
    one[short["last"].to_numpy(np.int64), short["symbol"].to_numpy(np.int64)] = short["n"].to_numpy(float)
    by_tail = counts.repartition(F.shiftright("event", 9 + 8 * (ORDER - 2))).sortWithinPartitions("event")
    return stage(by_tail.mapInArrow(costing(one, one.sum(0)), "event long, n long, cost double"), "costs")


def frequent(counts: DataFrame, most: int) -> Column:
    """A condition on n that at most `most` rows of counts meet, the most frequent ones; large n are cut in steps of about a twelfth.

    At most about a thousand sums reach the driver; a sorted head of every task would fill it.
    """
    n = F.col("n")
    level = F.when(n < 512, n).otherwise(440 + F.floor(F.log2(n) * 8))
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("rows")).toPandas().sort_values("level", ascending=False)
    fits = levels["level"][levels["rows"].cumsum() <= most]
    return level >= int(fits.min()) if len(fits) else F.lit(False)


def columns(rows: DataFrame) -> list[np.ndarray]:
    """The columns of a table of bounded size."""
    return [x.to_numpy() for x in rows.toArrow().columns]


def scoring(shared, costs, floor: float, total: float, end: tuple[float, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:  # noqa: ANN001
    """For each text a row with the sums over its frequent words and events, and a row for each other distinct word and event (times > 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, p, n = shared.value
        known, base = n > 0, np.log10((n + floor) / total)
        priced, cost = costs.value
        for batch in batches:
            for part in T.slices(batch, most=SLICE):
                text = T.of(part, T.SOLID, True)
                m = part.num_rows
                unique, first, inverse = np.unique(text.hash, return_index=True, return_inverse=True)
                begin = heads(text.data, text.starts[first], text.ends[first])
                at = np.searchsorted(h, unique).clip(0, max(0, len(h) - 1))
                hit = (h[at] == unique) & (p[at] == begin) if len(h) else np.zeros(len(unique), bool)
                sums = [np.where(hit, x[at], 0.0) if len(h) else np.zeros(len(unique)) for x in (known, base)]
                n_known, base_sum = (np.bincount(text.doc, x[inverse], minlength=m) + e for x, e in zip(sums, (end[1], end[0]), strict=True))
                rare = np.flatnonzero(~hit[inverse])
                pair, times = np.unique(text.doc[rare] * (len(unique) + 1) + inverse[rare], return_counts=True)
                doc, word = np.divmod(pair, len(unique) + 1)
                others = [(doc, unique[word].view(np.int64), begin[word], np.full(len(doc), WORD), times)]
                score = np.zeros(m)
                for owner, event in text_events(text):
                    events = np.unique(event)
                    at = np.searchsorted(priced, events).clip(0, max(0, len(priced) - 1))
                    hit = priced[at] == events if len(priced) else np.zeros(len(events), bool)
                    place = np.searchsorted(events, event)
                    score += np.bincount(owner, (np.where(hit, cost[at], 0.0) if len(priced) else np.zeros(len(events)))[place], minlength=m)
                    if not hit.all():
                        rare = np.flatnonzero(~hit[place])
                        pair, times = np.unique(owner[rare] * (len(events) + 1) + place[rare], return_counts=True)
                        doc, place = np.divmod(pair, len(events) + 1)
                        others.append((doc, events[place], np.zeros(len(doc), np.int64), np.full(len(doc), EVENT), times))
                doc, key, head, kind, times = (np.concatenate(x) for x in zip(*others, strict=True))
                k1, k2 = (part.column(x).to_numpy() for x in ("k1", "k2"))
                whole, some = np.arange(m), len(doc)
                put = lambda a, b, kind: pa.array(np.concatenate([np.asarray(a, kind), np.asarray(b, kind)]))
                rows = pa.record_batch(
                    {
                        "k1": put(k1, k1[doc], np.int64),
                        "k2": put(k2, k2[doc], np.int64),
                        "h": put(k2, key, np.int64),
                        "p": put(whole, head, np.int64),
                        "kind": put(np.zeros(m), kind, np.int32),
                        "times": put(np.zeros(m), times, np.int64),
                        "doc_id": pa.concat_arrays([part.column("doc_id"), pa.nulls(some, pa.int64())]),
                        "n_tokens": put(text.counts + 1, np.zeros(some), np.int64),
                        "n_known": put(n_known, np.zeros(some), np.int64),
                        "base": put(base_sum, np.zeros(some), float),
                        "score": put(score, np.zeros(some), float),
                    }
                )
                for a in range(0, rows.num_rows, 100_000):
                    yield rows.slice(a, 100_000)

    return run


SUMS = "k1 long, k2 long, h long, p long, kind int, times long, doc_id long, n_tokens long, n_known long, base double, score double"


def score(docs: DataFrame, train: Column, head: int = HEAD, costs: int = COSTS) -> DataFrame:
    """Per row of docs: doc_id, n_tokens, n_known, train_tokens, base_score, score. train: a condition on doc_id.

    base_score is the sum over tokens of log10((c + 0.5) / (N + 0.5 * (V + 1))), score the model's log10 probability.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", *row_key(), train.alias("train"))
    words = vocabulary(docs)
    trained = docs.filter("train").count()
    found = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    tokens, distinct = found["n"] + trained, found["v"] + (trained > 0)
    total = tokens + 0.5 * (distinct + 1)
    words = stage(words.mapInArrow(keying, "h long, p long, n long"), "vocabulary")
    h, p, n = columns(words.filter(frequent(words, head)).select("h", "p", "n"))
    order = np.argsort(h.view(np.uint64))
    shared = spark.sparkContext.broadcast((h.view(np.uint64)[order], p[order], n[order]))
    priced = event_costs(docs)
    often = frequent(priced, costs)
    event, cost = columns(priced.filter(often).select("event", "cost"))
    order = np.argsort(event)
    table = spark.sparkContext.broadcast((event[order], cost[order]))
    del h, p, n, event, cost, order
    end = float(np.log10((trained + 0.5) / total)), int(trained > 0)
    rows = docs.select("doc_id", "text", "k1", "k2").mapInArrow(scoring(shared, table, 0.5, total, end), SUMS)
    # a text's own row carries no word or event; its key is its own hash, spread like the words', and meets nothing
    rest = words.select("h", "p", F.lit(WORD).alias("kind"), F.col("n").alias("c"), F.lit(None).cast("double").alias("cost"))
    rest = rest.unionByName(priced.filter(~often).select(F.col("event").alias("h"), F.lit(0).cast("long").alias("p"), F.lit(EVENT).alias("kind"), F.lit(None).cast("long").alias("c"), "cost"))
    rows = rows.join(rest, ["h", "p", "kind"], "left")
    times = F.col("times")
    own = F.count_if(F.col("kind") == 0)
    base = F.when(F.col("kind") == WORD, times * F.log10((F.coalesce("c", F.lit(0)) + 0.5) / total)).otherwise(0.0)
    sums = rows.groupBy("k1", "k2").agg(
        own.alias("copies"),
        F.max("doc_id").alias("doc_id"),
        (F.sum("n_tokens") / own).cast("long").alias("n_tokens"),
        ((F.sum("n_known") + F.sum(F.when(F.col("c") > 0, times).otherwise(0))) / own).cast("long").alias("n_known"),
        ((F.sum("base") + F.sum(base)) / own).alias("base_score"),
        ((F.sum("score") + F.sum(F.coalesce(times * F.col("cost"), F.lit(0.0)))) / own).alias("score"),
    )
    sums = sums.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return sums.select("doc_id", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def model_scores(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out (crc32 of doc_id as text, modulo 5, is 1; not learned from), n_tokens, n_known, train_tokens, base_score, score."""
    out = score(docs, id_remainder() != 1)
    return out.select("doc_id", (id_remainder() == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
