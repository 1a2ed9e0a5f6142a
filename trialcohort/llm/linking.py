"""Components of classes of equal sets that share signatures, with every link between candidates confirmed on full sets.

Rounds of stars come first: in each group of classes that share a signature, all are compared with one center, the same
center in every group where that is possible, later one picked by the signature. What is linked forms components, and a
group within one component is done. What is left, groups that hold several components after all rounds, is compared
exactly: what such groups connect is cut into blocks, and two blocks meet in a task, where a matrix product gives all
intersections at once. The largest component of what is connected needs no comparison within itself, so its classes are
repeated for the blocks of the others alone. No link between classes of different components is lost, and only links, not
pairs, leave a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialcohort.llm import textarrays as T
from trialcohort.llm.common import stage, stage_few
from trialcohort.llm.components import connected_components

ROUNDS = 2
BLOCK_ROWS, BLOCK_BYTES = 256, 8 << 20
COLUMNS = 8_192  # shingles of one matrix product


def shingle_sets(text: T.Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of each text's set, ascending, and where each text's begin."""
    n = len(text.counts)
    at, names = text.windows(shingle, salt=shingle)
    doc = text.doc[at]
    for k in range(1, shingle):
        short = np.flatnonzero(text.counts == k)
        if len(short):
            at, found = text.windows(k, salt=k)
            mine = np.isin(text.doc[at], short)
            names, doc = np.concatenate([names, found[mine]]), np.concatenate([doc, text.doc[at][mine]])
    if (doc[1:] < doc[:-1]).any():
        order = np.argsort(doc, kind="stable")
        names, doc = names[order], doc[order]
    begin = np.searchsorted(doc, np.arange(n + 1)).tolist()
    for a, b in zip(begin[:-1], begin[1:], strict=True):
        names[a:b].sort()
    new = np.append(True, (names[1:] != names[:-1]) | (doc[1:] != doc[:-1]))[: len(names)]
    names, doc = names[new], doc[new]
    return names, np.searchsorted(doc, np.arange(n + 1))


def verifying(shingle: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows (a, b, text_a, text_b) those whose sets are similar enough: (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str | None, np.ndarray] = (None, np.empty(0, np.uint64))
        for batch in batches:
            for part in T.slices(batch, "text_a"):
                names, begin = shingle_sets(T.of(part, T.SOLID, True, "text_a"), shingle)
                good = []
                for i, other in enumerate(part.column("text_b")):
                    other = other.as_py()
                    if other != last[0]:  # rows of one center mostly follow each other
                        alone = pa.record_batch({"text": pa.array([other], pa.string())})
                        last = other, shingle_sets(T.of(alone, T.SOLID, True), shingle)[0]
                    own = names[begin[i] : begin[i + 1]]
                    both = len(np.intersect1d(own, last[1], assume_unique=True))
                    good.append(100 * both >= percent * (len(own) + len(last[1]) - both) > 0)
                yield pa.record_batch({"a": part.column("a"), "b": part.column("b")}).filter(pa.array(good, pa.bool_()))

    return run


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) of class numbers that are links. texts: (cid, text)."""
    one = texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    return rows.mapInArrow(verifying(shingle, percent), "a long, b long")


def crossing(shingle: int, percent: int) -> Callable[[pa.Table], pa.Table]:
    """Links (a, b) between rows (cid, root, text, block) of two blocks with different roots, or within one block."""

    def run(rows: pa.Table) -> pa.Table:
        root, cid, block = (rows.column(x).to_numpy() for x in ("root", "cid", "block"))
        sets = []
        for batch in rows.select(["text"]).combine_chunks().to_batches():
            for part in T.slices(batch):
                names, begin = shingle_sets(T.of(part, T.SOLID, True), shingle)
                sets += [names[a:b] for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True)]
        size = np.array([len(x) for x in sets])
        row = np.repeat(np.arange(len(sets)), size)
        _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        seen = times[token] > 1  # other shingles are in no intersection
        place = np.cumsum(times > 1) - 1
        row, token = row[seen], place[token[seen]]
        order = np.argsort(token, kind="stable")
        row, token = row[order], token[order]
        both = np.zeros((len(sets), len(sets)), np.float32)
        for start in range(0, int(token[-1]) + 1 if len(token) else 0, COLUMNS):
            a, b = np.searchsorted(token, (start, start + COLUMNS))
            held = np.zeros((len(sets), COLUMNS), np.float32)
            held[row[a:b], token[a:b] - start] = 1
            both += held @ held.T
        union = size[:, None] + size[None, :] - both
        linked = (100 * both >= percent * union) & (root[:, None] != root[None, :])
        if block.min() != block.max():
            linked &= block[:, None] != block[None, :]
        x, y = np.nonzero(np.triu(linked, 1))
        return pa.table({"a": cid[x], "b": cid[y]})

    return run


def with_roots(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Adds `root`, the class's component; a class without links is its own."""
    if roots is None:
        return rows.withColumn("root", F.col("cid"))
    return rows.join(roots, "cid", "left").withColumn("root", F.coalesce("root", "cid"))


def blocks(mixed: DataFrame, texts: DataFrame, rows: int, size: int) -> DataFrame:
    """Rows (whole, low, high, cid, root, text, block) of every two blocks that have to meet. mixed: (cid, center, root)."""
    whole = connected_components(mixed.select(F.col("cid").alias("a"), F.col("center").alias("b")))
    members = mixed.select("cid", "root").distinct().join(whole.select(F.col("node").alias("cid"), F.col("root").alias("whole")), "cid")
    members = stage(members.join(texts, "cid").withColumn("bytes", F.octet_length("text").cast("long")), "members")
    counted = members.groupBy("whole", "root").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    total = counted.groupBy("whole").agg(F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    top = counted.select("whole", "root", F.col("bytes").alias("top_bytes")).join(total, "whole").filter("root = top.root")
    parts = lambda n, b: F.greatest(F.lit(1), F.ceil(n / rows), F.ceil(b / size)).cast("int")
    top = top.select(
        "whole",
        F.col("top.root").alias("main"),
        parts(F.col("top.n"), F.col("top_bytes")).alias("main_parts"),
        parts(F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top_bytes")).alias("parts"),
    )
    placed = members.join(stage(top, "wholes"), "whole")
    # blocks below 0 hold the largest component, the others all the rest
    main, spread = F.col("root") == F.col("main"), F.xxhash64("cid")
    block = F.when(main, -1 - F.pmod(spread, F.col("main_parts"))).otherwise(F.pmod(spread, F.col("parts"))).cast("int")
    first = F.when(main, 0).otherwise(-F.col("main_parts"))
    placed = placed.withColumn("block", block).withColumn("other", F.explode(F.sequence(first, F.col("parts") - 1)))
    return placed.select("whole", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "cid", "root", "text", "block")


def linked_roots(
    members: DataFrame, keys: DataFrame, texts: DataFrame, shingle: int, percent: int, rounds: int = ROUNDS, rows: int | None = None, size: int | None = None
) -> DataFrame:
    """(cid, root) of the classes with a link; root is the least class that links reach.

    members: (cid, n, key), a row for each signature of a class with n members. keys: (cid, k1, k2), a document of each
    class. texts: (k1, k2, text), from which one row for each class is taken.
    """
    count = members.groupBy("key").agg(F.min("cid").alias("least"), F.max("cid").alias("most"))
    # what several classes share is few; staged, it makes the join's shuffles fresh ones
    several = stage(count.filter("least != most").select("key", F.col("least").alias("center")), "several")
    shared = stage(members.join(several, "key"), "shared")
    wanted = stage(shared.select("cid").distinct().join(keys, "cid"), "wanted")
    found = texts.join(wanted.hint("merge"), ["k1", "k2"]).select("cid", "text")
    texts = stage(found.groupBy("cid").agg(F.first("text").alias("text")), "texts")
    links = roots = None
    for turn in range(rounds):
        placed = with_roots(shared, roots)
        if turn:
            mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
            placed = stage(placed.join(stage(mixed.select("key"), "mixed"), "key"), "placed")
            if placed.isEmpty():
                return roots
            pick = F.min_by(F.struct("cid", "n", "root"), F.xxhash64("cid", "key", F.lit(turn)))
        else:
            pick = F.min(F.struct("cid", "n", "root"))
        centers = stage_few(placed.groupBy("key").agg(pick.alias("at")), "centers")
        star = placed.join(centers, "key").filter("cid != at.cid and root != at.root")
        star = star.filter(100 * F.least("n", "at.n") >= percent * F.greatest("n", "at.n"))
        star = stage_few(star.select(F.greatest("cid", "at.cid").alias("a"), F.least("cid", "at.cid").alias("b")).distinct(), "star")
        more = stage(verified(star, texts, shingle, percent), "links")
        links = more if links is None else links.unionByName(more)
        roots = stage_few(connected_components(links).select(F.col("node").alias("cid"), "root"), "roots")
    placed = with_roots(shared, roots)
    mixed = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low != high")
    rest = stage_few(placed.join(stage(mixed.select("key"), "mixed"), "key").select("cid", "center", "root").distinct(), "rest")
    if rest.isEmpty():
        return roots
    groups = blocks(rest, texts, rows or BLOCK_ROWS, size or BLOCK_BYTES).groupBy("whole", "low", "high")
    more = stage(groups.applyInArrow(crossing(shingle, percent), "a long, b long"), "links")
    links = more if links is None else links.unionByName(more)
    return connected_components(links).select(F.col("node").alias("cid"), "root")
