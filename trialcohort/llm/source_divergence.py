"""How far the sources of a language stand apart in their words.

Terms are runs of letters: A-Z (lower-cased), a-z and all beyond ASCII. A language keeps the V terms that at least MIN_DOCS
of its documents hold. A group (lang, source), and the language as a whole, gives each kept term the share
p = 1 + floor(SCALE * (count + 2) / (N + 2 * V)), N its occurrences of kept terms; two shares p and q differ by
floor((p - q)**2 / (p + q)). All is exact integers: the quotient is taken in three steps that stay below 2**63 as long as N
stays below 9 * 10**15.

Strings come late. Tasks count the terms of their texts and write them once; what is shuffled for counting are 64-bit
digests. Per digest the least and the greatest of its strings are found, one of each from a task: where they differ, strings
collide, and the digest is split into numbered ones by its strings. Text is joined back for the terms that are put out alone.

Pairs of sources are the result itself, so all of them are made, but never from pairs per term: a language's terms are cut
into blocks of about TERMS and its sources into blocks of about SOURCES, and a task with two blocks of sources and one of
terms sums over a matrix of counts, zeros included. Sums, not terms, leave it.

A null text, lang or source is ''. A row is a document, whatever its doc_id. A source with a third of all rows is counted
within tasks first. Long texts are split in blocks. An empty table gives no rows; a language without kept terms has pairs of
value 0. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialcohort.llm.common import stage
from trialcohort.llm.textarrays import slices
from trialcohort.llm.wordblocks import as_bytes, word_blocks

MIN_DOCS, TOP, SCALE = 10, 10, 1_000_000_000
HELD = 500_000  # counted terms that a task holds before it writes them
TERMS, SOURCES = 4_096, 128
LETTERS = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
KEY = ["digest", "split"]


def counting(held: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (lang, source, term, n, docs) from rows (lang, source, text), and one with a null term for each group seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in groups.items():
                terms = [None, *n]
                for a in range(0, len(terms), 100_000):
                    part = terms[a : a + 100_000]
                    yield pa.record_batch(
                        {
                            "lang": pa.array([lang] * len(part), pa.string()),
                            "source": pa.array([source] * len(part), pa.string()),
                            "term": pa.array(part, pa.binary()),
                            "n": pa.array([n[x] for x in part], pa.int64()),
                            "docs": pa.array([docs[x] for x in part], pa.int64()),
                        }
                    )
            groups.clear()

        size = 0
        for batch in batches:
            for piece in slices(batch):
                rows = zip(piece.column("lang").to_pylist(), piece.column("source").to_pylist(), as_bytes(piece.column("text")), strict=True)
                for lang, source, text in rows:
                    n, docs = groups.setdefault((lang, source), (Counter(), Counter()))
                    before, distinct = len(n), set()
                    for words in word_blocks(text.translate(LETTERS)):
                        n.update(words)
                        distinct.update(words)
                    docs.update(distinct)
                    size += len(n) - before
                    if size > held:
                        yield from out()
                        size = 0
        yield from out()

    return run


def digest64(term: Column) -> Column:
    return F.xxhash64(term)


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (n + 2 * v)) in three exact steps of 1,000."""
    whole = n + 2 * v
    out, rest = F.lit(1).cast("long"), count + 2
    for power in (1_000_000, 1_000, 1):
        out = out + F.call_function("div", 1_000 * rest, whole) * power
        rest = F.pmod(1_000 * rest, whole)
    return out


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(count: np.ndarray, n: np.ndarray, v: int) -> np.ndarray:
    """As share(), on arrays; n has one number for each row of count."""
    whole = (n + 2 * v)[:, None]
    out, rest = np.ones_like(count), count + 2
    for power in (1_000_000, 1_000, 1):
        out += 1_000 * rest // whole * power
        rest = 1_000 * rest % whole
    return out


def tiling(rows: pa.Table) -> pa.Table:
    """Rows (lang, source, other, value): sums over the terms of a tile, for each ordered pair of its sources.

    A row of the tile is a group (digest null, its N as count) or a term's count in a group.
    """
    lang, low, high = (rows.column(x)[0].as_py() for x in ("lang", "low", "high"))
    v, width = rows.column("v")[0].as_py(), rows.column("width")[0].as_py()
    names = rows.column("source").dictionary_encode().combine_chunks()
    index, count = names.indices.to_numpy(), rows.column("count").to_numpy()
    block, digest = rows.column("block").to_numpy(), rows.column("digest").combine_chunks()
    group = np.asarray(digest.is_null())
    n, side = np.zeros(len(names.dictionary), np.int64), np.zeros(len(names.dictionary), np.int64)
    n[index[group]], side[index[group]] = count[group], block[group]
    split = rows.column("split").to_numpy()[~group].astype(np.int64)
    _, place = np.unique(digest.filter(pa.array(~group)).to_numpy(), return_inverse=True)
    _, place = np.unique(place * (split.max(initial=0) + 1) + split, return_inverse=True)
    counts = np.zeros((len(n), width), np.int64)
    counts[index[~group], place] = count[~group]
    p = shares(counts, n, v) if v else np.ones_like(counts)
    a, b, value = [], [], []
    for i in range(len(n)):
        if side[i] == low:
            with_i = np.flatnonzero((side == high) & (np.arange(len(n)) != i))
            gap = p[with_i] - p[i]
            a.append(np.full(len(with_i), i))
            b.append(with_i)
            value.append((gap * gap // (p[with_i] + p[i])).sum(axis=1) if v else np.zeros(len(with_i), np.int64))
    a, b, value = (np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64) for x in (a, b, value))
    if low != high:  # pairs within one block come in both orders already
        a, b, value = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([value, value])
    text = names.dictionary.take
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "source": text(pa.array(a)), "other": text(pa.array(b)), "value": pa.array(value)})


class Audit:
    """The staged tables of one audit: groups (lang, source, n, lang_n, v, sources) and counts of kept terms."""

    def __init__(self, docs: DataFrame, min_docs: int, digest: Callable[[Column], Column], held: int):
        named = [F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]
        rows = docs.select(*named, "text").mapInArrow(counting(held), "lang string, source string, term binary, n long, docs long")
        seen = stage(rows.withColumn("digest", digest(F.col("term"))), "terms")
        terms = seen.filter("term is not null")
        # one row per digest; tasks send one least and one greatest string each
        self.spelled = stage(terms.groupBy("digest").agg(F.min("term").alias("term"), F.max("term").alias("last")), "spelled")
        self.collided = self._split(terms)
        keyed = terms.withColumn("split", F.lit(0))
        if self.collided is not None:
            keyed = terms.join(self.collided, ["digest", "term"], "left").withColumn("split", F.coalesce("split", F.lit(0)))
        counts = keyed.groupBy("lang", "source", *KEY).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        term = Window.partitionBy("lang", *KEY)  # at most one row per source of the language
        counts = counts.withColumns({"lang_n": F.sum("n").over(term), "lang_docs": F.sum("docs").over(term)}).filter(F.col("lang_docs") >= min_docs)
        self.counts = stage(counts.select("lang", "source", *KEY, "n", "lang_n"), "counts")
        kept = self.counts.groupBy("lang", *KEY).agg(F.first("lang_n").alias("lang_n")).groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_n"))
        used = self.counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
        groups = seen.select("lang", "source").distinct().join(used, ["lang", "source"], "left")
        sources = seen.select("lang", "source").distinct().groupBy("lang").agg(F.count("*").alias("sources"))
        langs = stage(sources.join(kept, "lang", "left"), "langs")
        zero = F.lit(0).cast("long")
        self.groups = stage(groups.join(langs, "lang").select("lang", "source", "sources", *[F.coalesce(c, zero).alias(c) for c in ("n", "v", "lang_n")]), "groups")

    def _split(self, terms: DataFrame) -> DataFrame | None:
        """(digest, term, split) of the strings of colliding digests, numbered from 1; None where nothing collides."""
        collided = stage(self.spelled.filter("term != last").select("digest"), "collided")
        if collided.isEmpty():
            return None
        strings = terms.select("digest", "term").join(collided, "digest", "left_semi").distinct()
        return stage(strings.withColumn("split", F.row_number().over(Window.partitionBy("digest").orderBy("term"))), "split")

    def spell(self, rows: DataFrame) -> DataFrame:
        """Adds the string `item` of each (digest, split)."""
        rows = rows.join(self.spelled.select("digest", F.col("term").alias("plain")), "digest")
        if self.collided is not None:
            rows = rows.join(self.collided.withColumnRenamed("term", "own"), KEY, "left").withColumn("plain", F.coalesce("own", "plain"))
        return rows.withColumn("item", F.col("plain").cast("string"))

    def terms(self, top: int) -> DataFrame:
        """(lang, source, item, value, rank): terms that a group uses above its language, the first `top` of each group."""
        rows = self.counts.join(self.groups.select("lang", "source", F.col("n").alias("group_n"), "v", F.col("lang_n").alias("all_n")), ["lang", "source"])
        rows = rows.withColumns({"p": share(F.col("n"), F.col("group_n"), F.col("v")), "q": share(F.col("lang_n"), F.col("all_n"), F.col("v"))})
        rows = rows.filter("p > q").select("lang", "source", *KEY, difference(F.col("p"), F.col("q")).alias("value"))
        group = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
        near = stage(rows.withColumn("rank", F.rank().over(group)).filter(F.col("rank") <= top).drop("rank"), "near")  # ties stay
        ranked = self.spell(near).withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "plain")))
        return ranked.filter(F.col("rank") <= top).select("lang", "source", "item", "value", "rank")

    def pairs(self, width: int, height: int) -> DataFrame:
        """(lang, source, item, value, rank): each other source of the language by what all kept terms differ."""
        parts = lambda n, size: F.greatest(F.lit(1), F.ceil(F.col(n) / size)).cast("int")
        groups = self.groups.withColumns({"blocks": parts("v", width), "sides": parts("sources", height)})
        side = F.pmod(F.xxhash64("source"), F.col("sides")).cast("int").alias("block")
        piece = F.pmod(F.xxhash64(*KEY), F.col("blocks")).cast("int").alias("slice")
        rows = self.counts.join(groups.select("lang", "source", "blocks", "sides", "v"), ["lang", "source"])
        rows = rows.select("lang", "source", "v", "sides", side, piece, *KEY, F.col("n").alias("count"))
        # a tile needs the number of its terms, not their names, to know its zeros
        widths = rows.select("lang", "slice", *KEY).distinct().groupBy("lang", "slice").agg(F.count("*").cast("int").alias("width"))
        every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("slice")
        none = [F.lit(None).cast("long").alias("digest"), F.lit(0).alias("split")]
        heads = groups.select("lang", "source", "v", "sides", side, every, *none, F.col("n").alias("count"))
        tiles = rows.unionByName(heads).withColumn("opposite", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
        tiles = tiles.withColumns({"low": F.least("block", "opposite"), "high": F.greatest("block", "opposite")})
        tiles = tiles.join(widths, ["lang", "slice"], "left").withColumn("width", F.coalesce("width", F.lit(0)))
        tiles = tiles.select("lang", "slice", "low", "high", "source", "block", *KEY, "count", "v", "width")
        sums = tiles.groupBy("lang", "slice", "low", "high").applyInArrow(tiling, "lang string, source string, other string, value long")
        sums = sums.groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value"))
        rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
        return sums.withColumn("rank", rank)


def source_divergence(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    digest: Callable[[Column], Column] = digest64,
    held: int = HELD,
    width: int = TERMS,
    height: int = SOURCES,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): part `pair` for every other source of the language, part `term` for the top terms."""
    audit = Audit(docs, min_docs, digest, held)
    parts = [("pair", audit.pairs(width, height)), ("term", audit.terms(top))]
    pair, term = (x.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, x in parts)
    return pair.unionByName(term)
