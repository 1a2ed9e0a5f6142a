"""Secrets in text: three patterns, and strings of high entropy in any window. Built-in functions only.

Patterns: assignments to names like password or api_key, access keys, and hexadecimal runs; matches don't overlap within
a kind, and those that are too short fall after matching.

Entropy: candidates are runs of 20 or more characters of base64 or names, with a digit and a letter. A window of 20
characters slides over each; the counts of characters in the window are updated by the one that enters and the one that
leaves, and so is the sum of c * log2(c), which gives the Shannon entropy log2(20) - sum / 20. A candidate is a secret if
some window reaches the limit of its class (hexadecimal or mixed). Windows that overlap an allowed word (alphabets,
placeholders) don't count; the others of the candidate do. Allow-listed candidates (identifiers in the form of a UUID,
digests of sub-resources) and those within a span found already are left out.

Spans count code points from 0, the end is exclusive. A null text is empty and has none. Rows are independent of each
other: repeated rows, null ids and extra columns make no difference.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["assign", "access", "hex", "entropy"]
# fixed values: the patterns and least lengths of the kinds
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ASSIGN_LEAST = 8
ACCESS = "AKIA[A-Z0-9]{12,}"  # runs of 16 or more, as shorter ones are dropped
HEX = "[0-9a-f]{32,}"
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WINDOW = 20
STEP = 256  # spans that are placed at once
HEX_LIMIT, MIXED_LIMIT = 3.0, 3.6
ALLOWED_RUNS = ["^[0-9A-Fa-f]{8}-([0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$", "^sha(256|384|512)-"]
ALLOWED_WORDS = "0123456789|(?i:abcdefghij|example(?:xample)*|placeholder|x{5,})"  # occurrences that overlap are one


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each number of an array of longs, merge() of it and all before it; merge is associative and 0 its neutral number.

    An array that grows by one is copied each time, so blocks of STEP are run through by themselves, then their last numbers.
    """

    def add(state: Column, x: Column) -> Column:
        now = merge(state["last"], x)
        return F.struct(now.alias("last"), F.array_append(state["all"], now).alias("all"))

    def alone(block: Column) -> Column:
        return F.aggregate(block, F.struct(F.lit(0).cast("long").alias("last"), F.array().cast("array<long>").alias("all")), add, lambda s: s["all"])

    def together(blocks: Column) -> Column:
        tops = alone(F.transform(blocks, lambda x: F.element_at(x, -1)))
        ahead = lambda t, i: F.coalesce(F.get(t, i - 1), F.lit(0).cast("long"))
        return bound(tops, lambda t: F.flatten(F.transform(blocks, lambda block, i: F.transform(block, lambda x: merge(ahead(t, i), x)))))

    def cut(all_values: Column) -> Column:
        starts = F.sequence(F.lit(0), F.call_function("div", F.size(all_values) - 1, F.lit(STEP)).cast("int"))
        return F.transform(starts, lambda i: alone(F.slice(all_values, i * STEP + 1, F.lit(STEP))))

    return bound(values, lambda v: F.when(F.size(v) > 0, bound(cut(v), together)).otherwise(v))


def matches(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Array of (start, kind, end, value) of all matches, in order; value is the given group, of `least` characters or more.

    The pieces between matches and the matches themselves alternate, so their lengths give the places.
    """
    found = [F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit")]
    found += [F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value")] * (group > 0)
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")

    def spans(pair: Column) -> Column:
        steps = F.transform(pair, lambda x: (F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0))).cast("long"))

        def span(ends: Column) -> Callable[[Column, Column], Column]:
            def at(x: Column, i: Column) -> Column:
                end = F.get(ends, i).cast("int")
                value = x["value" if group else "hit"]
                return F.struct((end - F.length(x["hit"])).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), value.alias("value"))

            return at

        placed = bound(running(steps, lambda a, b: a + b), lambda ends: F.transform(pair, span(ends)))
        return F.filter(placed, lambda x: x["value"].isNotNull() & (F.length(x["value"]) >= least))

    return F.when(text.rlike(pattern), bound(F.arrays_zip(*found), spans)).otherwise(empty)


def window_entropy(value: Column, window: int = WINDOW) -> Column:
    """The highest Shannon entropy, in bits, of any `window` consecutive characters of value (which is as long or longer)."""

    def weight(c: Column) -> Column:
        return F.when(c > 1, c * F.log2(c)).otherwise(0.0)

    def symbol(characters: Column, at: Column) -> Column:
        return F.instr(F.lit(ALPHABET), F.get(characters, at - 1)) - 1

    def slide(characters: Column, state: Column, at: Column) -> Column:
        enters = symbol(characters, at)
        leaves = F.when(at > window, symbol(characters, at - window)).otherwise(-1)
        before = F.get(state["counts"], enters)
        gone = F.get(state["counts"], leaves)
        change = F.when(enters == leaves, 0.0).otherwise(
            weight(before + 1) - weight(before) + F.when(leaves >= 0, weight(gone - 1) - weight(gone)).otherwise(0.0)
        )
        total = state["total"] + change
        counts = F.transform(state["counts"], lambda c, i: c + (i == enters).cast("int") - (i == leaves).cast("int"))
        return F.struct(counts.alias("counts"), total.alias("total"), F.when(at >= window, F.least(state["least"], total)).otherwise(state["least"]).alias("least"))

    start = F.struct(F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0.0).alias("total"), F.lit(float(window * window)).alias("least"))
    entropy = lambda s: F.lit(math.log2(window)) - s["least"] / window
    places = F.sequence(F.lit(1), F.length(value))
    return bound(F.split(value, "", -1), lambda c: F.aggregate(places, start, lambda state, at: slide(c, state, at), entropy))


def is_random(value: Column) -> Column:
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    allowed = F.lit(False)
    for pattern in ALLOWED_RUNS:
        allowed |= value.rlike(pattern)
    limit = F.when(value.rlike("^([0-9a-f]+|[0-9A-F]+)$"), HEX_LIMIT).otherwise(MIXED_LIMIT)
    pieces = F.filter(F.split(value, ALLOWED_WORDS, -1), lambda x: F.length(x) >= WINDOW)
    return mixed & ~allowed & F.when(mixed & ~allowed, F.exists(pieces, lambda x: window_entropy(x) >= limit)).otherwise(False)


def secret_spans(docs: DataFrame) -> DataFrame:
    """Columns of docs and base, added: arrays of (start, kind, end) sorted by start, then kind; kind is the place in KINDS."""
    text = F.coalesce("text", F.lit(""))
    bare = lambda spans: F.transform(spans, lambda x: F.struct(x["start"], x["kind"], x["end"]))
    base = F.array_sort(bare(F.concat(matches(text, ASSIGN, 0, 2, ASSIGN_LEAST), matches(text, ACCESS, 1), matches(text, HEX, 2))))
    out = docs.withColumn("base", base)
    # among all spans in order, one lies within a base span if one that began before it ends no earlier
    again = F.transform("base", lambda x: F.struct(x["start"], x["kind"], x["end"], F.lit("").alias("value")))
    candidates = matches(text, CANDIDATE, 3)
    reach = lambda x: F.when(x["kind"] == 3, 0).otherwise(x["end"]).cast("long")

    def outside(every: Column) -> Column:
        furthest = running(F.transform(every, reach), F.greatest)
        return bound(furthest, lambda f: F.filter(every, lambda x, i: (x["kind"] == 3) & (F.get(f, i) < x["end"])))

    added = F.filter(bound(F.sort_array(F.concat(again, candidates)), outside), lambda x: is_random(x["value"]))
    return out.withColumn("added", F.when(text.rlike(CANDIDATE), bare(added)).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int>>")))


def joined(spans: str | Column) -> Column:
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def secrets(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, n_entropy, base_sha256, spans."""
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return secret_spans(docs.select("doc_id", "text")).select(
        "doc_id", count(0), count(1), count(2), F.size("added").cast("long").alias("n_entropy"),
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
