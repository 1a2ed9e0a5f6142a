"""Joins and unions on fresh shuffles, which adaptive execution can split where a key holds very many rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(key: Column) -> Column:
    """The key as a value whose partitioning Spark doesn't know.

    A join on it shuffles a side anew that an aggregate or a join has partitioned by the key already. Only a side that
    comes straight from a shuffle can be split at run time.
    """
    return F.element_at(F.array(key), 1)


def fresh_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", null_safe: bool = False) -> DataFrame:
    """left joined to right on the columns `on`, both sides on shuffles of their own; the columns of left, then right's others."""
    names = [(k, f"__left_{i}", f"__right_{i}") for i, k in enumerate(on)]
    one = left.withColumns({a: fresh(F.col(f"`{k}`")) for k, a, _ in names})
    two = right.withColumns({b: fresh(F.col(f"`{k}`")) for k, _, b in names}).drop(*on)
    equal = [F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b) for _, a, b in names]
    return one.join(two, reduce(lambda x, y: x & y, equal), how).drop(*[x for _, a, b in names for x in (a, b)])


def lookup_join(
    rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left", null_safe: bool = False
) -> DataFrame:
    """Rows joined to a lookup table. With `null_safe` a null key matches a null key.

    Spark broadcasts the lookup when its own size check allows. Otherwise both sides are shuffled for this
    join alone, and a hot key's rows are split at run time against its few rows of the lookup.
    """
    return fresh_join(rows, lookup, on, how, null_safe)


def left_join_many(left: DataFrame, many: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join to a large side with many rows per key.

    Written as an inner join, which adaptive execution may split on either side, and an anti join for
    rows without any partner; that one needs the distinct keys only, combined before their shuffle.
    """
    matched = fresh_join(left, many, on)
    without = left.join(many.select(*on).distinct(), list(on), "left_anti")
    return matched.unionByName(without, allowMissingColumns=True)


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, copies included, columns by name."""
    return reduce(DataFrame.unionByName, frames)
