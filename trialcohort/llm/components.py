"""Connected components of a graph given as edges, by rounds of minimum neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialcohort.llm.common import stage_few
from trialcohort.operators.joins import fresh_join


def connected_components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) of long ids, one row (node, root) for each node with an edge; root is the least node reachable.

    Each round hangs every node's larger neighbours on its least one, then every node on the least of its smaller ones;
    the number of rounds grows with the logarithm of the longest chain. Neighbours are never gathered: the least is
    an aggregate that tasks combine before the shuffle, so a node with very many neighbours costs no more than its edges.
    """
    now = stage_few(edges.filter("a != b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = fresh_join(both.filter("u > v"), least, ["v"]).select(F.col("u").alias("v"), F.col("m").alias("u")).filter("u != v").distinct()
        large = stage_few(large, "large")
        below = large.groupBy("v").agg(F.min("u").alias("m"))
        small = fresh_join(large, below, ["v"])
        small = small.select("v", F.col("m").alias("u")).unionByName(small.filter("u != m").select(F.col("u").alias("v"), F.col("m").alias("u"))).distinct()
        then = stage_few(small, "small")
        # done when each node hangs on one root, and no root hangs on another
        roots = then.select(F.col("u").alias("v")).distinct()
        more = then.groupBy("v").agg(F.count("*").alias("n")).filter("n > 1").select("v").unionByName(then.join(roots, "v", "left_semi").select("v"))
        if more.isEmpty():
            return then.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
        now = then
