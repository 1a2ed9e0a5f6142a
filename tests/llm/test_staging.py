"""Rows of graphs and groups are staged in few files, however many partitions the shuffles have."""

from collections import Counter
from pathlib import Path

from tests.llm.conftest import sorted_rows
from tests.test_plans import SKEW, settings
from trialcohort.llm import circulant_minhash, common
from trialcohort.llm.components import connected_components

MANY = {**SKEW, "spark__sql__shuffle__partitions": "90"}


def files(spark):
    """Files with rows, or the first without, of each table staged so far."""
    return Counter(str(x.parent) for x in Path(spark.conf.get("spark.checkpoint.dir")).glob("*/part-*.parquet"))


def most(spark):
    return max(common.FEW_FILES, common.FILES_PER_CORE * spark.sparkContext.defaultParallelism)


def added(spark, before, *names):
    now = {k: n for k, n in files(spark).items() if k not in before}
    return {x: [n for k, n in now.items() if Path(k).name.startswith(f"{x}-")] for x in names}


def test_components_are_staged_in_few_files(spark):
    """Chains of ten nodes each: every round has thousands of rows, a few for each of 90 partitions at least."""
    before = files(spark)
    with settings(spark, **MANY):
        edges = spark.range(5_000).filter("id % 10 != 9").selectExpr("id AS a", "id + 1 AS b")
        found = connected_components(edges)
        assert sorted_rows(found.selectExpr("root = node - node % 10 AS right").groupBy("right").count()) == [(True, 5_000)]
    for name, counts in added(spark, before, "edges", "large", "small").items():
        assert counts and max(counts) <= most(spark) < 90, name


def test_groups_are_staged_in_few_files(spark):
    """Two hundred groups of near copies."""
    before = files(spark)
    with settings(spark, **MANY):
        words = "concat_ws(' ', transform(sequence(1, 60), x -> concat('g', id % 200, 'x', x)))"
        docs = spark.range(600).selectExpr("id AS doc_id", f"concat({words}, ' end', id) AS text")
        found = circulant_minhash.near_duplicate_digest(docs).groupBy("kept").count()
        assert sorted_rows(found) == [(False, 400), (True, 200)]
    for name, counts in added(spark, before, "centers", "star", "names").items():
        assert counts and max(counts) <= most(spark) < 90, name
