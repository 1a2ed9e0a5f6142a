"""What the physical plans must and must not hold."""

import contextlib
import random
import re
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.fixture_tables import inputs
from trialcohort.functions import numbers
from trialcohort.functions.fixed_values import STUDY_COLUMNS
from trialcohort.operators import baseline, icd, joins, paging, represent, sampling, study, text_flags
from trialcohort.plans import driver_queries, pipeline, standins
from trialcohort.sources.shared import staged

FOLDER = "/root/testdata/sf0.001"
FACTS = ["sampling_method", "gender", "minimum_age", "maximum_age", "were_results_reported"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.mark.parametrize("name", ["wide_table", "label_requests", "keyword_flags", "trial_text", "representation", "icd_map"])
def test_no_python_in_the_plan(spark, name):
    text = plan(driver_queries.queries()[name](spark, FOLDER))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_only_needed_columns_are_read(spark):
    df = driver_queries.pivot_sums(standins.Tables(spark, FOLDER))
    text = plan(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_filters_reach_the_scan(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = plan(baseline.non_negative(lines, "l_quantity").select("l_quantity"))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,0.0)]" in text


def test_small_dimensions_are_broadcast(spark):
    t = standins.Tables(spark, FOLDER)
    codes = driver_queries._part_codes(t)
    assert "BroadcastHashJoin" in plan(icd.with_chapter(codes, icd.chapter_frame(spark)))
    supplier = spark.read.parquet(f"{FOLDER}/supplier.parquet").selectExpr("s_name as title_lc", "'age' as category")
    rows_ = spark.read.parquet(f"{FOLDER}/supplier.parquet").withColumnRenamed("s_name", "title")
    assert "BroadcastHashJoin" in plan(baseline.with_title_category(rows_, supplier))


def exchanged(df):
    """The output columns of every shuffle of the plan."""
    found = []

    def walk(node):
        if "Exchange" in node.getClass().getSimpleName():
            found.append([node.output().apply(i).name() for i in range(node.output().size())])
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    top = df._jdf.queryExecution().executedPlan()
    walk(top.initialPlan() if top.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else top)
    return found


def test_no_text_is_shuffled_for_flags(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        flags = driver_queries.intervention_flags(standins.Tables(spark, FOLDER))
        shuffles = exchanged(flags)
        text = plan(flags)
    long_texts = {"text", "html", "official_title", "description"}
    assert shuffles and not any(long_texts & set(columns) for columns in shuffles if "known" in columns)
    for name in ("documents", "pages", "conversations", "benchmark"):
        assert text.count(f"{name}.parquet") == 1


def test_wide_table_has_few_shuffles(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        star = plan(driver_queries.study_star(standins.Tables(spark, FOLDER)))
    assert star.count("FileScan") - star.count("ReusedExchange") <= 16
    # where no key is longer than a page, what numbers pages is planned but doesn't run
    wide = driver_queries.wide_table(standins.Tables(spark, FOLDER))
    wide.collect()
    assert plan(wide).split("== Initial Plan ==")[0].count("Exchange hashpartitioning") <= 40


def hot(spark, n=60_000):
    """n rows, a third of which share one key; wide enough to be worth splitting."""
    return (
        spark.range(n)
        .repartition(16)
        .withColumn("key", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 997)))
        .withColumn("filler", F.sha2(F.col("id").cast("string"), 512))
    )


SKEW = {
    "spark__sql__shuffle__partitions": "64",
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


SMALL = {
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "128KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
}


def check_spread(joined, expected):
    """All rows are there and no task of the join had more than a small share of them."""
    # the filler has to go through the join, or its partitions are too small to be split
    tasks = joined.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("rows"), F.max("filler")).collect()
    per_task = [r["rows"] for r in tasks]
    assert sum(per_task) == expected
    assert max(per_task) < 0.15 * expected


def test_hot_title_is_spread(spark):
    with settings(spark, **SKEW, **SMALL):
        df = hot(spark).withColumnRenamed("key", "title")
        dictionary = df.select(F.lower("title").alias("title_lc")).distinct().withColumn("category", F.lit("age"))
        check_spread(baseline.with_title_category(df, dictionary), 60_000)


def test_hot_title_of_a_dictionary_of_the_same_titles_is_spread(spark):
    with settings(spark, **SKEW, **SMALL):
        df = hot(spark).withColumn("title", F.concat(F.lit("age "), "key"))
        check_spread(baseline.with_title_category(df, baseline.title_dictionary(df)), 60_000)


def test_hot_trial_of_the_star_is_split(spark):
    with settings(spark, **SKEW, **SMALL):
        countries = hot(spark).select(F.col("key").alias("nct_id"), F.col("filler").alias("name"))
        trials = countries.select("nct_id").distinct()
        studies = trials.select("nct_id", *[F.lit(None).cast("string").alias(c) for c in STUDY_COLUMNS if c not in ("nct_id", "name", *FACTS)])
        facts = trials.select("nct_id", *[F.lit("x").alias(c) for c in FACTS[:-1]]), trials.select("nct_id", F.lit(True).alias(FACTS[-1]))
        star = study.study_star(studies, facts[0], countries, facts[1])
        assert len(star.collect()) == 60_000
        assert "skew=true" in plan(star)


def test_hot_term_is_split(spark):
    with settings(spark, **SKEW, **SMALL):
        conditions = hot(spark).select(F.col("filler").alias("nct_id"), F.col("key").alias("mesh_term"))
        terms = conditions.select(F.col("mesh_term").alias("label"), F.lit("A10.1").alias("icd_code"), F.lit("m").alias("mesh_code")).distinct()
        none = spark.createDataFrame([], "ICD10CM_ID string, MESH_ID string")
        found = icd.icd_map(none, none, terms, conditions, spark.createDataFrame([], "NCT_id string, ICD10 string"), icd.chapter_frame(spark))
        assert len(found.collect()) == 60_000
        assert "skew=true" in plan(found)


def test_hot_missing_expression_is_spread(spark):
    with settings(spark, **SKEW, **SMALL):
        df = hot(spark).withColumnRenamed("key", "cat_exp").withColumn("cat_title", F.lit("age"))
        df = df.withColumn("cat_exp", F.nullif("cat_exp", F.lit("hot")))
        names = df.groupBy("cat_title", "cat_exp").agg(F.lit("x").alias("piv_cat"))
        joined = represent.with_labels(df, names)
        check_spread(joined, 60_000)
        assert joined.filter("piv_cat is null").count() == 0


def test_hot_trial_of_a_left_join_is_spread(spark):
    with settings(spark, **SKEW, **SMALL):
        countries = hot(spark)
        trials = countries.select("key").distinct().union(spark.createDataFrame([("lone",)], "key string"))
        check_spread(joins.left_join_many(trials, countries, ["key"]), 60_001)


def test_hot_group_is_split_at_run_time(spark):
    with settings(spark, **SKEW, **SMALL):
        df = hot(spark).withColumn("count", F.col("id") % 1)
        largest = baseline.group_max_rows(df, "key", "count")
        assert len(largest.collect()) == 60_000
        assert "skew=true" in plan(largest)


def test_hot_list_is_taken_apart(spark):
    df = hot(spark)
    lists = study.aligned_lists(df, "key", {"id": "ids"}, 1000)
    sizes = rows(lists.groupBy("key").agg(F.sum(F.size("ids")).alias("n"), F.max(F.size("ids")).alias("largest")))
    assert sum(n for _, n, _ in sizes) == 60_000
    assert max(largest for _, _, largest in sizes) == 1000



def test_no_task_numbers_much_of_a_hot_key(spark):
    """A million values that share their beginnings: every range is a small share, and the pages are exact."""
    with settings(spark, spark__sql__shuffle__partitions="32"):
        df = spark.range(1_000_000).select(F.lit("hot").alias("key"), F.format_string("Arm %07d", "id").alias("arm"))
        df = df.repartition(16).union(spark.createDataFrame([("cold", "Arm 0"), ("cold", None)], "key string, arm string"))
        _, stepped = paging.split_by_length(df, df.groupBy("key").agg(F.count("*").alias("__rows")), "key")
        bounds = paging.range_bounds(stepped, ["key"], ["arm"], F.lit(1))
        found = {r.key: [b.arm for b in r["__bounds"]] for r in bounds.collect()}
        assert set(found) == {"hot"}
        at = [0, *(int(b[4:]) for b in found["hot"]), 1_000_000]
        assert len(at) < 400 and max(b - a for a, b in zip(at, at[1:])) < 100_000
        pages = study.aligned_lists(df, "key", {"arm": "arms"}, 100_000).collect()
        hot_pages = {r.list_part: r.arms for r in pages if r.key == "hot"}
        assert [x for k in sorted(hot_pages) for x in hot_pages[k]] == [f"Arm {i:07d}" for i in range(1_000_000)]
        assert max(map(len, hot_pages.values())) == 100_000
        assert [(r.list_part, r.arms) for r in pages if r.key == "cold"] == [(0, [None, "Arm 0"])]


def test_lists_do_not_depend_on_how_a_key_is_cut(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, "x", "y"]), rng.choice([None, *"pqrst"])) for _ in range(700)]
    df = spark.createDataFrame(data, "k string, one string, two string").repartition(3)
    families = [paging.Family(df, "k", {"one": "ones", "two": "twos"}), paging.Family(df.filter("one = 'x'"), "k", {"two": "only"})]
    whole = rows(paging.paged_lists(families, "k", 10_000))
    for at_once in (1, 7, 10_000):
        parts = defaultdict(dict)
        for r in paging.paged_lists(families, "k", 9, at_once).collect():
            parts[r.k][r.list_part] = r
        joined = [(k, 0, *([x for p in sorted(pages) for x in pages[p][c] or []] for c in ("ones", "twos", "only"))) for k, pages in parts.items()]
        assert sorted(joined, key=repr) == whole


def test_a_large_sample_needs_no_single_task(spark):
    df = spark.range(50_000).withColumnRenamed("id", "k")
    text = plan(sampling.sample_ids(df, "k", 20_000))
    counts = re.findall(r"Exchange SinglePartition.*\n.*HashAggregate\(keys=\[__cell", text)  # the only rows that meet
    assert "TakeOrdered" not in text and text.count("Exchange SinglePartition") == len(counts) > 0
    assert sampling.sample_ids(df, "k", 20_000).count() == 20_000


def test_texts_are_read_once_for_rows_and_once_for_lengths(spark):
    text = plan(driver_queries.trial_text(standins.Tables(spark, FOLDER)))
    sets = text_flags.text_sets(spark.read.parquet(f"{FOLDER}/documents.parquet").selectExpr("lang as k", "'f' as field", "text"), "k")
    sets.collect()
    final = plan(sets).split("== Initial Plan ==")[0]
    assert final.count("FileScan") + final.count("Scan parquet") <= 2 and "Python" not in text


def ran(df):
    """The plan as it ran in the end."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_texts_within_a_page_are_shuffled_once(spark):
    """texts of short keys are told from those of long ones where they lie, and no sort comes before they are gathered."""
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        sets = text_flags.text_sets(hot(spark).selectExpr("cast(id % 1000 as string) as k", "'f' as field", "filler as text"), "k")
        text = plan(sets)
    assert re.search(r"BroadcastHashJoin .*LeftAnti", text) and not re.search(r"SortMergeJoin .*LeftAnti", text)
    assert ran(sets).count("Exchange hashpartitioning(") == 1


def test_ids_of_codes_are_not_shuffled_by_term(spark):
    """a shuffle of terms holds their codes at most, the ids meet them after it."""
    t = standins.Tables(spark, FOLDER)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        shuffles = exchanged(driver_queries.term_sets(t)) + exchanged(driver_queries.trial_code_sizes(t))
    by_term = [columns for columns in shuffles if "MESH_term" in columns]
    assert by_term and not any("ids" in columns or columns.count("buf") > 1 for columns in by_term)


def test_lists_within_a_page_are_shuffled_once(spark):
    """beside that of counts of rows, which is done by then, one shuffle, and no table of distinct rows in a task."""
    sponsors = hot(spark).selectExpr("cast(id % 1000 as string) as nct_id", "key as agency_class", "'lead' as lead_or_collaborator")
    final = ran(pipeline.sponsor_lists(sponsors))
    assert final.count("Exchange hashpartitioning(") == 1
    assert not re.findall(r"HashAggregate\(keys=\[[^]]*agency_class", final)


def test_countries_are_counted_in_one_table_of_trials(spark):
    """a task holds its trials, not their pairs with names too."""
    facts = ran(study.country_facts(hot(spark).selectExpr("cast(id % 1000 as string) as nct_id", "key as name")))
    assert not re.findall(r"HashAggregate\(keys=\[[^]]*name", facts) and facts.count("Exchange hashpartitioning(") == 1


def test_wide_rows_are_joined_packed_and_lists_gathered_once(spark):
    """no generated method holds the wide rows, families of lists are gathered by one aggregate, their rows made once."""
    wide = driver_queries.wide_table(standins.Tables(spark, FOLDER))
    final = ran(wide)
    top = next(line for line in final.splitlines() if "Project [" in line)
    assert "*(" not in top.split("Project [")[0]
    by_trial = [line for line in final.splitlines() if re.search(r"ObjectHashAggregate\(keys=\[nct_id", line, re.IGNORECASE)]
    assert by_trial and all(len(re.findall(r"collect_(?:list|set)\(", line)) <= 1 for line in by_trial)
    assert len(re.findall(r"FileScan parquet \[l_orderkey", final)) <= 4


def test_sums_of_wide_rows_stay_out_of_generated_methods(spark):
    """the values are those of a plain sum, nulls as nothing."""
    columns = [f"c{i}" for i in range(6)]
    df = spark.createDataFrame([(0.1, 0.2, None, 0.3, -0.0, 1e16), (None,) * 6], ", ".join(f"{c} double" for c in columns))
    summed = df.select("*", numbers.sum_skipping_nulls([F.col(c) for c in columns]).alias("total"))
    assert "*(" not in next(line for line in plan(summed.join(df.select("c0"), "c0", "left")).splitlines() if "aggregate(" in line).split("Project [")[0]
    assert [r.total for r in summed.collect()] == [0.0 + 0.1 + 0.2 + 0.0 + 0.3 + -0.0 + 1e16, 0.0]


def test_wide_table_of_slices_is_that_of_one(spark):
    given, kept = inputs(spark), []

    def keep(df, name):
        kept.append(name)
        return staged(df, name)

    def wide(**more):
        tables = [pipeline.base_of(given), given.countries, given.census, pipeline.trial_flags_of(given), given.interventions, given.sponsors]
        icd_codes, baselines = pipeline.icd_of(given, keep), pipeline.categorised_baselines(given, keep)
        return rows(pipeline.wide_table(*tables, icd_codes, baselines, given.labels, keep=keep, **more))

    whole = wide()
    assert whole and not [x for x in kept if x.startswith("wide_")]
    assert wide(slice_rows=5) == whole
    assert len([x for x in kept if x.startswith("wide_rows_")]) > 1


def test_a_trial_is_in_one_slice(spark):
    ids = spark.createDataFrame([(f"T{i}",) for i in range(50)] + [(None,)], "nct_id string")
    found = ids.select(*[pipeline.in_slice("nct_id", i, 4).cast("int").alias(f"s{i}") for i in range(4)]).collect()
    assert all(sum(r) == 1 for r in found) and all(sum(c) for c in zip(*found))


def test_staging_frees_its_shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before, until = files.getAllFiles().size(), time.time() + 20
    staged(standins.Tables(spark, FOLDER).lineitem.groupBy("l_orderkey").count(), "freed")
    while files.getAllFiles().size() > before and time.time() < until:
        time.sleep(0.2)
    assert files.getAllFiles().size() <= before


def test_repeated_terms_are_not_shuffled_twice(spark):
    """A trial's terms go by term to their codes and by trial to its sets; what repeats is dropped in the latter."""
    conditions = spark.createDataFrame([("A", "Flu"), ("A", "flu"), ("B", "FLU")], "nct_id string, mesh_term string")
    terms = spark.createDataFrame([("Flu", "J11.1", "D1"), ("flu", "J10", "D1")], "label string, icd_code string, mesh_code string")
    none = spark.createDataFrame([], "ICD10CM_ID string, MESH_ID string")
    direct = spark.createDataFrame([("B", "J11")], "NCT_id string, ICD10 string")
    found = icd.icd_map(none, none, terms, conditions, direct, icd.chapter_frame(spark))
    assert rows(found) == [("A", ["J10", "J11"], ["Respiratory System"]), ("B", ["J10", "J11"], ["Respiratory System"])]
    assert not re.search(r"hashpartitioning\(NCT_id#\d+, MESH_term", plan(found))
