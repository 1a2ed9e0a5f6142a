"""Baseline measures: the total group of each trial, and what each measure is about."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trialcohort.functions.fixed_values import CURATED_TITLES, TITLE_WORDS
from trialcohort.functions.text import has_token
from trialcohort.operators.joins import left_join_many, lookup_join

UNKNOWN = "unknown"


def measures(counts: DataFrame, measurements: DataFrame, on: Sequence[str] = ("nct_id", "ctgov_group_code")) -> DataFrame:
    """Group counts with their measurements; a group without any keeps one row."""
    return left_join_many(counts, measurements, on)


def group_max_rows(df: DataFrame, key: str, value: str) -> DataFrame:
    """Rows holding their group's largest value, ties kept; a group of nulls only has none.

    A window would sort a whole group in one task. Here the maximum is combined map-side and only it
    is joined back, on key and value: a fresh shuffle on both sides, which can be split at run time.
    """
    largest = df.groupBy(key).agg(F.max(value).alias(value))
    return df.join(largest, [key, value], "left_semi")


def non_negative(df: DataFrame, value: str) -> DataFrame:
    """Rows whose value is zero or more; nulls go too."""
    return df.filter(F.col(value) >= 0)


def baseline_rows(
    counts: DataFrame, measurements: DataFrame, keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """Measurements of each trial's largest group, non-negative values only.

    The largest group depends on the counts alone, so it is picked before the join; and a group without
    measurements has no valid value, so the join may be an inner one. `keep` writes the largest groups and reads them
    back, so that the shuffles that picked them needn't stay for the join.
    """
    total_group = group_max_rows(counts, "nct_id", "count")
    if keep is not None:
        total_group = keep(total_group, "total_groups")
    return non_negative(measurements, "param_value_num").join(total_group, ["nct_id", "ctgov_group_code"])


def title_category(title: Column) -> Column:
    """Category by the words in a title, the first rule that fits: age, race, gender, enrollment."""
    t = F.lower(title)
    return (
        F.when(t.contains("age"), "age")
        .when(t.rlike("race|ethnicity"), "race")
        .when(t.rlike("gender|sex|male|female"), "gender")
        .when(t.contains("enrollment"), "enrollment")
    )


def title_dictionary(titles: DataFrame, title: str = "title") -> DataFrame:
    """(title_lc, category) of curated titles, by their words; titles that fit no rule are left out."""
    return (
        titles.select(F.lower(F.col(title)).alias("title_lc"))
        .distinct()
        .withColumn("category", title_category(F.col("title_lc")))
        .filter(F.col("category").isNotNull())
    )


def title_frame(spark: SparkSession, titles: Iterable[str]) -> DataFrame:
    return spark.createDataFrame([(t,) for t in titles], "title string")


def title_candidates(df: DataFrame, title: str = "title", words: Iterable[str] = TITLE_WORDS) -> DataFrame:
    """Rows whose title holds one of the words as a whole token: what a curated list is picked from."""
    return df.filter(has_token(F.col(title), words))


def with_title_category(df: DataFrame, dictionary: DataFrame | None = None, title: str = "title") -> DataFrame:
    """Adds cat_title: the category of the title, letter case aside but not blanks; 'unknown' without one.

    Without a dictionary the titles of CURATED_TITLES count, each in the category of its words.
    """
    if dictionary is None:
        curated = F.lower(F.col(title)).isin(sorted({t.lower() for t in CURATED_TITLES}))
        return df.withColumn("cat_title", F.coalesce(F.when(curated, title_category(F.col(title))), F.lit(UNKNOWN)))
    keyed = df.withColumn("title_lc", F.lower(F.col(title)))
    named = dictionary.select("title_lc", F.col("category").alias("cat_title"))
    return (
        lookup_join(keyed, named, ["title_lc"])
        .drop("title_lc")
        .withColumn("cat_title", F.coalesce("cat_title", F.lit(UNKNOWN)))
    )


def null_pattern(category: Column, classification: Column) -> Column:
    """3 both missing, 1 no category, 2 no classification, 4 both there."""
    return (
        F.when(category.isNull() & classification.isNull(), 3)
        .when(category.isNull(), 1)
        .when(classification.isNull(), 2)
        .otherwise(4)
    )


def expression(cat_title: Column, nan_status: Column, category: Column, classification: Column) -> Column:
    """The text that says whom a demographic measure counts."""
    demographic = cat_title.isin("gender", "race", "age")
    return F.when(demographic & (nan_status == 1), classification).when(
        demographic & nan_status.isin(2, 4), category
    )


def with_expression(df: DataFrame) -> DataFrame:
    """Adds nan_status and cat_exp."""
    return df.withColumn("nan_status", null_pattern(F.col("category"), F.col("classification"))).withColumn(
        "cat_exp",
        expression(F.col("cat_title"), F.col("nan_status"), F.col("category"), F.col("classification")),
    )


def categorise(baselines: DataFrame, dictionary: DataFrame | None = None) -> DataFrame:
    """Rows whose title has a category, by the dictionary or else by the titles shipped, with cat_title, nan_status and cat_exp."""
    known = with_title_category(baselines, dictionary).filter(F.col("cat_title") != UNKNOWN)
    return with_expression(known)


def null_pattern_report(df: DataFrame, key: str = "nct_id", status: str = "nan_status") -> DataFrame:
    """Number of trials per null pattern. Distinct trials are taken first, so no task counts a pattern alone."""
    return (
        df.select(status, key)
        .distinct()
        .groupBy(status)
        .agg(F.count(key).alias("count"))
    )
