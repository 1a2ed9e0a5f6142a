"""One query per operator and job over the given tables, each calling the real operator.

Lists come out as text and whole numbers as bigint, so results can be compared with other engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialcohort.functions.codes import code_prefix, strip_decimals
from trialcohort.functions.dates import date_text, parse_date, year_text
from trialcohort.functions.numbers import to_number
from trialcohort.functions.text import join_list, tokens, unwrap_single
from trialcohort.operators import baseline, icd, joins, labels, represent, sampling, study, text_flags
from trialcohort.plans import pipeline, standins
from trialcohort.plans.standins import Tables

DOCUMENT_KEYWORDS = ["the", "of the", "de", "la", "par la", "tion", "que"]


def plain(df: DataFrame) -> DataFrame:
    """Lists as text with '-' for null, whole numbers as bigint."""

    def column(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.ArrayType):
            c = F.array_join(c, " | ", "-")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        return c.alias(field.name)

    return df.select(*[column(f) for f in df.schema])


def group_max_rows(t: Tables) -> DataFrame:
    rows = baseline.group_max_rows(t.lineitem, "l_orderkey", "l_quantity")
    rows = baseline.non_negative(rows.withColumn("margin", F.col("l_discount") - 0.02), "margin")
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount")


def study_star(t: Tables) -> DataFrame:
    return study.study_star(
        standins.studies(t), standins.eligibilities(t), standins.countries(t), standins.calculated_values(t)
    )


def study_base(t: Tables) -> DataFrame:
    return study.study_base(standins.studies(t), standins.eligibilities(t), standins.calculated_values(t))


def measures(t: Tables) -> DataFrame:
    # A group of each order's own, beside those of its lines, has no measurement.
    empty = t.orders.selectExpr("cast(o_orderkey as string) as nct_id", "'BG99' as ctgov_group_code", "0L as count")
    counts = joins.union_all(standins.baseline_counts(t), empty)
    return baseline.measures(counts, standins.baseline_measurements(t))


def distinct_text(t: Tables) -> DataFrame:
    long = text_flags.long_text(
        standins.interventions(t), "nct_id", {"intervention_type": "types", "name": "names"}
    )
    return text_flags.fold_texts(long, "nct_id", ["types", "names"])


def title_category(t: Tables) -> DataFrame:
    rows = baseline.with_title_category(standins.baseline_measurements(t), standins.titles(t))
    return rows.select("nct_id", "ctgov_group_code", "title", "cat_title")


def title_rule(t: Tables) -> DataFrame:
    """The rule on titles made of part name, brand and type."""
    titles = t.part.selectExpr("p_partkey", "concat(p_name, ' ', p_type, ' enrollment package ', p_size) as title")
    return titles.select(
        "p_partkey",
        baseline.title_category(F.col("title")).alias("whole_title"),
        baseline.title_category(F.expr("replace(title, 'package', p_partkey)")).alias("without_age"),
    )


def title_candidates(t: Tables) -> DataFrame:
    words = ["ring", "widget", "hot"]
    return baseline.title_candidates(t.part, "p_name", words).select(
        "p_partkey", "p_name", F.size(tokens(F.col("p_name"))).alias("token_ct")
    )


def _categorised(t: Tables) -> DataFrame:
    return baseline.categorise(standins.baseline_measurements(t), standins.titles(t))


def null_pattern_report(t: Tables) -> DataFrame:
    return baseline.null_pattern_report(_categorised(t))


def expression_pick(t: Tables) -> DataFrame:
    return _categorised(t).select(
        "nct_id", "classification", "category", "cat_title", "nan_status", "cat_exp", "param_value_num"
    )


def baseline_rows(t: Tables) -> DataFrame:
    return baseline.baseline_rows(standins.baseline_counts(t), standins.baseline_measurements(t))


def categorised_baselines(t: Tables) -> DataFrame:
    return baseline.categorise(baseline_rows(t), standins.titles(t))


def enrollment_sums(t: Tables) -> DataFrame:
    facts = study.with_country_facts(study_base(t), standins.countries(t))
    return study.enrollment_sums(facts).select("nct_id", "sum_Enrollment", "study_Country_ct")


def enrollment_values(t: Tables) -> DataFrame:
    return study.enrollment_values(study_base(t))


def country_lists(t: Tables) -> DataFrame:
    return study.country_lists(study_base(t), standins.countries(t))


def study_details(t: Tables) -> DataFrame:
    return study.study_details(study_base(t))


def date_parse(t: Tables) -> DataFrame:
    """Order dates as text in three shapes, of which one can be read."""
    shaped = t.orders.selectExpr(
        "o_orderkey",
        """case o_orderpriority when '1-URGENT' then date_format(o_orderdate, 'yyyy/MM') when '2-HIGH' then
           concat(o_orderkey, ' days') else date_format(o_orderdate, 'yyyy-MM-dd') end as day""",
    )
    date = parse_date(F.col("day"))
    return shaped.select("o_orderkey", date_text(date).alias("day"), year_text(date).alias("year"))


def census_roles(t: Tables) -> DataFrame:
    """Customer nation and order and ship year against the census by both years."""
    keyed = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "l_orderkey",
            "l_linenumber",
            F.col("n_name").alias("census_country"),
            year_text(F.col("o_orderdate")).alias("st_Year"),
            year_text(F.col("l_shipdate")).alias("comp_Year"),
        )
    )
    return study.with_census(keyed, standins.census(t))


def study_frame(t: Tables) -> DataFrame:
    return study.study_frame(study_base(t), standins.countries(t), standins.census(t))


def aligned_lists(t: Tables) -> DataFrame:
    return pipeline.intervention_lists(standins.interventions(t))


def sponsor_lists(t: Tables) -> DataFrame:
    return pipeline.sponsor_lists(standins.sponsors(t))


def list_sizes(t: Tables) -> DataFrame:
    lists = pipeline.intervention_lists(standins.interventions(t))
    return lists.select(
        "NCT_id",
        F.size("int_Name").alias("names"),
        unwrap_single(F.col("int_Name")).alias("only_name"),
        join_list(F.col("int_Name")).alias("joined"),
        F.size(F.array(join_list(F.col("int_Name")))).alias("wrapped"),
    )


def sponsors_distinct(t: Tables) -> DataFrame:
    return pipeline.distinct_sponsors(standins.sponsors(t))


def sponsors_all(t: Tables) -> DataFrame:
    """Lead sponsors and collaborators, copies kept."""
    return joins.union_all(standins.lead_sponsors(t), standins.collaborators(t))


def keyword_flags(t: Tables) -> DataFrame:
    flags = text_flags.keyword_flags(t.documents, DOCUMENT_KEYWORDS, ["text", "source"], dummies=True)
    return flags.drop("text", "n_chars")


def keyword_counts(t: Tables) -> DataFrame:
    flags = text_flags.keyword_flags(t.documents, DOCUMENT_KEYWORDS, ["text", "source"])
    return text_flags.keyword_counts(flags, "doc_id", ["text", "source"])


def keyword_matches(t: Tables) -> DataFrame:
    flags = text_flags.keyword_flags(t.conversations, ["par la", "of the", "assistant"], ["text", "role"])
    return text_flags.keyword_matches(flags, ["text", "role"])


def trial_matches(t: Tables) -> DataFrame:
    """Flagged conversations, whose turns are taken for the pages of a trial."""
    pages = t.conversations.withColumnRenamed("turn", "list_part")
    flags = text_flags.keyword_flags(pages, ["par la", "of the", "assistant"], ["text", "role"])
    return text_flags.trial_matches(flags, "conv_id", ["text", "role"]).drop("DHT_searched_text")


def trial_text(t: Tables) -> DataFrame:
    return text_flags.trial_text(
        standins.studies(t),
        standins.interventions(t),
        standins.brief_summaries(t),
        standins.design_groups(t),
        standins.design_outcomes(t),
        standins.detailed_descriptions(t),
    )


def intervention_flags(t: Tables) -> DataFrame:
    inputs = standins.inputs(t.spark, t.folder)
    return pipeline.trial_flags_of(inputs)


def device_flags(t: Tables) -> DataFrame:
    """Flags on the intervention rows themselves, put together per trial."""
    flags = text_flags.keyword_flags(standins.interventions(t), ["red widget", "hot"], ["name", "description"])
    return text_flags.intervention_flags(flags)


def sample_rows(t: Tables) -> DataFrame:
    return sampling.keep_sample(t.lineitem, "l_orderkey", 1500).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )


def label_expressions(t: Tables) -> DataFrame:
    return labels.distinct_expressions(_categorised(t), label_missing=True)


def label_requests(t: Tables) -> DataFrame:
    """Requests for every event type of every user, the types taken for categories."""
    types = {
        "click": ["left", "right", "unknown_c"],
        "error": ["user", "system"],
        "purchase": ["small", "large"],
        "signup": ["new", "again"],
        "view": ["short", "long"],
    }
    asked = t.events.select(
        F.col("event_type").alias("cat_title"), F.concat(F.lit("user "), F.col("user_id")).alias("cat_exp")
    )
    return labels.label_requests(asked, types)


def _responses(t: Tables) -> DataFrame:
    """Event properties wrapped as response lines; errors break off, sign-ups answer with a list."""
    content = """concat('{"cat_title": "', event_type, '", "cat_exp": ', if(user_id % 4 = 0, 'null',
        concat('"user ', user_id, '"')), ', "piv_cat": "', get_json_object(props, '$.k'), '"}')"""
    answer = f"if(event_type = 'signup', concat('[', {content}, ']'), {content})"
    line = f"""to_json(named_struct('id', event_id, 'response', named_struct('body', named_struct('choices',
        array(named_struct('message', named_struct('content', {answer})))))))"""
    return t.events.selectExpr(
        f"case event_type when 'error' then left({line}, 40) when 'view' then props else {line} end as value"
    )


def label_parse(t: Tables) -> DataFrame:
    return labels.parse_responses(_responses(t))


def label_table(t: Tables) -> DataFrame:
    return labels.label_table(_responses(t))


def label_conflicts(t: Tables) -> DataFrame:
    return labels.label_conflicts(labels.parse_responses(_responses(t)))


def null_safe_join(t: Tables) -> DataFrame:
    categorised = _categorised(t)
    unique = labels.unique_labels(standins.labels(t))
    return represent.with_labels(categorised, unique).select(
        "nct_id", "ctgov_group_code", "cat_title", "cat_exp", "piv_cat", "param_value_num"
    )


def _pivot_rows(t: Tables) -> DataFrame:
    """All labelled rows, values below zero left out."""
    categorised = baseline.non_negative(_categorised(t), "param_value_num")
    unique = labels.unique_labels(standins.labels(t))
    return represent.with_pivot_columns(represent.with_labels(categorised, unique))


def pivot_values(t: Tables) -> DataFrame:
    return _pivot_rows(t).select(
        "nct_id", "ctgov_group_code", "cat_title", "nan_status", "piv_cat", "piv_num", "piv_text"
    )


def category_sums(t: Tables) -> DataFrame:
    return represent.category_sums(_pivot_rows(t))


def pivot_sums(t: Tables) -> DataFrame:
    flags = {"A": "accepted", "N": "none", "R": "returned"}
    return represent.pivot_sums(t.lineitem, "l_orderkey", "l_returnflag", "l_quantity", flags)


def unplaced_labels(t: Tables) -> DataFrame:
    return represent.unplaced_labels(_pivot_rows(t))


def enrollment_lists(t: Tables) -> DataFrame:
    return represent.enrollment_lists(_pivot_rows(t))


def demographic_pivot(t: Tables) -> DataFrame:
    return represent.demographic_pivot(categorised_baselines(t), labels.unique_labels(standins.labels(t)))


def shares(t: Tables) -> DataFrame:
    """Quantities per return flag and line status as the groups of an order, its price in thousands as people."""
    groups = {
        "am_Indian": "AF", "Asian": "AO", "Black": "NF", "Hispanic": "NO", "Hawaian": "RF", "White": "RO",
    }
    rows = t.lineitem.withColumn("group", F.concat("l_returnflag", "l_linestatus"))
    sums = represent.pivot_sums(
        rows, "l_orderkey", "group", "l_quantity", {code: name for name, code in groups.items()}
    )
    figures = sums.withColumns(
        {
            "Male": F.col("am_Indian") + F.col("Asian"),
            "Female": F.col("White"),
            "other": F.lit(None).cast("double"),
            "<18 years": F.col("Black"),
            "18:65 years": F.col("Hispanic"),
            ">65 years": F.col("Asian"),
            "age_Mean": F.lit(None).cast("double"),
            "age_Median": F.lit(None).cast("double"),
            "unknown_g": F.col("Hawaian"),
            "unknown_a": F.col("Hawaian"),
            "unknown_r": F.col("Hawaian"),
        }
    )
    people = t.orders.selectExpr("o_orderkey", "cast(floor(o_totalprice / 5000) as bigint) as Enrollment")
    joined = people.join(figures, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")
    return represent.with_checks(represent.with_shares(represent.with_reported_flags(joined)))


def to_numbers(t: Tables) -> DataFrame:
    """Words of part names and their sizes as text; only the sizes are numbers."""
    return t.part.select(
        "p_partkey", to_number(F.col("p_name")).alias("name"), to_number(F.concat("p_size", F.lit(".5"))).alias("size")
    )


def _part_codes(t: Tables) -> DataFrame:
    return t.part.selectExpr("p_partkey", f"if(p_size = 7, null, {standins.CODE}) as ICD10").filter(
        "ICD10 is not null"
    )


def code_prefixes(t: Tables) -> DataFrame:
    raw = standins.trial_icd(t)
    return raw.select(
        "NCT_id",
        strip_decimals(F.col("ICD10")).alias("code"),
        code_prefix(strip_decimals(F.col("ICD10"))).alias("prefix"),
    )


def icd_chapter(t: Tables) -> DataFrame:
    return icd.with_chapter(_part_codes(t), icd.chapter_frame(t.spark))


def icd_chapter_by_range(t: Tables) -> DataFrame:
    return icd.with_chapter_by_range(_part_codes(t), icd.chapter_frame(t.spark))


def code_map(t: Tables) -> DataFrame:
    return icd.code_map(standins.code_map_1(t), standins.code_map_2(t))


def term_codes(t: Tables) -> DataFrame:
    return icd.term_codes(icd.term_frame(standins.mesh_icd(t)), code_map(t))


def term_sets(t: Tables) -> DataFrame:
    return icd.term_sets(term_codes(t), code_map(t))


def trial_codes(t: Tables) -> DataFrame:
    return icd.trial_codes(standins.browse_conditions(t), term_codes(t))


def trial_code_sizes(t: Tables) -> DataFrame:
    return icd.trial_code_sizes(standins.browse_conditions(t), term_sets(t))


def code_sets(t: Tables) -> DataFrame:
    """Codes and chapters per term."""
    return icd.code_sets(term_codes(t), icd.chapter_frame(t.spark), "MESH_term", "ICD10CM_id")


def icd_map(t: Tables) -> DataFrame:
    return icd.icd_map(
        standins.code_map_1(t),
        standins.code_map_2(t),
        standins.mesh_icd(t),
        standins.browse_conditions(t),
        standins.trial_icd(t),
        icd.chapter_frame(t.spark),
    )


def representation(t: Tables) -> DataFrame:
    """The share of each group among a trial's participants: the question the whole work is about."""
    trials = standins.studies(t).select(F.col("nct_id").alias("NCT_id"), F.col("enrollment").alias("Enrollment"))
    categorised = categorised_baselines(t)
    sums = represent.demographic_sums(categorised, labels.unique_labels(standins.labels(t)))
    return represent.representation(trials, sums)


def wide_table(t: Tables) -> DataFrame:
    return pipeline.build_all(standins.inputs(t.spark, t.folder))


QUERIES = [
    group_max_rows, study_star, measures, distinct_text, title_category, title_rule, title_candidates,
    null_pattern_report, expression_pick, baseline_rows, categorised_baselines, enrollment_sums,
    enrollment_values, country_lists, study_details, date_parse, census_roles, study_frame, aligned_lists,
    sponsor_lists, list_sizes, sponsors_distinct, sponsors_all, keyword_flags, keyword_counts, keyword_matches,
    trial_matches, unplaced_labels,
    trial_text, intervention_flags, device_flags, sample_rows, label_expressions, label_requests, label_parse,
    label_table, label_conflicts, null_safe_join, pivot_values, category_sums, pivot_sums, enrollment_lists,
    demographic_pivot, shares, to_numbers, code_prefixes, icd_chapter, icd_chapter_by_range, code_map, term_codes,
    term_sets, trial_codes, trial_code_sizes, code_sets, icd_map, representation, wide_table,
]


def _registered(query: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(query(Tables(spark, sf_dir)))

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: _registered(q) for q in QUERIES}
