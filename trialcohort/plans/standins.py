"""The job's input tables made from the star-schema and text tables: an order stands for a trial, its
lines for baseline measurements, supplier nations for countries, documents and pages for trial text.

Every table is derived from all rows of its sources.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialcohort.functions.fixed_values import CATEGORY_LABELS
from trialcohort.operators.baseline import title_dictionary, title_frame
from trialcohort.operators.joins import union_all
from trialcohort.plans.pipeline import Inputs

KEYWORDS = ["widget", "Red Widget", " ring ", "with", "of the", "de", "par la", "gizmo"]


class Tables:
    """The given tables of one folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)  # looked up once, not read once
        return table


def studies(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "cast(o_orderkey as string) as nct_id",
        "if(o_orderpriority < '3', 'INTERVENTIONAL', 'OBSERVATIONAL') as study_type",
        "o_orderstatus = 'F' as is_fda_regulated_drug",
        "o_orderstatus = 'P' as is_fda_regulated_device",
        "case when o_orderstatus <> 'O' then o_custkey % 2 = 0 end as is_unapproved_device",
        "o_orderstatus as overall_status",
        "case when o_custkey % 50 <> 7 then cast(floor(o_totalprice / 2000) as bigint) end as enrollment",
        "if(o_orderstatus = 'P' and o_orderpriority = '5-LOW', 'not given', date_format(o_orderdate, 'yyyy-MM-dd'))"
        " as start_date",
        "date_format(o_orderdate + interval 400 days, 'yyyy-MM-dd') as completion_date",
        "o_orderpriority as phase",
        "o_custkey % 5 as number_of_arms",
        "concat('Study with priority ', o_orderpriority) as official_title",
    )


def eligibilities(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "cast(o_orderkey as string) as nct_id",
        "case when o_orderstatus = 'F' then 'PROBABILITY_SAMPLE' end as sampling_method",
        "if(o_orderpriority = '2-HIGH', 'FEMALE', 'ALL') as gender",
        "concat(o_custkey % 18, ' Years') as minimum_age",
        "case when o_custkey % 3 = 0 then '65 Years' end as maximum_age",
    )


def countries(t: Tables) -> DataFrame:
    return (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("l_orderkey").cast("string").alias("nct_id"), F.col("n_name").alias("name"))
        .distinct()
    )


def calculated_values(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "cast(o_orderkey as string) as nct_id", "o_totalprice > 250000 as were_results_reported"
    )


def baseline_counts(t: Tables) -> DataFrame:
    return (
        t.lineitem.groupBy(
            F.col("l_orderkey").cast("string").alias("nct_id"),
            F.concat(F.lit("BG00"), F.col("l_linenumber")).alias("ctgov_group_code"),
        )
        .agg(F.max("l_quantity").cast("bigint").alias("count"))
    )


TITLES = ["Age, Categorical", "Sex: Female, Male", "RACE (NIH/OMB)", "Region of Enrollment", "Age, Continuous", "Weight"]
TITLE_OF_ROW = f"element_at(array({', '.join(repr(x) for x in TITLES)}), cast(l_suppkey % 6 as int) + 1)"


def baseline_measurements(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "cast(l_orderkey as string) as nct_id",
        "concat('BG00', l_linenumber) as ctgov_group_code",
        "nullif(l_returnflag, 'N') as classification",
        "case when l_linestatus = 'O' then concat('C', cast(round(l_discount * 100) as int)) end as category",
        f"{TITLE_OF_ROW} as title",
        "'Participants' as units",
        "case when l_suppkey % 6 = 4 then 'MEAN' when l_partkey % 20 = 3 then 'MEDIAN' else 'COUNT_OF_PARTICIPANTS' end"
        " as param_type",
        "case when l_tax = 0.08 then -1.0 when l_tax <> 0.07 then l_quantity end as param_value_num",
    )


def interventions(t: Tables) -> DataFrame:
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        "cast(l_orderkey as string) as nct_id",
        "case p_type when 'ECONOMY' then 'DEVICE' when 'PROMO' then 'COMBINATION DEVICE' else p_type end"
        " as intervention_type",
        "case when p_size > 1 then p_name end as name",
        "concat(p_brand, ' ', p_type) as description",
    )


def lead_sponsors(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "cast(o_orderkey as string) as nct_id", "c_mktsegment as agency_class", "'lead' as lead_or_collaborator"
    )


def collaborators(t: Tables) -> DataFrame:
    return (
        t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .selectExpr(
            "cast(l_orderkey as string) as nct_id",
            "nullif(r_name, 'ASIA') as agency_class",
            "'collaborator' as lead_or_collaborator",
        )
    )


def sponsors(t: Tables) -> DataFrame:
    return union_all(lead_sponsors(t), collaborators(t))


# A vocabulary of terms with a few codes each.
CONCEPT = "(p_partkey div 4)"
TERM = f"concat(p_name, ' ', {CONCEPT})"
CODE = (
    f"concat(char(65 + {CONCEPT} % 26), lpad(cast(({CONCEPT} * 7 + p_size % 3) % 100 as string), 2, '0'), '.', "
    "p_partkey % 10)"
)


def browse_conditions(t: Tables) -> DataFrame:
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        "cast(l_orderkey as string) as nct_id", f"if(l_tax > 0.04, upper({TERM}), {TERM}) as mesh_term"
    )


def code_map_1(t: Tables) -> DataFrame:
    return t.part.selectExpr(f"{CODE} as ICD10CM_ID", f"concat('D', {CONCEPT}) as MESH_ID")


def code_map_2(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        f"concat(char(66 + {CONCEPT} % 25), lpad(cast({CONCEPT} % 100 as string), 2, '0')) as ICD10CM_ID",
        f"case when p_type = 'PROMO' then concat('D', {CONCEPT}) end as MESH_ID",
    )


def mesh_icd(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        f"{TERM} as label",
        f"case when p_size % 3 <> 0 then {CODE} end as icd_code",
        f"concat(if(p_size % 4 = 0, 'X', 'D'), {CONCEPT}) as mesh_code",
    )


def trial_icd(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "cast(o_orderkey as string) as NCT_id",
        """case when o_custkey % 11 = 0 then null when o_custkey % 13 = 0 then 'C7A.1' when o_custkey % 17 = 0 then 'A1'
           else concat(if(o_custkey % 7 = 0, ' ', ''), char(97 + o_custkey % 26),
                lpad(cast(o_custkey % 100 as string), 2, '0'), if(o_custkey % 2 = 0, '.1', '')) end as ICD10""",
    )


def brief_summaries(t: Tables) -> DataFrame:
    return t.documents.selectExpr("cast(doc_id as string) as nct_id", "text as description")


def design_groups(t: Tables) -> DataFrame:
    return t.conversations.selectExpr("cast(conv_id as string) as nct_id", "role as title", "text as description")


def design_outcomes(t: Tables) -> DataFrame:
    return t.pages.selectExpr("cast(page_id as string) as nct_id", "url as measure", "html as description")


def detailed_descriptions(t: Tables) -> DataFrame:
    return t.benchmark.selectExpr("cast(item_id as string) as nct_id", "text as description")


def census(t: Tables) -> DataFrame:
    figures = {
        "male": "o_orderstatus = 'F'",
        "female": "o_orderstatus = 'O'",
        "age_lt18": "o_orderpriority = '1-URGENT'",
        "age_18_65": "o_orderpriority = '2-HIGH'",
        "age_gt65": "o_orderpriority = '3-MEDIUM'",
        "white": "o_totalprice > 400000",
        "hispanic": "o_totalprice > 300000",
        "black": "o_totalprice > 200000",
        "am_indian": "o_totalprice > 100000",
        "asian": "o_custkey % 2 = 0",
        "hawaiian": "o_custkey % 3 = 0",
        "mixed": "o_custkey % 5 = 0",
    }
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("country"), F.date_format("o_orderdate", "yyyy").alias("year"))
        .agg(*[F.count_if(F.expr(test)).cast("double").alias(name) for name, test in figures.items()])
    )


def titles(t: Tables) -> DataFrame:
    return title_dictionary(title_frame(t.spark, TITLES))


def labels(t: Tables) -> DataFrame:
    """A label for each expression but 'C9': 'A' gets a second one, that of 'C8' is no column's."""
    rows = []
    for category, names in CATEGORY_LABELS.items():
        places = {None: len(names) - 1, "A": 0, "R": 1, **{f"C{i}": i % len(names) for i in range(11)}}
        rows += [(category, e, names[i]) for e, i in places.items() if e not in ("C8", "C9")]
        rows += [(category, "A", "~ second label"), (category, "C8", "Someone else")]
    return t.spark.createDataFrame(rows, "cat_title string, cat_exp string, piv_cat string")


def inputs(spark: SparkSession, folder: str) -> Inputs:
    t = Tables(spark, folder)
    tables = {
        make.__name__: make(t)
        for make in (
            studies, eligibilities, countries, calculated_values, baseline_counts, baseline_measurements,
            interventions, sponsors, browse_conditions, brief_summaries, design_groups, design_outcomes,
            detailed_descriptions, census, titles, labels, code_map_1, code_map_2, mesh_icd, trial_icd,
        )
    }
    return Inputs(**tables, keywords=KEYWORDS)
