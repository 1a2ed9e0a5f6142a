"""Small hand-made input tables for the whole job: six trials."""

from pyspark.sql import SparkSession

from trialcohort.operators.baseline import title_dictionary
from trialcohort.plans.pipeline import Inputs
from trialcohort.sources.schemas import SCHEMAS

DATA = {
    "studies": [
        ("T1", "INTERVENTIONAL", True, False, None, "COMPLETED", 200, "2018-05-01", "2019-02-03", "PHASE2", 2, "An asthma app"),
        ("T2", "INTERVENTIONAL", False, False, False, "COMPLETED", 0, "2018-01-01", "2018-12-31", None, 1, "Two places"),
        ("T3", "OBSERVATIONAL", None, None, None, "UNKNOWN", None, "soon", None, None, None, None),
        ("T4", "INTERVENTIONAL", False, True, False, "COMPLETED", 10, "2018-07-01", "2025-01-01", "PHASE3", 1, "One place"),
        ("T5", "INTERVENTIONAL", False, True, False, "COMPLETED", 10, "2018-07-01", "2018-08-01", "PHASE3", 1, "No people"),
        ("T6", "INTERVENTIONAL", False, True, False, "WITHDRAWN", 50, "2018-07-01", "2018-08-01", "PHASE3", 1, "Places"),
    ],
    "eligibilities": [("T1", None, "ALL", "18 Years", "65 Years"), ("T3", "PROBABILITY_SAMPLE", "FEMALE", None, None)],
    "countries": [("T1", "United States"), ("T2", "United States"), ("T2", "France"), ("T4", "France"), ("T9", "Peru")],
    "calculated_values": [("T1", True), ("T2", False)],
    "baseline_counts": [
        ("T1", "B1", 80), ("T1", "B2", 120), ("T1", "B3", 200),
        ("T2", "B1", 5), ("T2", "B2", 5), ("T3", "B1", None), ("T4", "B1", 10), ("T6", "B1", 50),
    ],
    "baseline_measurements": [
        ("T1", "B1", None, "Women", "Sex: Female, Male", "Participants", "COUNT", 50.0),
        ("T1", "B3", None, "Women", "SEX: Female, Male", "Participants", "COUNT", 120.0),
        ("T1", "B3", None, "Men", "Sex: Female, Male", "Participants", "COUNT", 80.0),
        ("T1", "B3", None, "Men", "Weight", "kg", "MEAN", 80.0),
        ("T1", "B3", "White", None, "Race", "Participants", "COUNT", 180.0),
        ("T1", "B3", "Hispanic", "Hispanic", "Race", "Participants", "COUNT", 40.0),
        ("T1", "B3", "Native", None, "Race", "Participants", "COUNT", 2.0),
        ("T1", "B3", "Islander", None, "Race", "Participants", "COUNT", 4.0),
        ("T1", "B3", None, None, " Age", "Years", "MEAN", 41.5),
        ("T1", "B3", None, "unclear", " Age", "Years", "COUNT", 8.0),
        ("T2", "B1", None, "Women", "Sex: Female, Male", "Participants", "COUNT", 3.0),
        ("T2", "B2", None, "Women", "Sex: Female, Male", "Participants", "COUNT", 1.0),
        ("T2", "B2", None, "Men", "Sex: Female, Male", "Participants", "COUNT", -4.0),
        ("T2", "B2", None, "Men", "Sex: Female, Male", "Participants", "COUNT", None),
        ("T3", "B1", None, "Women", "Sex: Female, Male", "Participants", "COUNT", 3.0),
        ("T4", "B1", None, None, "Sex: Female, Male", "Participants", "COUNT", 10.0),
        ("T6", "B1", "France", "count", "Region of Enrollment", "Participants", "COUNT", 30.0),
        ("T6", "B1", "Global", "Peru", "Region of Enrollment", "Participants", "COUNT", 15.0),
        ("T6", "B1", None, None, "Region of Enrollment", "Participants", "COUNT", 5.0),
    ],
    "interventions": [
        ("T1", "DRUG", None, None), ("T1", "DEVICE", "Asthma App", "A phone app"), ("T4", "DEVICE", "Band", "worn; sensors"),
    ],
    "sponsors": [
        ("T1", "INDUSTRY", "lead"), ("T1", "NIH", "collaborator"), ("T1", "NIH", "collaborator"), ("T2", None, "lead"),
    ],
    "browse_conditions": [("T1", "ASTHMA"), ("T4", "Asthma"), ("T4", "nothing known")],
    "brief_summaries": [("T1", "First."), ("T2", None)],
    "design_groups": [("T1", "Arm", "one"), ("T1", "Arm", "two")],
    "design_outcomes": [("T4", "Sensor signal", None)],
    "detailed_descriptions": [],
    "census": [
        ("United States", "2018", *[float(i) for i in range(1, 13)]),
        ("United States", "2019", *[float(i) for i in range(101, 113)]),
        ("France", "2018", *[float(i) for i in range(201, 213)]),
    ],
    "labels": [
        ("gender", "Women", "female"), ("gender", "Men", "male"), ("gender", "Men", "other"), ("gender", None, "unknown_g"),
        ("race", "White", "White"), ("race", "Hispanic", "Hispanic or Latino"),
        ("race", "Native", "American Indian or Alaska Native"),
        ("race", "Islander", "Native Hawaian or Other Pacific Islander"),
    ],
    "code_map_1": [("J45.1", "D1"), ("J45.2", "D1")],
    "code_map_2": [("J46", "D1")],
    "mesh_icd": [("Asthma", "J45.9", "D1"), ("Other thing", "C7A", "D7")],
    "trial_icd": [("T1", "D49.9"), ("T2", None), ("T5", "Z00")],
}

TITLES = ["Sex: Female, Male", "Race", " Age", "Region of Enrollment"]
KEYWORDS = ["app", "sensor", "sensors"]


def inputs(spark: SparkSession) -> Inputs:
    tables = {name: spark.createDataFrame(data, SCHEMAS[name]) for name, data in DATA.items()}
    titles = spark.createDataFrame([(t,) for t in TITLES], SCHEMAS["titles"])
    return Inputs(**tables, titles=title_dictionary(titles), keywords=KEYWORDS)
