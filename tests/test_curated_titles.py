from trialcohort.functions.fixed_values import CURATED_TITLES
from trialcohort.operators import baseline


def test_titles_without_a_dictionary_match_exactly(spark):
    data = [
        "Percentage of responders", "Average weight", "Dosage", "Age ", "Stage", None, " AGE", "age", "Age (<60 or ≥60 years)", "Race/ethnicity",
        "SEX: Female, Male", "Region of Enrollment", "Patients enrolled were female gender over the age of 18.",
    ]
    df = spark.createDataFrame([(t,) for t in data], "title string")
    got = [r.cat_title for r in baseline.with_title_category(df).collect()]
    assert got == ["unknown"] * 6 + ["age"] * 3 + ["race", "gender", "enrollment", "age"]


def test_every_title_shipped_has_the_category_of_the_dictionary(spark):
    df = spark.createDataFrame([(t,) for t in CURATED_TITLES], "title string")
    dictionary = baseline.title_dictionary(baseline.title_frame(spark, CURATED_TITLES))
    pairs = lambda out: sorted((r.title, r.cat_title) for r in out.collect())
    got = pairs(baseline.with_title_category(df))
    assert got == pairs(baseline.with_title_category(df, dictionary)) and "unknown" not in {c for _, c in got}
