import hashlib
import json
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from trialcohort.functions.fixed_values import CATEGORY_LABELS, ICD10_CHAPTERS, PIVOT_COLUMNS
from trialcohort.functions.text import clean_keywords
from trialcohort.operators import baseline, icd, joins, labels, paging, represent, sampling, study, text_flags

MEASUREMENT = (
    "nct_id string, ctgov_group_code string, classification string, category string, title string, units string, "
    "param_type string, param_value_num double"
)


# ---- joins and lists with hot keys ---------------------------------------------------------------


def test_left_join_many_keeps_unmatched_rows_once(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, l string")
    many = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "n")], "k int, m string")
    assert rows(joins.left_join_many(left, many, ["k"])) == rows(left.join(many, "k", "left"))


def test_left_join_many_with_hot_keys(spark):
    many = spark.createDataFrame([("hot", i) for i in range(500)] + [("b", 1), ("c", 2)], "k string, v int").repartition(8)
    left = spark.createDataFrame([("hot", "x"), ("hot", "y"), ("b", "z"), ("none", "u"), (None, "w")], "k string, l string")
    assert rows(joins.left_join_many(left, many, ["k"])) == rows(left.join(many, "k", "left"))


def test_lookup_join(spark):
    many = spark.createDataFrame([(f"k{i % 4}", i) for i in range(300)] + [(None, 7)], "k string, v int").repartition(8)
    lookup = spark.createDataFrame([("k1", "a"), ("k1", "b"), ("k2", "c"), (None, "d")], "k string, l string")
    for how in ("left", "inner"):
        assert rows(joins.lookup_join(many, lookup, ["k"], how)) == rows(many.join(lookup, "k", how))


def test_null_safe_left_join(spark):
    left = spark.createDataFrame([("a", None), ("a", "x"), (None, None), ("b", "x")], "k string, e string")
    right = spark.createDataFrame([("a", None, 1), (None, None, 2)], "k string, e string, v int")
    joined = joins.lookup_join(left, right, ["k", "e"], null_safe=True)
    assert rows(joined) == sorted([("a", None, 1), ("a", "x", None), (None, None, 2), ("b", "x", None)], key=repr)


@pytest.mark.parametrize("size", [1, 4, paging.PAGE_SIZE])
@pytest.mark.parametrize("partitions", [1, 4, 8])
def test_pages_in_order_give_the_exact_list(spark, size, partitions):
    data = [("hot", f"v{i % 70}", str(i)) for i in range(200)] + [("equal", "same", None)] * 1000 + [("one", None, None)]
    df = spark.createDataFrame(data, "k string, a string, b string").repartition(partitions)
    got = sorted(study.aligned_lists(df, "k", {"a": "as", "b": "bs"}, size).collect(), key=lambda r: (r.k, r.list_part))
    for key in ("hot", "equal", "one"):
        pages = [r for r in got if r.k == key]
        assert [r.list_part for r in pages] == list(range(len(pages)))
        assert all(len(r["as"]) == size for r in pages[:-1]) and 1 <= len(pages[-1]["as"]) <= size
        pairs = [pair for r in pages for pair in zip(r["as"], r["bs"])]
        none_first = lambda pair: [(x is not None, x or "") for x in pair]
        assert pairs == sorted(((a, b) for k, a, b in data if k == key), key=none_first)


def test_families_share_pages_and_miss_none(spark):
    one = spark.createDataFrame([("t", "b"), ("t", "a"), ("u", "c"), (None, "z")], "k string, v string")
    two = spark.createDataFrame([("t", 3), ("t", 1), ("t", 2), ("w", None)], "id string, n bigint")
    lists = paging.paged_lists([paging.Family(one, "k", {"v": "vs"}), paging.Family(two, "id", {"n": "ns"})], "key", 2)
    assert rows(lists) == [
        ("t", 0, ["a", "b"], [1, 2]), ("t", 1, None, [3]), ("u", 0, ["c"], None), ("w", 0, None, [None]),
    ]


@pytest.mark.parametrize("size", [1, 3, paging.PAGE_SIZE])
def test_a_family_of_distinct_rows_has_each_once(spark, size):
    data = [("t", "b", None), ("t", "b", None), ("t", None, "x"), ("t", "a", "x"), ("t", "a", "x"), ("t", "a", "y"), ("u", None, None), ("u", None, None)]
    df = spark.createDataFrame([*data, *data, (None, "a", "x")], "k string, a string, b string")
    lists = paging.paged_lists([paging.Family(df, "k", {"a": "as", "b": "bs"}, distinct=True), paging.Family(df, "k", {"a": "all"})], "k", size)
    pages = defaultdict(list)
    for r in sorted(lists.collect(), key=lambda r: (r.k, r.list_part)):
        pages[r.k] += zip(r["as"] or [], r["bs"] or [])
        assert max(len(r["as"] or []), len(r["all"] or [])) <= size
    assert pages == {"t": [(None, "x"), ("a", "x"), ("a", "y"), ("b", None)], "u": [(None, None)]}
    assert sum(len(r["all"] or []) for r in lists.collect()) == 16


def test_long_texts_of_unknown_keys_are_left_out(spark):
    long = spark.createDataFrame([(k, "f", f"text {i}") for k in "ab" for i in range(30)] + [("c", "f", "x"), ("d", "f", "x")], "k string, field string, text string")
    known = spark.createDataFrame([("a",), ("c",), ("e",)], "k string")
    got = text_flags.text_sets(long, "k", page_bytes=40, known=known).collect()
    assert {r.k for r in got} == {"a", "c"}
    assert sorted(t.text for r in got if r.k == "a" for t in r.texts if t.text) == sorted(f"text {i}" for i in range(30))


@pytest.mark.parametrize("size", [1, 20, text_flags.PAGE_BYTES])
@pytest.mark.parametrize("partitions", [1, 4, 8])
def test_text_pages_hold_each_text_once(spark, size, partitions):
    data = [("t", "f", f"text {i % 40}") for i in range(400)] + [("u", "f", "a very long text")] * 6 + [("v", "f", None)]
    long = spark.createDataFrame(data, "nct_id string, field string, text string").repartition(partitions)
    sets = text_flags.text_sets(long, "nct_id", page_bytes=size).collect()
    assert sorted((r.nct_id, t.text) for r in sets for t in r.texts if t.text) == sorted({(k, t) for k, _, t in data if t})
    assert {r.nct_id for r in sets if r.list_part == 0} == {"t", "u", "v"}
    again = text_flags.text_sets(long.repartition(3), "nct_id", page_bytes=size)
    plain = lambda found: sorted((r.nct_id, r.list_part, sorted(map(repr, r.texts))) for r in found)
    assert plain(sets) == plain(again.collect())


# ---- baselines -----------------------------------------------------------------------------------


def test_group_max_rows_keeps_ties_and_drops_null_groups(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "x"), ("c", None, "x"), ("c", 0, "y")],
        "k string, n int, v string",
    )
    assert rows(baseline.group_max_rows(df, "k", "n").select("k", "v")) == [("a", "y"), ("a", "z"), ("c", "y")]


def test_baseline_rows_equal_the_plain_way(spark):
    counts = spark.createDataFrame(
        [("t1", "B1", 10), ("t1", "B2", 10), ("t1", "B3", 4), ("t2", "B1", None), ("t3", "B1", 5), ("t3", "B2", 9)],
        "nct_id string, ctgov_group_code string, count bigint",
    )
    data = [
        ("t1", "B1", 3.0), ("t1", "B2", -1.0), ("t1", "B2", 0.0), ("t1", "B3", 2.0), ("t2", "B1", 1.0),
        ("t3", "B1", 2.0), ("t1", "B1", None),
    ]
    measurements = spark.createDataFrame(data, "nct_id string, ctgov_group_code string, param_value_num double")
    joined = counts.join(measurements, ["nct_id", "ctgov_group_code"], "left")
    plain = baseline.non_negative(baseline.group_max_rows(joined, "nct_id", "count"), "param_value_num")
    got = baseline.baseline_rows(counts, measurements)
    names = ["nct_id", "ctgov_group_code", "count", "param_value_num"]
    assert rows(got.select(names)) == rows(plain.select(names)) == [("t1", "B1", 10, 3.0), ("t1", "B2", 10, 0.0)]
    assert rows(baseline.measures(counts, measurements).select(names)) == rows(joined.select(names))


def test_title_rules(spark):
    titles = ["Age by Sex", "Percentage", "Race / Ethnicity", "Sex: Female, Male", "Region of Enrollment", "Weight", " Age"]
    dictionary = baseline.title_dictionary(baseline.title_frame(spark, titles + ["AGE BY SEX"]))
    assert rows(dictionary) == [
        (" age", "age"), ("age by sex", "age"), ("percentage", "age"), ("race / ethnicity", "race"),
        ("region of enrollment", "enrollment"), ("sex: female, male", "gender"),
    ]
    df = spark.createDataFrame([("AGE BY SEX",), ("Age",), (" Age",), (None,), ("Weight",)], "title string")
    assert rows(baseline.with_title_category(df, dictionary).select("title", "cat_title")) == sorted(
        [("AGE BY SEX", "age"), ("Age", "unknown"), (" Age", "age"), (None, "unknown"), ("Weight", "unknown")], key=repr
    )
    assert rows(baseline.title_candidates(df)) == rows(df.filter("lower(title) like '%age%'"))


def test_null_patterns_and_expressions(spark):
    dictionary = baseline.title_dictionary(baseline.title_frame(spark, ["Age", "Race", "Sex", "Enrollment"]))
    data = [
        (title, cl, ca) for title in ("Age", "Race", "Sex", "Enrollment", "Weight")
        for cl in ("cl", None) for ca in ("ca", None)
    ]
    df = spark.createDataFrame(data, "title string, classification string, category string").withColumn(
        "nct_id", F.lit("t")
    )
    got = {(r.title, r.classification, r.category): (r.nan_status, r.cat_exp) for r in baseline.categorise(df, dictionary).collect()}
    assert len(got) == 16
    for title in ("Age", "Race", "Sex"):
        assert got[title, "cl", "ca"] == (4, "ca")
        assert got[title, "cl", None] == (1, "cl")
        assert got[title, None, "ca"] == (2, "ca")
        assert got[title, None, None] == (3, None)
    assert {got["Enrollment", a, b][1] for a in ("cl", None) for b in ("ca", None)} == {None}
    report = baseline.null_pattern_report(baseline.categorise(df, dictionary))
    assert rows(report) == [(1, 1), (2, 1), (3, 1), (4, 1)]


# ---- labels --------------------------------------------------------------------------------------


def chunk_sizes(spark, n, chunks=5):
    df = spark.createDataFrame([("age", f"e{i}") for i in range(n)], "cat_title string, cat_exp string")
    got = labels.with_chunk(df, "cat_title", "cat_exp", chunks).collect()
    assert len({r.cat_exp for r in got}) == len(got) == n
    sizes = {}
    for r in got:
        sizes[r.chunk] = sizes.get(r.chunk, 0) + 1
    return [sizes[c] for c in sorted(sizes)]


def test_chunks(spark):
    assert chunk_sizes(spark, 3) == [1, 1, 1]
    assert chunk_sizes(spark, 9) == [1] * 9
    assert chunk_sizes(spark, 10) == [2] * 5
    assert chunk_sizes(spark, 13) == [2] * 6 + [1]
    assert chunk_sizes(spark, 997) == [199] * 5 + [2]


def test_chunks_do_not_depend_on_partitioning(spark):
    df = spark.createDataFrame([(c, f"e{i}") for c in "ab" for i in range(200)], "cat_title string, cat_exp string")
    assert rows(labels.with_chunk(df.repartition(7), "cat_title", "cat_exp")) == rows(
        labels.with_chunk(df.coalesce(1), "cat_title", "cat_exp")
    )


def test_requests(spark):
    df = spark.createDataFrame(
        [("gender", "Fem\"ale"), ("gender", None), ("gender", "Fem\"ale"), ("enrollment", "x")],
        "cat_title string, cat_exp string",
    )
    assert labels.distinct_expressions(df).count() == 1
    assert rows(labels.distinct_expressions(df, label_missing=True)) == [("gender", "Fem\"ale"), ("gender", "nan")]
    (line,) = labels.label_requests(df).collect()
    request = json.loads(line.value)
    assert (line.category, line.chunk, request["custom_id"]) == ("gender", 1, 'task-Fem"ale')
    assert list(request) == ["custom_id", "method", "url", "body"]
    assert request["body"]["response_format"] == {"type": "json_object"}
    assert request["body"]["temperature"] == 0 and request["body"]["max_tokens"] == 200
    content = request["body"]["messages"][0]["content"]
    assert 'label the phrase Fem"ale with one' in content
    assert "['male', 'female', 'other', 'unknown_g']" in content
    assert "'cat_title' = gender," in content and content.endswith("Please respond in JSON format.")
    assert "{" not in content


def response(content):
    return json.dumps({"id": "x", "response": {"body": {"choices": [{"message": {"content": content}}]}}})


def test_responses(spark):
    good = {"cat_title": "gender", "cat_exp": "Women", "piv_cat": "female"}
    lines = [
        response(json.dumps(good)),
        response(json.dumps({**good, "piv_cat": "other"})),
        response(json.dumps({"cat_title": "age", "cat_exp": "nan", "piv_cat": "unknown_a"})),
        response(json.dumps([good])),
        response("not json"),
        "{broken",
        json.dumps({"response": {"body": {}}}),
        json.dumps({"response": {"body": {"choices": []}}}),
        response(json.dumps({"cat_title": "race", "cat_exp": "x"})),
    ]
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    parsed = labels.parse_responses(df).collect()
    assert [r.is_bad for r in parsed] == [False, False, False, True, True, True, True, True, False]
    assert all(r.cat_title is None for r in parsed if r.is_bad)
    assert rows(labels.label_table(df)) == [("age", None, "unknown_a"), ("gender", "Women", "female")]
    assert rows(labels.label_conflicts(labels.parse_responses(df))) == [("gender", "Women", "female")]


# ---- text flags ----------------------------------------------------------------------------------


def text_tables(spark):
    return dict(
        studies=spark.createDataFrame([("t1", "An app study"), ("t2", None), ("t3", "c")], "nct_id string, official_title string"),
        interventions=spark.createDataFrame(
            [("t1", "DEVICE", "App Store", "d2"), ("t1", "DEVICE", "Band", "d1"), ("t2", "DRUG", None, None), ("x", "DRUG", "app", "")],
            "nct_id string, intervention_type string, name string, description string",
        ),
        summaries=spark.createDataFrame([("t1", "s"), ("t1", "s"), (None, "app")], "nct_id string, description string"),
        groups=spark.createDataFrame([("t2", "G", "uses sensors")], "nct_id string, title string, description string"),
        outcomes=spark.createDataFrame([("t2", "m", "an éapp")], "nct_id string, measure string, description string"),
        descriptions=spark.createDataFrame([("t3", "long")], "nct_id string, description string"),
    )


def test_trial_text(spark):
    got = {r.nct_id: r for r in text_flags.trial_text(**text_tables(spark)).collect()}
    assert set(got) == {"t1", "t2", "t3"} and all(r.list_part == 0 for r in got.values())
    assert got["t1"].intervention_type == "DEVICE" and got["t1"].name == "App Store;\n Band"
    assert got["t1"].q_3_desc == "d1;\n d2" and got["t1"].q_7_desc == "s"
    assert got["t2"].name == "" and got["t2"].q_3_desc == "" and got["t2"].official_title is None
    assert got["t3"].name is None and got["t3"].q_10_desc == "long"


def test_flags(spark):
    text = text_flags.trial_text(**text_tables(spark))
    flags = text_flags.keyword_flags(text, ["app", "app store ", "Sensors", "fit band"], dummies=True)
    got = {r.nct_id: r for r in flags.collect()}
    assert got["t1"]._official_title == ["app"] and got["t1"]._name == ["app store"] and got["t1"].DHT == 1
    assert got["t2"]._q_8_desc == ["sensors"] and got["t2"]._q_9_desc == [] and got["t2"].DHT == 1
    assert got["t3"].DHT == 0 and got["t3"].DHT_searched_text == "c |  |  |  |  |  |  |  | long"
    assert (got["t1"]["_app"], got["t1"]["_app_store"], got["t1"]["_fit_band"], got["t2"]["_Sensors"]) == (1, 1, 0, 1)
    assert dict(text_flags.keyword_counts(flags).collect()) == {"app": 1, "app store": 1, "sensors": 1}
    assert text_flags.trial_matches(flags).count() == 2
    assert text_flags.keyword_matches(flags).count() == 2
    assert rows(text_flags.intervention_flags(flags)) == [("t1", 1, 1), ("t2", 1, 0), ("t3", 0, 0)]


@pytest.mark.parametrize("size", [1, 4, text_flags.PAGE_BYTES])
def test_trials_are_flagged_alike_whatever_the_pages(spark, size):
    tables = text_tables(spark)
    more = [("t1", "DEVICE", f"App {i}", f"d{i % 3}") for i in range(30)] + [("ghost", "DEVICE", f"app {i}", "x") for i in range(30)]
    tables["interventions"] = tables["interventions"].union(spark.createDataFrame(more, tables["interventions"].schema))
    keywords = ["app", "app store ", "Sensors", "fit band"]
    text = text_flags.trial_text(**tables, page_bytes=size)
    assert {r.nct_id for r in text.collect()} == {"t1", "t2", "t3"}
    assert rows(text.filter("official_title is not null").groupBy("nct_id").count()) == [("t1", 1), ("t3", 1)]
    flags = text_flags.keyword_flags(text, keywords)
    expected = [("t1", 1, 1), ("t2", 1, 0), ("t3", 0, 0)]
    assert rows(text_flags.intervention_flags(flags)) == expected
    assert dict(text_flags.keyword_counts(flags).collect()) == {"app": 2, "app store": 1, "sensors": 1}
    matches = {r.nct_id: r for r in text_flags.trial_matches(flags).collect()}
    assert set(matches) == {"t1", "t2"} and matches["t1"]._name == ["app", "app store"]
    studies = tables.pop("studies")
    searched = text_flags.all_texts(studies, **tables)
    assert rows(text_flags.trial_flags(studies, searched, keywords)) == expected
    if size == 1:
        many = keywords + ["c++"] + [f"unheard{i}" for i in range(2_000)]
        assert rows(text_flags.trial_flags(studies, searched, many)) == expected


def test_many_keywords_hit_as_a_plain_search_does(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "'text' as field", "substring(text, 1, 500) as text")
    extra = ["The of the. of, THE of", None, "", "é-the covid-19, covid", "use c++x, c++ and a-xb", "Kelvin \u212aelvin \u017ftore i\u0307"]
    long = docs.union(spark.createDataFrame([(900 + i, "text", t) for i, t in enumerate(extra)], docs.schema))
    words = sorted({w for r in docs.limit(40).collect() for w in r.text.lower().split() if w.isalnum()})
    rng = random.Random(5)
    keywords = ["the", "of the", "of, the of", "covid-19", "covid", "19", "c++", "-x", "kelvin", "store"]
    keywords += [" ".join(rng.choices(words, k=rng.randrange(1, 4))) for _ in range(1_500)] + [f"{rng.choice(words)}{i}" for i in range(3_500)]
    search = re.compile(r"\b(" + "|".join(re.escape(k) for k in clean_keywords(keywords)) + r")\b", re.I)
    expected = [(i, "text", sorted({x.lower() for x in search.findall(t or "")})) for i, _, t in long.collect()]
    found = rows(text_flags.text_hits(long, "doc_id", keywords))
    assert found == sorted((r for r in expected if r[2]), key=repr) and len(found) > 50


def test_flagged_device_without_keyword_in_its_name(spark):
    df = spark.createDataFrame(
        [("a", "DEVICE", "Band", "an app"), ("b", "DEVICE", "Band", "none"), ("c", "DRUG", "app", ""), ("d", None, None, None)],
        "nct_id string, intervention_type string, name string, description string",
    )
    flags = text_flags.keyword_flags(df, ["app"], ["name", "description"])
    assert rows(text_flags.intervention_flags(flags)) == [("a", 1, 1), ("b", 0, 0), ("c", 1, 1), ("d", 0, 0)]


def test_flags_do_not_depend_on_partitioning(spark):
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    one = text_flags.keyword_flags(text.coalesce(1), ["the", "la"], ["text"])
    many = text_flags.keyword_flags(text.repartition(9), ["la", "the"], ["text"])
    assert rows(one.drop("text")) == rows(many.drop("text"))


def test_sample(spark):
    df = spark.createDataFrame([(f"t{i % 50}", i) for i in range(200)], "nct_id string, v int")
    sample = sampling.keep_sample(df, "nct_id", 7, seed=3)
    assert sample.select("nct_id").distinct().count() == 7 and sample.count() == 28
    assert rows(sample) == rows(sampling.keep_sample(df.repartition(5), "nct_id", 7, seed=3))
    assert rows(sample) != rows(sampling.keep_sample(df, "nct_id", 7, seed=4))
    assert sampling.sample_ids(df, "nct_id", 500).count() == 50


@pytest.mark.parametrize("cell", [0, 1, 4])
def test_sample_is_the_first_keys_by_md5_whatever_the_cells(spark, cell, monkeypatch):
    monkeypatch.setattr(sampling, "CELL", cell)
    df = spark.createDataFrame([(i % 300 or None,) for i in range(900)], "k long").repartition(5)
    first = sorted((hashlib.md5(f"{i}|9".encode()).hexdigest(), i) for i in range(1, 300))
    for n in (0, 1, 57, 298, 299, 1000):
        assert rows(sampling.sample_ids(df, "k", n, 9)) == sorted(((i,) for _, i in first[:n]), key=repr)


# ---- codes ---------------------------------------------------------------------------------------


def test_chapters(spark):
    chapters = icd.chapter_frame(spark)
    codes = ["C34", " e11", "D49", "C7A", "A1", "V00", "Y85", "T99", "K94", "U07", "B99X", "Z00", None]
    df = spark.createDataFrame([(c,) for c in codes], "ICD10 string")
    got = {r.ICD10: r.clinical_cat for r in icd.with_chapter(df, chapters).collect()}
    label = {a: name for a, _, name in ICD10_CHAPTERS}
    assert got["C34"] == "Neoplasms" and got[" e11"] == label["E00"] and got["U07"] == label["U00"]
    assert got["B99X"] == label["A00"] and got["Z00"] == label["Z00"]
    assert {got[c] for c in ("D49", "C7A", "A1", "V00", "Y85", "T99", "K94", None)} == {"Other"}
    assert rows(icd.with_chapter(df, chapters)) == rows(icd.with_chapter_by_range(df, chapters).select("ICD10", "clinical_cat"))


def test_every_prefix_by_lookup_and_by_range(spark):
    chapters = icd.chapter_frame(spark)
    df = spark.createDataFrame([(f"{chr(65 + a)}{n:02d}",) for a in range(26) for n in range(100)], "ICD10 string")
    assert rows(icd.with_chapter(df, chapters)) == rows(icd.with_chapter_by_range(df, chapters).select("ICD10", "clinical_cat"))


def test_first_of_overlapping_chapters_wins(spark):
    chapters = icd.chapter_frame(spark, [("A10", "A20", "first"), ("A00", "A99", "second")])
    df = spark.createDataFrame([("A15",), ("A05",)], "ICD10 string")
    assert rows(icd.with_chapter(df, chapters)) == [("A05", "second"), ("A15", "first")]


def icd_tables(spark):
    return dict(
        map1=spark.createDataFrame([("C34.1", "D1"), ("C34.2", "D1"), ("E11", "D2"), (None, "D5")], "ICD10CM_ID string, MESH_ID string"),
        map2=spark.createDataFrame([("C34", "D1"), ("E11.9", "D3"), ("I10", None)], "ICD10CM_ID string, MESH_ID string"),
        mesh_icd=spark.createDataFrame(
            [("Lung Cancer", "Z99", "D1"), ("Diabetes", "E11.2", "D9"), ("Unmapped", None, "D8"), (None, "A00", "D2"), ("Half", "I10", "D5")],
            "label string, icd_code string, mesh_code string",
        ),
        conditions=spark.createDataFrame(
            [("t1", "lung cancer"), ("t1", "DIABETES"), ("t1", "Diabetes"), ("t2", "unmapped"), ("t3", "other"), (None, "Diabetes"), ("t4", None)],
            "nct_id string, mesh_term string",
        ),
        trial_icd=spark.createDataFrame([("t1", "C34.9"), ("t5", "C7A"), ("t5", None), ("t6", None), (None, "A00")], "NCT_id string, ICD10 string"),
    )


def test_icd_map(spark):
    tables = icd_tables(spark)
    mapping = icd.code_map(tables["map1"], tables["map2"])
    assert rows(mapping) == sorted(
        [("C34", "D1"), ("E11", "D2"), ("E11", "D3"), ("I10", None), (None, "D5")], key=repr
    )
    codes = icd.term_codes(icd.term_frame(tables["mesh_icd"]), mapping)
    assert rows(codes) == [("diabetes", "E11"), ("half", "I10"), ("lung cancer", "C34")]
    sets = icd.term_sets(codes, mapping)
    assert rows(sets) == [("diabetes", ["E11"], ["D2", "D3"]), ("half", ["I10"], []), ("lung cancer", ["C34"], ["D1"])]
    assert rows(icd.trial_code_sizes(tables["conditions"], sets)) == [("t1", 3, 3, 5)]
    assert rows(icd.trial_codes(tables["conditions"], codes)) == [("t1", "C34"), ("t1", "E11")]
    got = icd.icd_map(chapters=icd.chapter_frame(spark), **tables)
    assert rows(got) == [
        ("t1", ["C34", "E11"], ["Endocrine, nutritional and metabolic diseases", "Neoplasms"]),
        ("t5", ["C7A"], ["Other"]),
    ]


# ---- studies -------------------------------------------------------------------------------------


def test_lists_keep_nulls_and_stay_aligned(spark):
    df = spark.createDataFrame(
        [("t", "b", None), ("t", "a", "2"), ("t", None, "9"), ("t", "a", "1"), ("t", "a", "1"), (None, "z", "z")],
        "k string, a string, b string",
    )
    assert rows(study.aligned_lists(df, "k", {"a": "as", "b": "bs"})) == [
        ("t", 0, [None, "a", "a", "a", "b"], ["9", "1", "1", "2", None])
    ]


# ---- representation ------------------------------------------------------------------------------

CATEGORISED = (
    "nct_id string, cat_title string, cat_exp string, nan_status int, classification string, category string, "
    "param_type string, param_value_num double"
)


def categorised(spark):
    n = "NUMBER"
    return spark.createDataFrame(
        [
            ("t1", "gender", "Women", 2, None, "Women", n, 40.0),
            ("t1", "gender", "Women", 2, None, "Women", n, 2.0),
            ("t1", "gender", None, 3, None, None, n, 5.0),
            ("t1", "gender", "??", 2, None, "??", n, 7.0),
            ("t1", "age", "x", 2, None, "x", "MEAN", 30.0),
            ("t1", "age", "x", 2, None, "x", "MEAN", 31.0),
            ("t1", "enrollment", None, 4, "US", "count", n, 50.0),
            ("t1", "enrollment", None, 4, "Global", "FR", n, 50.0),
            ("t1", "enrollment", None, 1, "Global", None, n, 50.0),
            ("t1", "enrollment", None, 2, None, "DE", n, 50.0),
            ("t1", "enrollment", None, 3, None, None, n, 50.0),
            ("t2", "race", "W", 1, "W", None, n, 9.0),
            ("t3", "race", "none", 1, "none", None, n, 9.0),
            (None, "race", "W", 1, "W", None, n, 9.0),
        ],
        CATEGORISED,
    )


def label_rows(spark):
    return spark.createDataFrame(
        [("gender", "Women", "female"), ("gender", None, "unknown_g"), ("race", "W", "White"), ("race", "W", "zz")],
        "cat_title string, cat_exp string, piv_cat string",
    )


def test_pivot(spark):
    unique = labels.unique_labels(label_rows(spark))
    got = {r.NCT_id: r.asDict() for r in represent.demographic_pivot(categorised(spark), unique).collect()}
    assert set(got) == {"t1", "t2"}
    assert list(got["t1"]) == ["NCT_id", "list_part", *PIVOT_COLUMNS.values()]
    t1 = {k: v for k, v in got["t1"].items() if v is not None}
    assert t1 == {
        "NCT_id": "t1", "list_part": 0, "Female": 42.0, "unknown_g": 5.0, "age_Mean": 61.0,
        "enroll_Country": [None, "50.0", "DE", "FR", "US"],
    }
    assert got["t2"]["White"] == 9.0 and got["t2"]["enroll_Country"] is None


def test_pivot_back_gives_the_sums(spark):
    unique = labels.unique_labels(label_rows(spark))
    pivot_rows = represent.with_pivot_columns(represent.with_labels(categorised(spark), unique))
    sums = represent.category_sums(pivot_rows)
    wide = represent.pivot_sums(pivot_rows.filter("cat_title <> 'enrollment' and nct_id is not null"), "nct_id", "piv_cat", "piv_num")
    back = wide.unpivot("nct_id", list(represent.DEMOGRAPHIC_COLUMNS.values()), "name", "piv_num").filter("piv_num is not null")
    names = {name: label for label, name in represent.DEMOGRAPHIC_COLUMNS.items()}
    assert sorted((r.nct_id, names[r.name], r.piv_num) for r in back.collect()) == rows(sums)


def representation(spark, **figures):
    schema = ["NCT_id string"] + [f"`{c}` double" for c in represent.DEMOGRAPHIC_COLUMNS.values()]
    row = ("t", *[figures.get(c) for c in represent.DEMOGRAPHIC_COLUMNS.values()])
    sums = spark.createDataFrame([row] if figures else [], ", ".join(schema))
    trials = spark.createDataFrame([("t", figures.get("Enrollment", 100))], "NCT_id string, Enrollment bigint")
    return represent.representation(trials, sums).collect()[0]


def test_shares(spark):
    r = representation(spark, Female=30.0, Male=70.0, White=80.0, Hispanic=30.0, am_Indian=1.0, unknown_g=3.0)
    assert (r["Perc_Female"], r["Perc_Male"], r["u_Perc_Gender"]) == (30.0, 70.0, 3.0)
    assert r["R_other"] is None and r["Perc_Other"] is None
    assert r[">100_perc_r"] and not r[">100_perc_g"] and not r[">100_perc_a"]
    assert r["c_Perc_White"] == 50.0 and r["c_100_perc_r"] is True
    assert (r["r_Race"], r["r_Gender"], r["r_Age"]) == (1, 1, 0)
    for share, figure in (("Perc_Female", "Female"), ("Perc_White", "White")):
        assert r[share] * r["Enrollment"] / 100 == r[figure]


def test_over_100_without_hispanics(spark):
    r = representation(spark, White=120.0)
    assert r[">100_perc_r"] and r["c_Perc_White"] is None and r["c_100_perc_r"] is True


def test_zero_enrollment_and_no_figures(spark):
    r = representation(spark, Enrollment=0, Female=3.0)
    assert r["Enrollment"] is None and r["Perc_Female"] is None and r["r_Gender"] == 1
    r = representation(spark)
    assert (r["r_Race"], r["r_Gender"], r["r_Age"]) == (0, 0, 0)
    assert r[">100_perc_r"] is False and r["c_100_perc_r"] is True


def test_labels_without_a_column_are_reported(spark):
    unique = spark.createDataFrame(
        [("gender", "Women", "Female"), ("gender", None, "unknown_g"), ("race", "W", "White")],
        "cat_title string, cat_exp string, piv_cat string",
    )
    labelled = represent.with_pivot_columns(represent.with_labels(categorised(spark), unique))
    assert rows(represent.unplaced_labels(labelled)) == [("gender", "Female", 2)]


def test_titles_by_rule_without_a_dictionary(spark):
    df = spark.createDataFrame([("Age, Categorical",), ("Weight",), (None,)], "title string")
    got = baseline.with_title_category(df)
    assert rows(got) == [("Age, Categorical", "age"), ("Weight", "unknown"), (None, "unknown")]


def test_labels_of_every_category_have_a_column():
    assert {label for names in CATEGORY_LABELS.values() for label in names} <= set(PIVOT_COLUMNS)
