import re
import time
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from trialcohort.functions.codes import code_prefix, strip_decimals
from trialcohort.functions.dates import date_text, parse_date, year_text
from trialcohort.functions.numbers import (
    any_reported,
    in_closed_range,
    percent,
    sum_skipping_nulls,
    to_number,
    zero_to_null,
)
from trialcohort.functions.text import (
    clean_keywords,
    has_token,
    join_list,
    keyword_hits,
    keyword_pattern,
    searched_text,
    strip,
    tokens,
    unwrap_single,
)


def values(spark, column, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(column).collect()]


def test_keywords_are_clean_and_longest_first():
    assert clean_keywords([" App", "app store", "APP", "", "  ", None]) == ["app store", "app"]


def test_no_keywords():
    with pytest.raises(ValueError):
        keyword_pattern([" "])


def test_overlapping_keywords_and_case(spark):
    pattern = keyword_pattern(["app", "App Store", "sensor"])
    data = [("The APP store has an app",), ("happy apps",), ("app app sensor",), (None,), ("",)]
    assert values(spark, keyword_hits(F.col("t"), pattern), data, "t string") == [
        ["app", "app store"],
        [],
        ["app", "sensor"],
        [],
        [],
    ]


def test_keywords_beyond_the_first_plane(spark):
    deseret = "\U00010428ab"  # a letter with two cases
    assert values(spark, keyword_hits(F.col("t"), keyword_pattern([deseret])), [("x \U00010400AB y",)], "t string") == [[deseret]]
    pattern = keyword_pattern([deseret, "ring"])
    assert values(spark, keyword_hits(F.col("t"), pattern), [(f"ring {deseret}",)], "t string") == [["ring", deseret]]


def test_letters_of_any_script_are_word_characters(spark):
    pattern = keyword_pattern(["app"])
    data = [("Éapp",), ("appé",), ("é app ñ",), ("_app",), ("app2",), ("(app)",)]
    assert values(spark, keyword_hits(F.col("t"), pattern), data, "t string") == [[], [], ["app"], [], [], ["app"]]


def test_keywords_with_other_characters(spark):
    words = ["c++", "a.b", "24/7", "#tag"]
    texts = ["we use c++x and c++ here", "axb a.b", "open 24/7", "my#tag and #tag", "c++"]
    expected = []
    escaped = "|".join(re.escape(k) for k in clean_keywords(words))
    for t in texts:
        expected.append(sorted({m.lower() for m in re.findall(rf"\b({escaped})\b", t, re.I)}))
    got = values(spark, keyword_hits(F.col("t"), keyword_pattern(words)), [(t,) for t in texts], "t string")
    assert got == expected


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("aAbBéÉsſ _.-1\n", max_size=25), min_size=1, max_size=30))
def test_hits_are_those_of_a_plain_search(spark, texts):
    texts = [unicodedata.normalize("NFC", t) for t in texts]
    words = ["a", "a b", "bé", "s", "1a", "ab"]
    search = re.compile(r"\b(" + "|".join(re.escape(k) for k in clean_keywords(words)) + r")\b", re.I)
    expected = [sorted({m.lower() for m in search.findall(t)}) for t in texts]
    got = values(spark, keyword_hits(F.col("t"), keyword_pattern(words)), [(t,) for t in texts], "t string")
    assert got == expected


def test_whole_documents_against_a_plain_search(spark):
    words = ["the", "of the", "de", "la", "par la", "tion", "que"]
    search = re.compile(r"\b(" + "|".join(re.escape(k) for k in clean_keywords(words)) + r")\b", re.I)
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = documents.select("text", keyword_hits(F.col("text"), keyword_pattern(words)).alias("hits")).collect()
    assert any(r.hits for r in found)
    for r in found:
        assert r.hits == sorted({m.lower() for m in search.findall(r.text)})


def test_pattern_of_many_keywords_is_made_quickly_and_holds_each(spark):
    words = [f"{chr(0x4E00 + i % 3000)}{i}" for i in range(6_000)] + ["a" * n for n in range(1, 500)] + ["\u017ft", "[", "]^", "a-b", "k\\"]
    start = time.perf_counter()
    pattern = keyword_pattern(words)
    assert time.perf_counter() - start < 1
    texts = [f"x{w}x" if not w[0].isalnum() or not w[-1].isalnum() else f"({w})" for w in words]
    got = values(spark, keyword_hits(F.col("t"), pattern), [(t,) for t in texts], "t string")
    search = re.compile(r"\b(" + "|".join(re.escape(k) for k in clean_keywords(words)) + r")\b", re.I)
    assert got == [sorted({m.lower() for m in search.findall(t)}) for t in texts]


def test_every_case_variant_is_found(spark):
    letters = [chr(c) for c in range(0x20, 0x1E944) if chr(c).isalpha() and chr(c).lower() != chr(c).upper()]
    for c in ("s", "k", "\u00e5", "\u00b5", "\u03c3", "\u03b8", "i", "\u0131", "\u01c6", "\u1e61", "\U00010428", "q"):
        found = values(spark, keyword_hits(F.col("t"), keyword_pattern([c])), [(x,) for x in letters], "t string")
        same = {x for x, hits in zip(letters, found) if hits}
        assert same == {x for x in letters if re.fullmatch(re.escape(c), x, re.I)}


def test_tokens(spark):
    data = [(" Age  (years) x ",), ("Percentage",), (None,)]
    assert values(spark, tokens(F.col("t")), data, "t string") == [["age", "(years)", "x"], ["percentage"], None]
    assert values(spark, has_token(F.col("t"), ["age"]), data, "t string") == [True, False, False]


def test_strip_and_join(spark):
    assert values(spark, strip(F.col("t")), [("\t a b \n",)], "t string") == ["a b"]
    lists = [(["a", None, "b"],), ([],), (None,)]
    assert values(spark, join_list(F.col("l")), lists, "l array<string>") == ["a, b", "", ""]
    assert values(spark, unwrap_single(F.col("l")), [(["a"],), (["a", "b"],), ([],), (None,)], "l array<string>") == [
        "a", None, None, None,
    ]
    assert values(spark, searched_text(["a", "b"]), [("x", None), (None, None)], "a string, b string") == ["x | ", " | "]


def test_codes(spark):
    data = [("C34.9",), ("D49",), ("C7A.1",), ("A1",), (None,), (" e11.9",), ("A1 ",), ("e11",), ("É11",), ("K94+",)]
    assert values(spark, strip_decimals(F.col("c")), data, "c string")[:3] == ["C34", "D49", "C7A"]
    assert values(spark, code_prefix(strip_decimals(F.col("c"))), data, "c string") == [
        "C34", "D49", None, None, None, "E11", None, "E11", None, "K94",
    ]


def test_dates(spark):
    data = [("2019-03-01",), ("2019-13-01",), ("soon",), ("",), (None,)]
    date = parse_date(F.col("d"))
    assert values(spark, date_text(date), data, "d string") == ["03-01-2019", None, None, None, None]
    assert values(spark, year_text(date), data, "d string") == ["2019", None, None, None, None]


def test_numbers(spark):
    assert values(spark, to_number(F.col("t")), [("1.5",), ("many",), (None,), ("7",)], "t string") == [1.5, None, None, 7]
    data = [(1.0, 4), (1.0, 0), (None, 4), (1.0, None)]
    assert values(spark, percent(F.col("n"), zero_to_null(F.col("e"))), data, "n double, e bigint") == [
        25.0, None, None, None,
    ]
    pair = [(1.0, None), (None, None), (60.0, 41.0)]
    total = sum_skipping_nulls([F.col("a"), F.col("b")])
    assert values(spark, total, pair, "a double, b double") == [1.0, 0.0, 101.0]
    assert values(spark, in_closed_range(total), pair, "a double, b double") == [True, True, False]
    assert values(spark, any_reported([F.col("a"), F.col("b")]), pair, "a double, b double") == [1, 0, 1]


def test_rows_helper(spark):
    assert rows(spark.createDataFrame([(2,), (1,)], "a int")) == [(1,), (2,)]
