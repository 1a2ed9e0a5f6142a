"""Lines and words that one 64-bit hash takes for equal stay apart, and hot windows are split."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.conftest import sorted_rows
from tests.test_plans import SKEW, plan, settings
from trialcohort.llm import line_windows, recompression
from trialcohort.llm import textarrays as T


def batch(*texts):
    n = len(texts)
    return pa.record_batch({"text": pa.array(texts), "k1": pa.array(range(n), pa.int64()), "k2": pa.array([0] * n, pa.int64())})


def same_first_hash(monkeypatch):
    monkeypatch.setattr(T, "hashes", lambda data, starts, ends: np.zeros(len(starts), T.U))


def test_second_hash_depends_on_the_bytes_alone():
    data = "the then é \x00b theory ".encode() * 60_000 + b"z" * 900 + b" " + b"z" * 900 + b" " + b"z" * 901
    text = T.of(pa.record_batch({"text": pa.array([data.decode()])}))
    by_word = {}
    for i, h in enumerate(text.second.tolist()):
        by_word.setdefault(text.word(i), set()).add(h)
    assert len(by_word) == 7 and all(len(x) == 1 for x in by_word.values())
    assert len(set().union(*by_word.values())) == 7
    assert not len(T.second_hashes(np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)))


def test_lines_of_equal_first_hash(monkeypatch):
    same_first_hash(monkeypatch)
    (found,) = line_windows.line_windows(3)(iter([batch("a\nb\nc", "a\nb\nd", "a\nb\nc")]))
    assert len(set(found.column("h1").to_pylist())) == 1
    one, two, three = found.column("h2").to_pylist()
    assert one == three != two


def test_words_of_equal_first_hash(monkeypatch):
    same_first_hash(monkeypatch)
    texts = [" ".join(f"{mark}{i}" for i in range(80)) for mark in "xyx"]
    (found,) = recompression.naming(35)(iter([batch(*texts)]))
    symbols = [r for r in found.to_pylist() if r["size"]]
    assert {r["k1"] for r in symbols} == {0, 1, 2} and len({r["name"] for r in symbols}) == 1
    inside = {r["k1"]: r["content"] for r in symbols}
    assert inside[0] == inside[2] != inside[1]
    words = T.of(batch(*texts))
    windows = recompression.content_at(words.second, words.first[:-1], 35, 32)
    assert windows[0] == windows[2] != windows[1]


def test_hot_windows_are_split(spark):
    """A passage in half of all documents: the joins back to counted names are split at run time, and nothing is lost."""
    low = {**SKEW, "spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1"}
    low["spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes"] = "16KB"
    low["spark__sql__adaptive__advisoryPartitionSizeInBytes"] = "16KB"
    with settings(spark, **low):
        own = F.concat_ws("\n", *[F.concat(F.lit(f"own{i} "), F.md5(F.concat("id", F.lit(str(i))))) for i in range(4)])
        docs = spark.range(12_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.concat(own, F.lit("\none\ntwo\nthree"))).otherwise(own).alias("text"))
        places = line_windows.repeated_line_windows(docs)
        assert sorted_rows(places.groupBy("at").count()) == [(4, 5_999)]
        places.collect()
        assert "skew=true" in plan(places)
