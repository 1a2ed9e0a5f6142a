"""The verdict of the quality rules and the toxicity model against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from trialcohort.llm import quality_divergence, toxicity_nbsvm


def test_distances_and_verdict(spark):
    rng = random.Random(12)
    words = [f"w{chr(97 + i // 10)}{i % 10}" for i in range(70)]
    often = [1 / (i + 2) if i < 50 else 0.004 for i in range(70)]
    rows = []
    for i in range(90):
        text = " ".join(rng.choices(words, often, k=rng.choice([5, 60, 150, 400])))
        rows.append((i, rng.choice([text, text, text, text + " É日本", text.upper(), text[:190]]), rng.choice(["en", "en", None])))
    rows += [(200, None, "en"), (201, "", "en"), (202, "1 2 # $ % & 3 4 5 6 7 8 9 " * 60, "en"), (203, words[-1] + " x y z u v w r s t " * 15, "en"), (204, rows[0][1], "few")]
    for lang in ("en", None):
        held = brute.Counter(w for _, t, x in rows if x == lang for w in brute.ALNUM.findall(brute.lower(t))).most_common(51)
        assert held[49][1] != held[50][1]  # no tie decides what is common
    docs = spark.createDataFrame([(d, t, x, None, None) for d, t, x in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = {r.doc_id: r for r in quality_divergence.quality_rules(docs.repartition(3), min_docs=20).collect()}
    expected = brute.divergence(rows)
    assert len(found) == len(expected) and {k for *_, k in expected} == {True, False}
    for doc, by_class, by_word, kept in expected:
        r = found[doc]
        assert (r.class_distance, r.word_distance) == pytest.approx((by_class, by_word), abs=1e-9) and r.kept == kept, doc
    assert max(c for _, c, _, _ in expected) > 0.2 and max(w for _, _, w, _ in expected) > 0.42


def test_scores_of_the_plain_model(spark, make):
    rng = random.Random(6)
    mild, rude = "the a cat sat on red mat and saw it go".split(), "fool idiot shut up you dumb".split()
    data = [(i, " ".join(rng.choices(mild + rude * (i % 3 == 0) * 2, k=rng.randrange(3, 14)))) for i in range(48)]
    labels = [(i, int(i % 3 == 0)) for i in range(48) if i % 5]
    data += [(100, None), (101, ""), (102, "You IDIOT"), (103, "é日本 the cat")]
    model = toxicity_nbsvm.fit(make(data), spark.createDataFrame(labels, "doc_id long, toxic int"), bits=22, chosen=100_000, steps=60)
    got = {r.doc_id: r.score for r in toxicity_nbsvm.score(make(data), model, ["doc_id"]).filter(F.col("doc_id").isNotNull()).collect()}
    expected = dict(brute.toxicity(data, labels, steps=60))
    assert got == pytest.approx(expected, abs=1e-9)
    assert got[102] > 0.5 > got[103] and len(model.chosen) > 30
