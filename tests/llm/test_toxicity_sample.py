import numpy as np

from trialcohort.llm import toxicity_nbsvm


def test_a_repeated_id_counts_as_one_text(spark, make):
    data = [(i, f"you loser {i % 7}" if i % 2 else f"you there {i % 5}") for i in range(30, 60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(30, 60)], "doc_id long, toxic int")
    once = toxicity_nbsvm.fit(make(data), labels)
    same = lambda a, b: np.array_equal(a.chosen, b.chosen) and np.allclose(a.weights, b.weights) and np.isclose(a.intercept, b.intercept)
    assert len(once.chosen)
    assert same(toxicity_nbsvm.fit(make(data + [data[1]] * 200), labels), once)
    # one id with several texts: one of them stands for all, the same one however the rows lie
    other = (31, "you quite other words")
    models = [toxicity_nbsvm.fit(make(data + [other] * 200, partitions=k), labels) for k in (1, 5)]
    alone = toxicity_nbsvm.fit(make([other if x[0] == 31 else x for x in data]), labels)
    assert same(*models) and (same(models[0], once) or same(models[0], alone))
