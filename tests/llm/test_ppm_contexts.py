"""The language model over whole texts, against a plain version whose contexts cross words."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from trialcohort.llm import ppm_scoring
from trialcohort.llm import textarrays as T
from trialcohort.llm.common import id_remainder

ORDER = ppm_scoring.ORDER


def some_docs():
    rng = random.Random(7)
    words = ["the", "then", "of", "a", "é", "日本", "thorn", "\x00b", *(f"zq{i}" for i in range(40))]
    return [(i, " ".join(rng.choices(words, k=rng.randrange(30)))) for i in range(20, 100)]


def close(df, expected):
    by = lambda r: (repr(r[0]), r[2], round(r[6], 3))
    got, expected = sorted(map(tuple, df.collect()), key=by), sorted(expected, key=by)
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-6, abs=1e-6)


def test_events_cross_words_in_blocks_of_any_size():
    texts = ["The  cat sat", None, "", " \n", "a b c", "é日本 x", "end"]
    text = T.of(pa.record_batch({"text": pa.array(texts)}), T.SOLID, True)
    expected = [(k, (int.from_bytes(c[::-1], "big") << 9) + s) for k, t in enumerate(texts) for c, s in brute.events(t, ORDER)]
    for most in (1, 7, 1 << 20):
        found = list(ppm_scoring.text_events(text, most))
        assert list(zip(*(np.concatenate(x).tolist() for x in zip(*found)))) == expected and all(len(x) <= most for x, _ in found)


@pytest.mark.parametrize("head, costs", [(ppm_scoring.HEAD, ppm_scoring.COSTS), (2, 0), (2, 100)])
def test_scores_of_whole_texts(make, odd, head, costs):
    data = [x for x in odd if x[0] not in (7, 8)] + some_docs()
    expected, cost = brute.ppm(data, ORDER)
    out = ppm_scoring.score(make(data, extra=True), id_remainder() != 1, head=head, costs=costs)
    close(out.select("doc_id", (id_remainder() == 1).alias("h"), "n_tokens", "n_known", "train_tokens", "base_score", "score"), expected)
    for context in (b"    ", b"the ", b"e zq", b"zzzz"):
        assert sum(10 ** cost(context, x) for x in range(257)) == pytest.approx(1)


def test_order_of_words_counts(make):
    plain = "one two three four five six seven eight nine ten"
    mixed = "seven two ten four one nine three eight six five"
    data = [(i, plain) for i in range(20, 60)]
    held = [i for i in range(60, 90) if brute.remainder(i) == 1][:2]
    got = {r.doc_id: r for r in ppm_scoring.model_scores(make([*data, (held[0], plain), (held[1], mixed)])).filter(F.col("doc_id") >= 60).collect()}
    in_order, shuffled = (got[i] for i in held)
    assert in_order.base_score == pytest.approx(shuffled.base_score) and in_order.n_known == shuffled.n_known
    assert in_order.score > shuffled.score + 1
