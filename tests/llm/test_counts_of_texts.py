"""Counts, lookups and signatures of many texts at a time against plain Python."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa

from trialcohort.llm import circulant_minhash, linking, quality_divergence
from trialcohort.llm import textarrays as T

TEXTS = ["", None, "A b! 12 #x", "é ü\x85 Été\n\n$", "x" * 700 + " <|>", "a b a b a b a b a b a b", "one two"]


def test_bytes_are_counted_as_one_by_one(monkeypatch):
    monkeypatch.setattr(quality_divergence, "TEXTS", 2)
    found = quality_divergence.byte_counts(*T.raw(pa.array(TEXTS, pa.string())))
    for text, row in zip(TEXTS, found.tolist(), strict=True):
        data, solid = (text or "").encode(), re.sub(r"[\x20\x09-\x0D]", "", text or "")
        kinds = Counter(quality_divergence.KIND[list(data)].tolist()) if data else Counter()
        assert row == [*[kinds[k] for k in range(quality_divergence.CLASSES)], sum(c in "#*$%&|<>" for c in text or ""), len(solid)]


def test_common_words_of_each_language():
    words = T.of(pa.record_batch({"text": pa.array(["a b a c", "a b a c", "", "b b"])}), T.ALNUM, True)
    a, b, c = (int(x) for x in words.hash[[0, 1, 3]].view(np.int64))
    found = quality_divergence.common_counts(words, np.array([0, 1, 1, 2]), [[b, a], [c], []])
    assert found.tolist() == [[1, 2, 1], [1, 0, 3], [0, 0, 0], [0, 0, 2]]


def test_places_are_exact():
    keys = np.sort(T.mixed(np.arange(300, dtype=np.uint64)))
    asked = np.concatenate([keys[::3], keys + np.uint64(1), keys[:1]])
    which, at = T.places(keys, asked)
    assert which.tolist() == [i for i, x in enumerate(asked) if x in set(keys)] and (keys[at] == asked[which]).all()
    assert not len(T.places(keys[:0], asked)[0]) and not len(T.places(keys, asked[:0])[0])


def test_hashes_do_not_depend_on_how_much_is_summed_at_a_time(monkeypatch):
    data, offsets = T.raw(pa.array(TEXTS * 40, pa.string()))
    whole = T.words(data, offsets, T.SOLID, True)
    monkeypatch.setattr(T, "HASHED", 64)
    parts = T.words(data, offsets, T.SOLID, True)
    assert (whole.hash == parts.hash).all() and (whole.second == parts.second).all() and (whole.doc == parts.doc).all()


def test_sets_and_signatures_of_parts(monkeypatch):
    text = T.of(pa.record_batch({"text": pa.array([*TEXTS, "one two three four five six", "zwei"], pa.string())}), T.SOLID, True)
    names, begin = linking.shingle_sets(text, 4)
    assert np.diff(begin).tolist() == [0, 0, 1, 1, 1, 2, 1, 3, 1]
    assert all((names[a + 1 : b] > names[a : b - 1]).all() for a, b in zip(begin[:-1], begin[1:], strict=True) if b > a)
    whole = circulant_minhash.signatures(names, begin, 8)
    monkeypatch.setattr(circulant_minhash, "HELD", 2)
    assert (circulant_minhash.signatures(names, begin, 8) == whole).all() and whole.shape == (7, 8)
