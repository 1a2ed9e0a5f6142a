import random
import re

import pyarrow as pa
import pytest

from tests.llm import brute
from trialcohort.llm import pack_pow2
from trialcohort.llm import textarrays as T
from trialcohort.llm.tokenizing import Encoder, together, vocabulary


@pytest.mark.parametrize("kind, lower, pattern", [(T.SOLID, False, brute.SOLID), (T.ALNUM, True, brute.ALNUM)])
def test_words_and_windows(kind, lower, pattern):
    rng = random.Random(1)
    texts = [None, "", " ", "a", "b", "x" * 2000 + " y"] + ["".join(rng.choices("ab \n\tÉ.Z9", k=rng.randrange(60))) for _ in range(300)]
    w = T.of(pa.RecordBatch.from_pydict({"text": texts}), kind, lower)
    expected = [[x.encode() for x in pattern.findall(brute.lower(t) if lower else t or "")] for t in texts]
    assert [[w.word(i) for i in range(w.first[d], w.first[d + 1])] for d in range(len(texts))] == expected
    flat = [x for each in expected for x in each]
    for size in (1, 3, 12):
        at, found = w.windows(size)
        assert len(at) == sum(max(0, len(x) - size + 1) for x in expected)
        named = {}
        assert all(named.setdefault(tuple(flat[a : a + size]), h) == h for a, h in zip(at, found))
        assert len(set(named.values())) == len(named)


def test_hashes_don_t_depend_on_the_place():
    word = "z" * 700
    parts = [T.of(pa.RecordBatch.from_pydict({"text": ["a " * n + word + " b"]})) for n in (0, 3, T.BLOCK)]
    assert len({int(p.hash[-2]) for p in parts}) == 1 and len({int(p.hash[-1]) for p in parts}) == 1


@pytest.mark.parametrize("name, blank, end", [("word_bpe_49k.json", False, 1), ("byte_bpe_50k.json", True, 0)])
def test_remembered_pieces_give_the_same_ids(name, blank, end, real, monkeypatch):
    monkeypatch.setattr("trialcohort.llm.tokenizing.MOST_PIECES", 300)
    encoder, rng = Encoder(vocabulary(name), blank), random.Random(2)
    texts = [None, "", " ", "a  b", "a   b ", "a\n b", "x <|endoftext|> y", "a\x1c b", "a\u0085 b", "ΑΣ ΑΣ", "it's 's ' s"]
    texts += ["".join(rng.choices("ab '́sΣ\n\t1. \x1cé　", k=rng.randrange(25))) for _ in range(500)] + [t for _, t in real[1][:40]]
    for part in (texts[:200], texts[200:], texts):
        ids, offsets = encoder.encode(part, end)
        for i, text in enumerate(part):
            expected = encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
            assert ids[offsets[i] : offsets[i + 1]].tolist() == expected, re.escape(text or "")


BOTH = pytest.mark.parametrize("name, blank, end", [("word_bpe_49k.json", False, 1), ("byte_bpe_50k.json", True, 0)])


@BOTH
@pytest.mark.parametrize("at_once", [4 << 20, 50])
def test_parts_give_the_ids_of_whole_texts(name, blank, end, at_once, monkeypatch):
    monkeypatch.setattr("trialcohort.llm.tokenizing.TEXTS_AT_ONCE", at_once)
    encoder, rng = Encoder(vocabulary(name), blank), random.Random(3)
    texts = [t.replace("#", chr(c)) for c in (*range(0x400), 0x2019, 0x212B, 0x3042, 0x1F600) for t in ("#", "a#b #c. Z#", "x\n#y\n\n#", "A#.\n#3", "'#s <|# a<#")]
    alphabet = [*"abAZéÀß×÷İɏɐ'.<|>12\n\n  \t_-", "\u0301", "\u00a0", "the", "<|endoftext|>"]
    texts += ["".join(rng.choices(alphabet, k=rng.randrange(1, 30))) for _ in range(3000)]
    texts += [" ".join("".join(rng.choices("abAZéɏ'.12\n-", k=rng.randrange(1, 6))) for _ in range(8)) for _ in range(3000)]
    texts = texts if at_once > 50 else texts[::8]  # small stretches
    ids, offsets = encoder.encode(texts, end)
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [end], re.escape(text)


@BOTH
def test_the_whole_chain_sees_few_parts(name, blank, end, monkeypatch):
    encoder, rng, chars = Encoder(vocabulary(name), blank), random.Random(4), 0
    whole = encoder.whole

    def counted(texts):
        nonlocal chars
        chars += sum(map(len, texts))
        return whole(texts)

    monkeypatch.setattr(encoder, "whole", counted)
    words = ["".join(rng.choices("abcdeéou", k=9)) for _ in range(4000)]
    texts = [" ".join(f"{a}.\n{b.title()}***" for a, b in zip(words[i : i + 100], words[i + 100 : i + 200])) for i in range(0, 4000, 200)]
    ids, offsets = encoder.encode(texts, end)
    # words after line breaks and before marks go to the merge model as well; marks and breaks are few
    assert chars < 200
    expected = [[*x, end] for x in whole(texts)]
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == expected


def test_batches_are_put_together(monkeypatch):
    monkeypatch.setattr("trialcohort.llm.tokenizing.TEXTS_AT_ONCE", 100)
    rng = random.Random(5)
    texts = [rng.choice([None, "", "é" * rng.randrange(30), "x" * rng.randrange(300)]) for _ in range(500)]
    whole = pa.RecordBatch.from_pydict({"doc_id": list(range(500)), "text": pa.array(texts)})
    for size in (1, 7, 500):
        out = list(together(whole.slice(i, size) for i in range(0, 500, size)))
        assert pa.Table.from_batches(out).to_pydict() == whole.to_pydict()
        sizes = [sum(len((t or "").encode()) for t in x.column("text").to_pylist()) for x in out]
        assert all(s <= 100 or x.num_rows == 1 or s - len((x.column("text")[-1].as_py() or "").encode()) < 100 for s, x in zip(sizes, out))
        assert len(out) < 400
    monkeypatch.setattr("trialcohort.llm.tokenizing.ROWS_AT_ONCE", 3)
    out = list(together(whole.slice(i, 50) for i in range(0, 500, 50)))
    assert pa.Table.from_batches(out).to_pydict() == whole.to_pydict() and max(x.num_rows for x in out) == 3
    assert not list(together(iter([])))


def test_packing_encodes_small_batches_together():
    rows = [(i, "a b c\nd " * i + str(i)) for i in range(60)]
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i], "text": [t]}) for i, t in rows]
    (out,) = pack_pow2.cutting(vocabulary("byte_bpe_50k.json"), 0, True, 64, True)(iter(batches))
    found = {i: [] for i, _ in rows}
    for r in out.to_pylist():
        assert r["start"] == len(found[r["doc_id"]]) and len(r["ids"]) == r["length"] == 1 << r["bucket"]
        found[r["doc_id"]] += r["ids"]
    tokenizer = Encoder(vocabulary("byte_bpe_50k.json"), True).tokenizer
    assert found == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in rows}
