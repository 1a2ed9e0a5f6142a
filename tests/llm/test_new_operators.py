"""Jaccard join, divergence of sources and interaction of filters, against plain versions."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import sorted_rows
from trialcohort.llm import filter_interaction as fi
from trialcohort.llm import linking, partenum_join
from trialcohort.llm import source_divergence as sd
from trialcohort.llm.wordblocks import word_blocks


def same(df, expected):
    got, expected = sorted_rows(df), sorted(expected, key=repr)
    wrong = [(a, b) for a, b in zip(got, expected) if a != b]
    assert len(got) == len(expected) and not wrong, wrong[:3]


def test_word_blocks():
    text = b"  a bb\tccc\n\x0bdd\x0c\re  " * 50 + "é x".encode()
    for size in (1, 3, 7, 1 << 20):
        assert [w for block in word_blocks(text, size) for w in block] == text.split()
    assert [w for block in word_blocks(b"", 4) for w in block] == []


# ---- Jaccard join -------------------------------------------------------------------------------


def near_texts(seed, groups=6, size=14, words=60, changes=6):
    """Groups of texts around one, each with some words changed: similarities on both sides of the threshold."""
    rng, out = random.Random(seed), []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(words + 20 * g)]
        for _ in range(size):
            text = base[:]
            for _ in range(rng.randrange(changes)):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
            out.append(" ".join(text))
    return out


def joined(docs, **more):
    return partenum_join.jaccard_join(docs, **more).select("doc_id", "n_shingles", "component_id")


def expected_join(data, **more):
    return [r[:3] for r in brute.near(data, **({"shingle": 3, "percent": 90} | more))[0]]


def test_jaccard_join_of_odd_rows(make, odd):
    data = odd + [(20 + i, t) for i, t in enumerate(near_texts(3) * 2)] + [(900, "only two"), (901, "Only TWO"), (902, "two only")]
    same(joined(make(data, extra=True)), expected_join(data))
    assert joined(make(odd).limit(0)).count() == 0


def test_jaccard_join_at_other_sizes(make):
    data = list(enumerate(near_texts(5, groups=3, changes=20)))
    for shingle, percent in ((1, 80), (2, 60)):
        same(joined(make(data), shingle=shingle, percent=percent), expected_join(data, shingle=shingle, percent=percent))


@pytest.mark.parametrize("percent", [60, 90])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(1)
    for n in [*range(1, 40), 57, 100, 257, 1000, 4000]:
        for _ in range(6):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            cut = int(rng.integers(0, len(a) * (100 - percent) // 100 + 1))
            more = rng.integers(0, 1 << 63, int(rng.integers(0, len(a) * (100 - percent) // 100 + 1))).astype(np.uint64)
            b = np.unique(np.concatenate([a[cut:], more]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * (len(a) + len(b) - both) > 0:
                assert np.intersect1d(partenum_join.signatures(a, percent), partenum_join.signatures(b, percent)).size


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_no_link_is_lost_between_blocks(spark, make, rounds, monkeypatch):
    data = list(enumerate(near_texts(9, groups=3, size=30, changes=9)))
    plain = linking.linked_roots
    monkeypatch.setattr(partenum_join, "linked_roots", lambda *a: plain(*a, rounds=rounds, rows=4, size=2_000))
    same(joined(make(data)), expected_join(data))


def test_copies_make_no_pairs(make, monkeypatch):
    base = [f"w{i}" for i in range(100)]
    texts = [" ".join(base), " ".join([*base[:99], "other"])]
    rows = []
    plain = linking.verified
    monkeypatch.setattr(linking, "verified", lambda pairs, *a: rows.append(pairs.count()) or plain(pairs, *a))
    out = joined(make([(1 + k, t) for k, t in enumerate(texts) for _ in range(200)])).distinct()
    assert sorted_rows(out) == [(1, 98, 1), (2, 98, 1)] and rows == [1]


# ---- divergence of sources ----------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_sources(rows, min_docs, top=10):
    docs, count = defaultdict(Counter), defaultdict(Counter)
    groups = {(lang or "", source or "") for lang, source, _ in rows}
    for lang, source, text in rows:
        terms = TERM.findall(brute.lower(text))
        docs[lang or ""].update(set(terms))
        count[lang or "", source or ""].update(terms)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        mine = {s: count[lang, s] for x, s in groups if x == lang}
        whole = sum(mine.values(), Counter())

        def share(counts, t, kept=kept):
            return 1 + 10**9 * (counts[t] + 2) // (sum(counts[x] for x in kept) + 2 * len(kept))

        differ = lambda p, q: (p - q) ** 2 // (p + q)
        p = {s: {t: share(c, t) for t in kept} for s, c in mine.items()}
        q = {t: share(whole, t) for t in kept}
        for s in mine:
            pairs = [(-sum(differ(p[s][t], p[o][t]) for t in kept), o.encode()) for o in mine if o != s]
            terms = [(-differ(p[s][t], q[t]), t.encode()) for t in kept if mine[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, item.decode(), -v, k) for k, (v, item) in enumerate(sorted(found)[:most], 1)]
    return out


@pytest.fixture
def sourced(spark):
    """Documents of (lang, source, text) rows."""

    def docs(rows, extra=False):
        df = spark.createDataFrame([(i, t, lang, s, None) for i, (lang, s, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
        for name in ["n", "v", "rank", "digest", "split", "item", "block"] * extra:
            df = df.withColumn(name, F.lit("x"))
        return df.repartition(3)

    return docs


def source_rows():
    rng = random.Random(4)
    rows = [(None, None, None), ("", "", "Été é a-b_c"), ("xx", "only", "one two three"), ("xx", None, "")]
    for i in range(90):
        source = rng.choice(["s1", "s1", "s1", "s2", "s3", None, "é", "s9"])
        text = " ".join(rng.choice(["The", "THE", "of", "naïve", "日本", f"{source}word", f"w{chr(97 + rng.randrange(9))}", "1999"]) for _ in range(rng.randrange(40)))
        rows.append((rng.choice(["en", "de", None]), source, text))
    return rows + [("en", "s1", "loud " * 5_000)] * 3


def test_source_divergence(sourced):
    rows = source_rows()
    same(sd.source_divergence(sourced(rows, extra=True), min_docs=3), brute_sources(rows, 3))
    same(sd.source_divergence(sourced(rows)), brute_sources(rows, 10))
    assert sd.source_divergence(sourced(rows).limit(0)).count() == 0


@pytest.mark.parametrize("digests", [1, 5])
def test_colliding_digests_are_split(sourced, digests):
    rows = source_rows()
    few = lambda term: F.pmod(F.xxhash64(term), F.lit(digests))
    same(sd.source_divergence(sourced(rows), min_docs=3, digest=few), brute_sources(rows, 3))


def test_tiles_of_any_size_and_early_writes_agree(sourced):
    rows = source_rows()
    same(sd.source_divergence(sourced(rows), min_docs=2, held=3, width=4, height=2), brute_sources(rows, 2))


def test_shares_are_exact():
    rng = random.Random(2)
    for _ in range(300):
        n = rng.choice([rng.randrange(1, 100), rng.randrange(1, 9 * 10**15 // 2)])
        v, count = rng.randrange(1, 50), rng.randrange(n + 1)
        got = sd.shares(np.array([[count, 0]]), np.array([n]), v)
        assert got.tolist() == [[1 + 10**9 * (c + 2) // (n + 2 * v) for c in (count, 0)]]


def test_share_columns_are_exact(spark):
    data = [(3, 10, 5), (9 * 10**14, 10**15, 1_000), (0, 0, 1), (7 * 10**15, 8 * 10**15, 3)]
    df = spark.createDataFrame(data, "c long, n long, v long")
    got = [r[0] for r in df.select(sd.share(F.col("c"), F.col("n"), F.col("v"))).collect()]
    assert got == [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in data]


# ---- interaction of filters ---------------------------------------------------------------------


def brute_filters(rows, labels):
    """rows: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    first = {}
    for d, text, _ in rows:
        if d is not None:
            first[text or ""] = min(first.get(text or "", d), d)
    docs = []
    for d, text, lang in rows:
        text = text or ""
        w = brute.SOLID.findall(text)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": d is not None and first[text] < d,
        }
        docs.append((lang or "", {k for k, v in fails.items() if v}, d in good, d in toxic))
    out = []
    for part in {d[0] for d in docs}:
        mine, found, shapley = [d for d in docs if d[0] == part], [], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                redundant = sum(f in d[1] for d in mine) - len(gone)
                shapley[f] += len(gone)
                unique = sum(d[1] == {f} for d in mine)
                found.append((f, (part, order, step, len(left), len(gone), redundant, unique, sum(d[2] for d in gone), sum(d[3] for d in gone))))
        out += [(*row, shapley[f]) for f, row in found]
    return out


def filter_rows():
    rng = random.Random(8)
    rows = [(1, None, None), (2, "", "en"), (3, "", ""), (None, "", "en"), (None, "copy " * 300, "en"), (4, "copy " * 300, "en"), (4, "copy " * 300, "de")]
    for i in range(5, 120):
        words = [f"w{rng.randrange(rng.choice([60, 4000]))}" for _ in range(rng.choice([20, 199, 200, 230]))]
        text = rng.choice([" ", "\n", "\t "]).join(words) + rng.choice(["", "", " 100 %", " LOUD WORDS " * 3, "É"])
        rows.append((i, text, rng.choice(["en", "de", None])))
        if rng.random() < 0.3:
            rows.append((rng.randrange(200, 260), text, rng.choice(["en", "fr"])))
    return rows


def test_filter_interaction(spark):
    rows = filter_rows()
    labels = [(i, int(i % 2 == 0), int(i % 7 == 0)) for i in range(0, 250, 3)] + [(6, 0, 1), (None, 1, 1), (9, None, None)]
    docs = spark.createDataFrame([(d, t, lang, None, None) for d, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    extra = docs.selectExpr("*", "'x' as part", "1 as mask", "'y' as digest", "0 as good", "1 as least").repartition(4)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("z"))
    same(fi.filter_interaction(extra, known), brute_filters(rows, labels))
    same(fi.filter_interaction(docs, known.limit(0)), brute_filters(rows, []))
    assert fi.filter_interaction(docs.limit(0), known).count() == 0


def test_removal_steps_are_the_min_plus_product():
    orders, steps = list(permutations(range(4))), fi.removal_steps(4)
    for mask in range(16):
        for k, order in enumerate(orders):
            hit = [step for step, f in enumerate(order, 1) if mask >> f & 1]
            assert steps[mask, k] == (hit[0] if hit else 5)


def test_text_mask_in_blocks(monkeypatch):
    text = ("word " * 40 + "other\n" * 10 + "A" * 9).encode()
    whole = fi.text_mask(text)
    monkeypatch.setattr(fi, "word_blocks", lambda data: word_blocks(data, 16))
    assert fi.text_mask(text) == whole == 0b0011 | 0b0100 * (900 > 3 * len(text))
