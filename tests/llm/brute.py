"""The operators once more, the plain way, on lists of rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

SOLID = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def remainder(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5


def base_rules(text):
    text = text or ""
    words = SOLID.findall(text)
    found = Counter(zip(*(words[k:] for k in range(5))))
    repeat = set()
    for i in range(len(words) - 4):
        if found[tuple(words[i : i + 5])] > 1:
            repeat |= set(range(i, i + 5))
    lines = [x for x in text.split("\n") if SOLID.search(x)]
    seen, again = set(), 0
    for x in lines:
        again += x in seen
        seen.add(x)
    failed = len(words) < 10 or 100 * len(repeat) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(repeat), failed


def contamination(docs, items):
    windows = {}
    for item, text in items:
        w = ALNUM.findall(lower(text))
        if item is not None and w:
            for k in range(max(1, len(w) - 9)):
                windows.setdefault(tuple(w[k : k + 10]), set()).add(item)
    sizes, out = {len(w) for w in windows}, []
    for doc, text in docs:
        w = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if x := windows.get(tuple(w[k : k + n])):
                    found |= x
                    hit |= set(range(k, k + n))
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    return out


def events(text, order):
    """(context, symbol) of each byte of a text's words, each followed by a blank, and of the end mark."""
    data = b" " * order + b"".join(w.encode() + b" " for w in SOLID.findall(lower(text)))
    return [(data[i - order : i], data[i]) for i in range(order, len(data))] + [(data[-order:], 256)]


def ppm(docs, order):
    """Rows of scores, and the cost of a symbol after a context."""
    counts, trained, trie = Counter(), 0, defaultdict(Counter)
    words = [SOLID.findall(lower(text)) for _, text in docs]
    for (doc, text), w in zip(docs, words):
        if remainder(doc) != 1:
            counts.update(w)
            trained += 1
            for context, symbol in events(text, order):
                for k in range(order + 1):
                    trie[context[order - k :]][symbol] += 1

    def cost(context, symbol):
        total, excluded = 0.0, set()
        for k in range(order, -1, -1):
            left = {x: n for x, n in trie.get(context[order - k :], {}).items() if x not in excluded}
            if left:
                whole = sum(left.values()) + len(left)
                if symbol in left:
                    return total + math.log10(left[symbol] / whole)
                total += math.log10(len(left) / whole)
                excluded |= set(left)
        return total - math.log10(257 - len(excluded))

    n, v = sum(counts.values()) + trained, len(counts) + (trained > 0)
    whole, out = n + 0.5 * (v + 1), []
    for (doc, text), w in zip(docs, words):
        base = sum(math.log10((counts[x] + 0.5) / whole) for x in w) + math.log10((trained + 0.5) / whole)
        known = sum(counts[x] > 0 for x in w) + (trained > 0)
        out.append((doc, remainder(doc) == 1, len(w) + 1, known, n, base, sum(cost(*e) for e in events(text, order))))
    return out, cost


def secrets(docs, candidate, runs, words, limits, kinds):
    patterns = [
        re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
        re.compile("AKIA[A-Z0-9]+"),
        re.compile("[0-9a-f]+"),
    ]

    def entropy(w):
        return -sum(c / len(w) * math.log2(c / len(w)) for c in Counter(w).values())

    def random(x):
        if not (re.search("[0-9]", x) and re.search("[A-Za-z]", x)) or any(re.search(p, x) for p in runs):
            return False
        limit = limits[0] if re.fullmatch("[0-9a-f]+|[0-9A-F]+", x) else limits[1]
        hidden = {k for m in re.finditer(words, x) for k in range(*m.span())}
        clear = [x[i : i + 20] for i in range(len(x) - 19) if not hidden & set(range(i, i + 20))]
        return max(map(entropy, clear), default=0) >= limit - 1e-9

    def joined(spans):
        return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)

    out = []
    for doc, text in docs:
        text, base = text or "", []
        for k, p in enumerate(patterns):
            for m in p.finditer(text):
                if len(m[2] if k == 0 else m[0]) >= (8, 16, 32)[k]:
                    base.append((m.start(), k, m.end()))
        base.sort()
        found = [(m.start(), 3, m.end()) for m in re.finditer(candidate, text)]
        added = [x for x in found if random(text[x[0] : x[2]]) and not any(b[0] <= x[0] and x[2] <= b[2] for b in base)]
        n = Counter(k for _, k, _ in base)
        out.append((doc, n[0], n[1], n[2], len(added), sha(joined(base)), joined(sorted(base + added))))
    return out


def lines(docs):
    """Rows with equal ids must have equal texts here."""
    places = defaultdict(set)
    for doc, text in docs:
        found = [] if text is None else text.split("\n")
        for i in range(len(found) - 2):
            if any(SOLID.search(x) for x in found[i : i + 3]):
                places[tuple(found[i : i + 3])].add((doc or 0, i))
    gone = defaultdict(set)
    for each in places.values():
        for doc, i in sorted(each)[1:]:
            gone[doc] |= {i, i + 1, i + 2}
    out = []
    for doc, text in docs:
        found = [] if text is None else text.split("\n")
        kept = [x for i, x in enumerate(found) if text is not None and i not in gone[doc or 0]]
        out.append((doc, len(found), len(found) - len(kept), sha("\n".join(kept))))
    return out


def repeats(docs, window=35):
    words, count = [SOLID.findall(text or "") for _, text in docs], Counter()
    for w in words:
        count.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(docs, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def near(docs, shingle=4, percent=80):
    """(row's set size, root of its group) for each row, and the digest rows."""
    sets = []
    for _, text in docs:
        w = SOLID.findall(lower(text))
        sets.append(frozenset(tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))) if w else frozenset())
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holds, first = defaultdict(list), {}
    for i, s in enumerate(sets):
        if not s:
            continue
        if s in first:
            parent[find(i)] = find(first[s])
            continue
        first[s], both = i, Counter()
        for x in s:
            both.update(holds[x])
            holds[x].append(i)
        for j, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            ids[find(i)].append(doc)
    roots = [find(i) for i in range(len(docs))]
    out = []
    for i, (doc, _) in enumerate(docs):
        least = min(ids[roots[i]], default=None)
        out.append((doc, len(sets[i]), least, doc == least))
    return out, roots, sets


def binary_pieces(ids, longest=1024):
    out, start = [], 0
    while start < len(ids):
        n = min(longest, 1 << ((len(ids) - start).bit_length() - 1))
        out.append((start, n, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[start : start + n]))))
        start += n
    return out


def divergence(docs, min_docs=20, common=50):
    """(doc_id, class distance, word distance, kept) of rows (doc_id, text, lang); words tied at the last place aren't told apart."""

    def kind(c):
        if ord(c) > 127:
            return 6
        for k, group in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\n\r\x0b\x0c", ".,:;!?'\"()-")):
            if c in group:
                return k
        return 5

    def shares(counts, keys):
        whole = sum(counts[k] for k in keys)
        return [counts[k] / whole if whole else 0.0 for k in keys]

    def js(p, q):
        if not sum(p):
            return 0.0
        half = [(a + b) / 2 for a, b in zip(p, q)]
        to = lambda x: sum(a * math.log2(a / m) for a, m in zip(x, half) if a)
        return math.sqrt(max((to(p) + to(q)) / 2, 0))

    judged, words = defaultdict(list), defaultdict(Counter)
    for _, text, lang in docs:
        kinds = Counter(map(kind, text or ""))
        if kinds.total() >= 200:
            judged[lang].append(shares(kinds, range(7)))
        words[lang].update(ALNUM.findall(lower(text)))
    out = []
    for doc, text, lang in docs:
        kinds, mine = Counter(map(kind, text or "")), Counter(ALNUM.findall(lower(text)))
        by_class = by_word = 0.0
        if len(judged[lang]) >= min_docs:
            middle = [sorted(x)[(len(x) + 1) // 2 - 1] for x in zip(*judged[lang])]
            if kinds.total() >= 200:
                by_class = js(shares(kinds, range(7)), [x / sum(middle) for x in middle])
            top = [w for w, _ in words[lang].most_common(common)]
            rest = lambda c: {**{w: c[w] for w in top}, None: c.total() - sum(c[w] for w in top)}
            if mine.total() >= 100:
                by_word = js(shares(rest(mine), [*top, None]), shares(rest(words[lang]), [*top, None]))
        limit = 0.20 * math.sqrt(1000 / min(max(kinds.total(), 1), 1000))
        out.append((doc, by_class, by_word, not base_rules(text)[5] and by_class <= limit and by_word <= 0.42))
    return out


def toxicity(docs, labels, orders=(4, 5, 6), seen_in=3, penalty=1.0, steps=300):
    """Score of each document by a model of all labelled ones; n-grams of bytes that many texts hold, each counted once a text."""

    def grams(text):
        stream = b"".join(b" " + w.encode() for w in SOLID.findall(lower(text)))
        return {stream[i : i + n] for n in orders for i in range(len(stream) - n + 1)}

    known = dict(labels)
    texts = [(grams(text), known[doc]) for doc, text in docs if doc in known]
    count = [Counter(), Counter()]
    for found, y in texts:
        count[y].update(found)
    sizes = [sum(y == k for _, y in texts) for k in (0, 1)]
    ratio = {}
    for g in count[0] | count[1]:
        if count[0][g] + count[1][g] >= seen_in:
            ratio[g] = math.log((count[1][g] + 1) / (sizes[1] + 2)) - math.log((count[0][g] + 1) / (sizes[0] + 2))
    rows = [({g: ratio[g] for g in found if g in ratio}, y) for found, y in texts]
    rate = 1 / (0.25 * (max(1.0, max(sum(v * v for v in x.values()) for x, _ in rows) + 1)) + penalty / len(rows))
    x, ahead = defaultdict(float), defaultdict(float)
    for k in range(steps):
        slope = defaultdict(float, {g: penalty / len(rows) * ahead[g] for g in ratio})
        for values, y in rows:
            margin = sum(v * ahead[g] for g, v in values.items()) + ahead[None]
            wrong = 0.5 / sizes[y] * (1 / (1 + math.exp(-margin)) - y)
            slope[None] += wrong
            for g, v in values.items():
                slope[g] += v * wrong
        before, x = x, defaultdict(float, {g: ahead[g] - rate * s for g, s in slope.items()})
        ahead = defaultdict(float, {g: v + k / (k + 3) * (v - before[g]) for g, v in x.items()})
    return [(doc, 1 / (1 + math.exp(-sum(x[g] * ratio[g] for g in grams(text) if g in ratio) - x[None]))) for doc, text in docs]
