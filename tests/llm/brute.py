"""Plain Python versions of the operators over a dict of texts."""

import hashlib
import math
import re
from collections import Counter, defaultdict

SPACE = re.compile("[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def words(text):
    return SPACE.findall(text or "")


def substring(texts, size=35):
    held = {d: words(t) for d, t in texts.items()}
    count = Counter(tuple(w[i : i + size]) for w in held.values() for i in range(len(w) - size + 1))
    out = {}
    for d, w in held.items():
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if count[tuple(w[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        out[d] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def suffix(texts, size=100):
    seen, out = set(), {}
    for d in sorted(texts):
        b = (texts[d] or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            s = b[i : i + size]
            if s in seen:
                gone[i : i + size] = b"\1" * size
            seen.add(s)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept))
    return out


def shingles(text, size=5):
    w = words((text or "").translate(LOW))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def near(texts):
    sets = {d: shingles(t) for d, t in texts.items()}
    index, both = defaultdict(list), Counter()
    for d in sorted(sets):
        for s in sets[d]:
            for e in index[s]:
                both[e, d] += 1
            index[s].append(d)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def base(text):
    text = text or ""
    w = words(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if words(line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    hit = [False] * len(w)
    for i in range(len(w) - 4):
        if count[tuple(w[i : i + 5])] > 1:
            hit[i : i + 5] = [True] * 5
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, sum(hit))


def lines(rows, min_docs, share, min_words=10, min_left=0.3):
    """rows: (doc_id, host, text); the verdict of each doc_id."""
    texts, first, holders = defaultdict(set), {}, defaultdict(set)
    for d, host, text in rows:
        texts[host].add(text or "")
        for line in (text or "").split("\n"):
            if words(line):
                key = host, " ".join(words(line.translate(LOW)))
                holders[key].add(text)
                first[key] = min(first.get(key, d), d)
    out = {}
    for d, host, text in rows:
        n, *_, rep = base(text)
        gone = 0
        for line in (text or "").split("\n"):
            if words(line):
                key = host, " ".join(words(line.translate(LOW)))
                if len(holders[key]) > max(min_docs, share * len(texts[host])) and first[key] != d:
                    gone += len(words(line))
        failed = n < 10 or 100 * rep > 20 * n
        depleted = gone > 0 and (n - gone < min_words or n - gone < min_left * n)
        out[d] = (failed, gone, not failed and not depleted)
    return out


def contamination(texts, items, window=13):
    """items: (item_id, text)."""
    places = defaultdict(set)
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOW))
        size = min(len(w), window)
        for k in range(len(w) - size + 1) if w else ():
            places[tuple(w[k : k + size])].add(str(i))
    sizes = {len(k) for k in places}
    out = {}
    for d, t in texts.items():
        w = ALNUM.findall((t or "").translate(LOW))
        hit, found = [False] * len(w), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if got := places.get(tuple(w[i : i + size])):
                    found |= got
                    hit[i : i + size] = [True] * size
        n = sum(hit)
        out[d] = (len(w), n, len(found), sha(",".join(sorted(found))), n > 0 and 20 * n >= len(w))
    return out


def neighbours(texts, examples, k):
    """The k examples of largest TF-IDF cosine over all words, and the cosines; never the text itself."""
    count = {d: Counter(ALNUM.findall((t or "").translate(LOW))) for d, t in texts.items()}
    df = Counter(w for c in count.values() for w in c)
    unit = {}
    for d, c in count.items():
        v = {w: (1 + math.log(n)) * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for w, n in c.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        unit[d] = {w: x / size for w, x in v.items()}
    out = {}
    for d, v in unit.items():
        found = [(e, sum(x * unit[e].get(w, 0) for w, x in v.items())) for e in examples if e != d]
        out[d] = sorted((x for x in found if x[1] > 0), key=lambda x: (-round(x[1], 9), x[0]))[:k]
    return out
