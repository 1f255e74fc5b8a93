"""Plain versions of the operators, for comparison on small inputs."""

import hashlib
import re

import numpy as np
import xxhash

WORDS = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    return WORDS.findall(text or "")


def simhash(text, shingle=3):
    w = words(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))
    if not w:
        return 0
    grams = [" ".join(w[k : k + shingle]) for k in range(max(1, len(w) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=2):
    """{id: smallest id reachable} from {id: fingerprint}."""
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    codes = np.array([prints[i] for i in ids], np.uint64)
    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(codes[k + 1 :] ^ codes[k]) <= radius):
            a, b = find(i), find(ids[k + 1 + int(j)])
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def cut_repeats(rows, window=20):
    """{id: (words, removed, kept text)} from [(id, text)]; later starts of a window's words are cut."""
    seen, out = {}, {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            gram = tuple(w[k : k + window])
            if seen.setdefault(gram, (i, k)) != (i, k):
                gone[k : k + window] = [True] * window
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_pii(text):
    def fine(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(x) <= 255 for x in m.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and luhn(digits)
        return kind != "phone" or 9 <= len(digits) <= 15

    return [f"{kind}:{m.start()}:{m.end()}" for kind, p in PII.items() for m in re.finditer(p, text or "") if fine(kind, m.group())]


def base_quality(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    grams = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
    count = {}
    for g in grams:
        count[g] = count.get(g, 0) + 1
    covered = {k + j for k, g in enumerate(grams) if count[g] > 1 for j in range(8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def naive_tiles(doc, item, least):
    """Greedy string tiling by trying everything, longest first."""
    used_d, used_i, out = set(), set(), []
    while True:
        best = None
        for q in range(len(item)):
            for p in range(len(doc)):
                n = 0
                while p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n] and p + n not in used_d and q + n not in used_i:
                    n += 1
                if n >= least and (best is None or (-n, q, p) < best):
                    best = (-n, q, p)
        if best is None:
            return out
        n, q, p = -best[0], best[1], best[2]
        used_d.update(range(p, p + n))
        used_i.update(range(q, q + n))
        out.append((p, q, n))


def contaminated(rows, items, seed=5, threshold=0.5):
    """{(doc, item)} by naive tiling of every pair of texts that share ``seed`` tokens in a row."""

    def cut(text):
        return re.findall(r"[a-z0-9_\x80-\U0010ffff]+", (text or "").lower())

    items = [(i, cut(t)) for i, t in items]
    windows = {}
    for k, (_, words) in enumerate(items):
        for p in range(len(words) - seed + 1):
            windows.setdefault(tuple(words[p : p + seed]), set()).add(k)
    out = set()
    for doc, text in rows:
        words = cut(text)
        at = {}
        for p in range(len(words) - seed + 1):
            for k in windows.get(tuple(words[p : p + seed]), ()):
                at.setdefault(k, set()).update(range(p, p + seed))
        for k, places in at.items():
            # The naive version tries everything, so it only gets what lies around shared windows.
            part = [words[p] if p in places else f"#{p}" for p in sorted(places | {p + 1 for p in places}) if p < len(words)]
            if sum(t[2] for t in naive_tiles(part, items[k][1], seed)) >= threshold * len(items[k][1]):
                out.add((doc, items[k][0]))
    return out


def mixture(text, table, unknown, languages, temper):
    """(language, share) by expectation-maximisation over one text's words, a set of languages at a time."""
    import math

    like, weight = [], []
    for word, n in sorted({w: (text or "").lower().split().count(w) for w in (text or "").lower().split()}.items()):
        clean = "".join(c for c in word if c.isalpha())
        if clean:
            marked = f"^{clean}$"
            rows = [table.get(marked[k : k + size], unknown) for size in (2, 3) for k in range(len(marked) - size + 1)]
            like.append([temper * sum(r[x] for r in rows) for x in range(len(languages))])
            weight.append(n)
    if not like:
        return "und", 0.0

    def fit(chosen):
        shares = [1 / len(chosen)] * len(chosen)
        for _ in range(25):
            new = [0.0] * len(chosen)
            for row, n in zip(like, weight, strict=True):
                top = max(row)
                parts = [s * math.exp(row[x] - top) for s, x in zip(shares, chosen, strict=True)]
                for k, p in enumerate(parts):
                    new[k] += n * p / max(sum(parts), 1e-300)
            new = [v / sum(weight) for v in new]
            still = max(abs(a - b) for a, b in zip(new, shares, strict=True)) < 1e-4
            shares = new
            if still:
                break
        value = sum(n * (max(row) + math.log(max(sum(s * math.exp(row[x] - max(row)) for s, x in zip(shares, chosen, strict=True)), 1e-300))) for row, n in zip(like, weight, strict=True))
        return [s / sum(shares) for s in shares], value

    every = list(range(len(languages)))
    alone = [sum(n * row[x] for row, n in zip(like, weight, strict=True)) for x in every]
    single = max(every, key=lambda x: alone[x])
    best, shares, value = [single], [1.0], alone[single]
    full = fit(every)[0]
    order = sorted(every, key=lambda x: -full[x])
    for k in range(2, len(every) + 1):
        part, got = fit(order[:k])
        got -= (k - 1) * math.log(sum(weight) + 1)
        if got > value:
            best, shares, value = order[:k], part, got
    share, name = min((-s, languages[x]) for s, x in zip(shares, best, strict=True))
    return name, -share
