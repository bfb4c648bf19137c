"""Plain-Python versions of the corpus operators, for small inputs."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, n=4):
    w = words(lower(text))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def ngram_components(docs, n=4, percent=85):
    """docs: (id, text) -> {id: (set size, smallest linked id)}"""
    sets = {i: shingles(t, n) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    where = {}
    for i in ids:
        for s in sets[i]:
            where.setdefault(s, []).append(i)
    for i in ids:
        seen = {}
        for s in sets[i]:
            for j in where[s]:
                if j < i:
                    seen[j] = seen.get(j, 0) + 1
        for j, o in seen.items():
            if 100 * o >= percent * (len(sets[i]) + len(sets[j]) - o):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def covered(docs, size=50):
    """docs: (id, text) -> {id: (words, removed, kept text)}"""
    first = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - size + 1):
            g = tuple(w[k:k + size])
            first[g] = min(first.get(g, i), i)
    out = {}
    for i, t in docs:
        w = words(t)
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < i:
                gone.update(range(k, k + size))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


def holds_item(text, item, n=5):
    """Whether a text holds an item: 80% of the item's word shingles together."""
    def grams(t):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        return w, {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}

    w, want = grams(item)
    held, have = grams(text)
    if not want:
        return False
    step, size = 64, 128
    for lo in range(0, max(1, len(held) - step), step):
        part = held[lo:lo + size]
        inside = {tuple(part[i:i + n]) for i in range(len(part) - n + 1)}
        if len(want & inside) >= 0.8 * len(want):
            return True
    return False


def mixed(rows, weights=(1, 2, 3), cap=3, seed=17):
    """rows: (id, source, text) -> {id: (size, source size, target, taken)}"""
    import hashlib
    import math
    size = {i: len(words(t)) for i, _, t in rows}
    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[i] for i, x, _ in rows if x == s) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    capped = set()
    while True:
        open_ = [s for s in names if s not in capped]
        left = sum(total.values()) - sum(cap * total[s] for s in capped)
        share = sum(weight[s] for s in open_)
        target = {s: cap * total[s] if s in capped else left * weight[s] / share for s in names}
        over = {s for s in open_ if target[s] > cap * total[s]}
        if not over:
            break
        capped |= over
    out = {}
    for s in names:
        mine = sorted((hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i) for i, x, _ in rows if x == s)
        budget, before = math.floor(target[s]), 0
        whole, left = divmod(budget, total[s]) if total[s] else (0, 0)
        for _, i in mine:
            out[i] = (size[i], total[s], target[s], whole * size[i] + max(0, min(size[i], left - before)))
            before += size[i]
    return out


def runs(w, exponent=4, least=6):
    """Runs (start, length, period) of a word list, by start and period."""
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i > s and i + q - s >= max(least, exponent * q):
                found.setdefault((s, i + q - s), q)
            i += i == s
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def run_report(doc_id, text):
    """The runs query's row for one document, its text made periodic as the query does."""
    import hashlib
    import zlib
    w = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = runs(w)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    left = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


def filter_audit(docs, labels):
    """docs: (id, text, part), labels: id -> (good, toxic); the audit's rows, by plain filtering."""
    from itertools import permutations
    rows = []
    for i, text, part in docs:
        t = text or ""
        w = words(t)
        fails = "".join(k for k, bad in (
            ("A", len(w) < 100), ("B", 100 * len(set(w)) < 80 * len(w)),
            ("C", 100 * len(re.findall("[A-Z]", t)) > 10 * len(t)), ("D", re.search("[#$%&*|]", t)),
            ("E", i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs))) if bad)
        rows.append((part or "", fails, *labels.get(i, (0, 0))))
    out = []
    for part in {r[0] for r in rows}:
        mine, shapley, found = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                found.append((f, part, "".join(order), step, len(left), len(gone),
                              sum(f in r[1] for r in mine) - len(gone), sum(r[1] == f for r in mine),
                              sum(r[2] for r in gone), sum(r[3] for r in gone)))
        out += [(*r[1:], shapley[r[0]]) for r in found]
    return sorted(out)
