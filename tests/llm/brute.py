"""Plain, slow versions of the operators' contracts, to compare with."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(s):
    return re.sub("[A-Z]", lambda m: m.group().lower(), s or "")


def decontaminate(docs, items, size=10):
    wins = []
    for i, t in items:
        w = ITEM_WORD.findall(lower(t))
        wins += [(i, tuple(w[k : k + size])) for k in range(max(1, len(w) - size + 1))] if w else []
    by = {}
    for i, w in wins:
        by.setdefault(w, set()).add(i)
    sizes = {len(w) for w in by}
    for d, t in docs:
        w, hit, found = ITEM_WORD.findall(lower(t)), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (ids := by.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= ids
        yield d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(str(x) for x in found)).encode()).hexdigest(), bool(hit)


def quality_base(docs):
    for d, t in docs:
        t = t or ""
        w = WORD.findall(t)
        at = {}
        for k in range(len(w) - 7):
            at.setdefault(tuple(w[k : k + 8]), []).append(k)
        rep = {j for ks in at.values() if len(ks) > 1 for k in ks for j in range(k, k + 8)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        yield d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(rep), len(w) < 20 or 100 * len(rep) > 30 * len(w)


def substrings(docs, size=50):
    first = {}
    for d, t in docs:
        if d is not None:
            w = WORD.findall(t or "")
            for k in range(len(w) - size + 1):
                key = tuple(w[k : k + size])
                first[key] = min(first.get(key, d), d)
    for d, t in docs:
        w = WORD.findall(t or "")
        gone = set()
        if d is not None:
            for k in range(len(w) - size + 1):
                if first[tuple(w[k : k + size])] < d:
                    gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        yield d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()


def shingles(t, size):
    w = WORD.findall(lower(t))
    return {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def jaccard(docs, size, num, den):
    sets = [(d, shingles(t, size)) for d, t in docs]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and den * min(len(a), len(b)) >= num * max(len(a), len(b)):
                inter = len(a & b)
                if den * inter >= num * (len(a) + len(b) - inter):
                    parent[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return [(d, len(s), best.get(find(i))) for i, (d, s) in enumerate(sets)]


def secrets_base(text):
    text = text or ""
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 16]
    named = [f"{('assign', 'access', 'hex')[k]}:{a}:{z}" for a, k, z in sorted(spans)]
    n = Counter(k for _, k, _ in spans)
    return n[0], n[1], n[2], hashlib.sha256(",".join(named).encode()).hexdigest(), named


def lm_base(docs, held, end="\0end"):
    import math

    tokens = {i: [*WORD.findall(t or ""), end] for i, (_, t) in enumerate(docs)}
    c = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for i, (d, _) in enumerate(docs):
        ws = tokens[i]
        yield d, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)


def vote_model(votes, rounds=500):
    """Expectation-maximisation text by text: the posterior probability of good for each row of votes (-1, 0, 1)."""
    import math

    rules = range(len(votes[0]))
    post = [0.05 if v.count(-1) >= 2 else 0.7 if -1 in v else 0.95 for v in votes]
    for _ in range(rounds):
        right = {}
        for cls, vote in ((1, 1), (0, -1)):
            for j in rules:
                yes = all_ = 0.0
                for v, p in zip(votes, post):
                    if v[j]:
                        w = p if cls else 1 - p
                        all_ += w
                        yes += w * (v[j] == vote)
                right[cls, j] = (yes + 1) / (all_ + 2)
        prior = (sum(post) + 1) / (len(votes) + 2)
        new = []
        for v in votes:
            odds = math.log(prior / (1 - prior))
            for j in rules:
                if v[j] > 0:
                    odds += math.log(right[1, j] / (1 - right[0, j]))
                elif v[j] < 0:
                    odds += math.log((1 - right[1, j]) / right[0, j])
            new.append(1 / (1 + math.exp(-max(-40, min(40, odds)))))
        moved, post = max(abs(a - b) for a, b in zip(new, post)), new
        if moved < 1e-9:
            break
    return post
