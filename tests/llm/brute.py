"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df, *names):
    return sorted((tuple(r[n] for n in names or df.columns) for r in df.collect()), key=str)


def windows(text, size=10):
    words = ALNUM.findall((text or "").translate(LOWER))
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def contamination(docs, items):
    owners = defaultdict(set)
    for item, text in items:
        for window in windows(text):
            owners[window].add(item)
    out = []
    for doc, text in docs:
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in {len(w) for w in owners}:
            for i in range(len(words) - size + 1):
                own = owners.get(tuple(words[i : i + size]))
                if own:
                    hit.update(range(i, i + size))
                    found |= {str(x) for x in own if x is not None}
        out.append((doc, len(words), len(hit), len(found), ",".join(sorted(found))))
    return sorted(out, key=str)


def shingles(text, k):
    words = BLANK.findall((text or "").translate(LOWER))
    k = min(k, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if k else frozenset()


def near_duplicates(docs, k, percent=80):
    """id to smallest id reachable."""
    sets = [(d, shingles(t, k)) for d, t in docs if d is not None]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, (d, own) in enumerate(sets):
        shared = Counter(j for s in own for j in holders[s])
        for j, n in shared.items():
            if 100 * n >= percent * (len(own) + len(sets[j][1]) - n):
                a, b = find(d), find(sets[j][0])
                root[max(a, b)] = min(a, b)
        for s in own:
            holders[s].append(i)
    return {d: find(d) for d in root}


def revisits(pages):
    groups = defaultdict(list)
    for i, (page, _, html) in enumerate(pages):
        groups[(html or "").encode()].append((page is None, page or 0, i))
    out = []
    for i, (page, _, html) in enumerate(pages):
        raw = (html or "").encode()
        first = min(groups[raw])
        again = first[2] != i
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        to = None if not again or first[0] else first[1]
        out.append((page, len(raw), digest, "revisit" if again else "response", to))
    return sorted(out, key=str)


def licenses(docs, rules, base):
    out = []
    for doc, text in docs:
        words = ALNUM.findall((text or "").translate(LOWER))
        places, names = [], set()
        for phrase, label in base.items():
            own = phrase.split()
            at = [i for i in range(len(words) - len(own) + 1) if words[i : i + len(own)] == own]
            places += at
            names |= {label} if at else set()
        norm, found = " " + " ".join(words) + " ", []
        for r in rules:
            if r["keyword"] in norm:
                for m in re.finditer(r["pattern"], norm):
                    start = norm[: m.start()].count(" ") - 1
                    found.append((start, start + m[0].count(" ") + 1, r["rank"], r["label"], r["sure"]))
        kept = [x for x in found if x[3] and not any(y[0] <= x[0] and y[1] >= x[1] and y[2] < x[2] for y in found)]
        labels = ",".join(sorted(names | {x[3] for x in kept}))
        score = max((x[4] for x in kept), default=0.0)
        first, last = min(places, default=None), max(places, default=None)
        out.append((doc, len(words), len(places), first, last, ",".join(sorted(names)), labels, score))
    return sorted(out, key=str)


def repeats(docs, length):
    """id, bytes, removed ranges and what is left; a missing id is larger than all others."""
    number = lambda i: (i is None, i or 0)
    first = {}
    for doc, text in docs:
        raw = (text or "").encode()
        for p in range(len(raw) - length + 1):
            own = raw[p : p + length]
            first[own] = min(first.get(own, number(doc)), number(doc))
    out = []
    for doc, text in docs:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - length + 1):
            if first[raw[p : p + length]] < number(doc):
                gone[p : p + length] = [True] * length
        spans = []
        for p, x in enumerate(gone):
            if x and p and gone[p - 1]:
                spans[-1] = (spans[-1][0], p + 1)
            elif x:
                spans.append((p, p + 1))
        out.append((doc, len(raw), spans, bytes(c for c, x in zip(raw, gone, strict=True) if not x)))
    return sorted(out, key=str)


def collocations(docs, support, best, longest=4, percent=80, scale=2_000_000):
    """lang, rank, phrase, a, l, r, n, score."""
    f, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = tuple(re.findall("[^ \t]+", piece))
            total[lang] += len(words)
            for n in range(1, longest + 1):
                f[lang].update(words[i : i + n] for i in range(len(words) - n + 1))
    out = []
    for lang, counts in f.items():
        known = {p: a for p, a in counts.items() if a >= support and len(p) > 1}
        rows = []
        for p, a in known.items():
            inside = (q for q in known if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
            if any(100 * known[q] >= percent * a for q in inside):
                continue
            score, _, left, right = min(
                (scale * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))
            )
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:best], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out, key=str)


def trie(conversations):
    """Node rows of rebuilt conversations; (conv_id, turn, role, text) in."""
    own = defaultdict(list)
    for conv, turn, role, text in conversations:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    leaves, saved, children = Counter(), Counter(), Counter()
    for node in members:
        children[node[:-1]] += bool(node)
    for node, own_members in members.items():
        worth = (len(own_members) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += worth
            leaves[node[:d]] += not children[node]
    out = []
    for node, own_members in members.items():
        ends = ",".join(str(c) for c in own_members if len(built[c]) == len(node))
        parent = members[node[:-1]][0] if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        row = (own_members[0], len(node), parent, len(own_members), children[node], leaves[node], saved[node], digest)
        out.append(row)
    return sorted(out, key=str)


def toxic_features(text):
    found = Counter()
    for word in ALNUM.findall(text.translate(LOWER)):
        raw = word.encode()
        found[raw] += 1
        for size in (5, 6, 7, 8, 9, 10, 12):
            if len(raw) > size:
                found[raw[:size] + b"*"] += 1
    return found


def toxicity(docs, toxic, rounds=8000, penalty=3e-4):
    """(weight of each telling feature, thresholds) from labelled (id, text), by loops over dense rows."""
    counted = [(toxic[i], toxic_features(t)) for i, t in docs if i in toxic]
    n1, n0 = sum(t for t, _ in counted), sum(1 - t for t, _ in counted)
    telling, marked = [], []
    for f in sorted({f for _, c in counted for f in c}):
        a, b = sum(f in c for t, c in counted if t), sum(f in c for t, c in counted if not t)
        share, gap = (a + b) / (n1 + n0), a / n1 - b / n0
        spread = (share * (1 - share) * (1 / n1 + 1 / n0)) ** 0.5
        if a + b >= 5 and spread and gap / spread >= 5:
            telling.append(f)
            marked.append((a / n1) / (b / n0 + 1 / n0) >= 20)
    x = np.array([[min(c[f], 5.0) for f in telling] for _, c in counted])
    amount = x[:, np.array(marked, dtype=bool)].sum(axis=1)
    is_toxic = np.array([t for t, _ in counted])
    # Clean texts count as nothing, as in the model.
    low, high = np.quantile(amount[is_toxic > 0], (1 / 3, 2 / 3))
    grade = [0 if not t else 1 + (m > low) + (m > high) for t, m in zip(is_toxic, amount, strict=True)]
    n = len(grade)
    theta = [np.log(1 / min(max(sum(g > k for g in grade) / n, 1e-4), 1 - 1e-4) - 1) for k in range(3)]
    theta = np.maximum.accumulate(theta)
    w = np.zeros(len(telling))
    distinct = np.array([list(r) for r in {(g, *row) for g, row in zip(is_toxic, x, strict=True)}])[:, 1:]
    step = 2 / max(1.0, np.quantile((distinct**2).sum(axis=1), 0.99))
    ahead, ahead_t, momentum = w, theta, 1.0
    grade = np.array(grade)
    for _ in range(rounds):
        edges = np.array([-np.inf, *ahead_t, np.inf])
        score = x @ ahead
        a = 1 / (1 + np.exp(-np.clip(score - edges[grade], -35, 35)))
        b = 1 / (1 + np.exp(-np.clip(score - edges[grade + 1], -35, 35)))
        a[grade == 0], b[grade == 3] = 1.0, 0.0
        moved = ahead - step * (x.T @ (a + b - 1)) / n
        moved = np.sign(moved) * np.maximum(abs(moved) - step * penalty, 0)
        p = np.maximum(a - b, 1e-9)
        pull = [(a * (1 - a) / p)[grade == k + 1].sum() / n - (b * (1 - b) / p)[grade == k].sum() / n for k in range(3)]
        moved_t = np.maximum.accumulate(ahead_t - step * np.clip(pull, -1, 1))
        after = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        ahead = moved + (momentum - 1) / after * (moved - w)
        ahead_t = np.maximum.accumulate(moved_t + (momentum - 1) / after * (moved_t - theta))
        w, theta, momentum = moved, moved_t, after
    return dict(zip(telling, w, strict=True)), theta
