"""Plain versions of the operators for small tables."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def bucket(*parts, buckets=8192):
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    h = hashes[0]
    if len(hashes) > 1:
        h = 42
        for x in hashes:
            h = xxhash.xxh64_intdigest(x.to_bytes(8, "little"), seed=h)
    return signed(h) % buckets


def base(text):
    w = words(text)
    windows = defaultdict(list)
    for i in range(len(w) - 7):
        windows[tuple(w[i : i + 8])].append(i)
    covered = {i + j for at in windows.values() if len(at) > 1 for i in at for j in range(8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def quality(rows, trusted):
    """rows: (doc_id, text); per row the five counts, base_failed and kept."""

    def grams(text):
        w = words(text)
        return [bucket(x) for x in w] + [bucket(a, b) for a, b in zip(w, w[1:])]

    raw, target = Counter(), Counter()
    for doc_id, text in rows:
        g = Counter(grams(text))
        raw.update(g)
        if doc_id in trusted:
            target.update(g)
    n, m = sum(raw.values()) + 8192, sum(target.values()) + 8192

    def ratio(b):
        x = math.log(((target[b] + 1) / m) / ((raw[b] + 1) / n)) * 1_000_000
        return int(math.floor(abs(x) + 0.5)) * (1 if x >= 0 else -1)

    table = [ratio(b) for b in range(8192)]
    out = []
    for _, text in rows:
        counts, g = base(text), grams(text)
        failed = counts[0] < 20 or 100 * counts[4] > 30 * counts[0]
        out.append((*counts, failed, not failed and sum(table[b] for b in g) >= -50_000 * len(g)))
    return out


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard(rows):
    """rows: (doc_id, text) with different ids; {doc_id: (class id, number of links)}."""
    sets = [(i, shingles(t)) for i, t in rows]
    by = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            by[x].append(k)
    links = defaultdict(set)
    for k, (i, s) in enumerate(sets):
        for j, n in Counter(o for x in s for o in by[x] if o != k).items():
            if n >= 0.8 * (len(s) + len(sets[j][1]) - n) - 1e-9:
                links[i].add(sets[j][0])
    label = {}
    for i in sorted(i for i, _ in sets):
        todo = [] if i in label else [i]
        while todo:
            x = todo.pop()
            if x not in label:
                label[x] = i
                todo.extend(links[x])
    return {i: (label[i], len(links[i])) for i, _ in sets}


def spans(rows, n=20):
    """rows: (doc_id, text) with different ids; {doc_id: (n_words, n_removed, kept text)}."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        w = words(text)
        gone = set()
        for a in range(len(w) - n + 1):
            key = tuple(w[a : a + n])
            if key in seen:
                gone.update(range(a, a + n))
            seen.add(key)
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out
