"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import itertools
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}

#: Rows that every operator over documents has to cope with.
ODD_TEXTS = [
    None, "", "   \n\t ", "one", "one two three", "a b c d e", "A B C D E", "a b c d e f",
    " x y z", "\x1fw \x0bv\x0c u", "é" * 3000, "Ünïcode ÀÉ text\r\nwith lines",
    "same words here again and again", "same words here again and again",
    " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(400)),
    " ".join(f"w{i}" for i in range(390)) + " tail end",
    " ".join(f"w{i % 7}" for i in range(300)), "x " * 40000,
    "q " + " ".join(f"w{i}" for i in range(100, 136)) + " z",
    "q " + " ".join(f"w{i}" for i in range(100, 134)) + " z", "<|endoftext|> a <|endoftext|>",
]


def words(text):
    return WORD.findall(text or "")


def shingles(text, n=5):
    own = words((text or "").translate(LOWER))
    if not own:
        return set()
    if len(own) < n:
        return {tuple(own)}
    return {tuple(own[i:i + n]) for i in range(len(own) - n + 1)}


def groups(nodes, links):
    """Smallest reachable node of each node."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def jaccard_components(rows, n=5, percent=80):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows with distinct doc_ids."""
    sets = {i: shingles(t, n) for i, t in rows}
    where, links = {}, []
    for i, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(i)
    overlap = Counter()
    for own in where.values():
        overlap.update(itertools.combinations(sorted(own), 2))
    for (a, b), k in overlap.items():
        if 100 * k >= percent * len(sets[a] | sets[b]):
            links.append((a, b))
    root = groups(sets, links)
    return sorted((i, len(s), root[i]) for i, s in sets.items())


def repeats_removed(rows, window=35):
    """(id, n_words, n_removed, kept words) of (id, text) rows."""
    own = [(i, words(t)) for i, t in rows]
    seen = Counter(tuple(w[k:k + window]) for _, w in own for k in range(len(w) - window + 1))
    out = []
    for i, w in own:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out
