"""Line-by-line versions of rules, and small tables, for the tests of this folder."""

import re

import numpy as np

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def letters(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def solid(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def shingles(text, width):
    found = solid(text)
    if not found:
        return frozenset()
    return frozenset(tuple(found[k:k + width]) for k in range(max(1, len(found) - width + 1)))


def groups(n, edges):
    """Least member reachable from each of n nodes."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return [find(x) for x in range(n)]


def near_groups(texts, width, percent):
    sets = [shingles(t, width) for t in texts]
    edges = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return groups(len(sets), edges), sets


def hits(text, items, window=10):
    """(words, hit places, ids of items found) by trying every place."""
    found = letters(text)
    places, names = set(), set()
    for name, item in items:
        w = letters(item)
        n = min(len(w), window)
        for k in range(len(w) - n + 1 if w else 0):
            for at in range(len(found) - n + 1):
                if found[at:at + n] == w[k:k + n]:
                    places.update(range(at, at + n))
                    if name is not None:
                        names.add(str(name))
    return found, places, names


def edited(rng, words, share):
    out = list(words)
    for k in range(len(out)):
        if rng.random() < share:
            out[k] = f"x{rng.integers(1 << 40)}"
    return " ".join(out)


def odd_documents():
    return [
        (1, None, "en", "s", 0), (2, "", None, None, None), (3, "  \n", "en", "s", 3), (4, "a", "en", None, 1),
        (None, "no id here at all", "en", "s", 1), (5, "one two three four five six seven " * 3000, "en", "s", 1),
        (6, "a", "en", "s", 1), (6, "a", "en", "s", 1), (7, "12 34 !!", "en", "s", 1), (None, "no id here at all", "en", "s", 1),
    ]


def rng(seed=1):
    return np.random.default_rng(seed)
