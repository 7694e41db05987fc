from __future__ import annotations

import re
from collections import defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def docs(spark, rows, schema=SCHEMA):
    """A table of (doc_id, text[, source]) rows with the columns of documents."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, schema)


def groups(edges, nodes=()):
    """Least member of the component of every node."""
    head = {n: n for n in nodes}

    def find(x):
        head.setdefault(x, x)
        while head[x] != x:
            head[x] = head[head[x]]
            x = head[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            head[max(a, b)] = min(a, b)
    return {n: find(n) for n in list(head)}


def shingle_set(text, k=3):
    w = re.findall(r"\w+", text.lower())
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def jaccard_pairs(texts):
    """{(i, j): similarity} of all pairs that share a shingle, by an inverted list."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    posts = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            posts[x].append(i)
    both = defaultdict(int)
    for p in posts.values():
        for a in range(len(p)):
            for b in range(a + 1, len(p)):
                both[min(p[a], p[b]), max(p[a], p[b])] += 1
    return {(i, j): n / (len(sets[i]) + len(sets[j]) - n) for (i, j), n in both.items()}
