from __future__ import annotations

import hashlib

import numpy as np

from lakeloom.llm import queries, secret_forest as S
from tests.conftest import SF
from tests.llm.helpers import PIECES, docs

WORDS = S.words_of(PIECES)


def test_held_out_findings():
    """Findings of another seed: the forest tells true from false."""
    forest, f = S.train(WORDS), S.Features(WORDS)
    findings = S.labelled_findings(1500, seed=77)
    x, y = np.array([f.row(p, t, a, n) for p, t, a, n, _ in findings]), np.array([label for *_, label in findings])
    said = forest.predict(x) >= S.CUT
    assert said[y == 1].mean() >= 0.95 and 1 - said[y == 0].mean() >= 0.95


def test_trees_separate_what_a_cut_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5))
    y = ((x[:, 1] > 0.3) & (x[:, 3] < 0.5)).astype(float)
    assert ((S.grow(x, y).predict(x) >= 0.5) == y).mean() > 0.97


def test_candidates():
    assert [("password=abc123def456"[a : a + n]) for a, n in S.candidates("password=abc123def456")] == ["abc123def456"]
    text = 'x token = "0123456789abcdef0123" y QUJDREVGR0hJSktMTU5PUDEyMw== z'
    assert [text[a : a + n] for a, n in S.candidates(text)] == ["0123456789abcdef0123", "QUJDREVGR0hJSktMTU5PUDEyMw=="]
    assert S.candidates("") == S.candidates("plain words only, nothing-to-see-here") == []


def test_whole_table(spark):
    """The query against the same scan in one process."""
    forest, f = S.train(WORDS), S.Features(WORDS)
    want = []
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect():
        c = S.candidates(r["text"])
        if c:
            for (a, n), p in zip(c, forest.predict(np.array([f.row(r["source"], r["text"], a, n) for a, n in c])), strict=True):
                if p >= S.CUT:
                    want.append((r["doc_id"], a, n, hashlib.sha256(r["text"][a : a + n].encode()).hexdigest()))
    got = [(r["doc_id"], r["start"], r["length"], r["digest"]) for r in queries.op9_secrets(spark, "/root/testdata/sf0.01").collect()]
    assert sorted(got) == sorted(want) and want


def test_defined_results(spark):
    secret = 'token = "1beb58b8af68854f0e01b4ad40cdbb6ae7f578ae" end'
    long = "word " * 40_000 + secret
    rows = [(1, None), (2, ""), (3, secret + " " + secret), (4, secret, None), (4, secret, None), (None, secret), (5, long)]
    df = docs(spark, rows).selectExpr("*", "1 AS start", "2 AS length", "3 AS score")
    got = S.scan(df, WORDS).collect()
    assert sorted(r["doc_id"] or 0 for r in got) == [0, 3, 3, 4, 4, 5]
    assert next(r["start"] for r in got if r["doc_id"] == 5) == long.index("1beb")
    assert S.scan(df.limit(0), WORDS).count() == 0
    one_class = [x for x in S.labelled_findings(40) if x[4] == 0]
    assert S.scan(df, WORDS, one_class).count() == 0
    assert S.scan(df, WORDS, []).count() == 0


def test_values_are_candidates_whole():
    cut = lambda t: [t[a : a + n] for a, n in S.candidates(t)]
    assert cut('password = "p@ss#2024!Xy7&q"') == ["p@ss#2024!Xy7&q"]
    assert cut('password = "Tr0ub4dor&3xyz!"') == ["Tr0ub4dor&3xyz!"]
    assert cut('token = "abc.def.ghi-123", x') == ["abc.def.ghi-123"]
    assert cut("go to postgres://me:s3cr3t!pw@host/db now") == ["s3cr3t!pw"]
    assert cut("token=a1!b2?c3(d4), then") == ["a1!b2?c3(d4"]
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9PlFUP0THsR8U"
    assert cut(f"see {jwt}.") == [jwt]
    assert cut('token: "a sentence with ghp_0123456789abcdefghij inside"') == ["ghp_0123456789abcdefghij"]
    findings = S.labelled_findings(1200, seed=5)
    assert all((a, n) in S.candidates(t) for _, t, a, n, y in findings if y)


def plain_row(path, text, start, length):
    """The features again, by loops over characters."""
    import math
    import re
    from collections import Counter

    f = S.Features(WORDS)
    c = text[start : start + length].encode()
    n = len(c)
    kind = [1 if 48 <= x <= 57 else 2 if 65 <= x <= 90 else 3 if 97 <= x <= 122 else 0 for x in c]
    low = [x + 32 if k == 2 else x for x, k in zip(c, kind, strict=True)]
    likely = [f.pairs[a - 97, b - 97] for a, b in zip(low, low[1:]) if 97 <= a <= 122 and 97 <= b <= 122]
    before, behind = text[max(0, start - S.NEAR) : start], text[start + length : start + length + S.NEAR]
    covered, s, i = 0, c.decode().lower(), 0
    while i < len(s):
        part = re.match("[a-z]+", s[i:])
        ends = [k for k in range(4, len(part[0]) + 1) if s[i : i + k] in WORDS] if part else []
        covered += max(ends, default=0)
        i += max(ends, default=1)
    has = lambda p, t: float(p.search(t) is not None)
    share = lambda ok: sum(map(ok, c)) / n
    return [
        math.log(n), kind.count(1) / n, kind.count(2) / n, sum(k == 1 or 97 <= x <= 102 for x, k in zip(low, kind, strict=True)) / n, -sum(v / n * math.log2(v / n) for v in Counter(c).values()),
        sum(a != b for a, b in zip(kind, kind[1:])) / (n - 1), sum(likely) / len(likely) if likely else -3.0, covered / n,
        max(map(len, re.findall("[A-Za-z]+", c.decode())), default=0) / n, share(lambda x: chr(x) in "-_/+="), share(lambda x: chr(x) in "!@#$%^&*()[]{}<>?~.,:;|\\\"'`"), share(lambda x: x == 32), sum(a == b for a, b in zip(c, c[1:])) / (n - 1),
        float(before.rstrip(" \t\"'`").endswith(("=", ":", ">"))), float(before[-1:] in "\"'`" and behind[:1] in "\"'`" and behind[:1] != ""),
        has(S._GOOD, before), has(S._BAD, before), has(S._NUMBER, before), has(S._GOOD, behind), has(S._BAD, behind),
        has(S._PATH_TEST, path), has(S._PATH_DOC, path), has(S._PATH_CONF, path), float(S._PREFIX.match(c.decode()) is not None),
    ]


def test_features_and_votes_against_plain_python():
    forest, f = S.train(WORDS), S.Features(WORDS)
    findings = S.labelled_findings(120, seed=9)
    x = np.array([f.row(p, t, a, n) for p, t, a, n, _ in findings])
    assert x.shape[1] == len(S.NAMES)
    assert np.allclose(x, [plain_row(p, t, a, n) for p, t, a, n, _ in findings], atol=1e-9)

    def vote(row, at):
        while forest.feature[at] >= 0:
            at = forest.low[at] if row[forest.feature[at]] <= forest.cut[at] else forest.high[at]
        return forest.share[at]

    assert np.allclose(forest.predict(x), [np.mean([vote(r, int(k)) for k in forest.roots]) for r in x])
