"""Encoding against exhaustive search and an independent implementation; decoding as an exact round trip."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeloom.llm import queries, spm, tokencount
from lakeloom.llm.spm import BYTE, CONTROL, MARK, NORMAL, UNKNOWN, UnigramVocabulary
from tests.conftest import SF
from tests.llm.helpers import PIECES, docs

BYTES = [f"<0x{b:02X}>" for b in range(256)]
WORDS = [MARK, "a", "b", "ab", "ba", "aab", MARK + "a", MARK + "ab", "bb", "é", "éa"]


def small():
    return UnigramVocabulary(["<unk>", "<s>", *BYTES, *WORDS], [0.0, 0.0, *[0.0] * 256, *[-2.0, -1.0, -1.5, -1.75, -2.5, -2.0, -2.25, -2.25, -3.0, -1.0, -2.0]], [UNKNOWN, CONTROL, *[BYTE] * 256, *[NORMAL] * len(WORDS)])


def exhaustive(v, s):
    """The best score over all segmentations into pieces and uncovered characters."""
    score = {v.pieces[i]: float(v.scores[i]) for i in v.lattice}
    best = -np.inf
    for cuts in itertools.product([0, 1], repeat=max(0, len(s) - 1)):
        parts, a = [], 0
        for i, c in enumerate(cuts, 1):
            if c:
                parts.append(s[a:i])
                a = i
        parts.append(s[a:])
        total = sum(score.get(p, v.unknown_score if len(p) == 1 else -np.inf) for p in parts)
        best = max(best, total)
    return best


def cost(v, ids):
    total, k = 0.0, 0
    while k < len(ids):
        if v.kinds[ids[k]] == BYTE:
            b = int(v.pieces[ids[k]][3:5], 16)
            k += 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
            total += v.unknown_score
        else:
            total += float(v.scores[ids[k]])
            k += 1
    return total


@settings(max_examples=150, deadline=None)
@given(st.text("abé x", min_size=1, max_size=9))
def test_viterbi_is_best_of_all(s):
    v = small()
    assert abs(cost(v, v.encode(s)) - exhaustive(v, v.normalised(s))) < 1e-9


def test_ties_take_the_longest_last_piece():
    v = UnigramVocabulary(["<unk>", *BYTES, "a", "b", "c", "ab", "bc", MARK], [0.0, *[0.0] * 256, -1.0, -1.0, -1.0, -1.0, -1.0, -1.0], [UNKNOWN, *[BYTE] * 256, *[NORMAL] * 6])
    assert [v.pieces[i] for i in v.viterbi("abc")] == ["a", "bc"]


@pytest.fixture(scope="module")
def v():
    return UnigramVocabulary.load(PIECES)


def test_trie_finds_all_prefixes(v):
    keys = {v.pieces[i].encode(): i for i in v.lattice}
    for text in ("▁international agreement", "▁déjà vu été", "straße▁und", "日本語のテキスト"):
        data = text.encode()
        for start in range(len(data)):
            want = [(z, keys[data[start:z]]) for z in range(start + 1, len(data) + 1) if data[start:z] in keys]
            assert list(v.trie.prefixes(data, start)) == want


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_round_trip_and_batches_agree(s):
    e = spm.encoder(PIECES)
    ids, n = e.encode([s, s + " " + s, ""])
    assert ids.tolist() == e.v.encode(s) + e.v.encode(s + " " + s)
    assert n.tolist() == [len(e.v.encode(s)), len(e.v.encode(s + " " + s)), 0]
    if MARK not in s:
        assert e.v.decode(e.v.encode(s)) == s
    assert tokencount.counter(PIECES).counts([s, s + "\n" + s]).tolist() == [len(e.v.encode(s)), len(e.v.encode(s + "\n" + s))]


def test_equals_an_independent_lattice(v):
    """The tokenizers library's unigram model over the same pieces: the scores are the same everywhere."""
    from tokenizers import models

    vocabulary = [(p, float(s)) if k == NORMAL else (p, -1e6) for p, s, k in zip(v.pieces, v.scores, v.kinds, strict=True)]
    other = models.Unigram(vocabulary, v.unknown, False)
    for text in ("the quick brown fox jumps", "Überraschung in der Straße", "une étude à propos", "password token 12345 x"):
        s = v.normalised(text)
        assert abs(cost(v, [t.id for t in other.tokenize(s)]) - cost(v, v.viterbi(s))) < 1e-6


def test_whole_table(spark):
    """The registered query against the plain recurrence, document by document; counts by the count-only search."""
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op1_sentencepiece(spark, SF).collect()
    counts = {r["doc_id"]: r["n_tokens"] for r in queries.op7_token_counts(spark, SF).collect()}
    v = spm.encoder(PIECES).v
    assert len(got) == len(table)
    for r in got:
        assert r["ids"] == v.encode(table[r["doc_id"]])
        assert r["decoded"] == table[r["doc_id"]]
        assert r["n_tokens"] == len(r["ids"]) == counts[r["doc_id"]]


def test_defined_results(spark):
    long = "word " * 60_000 + "x" * 5000
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (None, "no id"), (4, long)]
    df = docs(spark, rows).selectExpr("*", "1 AS ids", "2 AS n_tokens", "3 AS decoded")
    got = sorted(((r["doc_id"] or 0, r["n_tokens"], r["decoded"]) for r in spm.sentencepiece(df, PIECES).collect()), key=str)
    counts = sorted(((r["doc_id"] or 0, r["n_tokens"]) for r in tokencount.token_counts(df, PIECES).collect()), key=str)
    assert (1, None, None) in got and (2, 0, "") in got and (0, 2, "no id") in got
    assert sum(x[0] == 3 for x in got) == 2
    assert next(x[2] for x in got if x[0] == 4) == long
    assert counts == sorted((x[:2] for x in got), key=str)
    assert spm.sentencepiece(df.limit(0), PIECES).count() == tokencount.token_counts(df.limit(0), PIECES).count() == 0
