"""The pipeline against its stages in plain Python where they can be, and against each stage's own operator."""

from __future__ import annotations

import corpus_pipeline
from lakeloom.llm import quality, spm
from lakeloom.llm.common import saved
from tests.conftest import SF
from tests.llm.helpers import PIECES, docs, groups, jaccard_pairs


def test_stages_and_whole_run(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r["doc_id"] for r in quality.quality(table, labels).where("keep").collect()}
    texts = {r["doc_id"]: r["text"] for r in table.collect() if r["doc_id"] in kept}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "exact dedup", "MinHash near-dedup", "mixing sources to target weights", "SentencePiece encoding and decoding"]
    one = saved(corpus_pipeline.STAGES[0][1](spark, table, SF), "t")
    assert one.columns == table.columns and {r["doc_id"] for r in one.collect()} == kept
    two = saved(corpus_pipeline.STAGES[1][1](spark, one, SF), "t")
    first: dict = {}
    for i in sorted(texts):
        first.setdefault(texts[i], i)
    left = set(first.values())
    assert two.columns == table.columns and {r["doc_id"] for r in two.collect()} == left
    three = saved(corpus_pipeline.STAGES[2][1](spark, two, SF), "t")
    got = {r["doc_id"] for r in three.collect()}
    pairs = jaccard_pairs({i: texts[i] for i in left})
    sure, loose = groups([p for p, s in pairs.items() if s >= 0.6], left), groups([p for p, s in pairs.items() if s >= 0.35], left)
    assert three.columns == table.columns and got <= left
    assert {i for i in left if loose[i] == i} <= got
    assert len([i for i in left if sure[i] != i and i in got]) <= 0.05 * max(1, len([i for i in left if sure[i] != i]))
    four = saved(corpus_pipeline.STAGES[3][1](spark, three, SF), "t")
    drawn = {r["doc_id"] for r in four.collect()}
    assert four.columns == table.columns and drawn <= got
    five = {r["doc_id"]: (r["ids"], r["decoded"]) for r in corpus_pipeline.STAGES[4][1](spark, four, SF).collect()}
    v = spm.encoder(PIECES).v
    assert five == {i: (v.encode(texts[i]), texts[i]) for i in drawn}
    assert {r["doc_id"]: (r["ids"], r["decoded"]) for r in corpus_pipeline.run(spark, SF).collect()} == five


def test_stages_take_nothing_and_nulls(spark):
    rows = [(1, None), (2, ""), (None, "x"), (3, "plain words"), (3, "plain words")]
    for df in (docs(spark, rows), docs(spark, rows).limit(0)):
        now = df
        for _, stage in corpus_pipeline.STAGES:
            now = saved(stage(spark, now, SF), "t")
        assert now.count() <= df.count()


