"""Quality classifier: ordinal cumulative-link regression over hashed text.

Graded ratings come from the labels: 0 for low quality, 1 for good but toxic, 2 for good and clean. One weight vector
over hashed features, shared by all grades, gives a score; ordered thresholds t1 < t2 turn it to P(grade >= k) =
sigmoid(score - tk). Features are relative frequencies in the whole text: hashed lower-case words without their outer
punctuation, hashed shapes of raw tokens (letters as a, digits as 0, other marks kept, runs shortened), and the share of
tokens that repeat the one before. Fitting uses at most ``max_labelled`` labelled documents, those of the least keyed hash
of doc_id; scoring reads every document.

Toxic words are few in a long text, so relative frequencies hardly show them. Marks are features whose presence tells toxic
from clean among good labelled documents, beyond chance; a document with a mark has its P(grade >= 2) lowered by the share
of toxic ones among such, and with ``reject_toxic`` it isn't kept if that falls under KEEP_TAIL.

Defined results: a null or empty text has no features, so its score is the bias alone; null grades are left out of the
fit, and of several grades for a document the least counts. With fewer than two grades to learn from, every document
gets that grade (or 0) and is kept. Repeated rows are scored alike. Extra columns don't matter. Empty tables give empty
results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import cache, claim, ship
from lakeloom.llm.spm import REMEMBERED, steps

BITS = 18
SIZE = 1 << BITS
REPEAT = SIZE  # the feature after the hashed ones
MAX_LABELLED = 8_000
#: A document is kept if its chance of a grade of at least KEEP_GRADE is KEEP_TAIL or more.
KEEP_GRADE, KEEP_TAIL = 1, 0.5
#: Marks: the chance of any by accident, at most, and the share of clean labelled documents that may have one.
MARK_CHANCE, CLEAN_LOST = 0.05, 0.01

_LETTER, _DIGIT, _RUN = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"([^a0])\1+")
_words: dict[str, int] = cache("quality", {})


def _feature(token: str) -> int:
    """The word's feature in the low bits and the shape's above them."""
    word = token.lower().strip(".,;:!?\"'()[]{}|-_*#$%&")
    shape = _RUN.sub(r"\1", _DIGIT.sub("0", _LETTER.sub("a", token)))
    return (xxhash.xxh32_intdigest("w" + word) & (SIZE - 1)) | (xxhash.xxh32_intdigest("s" + shape) & (SIZE - 1)) << BITS


def token_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all tokens, text after text: word feature, shape feature, whether it repeats the token before; tokens a text."""
    tokens: list[str] = []
    ends = []
    for t in texts:
        tokens += t.split()
        ends.append(len(tokens))
    if len(_words) > REMEMBERED:
        _words.clear()
    for w in set(tokens) - _words.keys():
        _words[w] = _feature(w)
    both = np.fromiter(map(_words.__getitem__, tokens), np.int64, len(tokens))
    n = np.diff(ends, prepend=0)
    starts = np.zeros(len(tokens) + 1, bool)
    starts[np.concatenate([[0], ends])] = True
    same = np.zeros(len(tokens), bool)
    same[1:] = both[1:] == both[:-1]
    return both & (SIZE - 1), both >> BITS, same & ~starts[:-1], n


def sums(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    ends = np.cumsum(n)
    return total[ends] - total[ends - n]


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray
    grades: int = 3
    marks: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    toxic: float = 0.0  # the share of toxic documents among those with marks

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.scored(*token_features(texts))

    def scored(self, w: np.ndarray, s: np.ndarray, same: np.ndarray, n: np.ndarray) -> np.ndarray:
        return sums(self.weights[w] + self.weights[s] + self.weights[REPEAT] * same, n) / np.maximum(n, 1)

    def judged(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tails with marks taken into account, and whether marks make a text toxic."""
        w, s, same, n = token_features(texts)
        p = self.tails(self.scored(w, s, same, n))
        if not len(self.marks):
            return p, np.zeros(len(texts), bool)
        flags = np.zeros(SIZE, bool)
        flags[self.marks] = True
        marked = np.zeros(len(texts), bool)
        marked[np.searchsorted(np.cumsum(n), np.flatnonzero(flags[w] | flags[s]), "right")] = True
        p[marked, 1:] *= 1 - self.toxic
        return p, marked & (p[:, 1] < KEEP_TAIL)

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1 on, a column each."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -40, 40)))


def fit(index: list[np.ndarray], value: list[np.ndarray], grade: np.ndarray, epochs: int = 60, rate: float = 0.5, l2: float = 1e-7, grades: int = 3) -> OrdinalModel:
    """Full-batch Adagrad on the cumulative-link likelihood; deterministic."""
    kinds = np.unique(grade)
    w = np.zeros(SIZE + 1)
    if len(kinds) < 2:
        top = int(kinds[0]) if len(kinds) else 0
        return OrdinalModel(w, np.where(np.arange(1, grades) <= top, -30.0, 30.0) if len(kinds) else np.full(grades - 1, -30.0), grades)
    y = (grade[:, None] >= np.arange(1, grades)).astype(float)
    share = np.clip(y.mean(0), 1e-3, 1 - 1e-3)
    t = -np.log(share / (1 - share))
    n = np.array([len(i) for i in index])
    rows, cols, x = np.repeat(np.arange(len(n)), n), np.concatenate(index), np.concatenate(value)
    live, cols = np.unique(cols, return_inverse=True)
    v, g2, t2 = np.zeros(len(live)), np.full(len(live), 1e-8), np.full(len(t), 1e-8)
    for _ in range(epochs):
        score = np.bincount(rows, x * v[cols], len(n))
        # the likelihood of a grade k is P(>= k) - P(>= k + 1); with ends 1 and 0
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - t, -40, 40)))
        full = np.concatenate([np.ones((len(n), 1)), p, np.zeros((len(n), 1))], 1)
        at = np.arange(len(n))
        hi, lo = full[at, grade], full[at, grade + 1]
        like = np.maximum(hi - lo, 1e-9)
        d_hi, d_lo = hi * (1 - hi), lo * (1 - lo)
        d = (d_hi - d_lo) / like  # by the score
        gv = np.bincount(cols, x * d[rows], len(live)) - l2 * len(n) * v
        gt = np.array([(-(d_hi / like)[grade == k].sum() + (d_lo / like)[grade == k - 1].sum()) for k in range(1, grades)])
        g2 += gv * gv
        t2 += gt * gt
        v += rate * 4 * gv / np.sqrt(g2)
        t = np.maximum.accumulate(t + rate * 0.2 * gt / np.sqrt(t2))
        t += np.arange(len(t)) * 1e-6
    w[live] = v
    return OrdinalModel(w, t, grades)


def find_marks(index: list[np.ndarray], grade: np.ndarray) -> tuple[np.ndarray, float]:
    """Features whose presence tells grade 1 from grade 2, and the share of grade 1 among documents with one of them."""
    some = [(i[i < SIZE], g == 1) for i, g in zip(index, grade.tolist(), strict=True) if g]
    base = float(np.mean([t for _, t in some])) if some else 0.0
    if not 0 < base < 1:
        return np.zeros(0, np.int64), 0.0
    every = np.bincount(np.concatenate([i for i, _ in some]), minlength=SIZE)
    toxic = np.bincount(np.concatenate([i for i, t in some if t]), minlength=SIZE)
    share = toxic / np.maximum(every, 1)
    # Chernoff's bound on the chance of such a share, over all features that could have it
    x = np.clip(share, 1e-12, 1 - 1e-12)
    bound = -every * (x * np.log(x / base) + (1 - x) * np.log((1 - x) / (1 - base)))
    got = np.flatnonzero((share > 0.5) & (share > base) & (bound <= np.log(MARK_CHANCE / max(1, int((every > 1).sum())))))
    clean = [i for i, t in some if not t]
    rows, cols = np.repeat(np.arange(len(clean)), [len(i) for i in clean]), np.concatenate(clean)
    near = np.isin(cols, got)
    rows, cols = rows[near], cols[near]
    flags, lost, marks = np.zeros(SIZE, bool), np.zeros(len(clean), bool), []
    for f in got[np.lexsort((got, -every[got], -share[got]))].tolist():  # the surest first, as long as clean documents stay
        more = lost.copy()
        more[rows[cols == f]] = True
        if more.mean() > CLEAN_LOST:
            break
        lost = more
        marks.append(f)
    got = np.array(marks, np.int64)
    flags[got] = True
    hit = [t for i, t in some if flags[i].any()]
    return got, (sum(hit) + 0.5) / (len(hit) + 1) if hit else 0.0


def sparse(texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Feature numbers and values of each text."""
    w, s, same, n = token_features(texts)
    index, value = [], []
    a = 0
    for k in n.tolist():
        z = a + k
        i, c = np.unique(np.concatenate([w[a:z], s[a:z]]), return_counts=True)
        index.append(np.append(i, REPEAT).astype(np.int64))
        value.append(np.append(c, same[a:z].sum()) / max(k, 1))
        a = z
    return index, value


def grade(quality: Column, toxic: Column) -> Column:
    return F.when(quality.isNull() | toxic.isNull(), None).when(quality <= 0, 0).otherwise(F.when(toxic > 0, 1).otherwise(2))


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> OrdinalModel:
    """Fits on the bounded sample; its features are made by the executors and only they go to the driver."""
    ship(docs.sparkSession)
    rated = labels.select(F.col("doc_id").alias("doc_id"), grade(F.col("quality"), F.col("toxic")).alias("grade")).dropna().groupBy("doc_id").agg(F.min("grade").alias("grade"))
    some = rated.orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id").limit(max_labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("quality")
        for part, texts in steps(batches, 1):
            i, v = sparse(texts)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(i, pa.list_(pa.int64())), pa.array(v, pa.list_(pa.float64()))], ["doc_id", "grade", "i", "v"])

    # the sample's size is bounded by max_labelled, so it is always fit to broadcast
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(some), "doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    got = rows.mapInArrow(run, f"doc_id {kind}, grade int, i array<bigint>, v array<double>").toArrow()
    order = np.lexsort((got["v"].combine_chunks().value_lengths().to_numpy(), got["doc_id"].to_numpy())) if got.num_rows else np.zeros(0, int)
    index, value = ([c[k].values.to_numpy() for k in order] for c in (got["i"].combine_chunks(), got["v"].combine_chunks()))
    graded = got["grade"].to_numpy()[order].astype(int) if got.num_rows else np.zeros(0, int)
    model = fit(index, value, graded)
    model.marks, model.toxic = find_marks(index, graded)
    return model


def score(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """Rows (doc_id, expected_grade, tail_1, tail_2, toxic) of all documents; narrow."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds, model.grades, model.marks, model.toxic))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("quality")
        m = OrdinalModel(*shared.value)
        for part, texts in steps(batches, 1):
            p, toxic = m.judged(texts)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p.sum(1)), pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array(toxic)], ["doc_id", "expected_grade", "tail_1", "tail_2", "toxic"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, expected_grade double, tail_1 double, tail_2 double, toxic boolean")


def quality(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, reject_toxic: bool = False) -> DataFrame:
    """Expected grade, tail probabilities and the decision ``keep`` for every document."""
    good = F.col(f"tail_{KEEP_GRADE}") >= KEEP_TAIL
    return score(docs, train(docs, labels, max_labelled)).withColumn("keep", good & ~F.col("toxic") if reject_toxic else good)


def select(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, reject_toxic: bool = False) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with the columns they came with; one pass, no join."""
    model = train(docs, labels, max_labelled)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.thresholds, model.grades, model.marks, model.toxic))
    at = [c.lower() for c in docs.columns].index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("quality")
        m = OrdinalModel(*shared.value)
        for part, texts in steps(batches, at):
            p, toxic = m.judged(texts)
            yield part.filter(pa.array((p[:, KEEP_GRADE - 1] >= KEEP_TAIL) & ~(toxic & reject_toxic)))

    return docs.mapInArrow(run, docs.schema)
