"""Token counts without tokens: a Viterbi search that carries only the best score and its number of pieces.

An Aho-Corasick automaton over the unigram vocabulary reads a text once and reports, at every position, all pieces that
end there, longest first. For each position the best score and the piece count that goes with it are kept; the rules for
ties and for characters outside the vocabulary are those of :mod:`lakeloom.llm.spm`: a later candidate wins only by a
strictly greater score, so the longest last piece wins among equals, and an uncovered character counts its UTF-8 bytes.

Defined results: a null text has a null count, an empty one 0. Texts are read whole, whatever their length. Repeated rows
get equal counts; extra columns don't matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import cache, claim, received, send, ship
from lakeloom.llm.spm import ChunkMemo, Grown, UnigramVocabulary, chunked, steps


class PieceCounter:
    def __init__(self, v: UnigramVocabulary) -> None:
        self.v = v
        self.automaton = ahocorasick.Automaton()
        for i in v.lattice:
            self.automaton.add_word(v.pieces[i], (len(v.pieces[i]), float(v.scores[i])))
        self.automaton.make_automaton()
        self.single = {v.pieces[i] for i in v.lattice if len(v.pieces[i]) == 1}
        self.n = Grown(np.int32)
        self.memo = ChunkMemo(lambda chunks: self.n.add(np.array([self.of_chunk(c) for c in chunks], np.int32)), self.n.clear)

    def of_chunk(self, chunk: str) -> int:
        size, single, unknown = len(chunk), self.single, self.v.unknown_score
        best, count = [0.0] + [float("-inf")] * size, [0] * (size + 1)
        at = 0  # ends before this one are settled
        for end, (k, score) in self.automaton.iter(chunk):
            end += 1
            while at < end:  # no more pieces end at ``at``: an uncovered character may still be the better way to it
                if at and chunk[at - 1] not in single:
                    self._bytes(chunk, at, best, count, unknown)
                at += 1
            s = best[end - k] + score
            if s > best[end]:
                best[end], count[end] = s, count[end - k] + 1
        for at in range(max(at, 1), size + 1):
            if chunk[at - 1] not in single:
                self._bytes(chunk, at, best, count, unknown)
        return count[size]

    def _bytes(self, chunk: str, at: int, best: list[float], count: list[int], unknown: float) -> None:
        s = best[at - 1] + unknown
        if s > best[at]:
            best[at], count[at] = s, count[at - 1] + len(chunk[at - 1].encode())

    def counts(self, texts: list[str]) -> np.ndarray:
        if not self.v.byte_fallback:
            raise ValueError("counting needs a vocabulary with byte fallback")
        if not self.v.splits:
            return np.array([self.of_chunk(self.v.normalised(t)) for t in texts], np.int64)
        keys: list[str] = []
        ends = []
        for t in texts:
            keys += chunked(t)
            ends.append(len(keys))
        at = self.memo.of(keys)  # may grow the counts that are read next
        total = np.concatenate([[0], np.cumsum(self.n.data[at], dtype=np.int64)])
        return np.diff(total[ends], prepend=0)


_counters: dict[str, PieceCounter] = cache("tokencount", {})


def counter(path: str) -> PieceCounter:
    if path not in _counters:
        _counters[path] = PieceCounter(UnigramVocabulary.load(path))
    return _counters[path]


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens) of every row; narrow."""
    ship(docs.sparkSession)
    send(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("tokencount")
        c = counter(received(model_path))
        for part, texts in steps(batches, 1):
            null = part.column(1).is_null().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(c.counts(texts), pa.int64(), mask=null)], ["doc_id", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n_tokens bigint")
