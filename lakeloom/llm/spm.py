"""SentencePiece encoding and decoding with a unigram lattice.

The vocabulary file gives pieces with log scores, and whether a text gets a marker before it; a file that asks for texts to be
normalised otherwise is refused. Encoding is a Viterbi search over a double-array trie of the
pieces' UTF-8 bytes: the best-scoring segmentation wins; among equal scores the one whose last piece is longest, at
every position. A character that no piece of length one covers costs the least score minus 10 and becomes its bytes.
Decoding joins pieces, turns the marker U+2581 to spaces, byte pieces to UTF-8, and drops the one leading space.

Defined results: a null text gives null ids, null decoded text and null counts; an empty text gives no ids and an
empty decoded text. Texts of any length are taken whole. Repeated rows are encoded alike. Extra columns are left out
of the result; null ids of documents stay null. An empty table gives an empty result. A literal U+2581 decodes as a
space, as in the public library.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import cache, claim, received, send, ship

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
#: Bytes of text that one step of the worker holds, and distinct chunks that it remembers: they bound memory, not results.
STEP_BYTES, REMEMBERED = 2_000_000, 150_000
WIDE = 64


class DoubleArray:
    """A trie of byte strings in two arrays: child c of state s is base[s] + c, if check there is s."""

    def __init__(self, keys: list[bytes], values: list[int]) -> None:
        order = sorted(range(len(keys)), key=lambda i: keys[i])
        keys, values = [keys[i] for i in order], [values[i] for i in order]
        base, check, value = [0] * 4096, [-1] * 4096, [-1] * 4096
        check[0] = 0
        hole, front = 257, 257  # single children fill holes; siblings are tried from front on
        todo = [(0, 0, len(keys), 0)]
        while todo:
            state, a, b, depth = todo.pop()
            if a < b and len(keys[a]) == depth:
                value[state] = values[a]
                a += 1
            children: list[tuple[int, int, int]] = []
            while a < b:
                c, z = keys[a][depth], a + 1
                while z < b and keys[z][depth] == c:
                    z += 1
                children.append((c, a, z))
                a = z
            if not children:
                continue
            codes = [c for c, _, _ in children]
            if max(hole, front) + 1024 > len(check):
                more = len(check)
                base += [0] * more
                check += [-1] * more
                value += [-1] * more
            if len(codes) == 1:
                while check[hole] >= 0:
                    hole += 1
                at = hole - codes[0]
            else:
                at = front
                while any(check[at + c] >= 0 for c in codes):
                    at += 1
                    if at + 512 > len(check):
                        more = len(check)
                        base += [0] * more
                        check += [-1] * more
                        value += [-1] * more
                front = max(front, at - 32)
            base[state] = at
            for c in codes:
                check[at + c] = state
            todo.extend((at + c, x, y, depth + 1) for c, x, y in children)
        used = max(i for i, c in enumerate(check) if c >= 0) + 1
        pad = used + 512
        fit = lambda x, f: np.array((x + [f] * 512)[:pad], np.int32)
        self.base, self.check, self.value = fit(base, 0), fit(check, -1), fit(value, -1)
        self.check[0] = -1  # nothing leads to the root

    def prefixes(self, data: bytes, start: int) -> Iterator[tuple[int, int]]:
        """(end, value) of each key that begins at ``start``, the shortest first."""
        base, check, value, s = self.base, self.check, self.value, 0
        for k in range(start, len(data)):
            t = int(base[s]) + data[k]
            if check[t] != s or not base[s]:
                return
            s = t
            if value[s] >= 0:
                yield k + 1, int(value[s])


class UnigramVocabulary:
    """Pieces, scores and kinds of a vocabulary file, its trie, and encoding and decoding with them."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[int], dummy_prefix: bool = True) -> None:
        self.pieces, self.kinds, self.dummy_prefix = pieces, kinds, dummy_prefix
        self.scores = np.array(scores, np.float64)
        inner = [i for i, k in enumerate(kinds) if k in (NORMAL, USER)]
        if any(kinds[i] == USER for i in inner):
            raise ValueError("user-defined pieces are not supported")
        self.lattice = inner
        self.trie = DoubleArray([pieces[i].encode() for i in inner], inner)
        self.unknown_score = float(self.scores[inner].min()) - UNKNOWN_PENALTY if inner else -UNKNOWN_PENALTY
        self.unknown = kinds.index(UNKNOWN)
        self.byte_ids = np.full(256, -1, np.int32)
        for i, k in enumerate(kinds):
            if k == BYTE:
                self.byte_ids[int(pieces[i][3:5], 16)] = i
        self.byte_fallback = bool((self.byte_ids >= 0).all())
        #: Chunks can be encoded alone if no piece goes over their ends.
        self.splits = all("\n" not in pieces[i] and not re.search(f"[^{MARK}]{MARK}", pieces[i]) for i in inner) and dummy_prefix and self.byte_fallback
        spelled = []
        for p, k in zip(pieces, kinds, strict=True):
            spelled.append(bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN else p.replace(MARK, " ").encode())
        self.spelled_len = np.array([len(s) for s in spelled], np.int64)
        self.spelled_at = np.concatenate([[0], np.cumsum(self.spelled_len)[:-1]])
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)

    @classmethod
    def load(cls, path: str) -> UnigramVocabulary:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = sentencepiece_model_pb2.ModelProto.FromString(sp.serialized_model_proto())
        normal = spec.normalizer_spec
        if normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.escape_whitespaces or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError(f"{path} normalises texts; only vocabularies of texts as they are can be used")
        kinds = []
        for i in range(sp.get_piece_size()):
            kinds.append(UNKNOWN if sp.is_unknown(i) else CONTROL if sp.is_control(i) else UNUSED if sp.is_unused(i) else BYTE if sp.is_byte(i) else NORMAL)
        n = len(kinds)
        return cls([sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)], kinds, normal.add_dummy_prefix)

    def normalised(self, text: str) -> str:
        return (MARK if self.dummy_prefix and text else "") + text.replace(" ", MARK)

    # one string, by the plain recurrence
    def viterbi(self, chunk: str) -> list[int]:
        data = chunk.encode()
        n, scores, prefixes = len(data), self.scores, self.trie.prefixes
        best, back, ids = [-np.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        p = 0
        while p < n:
            b = data[p]
            width = 1 if b < 0x80 else 2 if b < 0xE0 else 3 if b < 0xF0 else 4
            here, single = best[p], False
            for end, i in prefixes(data, p):
                s = here + scores[i]
                if s > best[end]:
                    best[end], back[end], ids[end] = s, p, i
                single |= end == p + width
            if not single and here + self.unknown_score > best[p + width]:
                best[p + width], back[p + width], ids[p + width] = here + self.unknown_score, p, self.unknown
            p += width
        out: list[int] = []
        while n > 0:
            if ids[n] != self.unknown:
                out.append(ids[n])
            elif self.byte_fallback:
                out.extend(int(self.byte_ids[b]) for b in reversed(data[back[n] : n]))
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
            n = back[n]
        return out[::-1]

    # many short strings at once: the same recurrence, one position of all of them at a time
    def viterbi_many(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, chunk after chunk, and how many each chunk has."""
        data = [c.encode() for c in chunks]
        size = np.array([len(d) for d in data], np.int64)
        counts, parts = np.zeros(len(data), np.int64), {}
        low = 0
        for high in (8, 12, 16, 24, 40, WIDE):
            rows = np.flatnonzero((size > low) & (size <= high))
            low = high
            for k in range(0, len(rows), 20_000):
                some = rows[k : k + 20_000]
                ids, n = self._block([data[i] for i in some], size[some], high)
                counts[some] = n
                parts.update(zip(some.tolist(), np.split(ids, np.cumsum(n)[:-1]), strict=True))
        for i in np.flatnonzero(size > WIDE).tolist():
            ids = np.array(self.viterbi(chunks[i]), np.int32)
            counts[i], parts[i] = len(ids), ids
        flat = [parts[i] for i in range(len(data)) if i in parts]
        return (np.concatenate(flat) if flat else np.zeros(0, np.int32)), counts

    def _block(self, data: list[bytes], size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        text = np.zeros((n, width), np.int32)
        inside = np.arange(width) < size[:, None]
        text[inside] = np.frombuffer(b"".join(data), np.uint8)
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        best = np.full((n, width + 5), -np.inf)
        back, ids = np.zeros((n, width + 5), np.int16), np.full((n, width + 5), -1, np.int32)
        best[:, 0] = 0.0
        for p in range(width):
            lead = text[:, p]
            rows = np.flatnonzero((size > p) & ((lead & 0xC0) != 0x80))
            if not len(rows):
                continue
            lead = lead[rows]
            chars = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
            single = np.zeros(n, bool)
            here = best[rows, p]
            r, h, w, s = rows, here, chars, np.zeros(len(rows), np.int32)
            for k in range(p, width):
                t = base[s] + text[r, k]
                ok = (check[t] == s) & (size[r] > k) & (base[s] > 0)
                r, h, w, s = r[ok], h[ok], w[ok], t[ok]
                if not len(r):
                    break
                v = value[s]
                hit = v >= 0
                if hit.any():
                    rr, vv = r[hit], v[hit]
                    c = h[hit] + scores[vv]
                    up = c > best[rr, k + 1]
                    ru = rr[up]
                    best[ru, k + 1], back[ru, k + 1], ids[ru, k + 1] = c[up], p, vv[up]
                    single[rr[w[hit] == k + 1 - p]] = True
            lost = ~single[rows]
            if lost.any():
                r, w, c = rows[lost], chars[lost], here[lost] + self.unknown_score
                up = c > best[r, p + w]
                r, w, c = r[up], w[up], c[up]
                best[r, p + w] = c
                for j in range(4):  # a step for each byte; no piece ends inside a character
                    on = w > j
                    if not on.any():
                        break
                    back[r[on], p + j + 1] = p + j
                    ids[r[on], p + j + 1] = self.byte_ids[text[r[on], p + j]]
        steps, at, live = [], size.copy(), np.arange(n)
        while len(live):
            a = at[live]
            steps.append((live, ids[live, a]))
            at[live] = back[live, a]
            live = live[at[live] > 0]
        counts = np.zeros(n, np.int64)
        for r, _ in steps:
            counts[r] += 1
        end = np.cumsum(counts)
        out = np.zeros(int(end[-1]), np.int32)
        for j, (r, i) in enumerate(steps):
            out[end[r] - 1 - j] = i
        return out, counts

    def encode(self, text: str) -> list[int]:
        return self.viterbi(self.normalised(text))

    def decode_flat(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of id lists that lie one after the other."""
        n = self.spelled_len[ids]
        total = np.concatenate([[0], np.cumsum(n)])
        at = np.repeat(self.spelled_at[ids] - total[:-1], n) + np.arange(total[-1])
        data = self.spelled[at].tobytes()
        ends = total[np.cumsum(counts)].tolist()
        out, a = [], 0
        for z in ends:
            s = data[a:z].decode("utf-8", "replace")
            out.append(s[1:] if self.dummy_prefix and s.startswith(" ") else s)
            a = z
        return out

    def decode(self, ids: list[int]) -> str:
        return self.decode_flat(np.array(ids, np.int64), np.array([len(ids)]))[0]


_ODD = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+")


def chunked(text: str) -> list[str]:
    """Chunks that no piece goes over, as keys. A key stands for the marker and itself, unless it begins with a line
    break (no marker) or with NUL (the rest is the chunk as it is)."""
    keys = text.replace("\n", " \n").split(" ")
    if MARK not in text and "\0" not in text and "" not in keys[1:] and keys[0][:1] not in ("", "\n"):
        return keys
    return ["\0" + c for c in _ODD.findall(MARK + text.replace(" ", MARK))] if text else []


def chunk_of(key: str) -> str:
    return key[1:] if key[0] == "\0" else key if key[0] == "\n" else MARK + key


class ChunkMemo:
    """Index of each chunk seen so far; ``make`` is called with the chunks that are new."""

    def __init__(self, make: Callable[[list[str]], None], reset: Callable[[], None]) -> None:
        self.index: dict[str, int] = {}
        self.make, self.reset = make, reset

    def of(self, keys: list[str]) -> np.ndarray:
        new = set(keys) - self.index.keys()
        if len(self.index) + len(new) > REMEMBERED and self.index:
            self.index.clear()
            self.reset()
            new = set(keys)
        if new:
            news = list(new)
            self.make([chunk_of(k) for k in news])
            start = len(self.index)
            self.index.update(zip(news, range(start, start + len(news)), strict=True))
        return np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))


class Grown:
    """Arrays appended to one another, read as one."""

    def __init__(self, dtype: type) -> None:
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.data, self.n = np.zeros(1 << 16, self.dtype), 0

    def add(self, x: np.ndarray) -> None:
        if self.n + len(x) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(len(self.data), len(x)), self.dtype)])
        self.data[self.n : self.n + len(x)] = x
        self.n += len(x)


class Encoder:
    """Encodes many texts at once and remembers the chunks it met."""

    def __init__(self, vocabulary: UnigramVocabulary) -> None:
        self.v = vocabulary
        self.ids, self.at, self.n = Grown(np.int32), Grown(np.int64), Grown(np.int64)
        self.memo = ChunkMemo(self._make, lambda: [x.clear() for x in (self.ids, self.at, self.n)])

    def _make(self, chunks: list[str]) -> None:
        ids, n = self.v.viterbi_many(chunks)
        self.at.add(self.ids.n + np.cumsum(n) - n)
        self.n.add(n)
        self.ids.add(ids)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text, and how many each text has."""
        if not self.v.splits:
            each = [self.v.encode(t) for t in texts]
            return np.array([i for e in each for i in e], np.int32), np.array([len(e) for e in each], np.int64)
        keys: list[str] = []
        ends = []
        for t in texts:
            keys += chunked(t)
            ends.append(len(keys))
        k = self.memo.of(keys)
        n = self.n.data[k]
        total = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids.data[np.repeat(self.at.data[k] - total[:-1], n) + np.arange(total[-1])]
        return ids, np.diff(total[ends], prepend=0)


_encoders: dict[str, Encoder] = cache("spm", {})


def encoder(path: str) -> Encoder:
    """The worker's encoder for the vocabulary file at ``path``, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(UnigramVocabulary.load(path))
    return _encoders[path]


def steps(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches of about STEP_BYTES of text, with their texts; null texts as empty ones."""
    for b in batches:
        if not b.num_rows:
            continue
        sizes = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(b.column(text)), 0).to_numpy())
        a = 0
        while a < b.num_rows:
            z = max(a + 1, int(np.searchsorted(sizes, (sizes[a - 1] if a else 0) + STEP_BYTES, "right")))
            part = b.slice(a, z - a)
            yield part, [t or "" for t in part.column(text).to_pylist()]
            a = z


def sentencepiece(docs: DataFrame, model_path: str) -> DataFrame:
    """Rows (doc_id, n_tokens, ids, decoded), one for each row of ``docs``; narrow, without a shuffle."""
    ship(docs.sparkSession)
    send(docs.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("spm")
        e = encoder(received(model_path))
        for part, texts in steps(batches, 1):
            ids, n = e.encode(texts)
            decoded = e.v.decode_flat(ids, n)
            null = part.column(1).is_null().to_numpy(zero_copy_only=False)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(ids, pa.int32()), mask=pa.array(null))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64(), mask=null), lists, pa.array(decoded, pa.string(), mask=null)], ["doc_id", "n_tokens", "ids", "decoded"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids array<int>, decoded string")
