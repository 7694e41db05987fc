"""Secret scan: candidates from text, false positives removed by a random forest.

A candidate is a run of 16 or more characters of [A-Za-z0-9+/_-] (dotted parts of 10 or more and = at its end included) that
has a digit or a known prefix; or the whole value, of 8 characters or more of any kind, that is assigned to a name such as token
or password, or follows the word bearer, up to its quote or to white space; or the password of a URL. An assigned value with spaces in it gives way to a run
inside it. Features: length, shares of digits, upper case, hex digits, separators, other marks and spaces, entropy, character
transitions (how often the class of character changes, and how likely its letter pairs are in words), dictionary coverage
(share of letters inside vocabulary words of four or more), the path of the document, and the neighbouring words, which are
those in the NEAR characters on either side. The forest is trained here on labelled findings; :func:`labelled_findings`
makes them with a seed, and a table of (path, text, start, length, label) of reviewed findings can be given instead.

Defined results: null and empty texts have no candidates; a null source is an empty path. Each occurrence of a repeated
secret is a finding; repeated rows give repeated findings. Texts and candidates are read whole. Extra columns don't
matter. An empty table gives an empty result. With labels of one class only, every candidate gets that class.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import ship
from lakeloom.llm.spm import steps

TREES, DEPTH, LEAF, SEED, FINDINGS, CUT = 40, 9, 4, 5, 3000, 0.5
NEAR = 64  # characters on either side of a candidate in which words are looked for

_RUN = re.compile(r"[A-Za-z0-9+/_\-]{16,}(?:\.[A-Za-z0-9+/_\-]{10,})*={0,2}")
_NAME = r"(?:pass(?:word|wd|phrase)?|pwd|token|secret|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth)"
_ASSIGNED = re.compile(rf"(?i){_NAME}[\"']?\s*(?::=|=>|=|:)\s*(?:\"([^\"\n]{{8,}})\"|'([^'\n]{{8,}})'|`([^`\n]{{8,}})`|([^\s\"'`]{{8,}}))")
_IN_URL = re.compile(r"(?i)[a-z][a-z0-9+.\-]*://[^\s/:@\"'<>]*:([^\s/@\"'<>]{4,})@")
_BEARER = re.compile(r"(?i)\bbearer\s+([^\s\"'`]{8,})")
_ENDS = ".,;:)]}>"  # not of a value without quotes
_GOOD = re.compile(r"(?i)token|secret|passw|passphrase|api.?key|access.?key|private.?key|auth|bearer|credential")
_BAD = re.compile(r"(?i)sha\d*|md5|hash|digest|checksum|commit|revision|uuid|guid|etag|integrity|fingerprint|example|sample|dummy|placeholder|test")
_NUMBER = re.compile(r"(?i)card|phone|tel|account|iban|order|invoice|isbn|serial")
_PATH_TEST, _PATH_DOC, _PATH_CONF = re.compile(r"(?i)test|spec|fixture|mock|example|sample"), re.compile(r"(?i)readme|docs?/|\.md$|\.rst$|lock"), re.compile(r"(?i)\.env|conf|\.ini|\.ya?ml|secret|\.properties|credential")
NAMES = ("length", "digits", "upper", "hex", "entropy", "changes", "pairs", "dictionary", "longest_letters", "separators", "marks", "spaces", "same", "assigned", "quoted", "good_word", "bad_word", "number_word", "good_after", "bad_after", "path_test", "path_doc", "path_conf", "prefix")
_PREFIX = re.compile(r"^(?:AKIA|ASIA|ghp_|gho_|github_pat_|sk-|sk_live|pk_live|xox[abp]-|AIza|glpat-|eyJ)")
_COMMON = "the and ing ion ent tion her for that this with from have not are was all one out you can time your which will their there about would these other into than only some could been its over new like code user name data file value string list type true false null path key test class function return public const import".split()


def words_of(model_path: str) -> set[str]:
    """Dictionary words: the letters-only pieces of a public vocabulary that have four letters or more."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    got = (sp.id_to_piece(i).lstrip("▁").lower() for i in range(sp.get_piece_size()))
    return {w for w in got if len(w) >= 4 and w.isalpha()} | {w for w in _COMMON if len(w) >= 4}


class Features:
    def __init__(self, dictionary: set[str]) -> None:
        self.words = dictionary
        self.longest = max(map(len, dictionary), default=0)
        pairs = np.ones((26, 26))
        for w in sorted(dictionary):
            for a, b in zip(w, w[1:]):
                if "a" <= a <= "z" and "a" <= b <= "z":
                    pairs[ord(a) - 97, ord(b) - 97] += 1
        self.pairs = np.log(pairs / pairs.sum(1, keepdims=True) * 26)

    def covered(self, low: str) -> int:
        """Letters inside dictionary words, taken greedily from the left, the longest first."""
        n = 0
        for part in re.findall(r"[a-z]{4,}", low):
            i = 0
            while i < len(part) - 3:
                for k in range(min(self.longest, len(part) - i), 3, -1):
                    if part[i : i + k] in self.words:
                        n += k
                        i += k - 1
                        break
                i += 1
        return n

    def row(self, path: str, text: str, start: int, length: int) -> list[float]:
        c = text[start : start + length]
        a = np.frombuffer(c.encode("utf-8", "replace"), np.uint8)
        digit, upper, lower = (a >= 48) & (a <= 57), (a >= 65) & (a <= 90), (a >= 97) & (a <= 122)
        kind = digit * 1 + upper * 2 + lower * 3
        letters = np.where(upper, a + 32, a)
        hexa = digit | ((letters >= 97) & (letters <= 102))
        share = np.bincount(a, minlength=256)
        share = share[share > 0] / len(a)
        inner = (letters[:-1] >= 97) & (letters[:-1] <= 122) & (letters[1:] >= 97) & (letters[1:] <= 122)
        likely = self.pairs[letters[:-1][inner].astype(int) - 97, letters[1:][inner].astype(int) - 97]
        before, behind = text[max(0, start - NEAR) : start], text[start + length : start + length + NEAR]
        after = behind[:1]
        tight = before.rstrip(" \t\"'`")
        letters_only = re.findall(r"[A-Za-z]+", c)
        return [
            float(np.log(len(a))), float(digit.mean()), float(upper.mean()), float(hexa.mean()), float(-(share * np.log2(share)).sum()),
            float((kind[1:] != kind[:-1]).mean()) if len(a) > 1 else 0.0, float(likely.mean()) if len(likely) else -3.0, self.covered(c.lower()) / len(a),
            max(map(len, letters_only), default=0) / len(a), float(np.isin(a, list(b"-_/+=")).mean()), float(np.isin(a, list(b"!@#$%^&*()[]{}<>?~.,:;|\\\"'`")).mean()), float((a == 32).mean()), float((a[1:] == a[:-1]).mean()) if len(a) > 1 else 0.0,
            float(tight.endswith(("=", ":", ">"))), float(before[-1:] in "\"'`" and after in "\"'`" and bool(after)),
            float(bool(_GOOD.search(before))), float(bool(_BAD.search(before))), float(bool(_NUMBER.search(before))),
            float(bool(_GOOD.search(behind))), float(bool(_BAD.search(behind))),
            float(bool(_PATH_TEST.search(path))), float(bool(_PATH_DOC.search(path))), float(bool(_PATH_CONF.search(path))), float(bool(_PREFIX.match(c))),
        ]


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, length), in order; none overlaps another."""
    runs = [m.span() for m in _RUN.finditer(text) if _PREFIX.match(m.group()) or re.search(r"\d", m.group())]
    values = [m.span(1) for m in _IN_URL.finditer(text)]
    for m in (*_ASSIGNED.finditer(text), *_BEARER.finditer(text)):
        a, z = m.span(m.lastindex)
        if m.re is _BEARER or m.lastindex == 4:
            z = a + len(m[m.lastindex].rstrip(_ENDS))
        if z - a >= 8:
            values.append((a, z))
    whole: list[tuple[int, int]] = []
    for a, z in sorted(values):
        inside = any(a <= x and y <= z for x, y in runs) and (" " in text[a:z] or "\t" in text[a:z])
        if not inside and (not whole or a >= whole[-1][1]):
            whole.append((a, z))
    out: list[tuple[int, int]] = []
    ends = 0
    for a, z in sorted(whole + [r for r in runs if not any(a < r[1] and r[0] < z for a, z in whole)]):
        if a >= ends:
            out.append((a, z - a))
            ends = z
    return out


@dataclass
class Forest:
    """Trees in flat arrays; a leaf has feature -1."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for root in self.roots.tolist():
            at = np.full(len(x), root)
            while True:
                f = self.feature[at]
                live = f >= 0
                if not live.any():
                    break
                rows = np.flatnonzero(live)
                n = at[rows]
                at[rows] = np.where(x[rows, f[rows]] <= self.cut[n], self.low[n], self.high[n])
            total += self.share[at]
        return total / max(len(self.roots), 1)


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, leaf: int = LEAF, seed: int = SEED) -> Forest:
    """Bagged trees with a random subset of features at every split, by Gini."""
    feature, cut, low, high, share, roots = [], [], [], [], [], []
    rng = np.random.default_rng(seed)
    tries = max(1, round(np.sqrt(x.shape[1])) + 1)

    def node(rows: np.ndarray, d: int) -> int:
        me = len(feature)
        p = float(y[rows].mean()) if len(rows) else 0.0
        for a, v in ((feature, -1), (cut, 0.0), (low, -1), (high, -1), (share, p)):
            a.append(v)
        if d >= depth or len(rows) < 2 * leaf or p in (0.0, 1.0):
            return me
        best = (1e-9, -1, 0.0)
        for f in rng.choice(x.shape[1], tries, replace=False).tolist():
            order = np.argsort(x[rows, f], kind="stable")
            v, t = x[rows[order], f], y[rows[order]]
            n, left = len(rows), np.cumsum(t)[:-1]
            k = np.arange(1, n)
            ok = (v[1:] > v[:-1]) & (k >= leaf) & (n - k >= leaf)
            if not ok.any():
                continue
            right = t.sum() - left
            gain = p * (1 - p) * n - (left * (1 - left / k) + right * (1 - right / (n - k)))
            gain[~ok] = -1
            j = int(gain.argmax())
            if gain[j] > best[0]:
                best = (float(gain[j]), f, float((v[j] + v[j + 1]) / 2))
        if best[1] < 0:
            return me
        side = x[rows, best[1]] <= best[2]
        feature[me], cut[me] = best[1], best[2]
        low[me] = node(rows[side], d + 1)
        high[me] = node(rows[~side], d + 1)
        return me

    for _ in range(trees):
        roots.append(node(rng.integers(0, len(x), len(x)), 0))
    return Forest(*(np.array(a) for a in (roots, feature, cut, low, high, share)))


def labelled_findings(n: int = FINDINGS, seed: int = SEED) -> list[tuple[str, str, int, int, int]]:
    """(path, text, start, length, label): reviewed findings of the kinds that scanners report, true and false."""
    r = np.random.default_rng(seed)
    pick = lambda xs: xs[int(r.integers(len(xs)))]
    hexa = lambda k: r.bytes((k + 1) // 2).hex()[:k]
    b64 = lambda k: base64.b64encode(r.bytes(k)).decode()[:k]
    alnum = lambda k: "".join(r.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"), k))
    syllables = "the re an in er ti on es at ed nd ha en ou th sh le ver ein ich ung ment eau que cion ado sch bar mos".split()
    word = lambda k: "".join(r.choice(syllables, k))
    prose = lambda: " ".join(word(int(r.integers(1, 4))) for _ in range(int(r.integers(2, 9))))
    paths = ["", "forum", "crawl", "wiki", "app/settings.py", "config/prod.yml", ".env", "src/main.go", "tests/test_auth.py", "README.md", "docs/guide.md", "package-lock.json"]
    key = ["token", "secret", "api_key", "apiKey", "password", "access_key", "auth_token", "client_secret", "AWS_SECRET_ACCESS_KEY", "credential"]
    out = []
    for i in range(n):
        good = i % 2 == 0
        path = pick(paths)
        if good:
            plain = [lambda: hexa(int(r.integers(12, 65))), lambda: hexa(40), lambda: hexa(32), lambda: hexa(64), lambda: b64(40), lambda: alnum(int(r.integers(12, 44)))]
            marked = [lambda: "AKIA" + alnum(16).upper(), lambda: "ghp_" + alnum(36), lambda: "sk-" + alnum(48), lambda: "xoxb-" + alnum(40), lambda: "glpat-" + alnum(20)]
            # chosen by people: any character that can be typed
            marks = "!@#$%^&*?~+=_-."
            typed = [
                lambda: "".join(r.choice(list("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz23456789" + marks), int(r.integers(6, 24)))) + pick(marks) + str(int(r.integers(10))),
                lambda: word(2).capitalize().replace("o", "0").replace("e", "3") + pick(marks) + str(int(r.integers(1, 9999))) + alnum(3) + pick(marks),
                lambda: ".".join(alnum(int(r.integers(3, 7))) for _ in range(3)) + "-" + str(int(r.integers(100, 999))),
            ]
            known = r.random() < 0.35  # a known prefix is a secret wherever it stands
            by_hand = not known and r.random() < 0.35
            c = pick(marked if known else typed if by_hand else plain)()
            before = pick([f"{pick(key)} = \"", f"{pick(key)}: ", f"{pick(key)}='", f"{pick(key)}=", f"export {pick(key)}=", "Authorization: Bearer ", f"\"{pick(key)}\": \""])
            if by_hand and r.random() < 0.3:
                before, c = f"{pick(['postgres', 'https', 'amqp', 'mongodb+srv'])}://{word(2)}:", "".join(x for x in c if x not in "@<>")
            elif by_hand:
                before = pick([x for x in (f"{pick(key)} = \"", f"{pick(key)}='", f"{pick(key)}: \"", f"{pick(key)}=", f"{pick(key)}: ") if x[-1] in "\"'" or c[-1] not in _ENDS])
            if known and r.random() < 0.5:
                before = pick(["", "key ", "see ", "id ", "("])
            if path.startswith(("tests", "README", "docs", "package")) and r.random() < 0.7:
                path = "crawl"
            c = c.upper() if not known and not by_hand and r.random() < 0.05 else c
            before = before.upper() if "://" not in before and r.random() < 0.05 else before
        else:
            c = pick([
                lambda: hexa(40), lambda: hexa(64), lambda: hexa(32), lambda: "".join(map(str, r.integers(0, 10, 16))), lambda: "".join(map(str, r.integers(0, 10, int(r.integers(16, 24))))),
                lambda: word(int(r.integers(6, 12))) + str(int(r.integers(0, 99))), lambda: "-".join(word(2) for _ in range(4)) + f"-{int(r.integers(1, 2030))}", lambda: "/".join(word(2) for _ in range(5)) + f"/{int(r.integers(9))}",
                lambda: "x" * int(r.integers(16, 40)) + "1", lambda: f"{hexa(8)}-{hexa(4)}-{hexa(4)}-{hexa(4)}-{hexa(12)}", lambda: f"2024-{int(r.integers(10, 13))}-{int(r.integers(10, 29))}T{int(r.integers(10, 24))}-00-00", lambda: "=" * 20 + "1", lambda: "your_api_key_here_123",
                lambda: prose() + " " + word(3), lambda: pick(["${", "{{", "$(", "<", "process.env.", "os.environ.", "config.get."]) + pick(key).upper(), lambda: word(int(r.integers(4, 7))), lambda: "-".join(word(2) for _ in range(3)), lambda: "*" * int(r.integers(8, 16)),
            ])()
            random = re.fullmatch(r"[0-9a-f]{32,}", c) and not c.isdigit()
            before = pick([f"commit ", f"sha256:", f"md5 = \"", f"integrity: ", f"etag: \"", f"checksum="]) if random else pick([f"{pick(key)}: \"", f"{pick(key)} = \"", f"{pick(key)}='", f"{pick(key)}: "]) if not re.search(r"\d", c) and "xxx" not in c else pick(["", f"card ", f"order: ", f"{prose()} ", "https://example.com/", "id=", f"{pick(key)} = \"" if "your" in c or "xxx" in c else "see ", "serial "])
        text = f"{prose()} {before}"
        start = len(text)
        text += c + ("\"" if before.endswith("\"") else "'" if before.endswith("'") else f"@{word(2)}.example/{word(1)}" if "://" in before and good else "") + " " + prose()
        # a true finding is what was written, whether the scanner would report it or not; false ones are those it reports beside
        out += [(path, text, start, len(c), 1)] * good
        out += [(path, text, a, k, 0) for a, k in candidates(text) if not good or a >= start + len(c) or a + k <= start]
    return out


def train(dictionary: set[str], findings: list[tuple[str, str, int, int, int]] | None = None) -> Forest:
    f = Features(dictionary)
    findings = labelled_findings() if findings is None else findings
    x = np.array([f.row(p or "", t or "", a, n) for p, t, a, n, _ in findings if n]).reshape(-1, len(NAMES))
    y = np.array([label for *_, n, label in findings if n], float)
    return grow(x, y) if len(y) else Forest(np.array([0]), np.array([-1]), np.array([0.0]), np.array([-1]), np.array([-1]), np.array([0.0]))


def scan(docs: DataFrame, dictionary: set[str], findings: list[tuple[str, str, int, int, int]] | None = None, keep_all: bool = False) -> DataFrame:
    """(doc_id, start, length, digest, score) of every finding that the forest holds true (or of all candidates).

    ``start`` counts characters. The secret itself isn't repeated: its SHA-256 is given.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((dictionary, train(dictionary, findings)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    least = -1.0 if keep_all else CUT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, forest = shared.value
        f = Features(words)
        for part, texts in steps(batches, 1):
            paths = part.column(2).to_pylist()
            at, x, where, sums = [], [], [], []
            for i, t in enumerate(texts):
                for a, n in candidates(t):
                    at.append(i)
                    where.append((a, n))
                    x.append(f.row(paths[i] or "", t, a, n))
                    sums.append(hashlib.sha256(t[a : a + n].encode()).hexdigest())
            if not at:
                continue
            p = forest.predict(np.array(x))
            ok = p >= least
            w = np.array(where)[ok]
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(np.array(at)[ok])), pa.array(w[:, 0], pa.int64()), pa.array(w[:, 1], pa.int64()), pa.array(np.array(sums)[ok].tolist(), pa.string()), pa.array(p[ok])],
                ["doc_id", "start", "length", "digest", "score"],
            )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    return rows.mapInArrow(run, f"doc_id {kind}, start bigint, length bigint, digest string, score double")
