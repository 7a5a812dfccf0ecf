"""Toxicity after noisy-channel deobfuscation.

Words whose letters were replaced by look-alike signs (leetspeak), spaced out or repeated are read as a
lattice: each sign offers the letters it may stand for, each run of a letter may stand for one or two, each
gap between spaced letters may be a word break or not.  The Viterbi path under a character trigram model of
the whole corpus restores the text, whatever the token's length.  A plain word is a lattice of one path and is
its own restoration.  Numbers stand for themselves: digits with the marks of numbers, amounts and dates, or with
a unit of at most two letters; so do signs without two unlike look-alikes.

The restored words and their beginnings of three to seven letters are scored by a logistic regression (FTRL with
an l1 penalty) on their presence.  Null and empty texts get the bias's score; digits alone are no word;
repeated rows get equal scores; without labels of both classes every score is the smoothed class share.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, hash_word, held_out, map_batches, small_batches, texts_of
from .learn import VECTORS, fit_in_one_task, ftrl, labelled, logistic, scored, vectors

BITS = 20
#: Labelled rows that a fit uses at most.
MAX_TRAIN = 8000
#: Bias of the regression: a text without learned features scores 0.02.  Were it learned, it would sink with
#: the many texts that have none, and texts with a single insult with it.
BIAS = -4.0
#: Sampled rows that must have a feature before it is learned.
MIN_ROWS = 3
FOLDS, TEST_FOLD = 5, 0

#: Letters that a sign may stand for, the likeliest first.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "€": "e", "£": "l", "(": "c", "*": "aeiou", "#": "h"}
#: Log cost of a sign for a letter, of a doubled letter kept, of a letter run cut, of a break between spaced letters.
COST_SIGN, COST_BREAK = 0.5, 2.0

# Symbols of the character model: 0 word edge, 1 any other letter, then a-z and the letters of Latin-1.
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(c for c in map(chr, range(0xDF, 0x100)) if c.isalpha())
SYMBOLS = len(_LETTERS) + 2
_CODE = {c: i + 2 for i, c in enumerate(_LETTERS)}
_TABLE = np.zeros(256, np.int64)
for _c, _i in _CODE.items():
    _TABLE[ord(_c)] = _i


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 256, _TABLE[np.minimum(points, 255)], 1)


def char_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigram counts of word characters over all texts; at most SYMBOLS^3 numbers, added up per task first."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** 3, np.int64)
        for batch in batches:
            texts = texts_of(batch, "_text")
            for i in range(0, len(texts), 64):  # one space apart, so words of two texts never touch
                c = np.concatenate([[0, 0], _codes(" ".join(texts[i:i + 64])), [0]])
                total += np.bincount((c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:], minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["gram", "n"])

    counts = docs.select(F.col(text_col).alias("_text")).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    out = np.zeros(SYMBOLS ** 3, np.float64)
    for row in counts.collect():
        out[row["gram"]] = row["n"]
    return out


class CharModel:
    """Interpolated trigram log probabilities."""

    def __init__(self, counts: np.ndarray):
        c3 = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
        c2, c1 = c3.sum(axis=0), c3.sum(axis=(0, 1))
        p1 = (c1 + 0.5) / (c1 + 0.5).sum()
        p2 = (c2 + 5 * p1) / (c2.sum(axis=1, keepdims=True) + 5)
        p3 = (c3 + 5 * p2[None]) / (c3.sum(axis=2, keepdims=True) + 5)
        self.logp = np.log(p3).astype(np.float32)

    def decode(self, lattice: list[list[tuple[str, float]]]) -> str:
        """The best path; each position offers (text to write, cost), where a text is '', ' ' or letters."""
        logp = memoryview(self.logp.reshape(-1))  # single numbers are read quicker than from an array
        beams: dict = {(0, 0): (0.0, None)}  # the last two symbols decide what follows; texts are chains of pieces
        for options in [*lattice, [(" ", 0.0)]]:
            new: dict = {}
            for (a, b), (score, out) in beams.items():
                for piece, cost in options:
                    s, x, y = score - cost, a, b
                    for ch in piece:
                        z = 0 if ch == " " else _CODE.get(ch, 1)
                        if z or y:  # an edge after an edge says nothing
                            s += logp[(x * SYMBOLS + y) * SYMBOLS + z]
                            x, y = y, z
                    if s > new.get((x, y), (-1e30,))[0]:
                        new[x, y] = (s, (out, piece) if piece else out)
            beams = new
        out, pieces = max(beams.values(), key=lambda v: v[0])[1], []
        while out:
            out, piece = out
            pieces.append(piece)
        return "".join(reversed(pieces)).strip()


_RUN = re.compile(r"(.)\1{2,}", re.S)
_ONE = r"[^\W_]|[@$€£!|+(*#]"
_SPACED = re.compile(rf"(?<!\S)(?:{_ONE})(?:[ .\-_]{{1,2}}(?:{_ONE})){{2,}}(?!\S)")
_EDGE = re.compile(r"^[^\w@$€£!|+(*#]+|[^\w@$€£|+*#]+$")
_JOINTS = re.compile(r"[.\-_~'`,:;/\\)\]\[{}\"?<>=&%^]+")
_PLAIN = re.compile(r"[^\W\d_]+")
_NUMBER = re.compile(r"[+#(]*[$€£]?[+\-]?\d[\d.,:;/()x*+=\-]*[$€£%+#]?(?:[^\W\d_]{1,2})?")


def _letters_of(ch: str) -> list[tuple[str, float]]:
    if ch.isalpha():
        return [(ch, 0.0)]
    return [(c, COST_SIGN) for c in LEET.get(ch, "")] or [("", COST_SIGN)]


def lattice_of(word: str, spaced: bool = False) -> list[list[tuple[str, float]]]:
    """Positions and what each may stand for, of a lower-cased word or of spaced-out letters."""
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(word):
        ch = word[i]
        j = i
        while j < len(word) and word[j] == ch:
            j += 1
        run = j - i
        if ch.isspace() or _JOINTS.match(ch):
            out.append([("", 0.0), (" ", COST_BREAK if spaced else 4.0)])
        else:
            letters = _letters_of(ch)
            if run >= 3:
                out.append([(c, k) for c, k in letters] + [(c * 2, k) for c, k in letters])
            else:
                out.extend([letters] * run)
        i = j
    return out


class Restorer:
    """Restores tokens under a character model; plain words are looked up without a lattice."""

    def __init__(self, model: CharModel):
        self.model = model
        self.memo = Memo(self.read, cap=100_000)

    def read(self, token: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """The plain readings of a token and its restored words."""
        word = token.lower()
        if _PLAIN.fullmatch(word) and not _RUN.search(word):
            return (), (word,)
        core = _EDGE.sub("", word)
        if _PLAIN.fullmatch(core) and not _RUN.search(core):
            return (), (core,)
        parts = tuple(_PLAIN.findall(word))
        if _NUMBER.fullmatch(core) or not (parts or len({c for c in core if c in LEET}) > 1):
            return parts, ()
        pieces = [x for x in _JOINTS.split(core) if len(x) > 1]
        if len(pieces) > 1:  # a chain of words: what lies between joints may be a word of its own
            parts += tuple(w for x in set(pieces) if not _NUMBER.fullmatch(x) for w in self.model.decode(lattice_of(x)).split())
        return parts, tuple(self.model.decode(lattice_of(core)).split())

    def words(self, text: str) -> set[str]:
        """The distinct words of the restored text, with the plain readings of what was restored."""
        found: set[str] = set()
        for plain, restored in map(self.memo.__getitem__, set(text.split())):
            found.update(plain, restored)
        found.update(self.spaced(text))
        return found

    def spaced(self, text: str) -> list[str]:
        """The words that the text spells in spaced-out letters."""
        found = []
        for m in _SPACED.finditer(text):
            letters = re.sub(r"[ .\-_]+", " ", m.group().lower())
            if len(set(letters)) > 2:  # one letter over and over spells nothing
                found += self.model.decode(lattice_of(letters, spaced=True)).split()
        return found

    def restore(self, text: str) -> str:
        """The text with spaced letters joined and every token restored."""
        text = _SPACED.sub(lambda m: self.model.decode(lattice_of(re.sub(r"[ .\-_]+", " ", m.group().lower()), spaced=True)), text)
        return re.sub(r"\S+", lambda m: " ".join(self.memo[m.group()][1]) or m.group(), text)


def _features_of(word: str) -> list[int]:
    names = ["w:" + word] + ["p:" + word[:k] for k in range(3, 8) if len(word) > k]
    return [hash_word(x) >> (64 - BITS) for x in names]


_features = Memo(_features_of, cap=100_000)


def _featurise(shared):
    box: list[Restorer] = []

    def features(text: str) -> tuple[np.ndarray, np.ndarray]:
        if not box:
            box.append(Restorer(shared.value))
        found = sorted({f for w in box[0].words(text) for f in _features[w]})
        return np.array(found, np.int64), np.empty(0)  # presence: the fit sets ones
    return features


class ToxicityModel:
    def __init__(self, chars: CharModel, weights: np.ndarray, bias: float):
        self.chars, self.bias = chars, bias
        kept = np.flatnonzero(weights)
        self.weights = dict(zip(kept.tolist(), weights[kept].tolist(), strict=True))

    def scorer(self):
        restorer, weights = Restorer(self.chars), self.weights
        weighed = Memo(lambda w: tuple(f for f in _features_of(w) if f in weights), cap=100_000)

        def of_token(token: str) -> tuple[int, ...]:
            """Weighed features of the token's words; most tokens have none, so many are kept at little cost."""
            plain, restored = restorer.read(token)
            return tuple({f for w in (*plain, *restored) for f in weighed[w]})

        known = Memo(of_token, cap=300_000)

        def score(text: str) -> float:
            found: set[int] = set()
            for features in map(known.__getitem__, set(text.split())):
                if features:
                    found.update(features)
            for w in restorer.spaced(text):
                found.update(weighed[w])
            return self.bias + sum(weights[f] for f in sorted(found))

        return lambda texts: logistic(np.array([score(t) for t in texts]))


def _fit(rows: list[dict]) -> tuple[np.ndarray, float]:
    """FTRL over the features that at least ``MIN_ROWS`` sampled rows have and that speak for the label.

    Features of one or two rows would explain those rows away and teach nothing about others.
    """
    size = 1 << BITS
    seen, toxic = np.zeros(size), np.zeros(size)
    for r in rows:
        f = np.frombuffer(r["features"], np.int32)
        seen[f] += 1
        toxic[f] += r["label"] == 1
    useful = (seen >= MIN_ROWS) & ((toxic + 0.5) / (seen + 1) > 0.5)
    for r in rows:
        f = np.frombuffer(r["features"], np.int32)
        f = f[useful[f]]
        r["features"], r["values"] = f.tobytes(), np.ones(len(f), np.float32).tobytes()
    return ftrl(rows, size, alpha=1.0, l1=0.01, l2=1e-4, epochs=20, positive=2.0, bias=BIAS)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        folds: int = FOLDS, test_fold: int = TEST_FOLD, max_train: int = MAX_TRAIN) -> ToxicityModel:
    """The character model counts every text; labels come from the sampled rows outside the held-out fold."""
    chars = CharModel(char_counts(docs, text_col))
    shared = docs.sparkSession.sparkContext.broadcast(chars)
    sample = labelled(docs, labels, id_col, text_col, label_col, lambda i: ~held_out(i, folds, test_fold), max_train, "toxic")
    weights, bias = fit_in_one_task(sample, VECTORS, vectors(_featurise(shared)), _fit)
    return ToxicityModel(chars, weights, bias)


def _lazy(shared):
    box: list = []

    def run(texts: list[str]) -> np.ndarray:
        if not box:
            box.append(shared.value.scorer())
        return box[0](texts)
    return run


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
             folds: int = FOLDS, test_fold: int = TEST_FOLD, max_train: int = MAX_TRAIN) -> DataFrame:
    """id_col, held_out, score, predicted of every row."""
    model = fit(docs, labels, id_col, text_col, label_col, folds, test_fold, max_train)
    out = scored(docs, id_col, text_col, _lazy(docs.sparkSession.sparkContext.broadcast(model)))
    return out.select(id_col, held_out(F.col(id_col), folds, test_fold).alias("held_out"), "score", "predicted")


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all columns) that score under ``threshold``."""
    run = _lazy(docs.sparkSession.sparkContext.broadcast(model))
    return map_batches(docs, lambda b: b.filter(pa.array(run(texts_of(b, text_col)) < threshold)), docs.schema)
