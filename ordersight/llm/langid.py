"""Language identification of code-switched text with a linear-chain conditional random field over words.

A word's features are its first and last one to four letters, its letter pairs and triples, the word itself
and the lexicons (words that the sample shows almost only in one language); transitions between the labels
of neighbouring words are learned with them.  Forward-backward gives every word its label posteriors; a
document's language is the label with the largest mean posterior, which is its score.

The field is fitted on a bounded, hash-chosen sample: spans of words of the sampled documents, two or three
of them put together, so that transitions between languages are seen.  Whole texts are labelled.

Defined cases: null, empty and letterless texts are ``und`` with score 0; null languages teach nothing; a
sample of one language predicts it; an empty sample predicts ``und``; equal means go to the first label in
sorted order; repeated rows get equal results.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LETTERS, hash_word, held_out, map_batches, sampled, texts_of
from .learn import fit_in_one_task

BITS = 16
#: Documents in the fitted sample, spans of each, words of a span.
MAX_TRAIN, SPANS, SPAN_WORDS = 3000, 3, 20
FOLDS, TEST_FOLD = 5, 0
UNKNOWN = "und"

_SIZE = 1 << BITS
_M = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def _hash_windows(codes: np.ndarray, at: np.ndarray, width: int, kind: int) -> np.ndarray:
    h = np.full(len(at), kind, np.uint64)
    for k in range(width):
        h = (h ^ codes[at + k]) * _M
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def features(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, feature number) pairs of the words."""
    joined = "\n" + "\n".join(words) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    edges = np.flatnonzero(codes == 10)
    start, end = edges[:-1] + 1, edges[1:]
    size = end - start
    number = np.arange(len(words))
    of, feats = [], []

    def add(which, found):
        of.append(number[which])
        feats.append(found)

    for k in range(1, 5):
        long = size >= k
        add(long, _hash_windows(codes, start[long], k, 10 + k))
        add(long, _hash_windows(codes, end[long] - k, k, 20 + k))
    word_at = np.repeat(number, size)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    left = np.repeat(size, size) - inside
    place = np.repeat(start, size) + inside
    for k in (2, 3):
        fits = left >= k
        add(word_at[fits], _hash_windows(codes, place[fits], k, 30 + k))
    feats.append(np.fromiter((hash_word(w) >> (64 - BITS) for w in words), np.int64, len(words)))
    of.append(number)
    known = [(i, lexicon[w]) for i, w in enumerate(words) if w in lexicon]
    if known:
        i, lang = np.array(known).T
        of.append(i)
        feats.append(_SIZE + lang)  # the rows after the hashed features
    return np.concatenate(of), np.concatenate(feats)


class Field:
    """Weights of (feature, label), transitions (from, to) and the first word's labels."""

    def __init__(self, langs: list[str], lexicon: dict[str, int], weights=None, moves=None, first=None):
        k = len(langs)
        self.langs, self.lexicon = langs, lexicon
        self.weights = np.zeros((_SIZE + k, k), np.float32) if weights is None else weights
        self.moves = np.zeros((k, k)) if moves is None else moves
        self.first = np.zeros(k) if first is None else first

    def emissions(self, words: list[str]) -> np.ndarray:
        of, f = features(words, self.lexicon)
        w = self.weights[f]
        return np.stack([np.bincount(of, w[:, j], len(words)) for j in range(len(self.langs))], axis=1)

    def marginals(self, emission: np.ndarray, lengths: np.ndarray, moves: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Label posteriors of the words of several sequences laid end to end, and transition posteriors summed.

        The sequences run side by side, longest first, so each step handles all that are still going on.
        Only learning asks for the transitions; without ``moves`` they stay zero.
        """
        k = emission.shape[1]
        order = np.argsort(-lengths, kind="stable")
        start = (np.cumsum(lengths) - lengths)[order]
        size = lengths[order]
        steps = int(size[0]) if len(size) else 0
        live = np.searchsorted(-size, -np.arange(steps), side="left")  # sequences longer than t
        e = np.exp(emission - emission.max(axis=1, keepdims=True))
        t_mat, begin = np.exp(self.moves), np.exp(self.first - self.first.max())
        alpha = np.empty_like(e)
        prev = None
        for t in range(steps):
            at = start[:live[t]] + t
            a = (begin if t == 0 else prev[:live[t]] @ t_mat) * e[at]
            a /= a.sum(axis=1, keepdims=True)
            alpha[at] = prev = a
        out = np.empty_like(e)
        moved = np.zeros((k, k))
        beta = np.ones((len(size), k))
        for t in range(steps - 1, -1, -1):
            n = live[t]
            at = start[:n] + t
            if t + 1 < steps and (m := live[t + 1]):
                nxt = start[:m] + t + 1
                into = e[nxt] * beta[:m]
                if moves:
                    joint = alpha[nxt - 1][:, :, None] * t_mat * into[:, None, :]
                    moved += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
                b = into @ t_mat.T
                beta[:m] = b / b.sum(axis=1, keepdims=True)
            g = alpha[at] * beta[:n]
            out[at] = g / g.sum(axis=1, keepdims=True)
        return out, moved


def _spans(shared: dict):
    def prepare(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = []
        for order, label, text in zip(batch.column("order").to_pylist(), batch.column("label").to_pylist(), texts_of(batch, "text"), strict=True):
            words = words_of(text)
            if not words:
                continue
            pick = np.random.default_rng(order & 0x7FFFFFFF)
            for i in range(shared["spans"]):
                at = int(pick.integers(0, max(1, len(words) - shared["words"] + 1)))
                rows.append({"order": order ^ i, "label": label, "words": words[at:at + shared["words"]]})
        return pa.RecordBatch.from_pylist(rows, schema=pa.schema(
            [("order", pa.int64()), ("label", pa.string()), ("words", pa.list_(pa.string()))])) if rows else None
    return prepare


def _lexicon(rows: list[dict], langs: list[str], least: int = 5, share: float = 0.9) -> dict[str, int]:
    seen: dict[str, np.ndarray] = {}
    for r in rows:
        for w in set(r["words"]):
            seen.setdefault(w, np.zeros(len(langs)))[langs.index(r["label"])] += 1
    return {w: int(c.argmax()) for w, c in seen.items() if c.sum() >= least and c.max() >= share * c.sum()}


def _train(rows: list[dict], epochs: int = 4, rate: float = 0.2, l2: float = 1e-4, batch: int = 48) -> Field:
    """Log likelihood by AdaGrad on sequences of one to three spans."""
    langs = sorted({r["label"] for r in rows})
    field = Field(langs, _lexicon(rows, langs))
    k = len(langs)
    if k < 2:
        return field
    gw, gm, gf = np.full_like(field.weights, 1e-2), np.full((k, k), 1.0), np.full(k, 1.0)
    for epoch in range(epochs):
        rng = np.random.default_rng(epoch)
        order = rng.permutation(len(rows))
        sequences, i = [], 0
        while i < len(order):
            n = int(rng.integers(1, 4))
            sequences.append([rows[j] for j in order[i:i + n]])
            i += n
        for b in range(0, len(sequences), batch):
            part = sequences[b:b + batch]
            words = [w for s in part for r in s for w in r["words"]]
            truth = np.array([langs.index(r["label"]) for s in part for r in s for _ in r["words"]])
            lengths = np.array([sum(len(r["words"]) for r in s) for s in part])
            of, f = features(words, field.lexicon)
            post, moved = field.marginals(field.emissions(words), lengths)
            diff = -post
            diff[np.arange(len(truth)), truth] += 1
            starts = np.cumsum(lengths) - lengths
            real = np.zeros((k, k))
            inner = np.ones(len(truth), bool)
            inner[starts] = False
            np.add.at(real, (truth[np.flatnonzero(inner) - 1], truth[inner]), 1)
            touched, slot = np.unique(f, return_inverse=True)
            grad = np.stack([np.bincount(slot, diff[of, j], len(touched)) for j in range(k)], axis=1) / len(part) - l2 * field.weights[touched]
            gw[touched] += grad ** 2
            field.weights[touched] += (rate * grad / np.sqrt(gw[touched])).astype(np.float32)
            grad = (real - moved) / len(part) - l2 * field.moves
            gm += grad ** 2
            field.moves += rate * grad / np.sqrt(gm)
            grad = diff[starts].sum(axis=0) / len(part) - l2 * field.first
            gf += grad ** 2
            field.first += rate * grad / np.sqrt(gf)
    return field


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = FOLDS,
        test_fold: int = TEST_FOLD, max_train: int = MAX_TRAIN) -> Field:
    usable = docs.filter(~held_out(F.col(id_col), folds, test_fold) & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()
                         & (F.col(lang_col) != UNKNOWN))
    share = max_train / max(1, usable.count())
    sample = usable.filter(sampled(F.col(id_col), share, "lang")).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("label"))
    return fit_in_one_task(sample, "order long, label string, words array<string>",
                           _spans({"spans": SPANS, "words": SPAN_WORDS}), _train)


class _Labeller:
    """Emission rows of words already met, up to a bound; whole batches at a time."""

    def __init__(self, field: Field, cap: int = 150_000):
        self.field, self.cap = field, cap
        self.rows: dict[str, int] = {}
        self.table = np.empty((0, len(field.langs)))

    def _numbers(self, words: list[str]) -> np.ndarray:
        new = list(set(words) - self.rows.keys())
        if new:
            if len(self.rows) + len(new) > self.cap:
                self.rows, self.table, new = {}, self.table[:0], list(set(words))
            base = len(self.table)
            self.rows.update(zip(new, range(base, base + len(new)), strict=True))
            self.table = np.concatenate([self.table, *[self.field.emissions(new[i:i + 20_000]) for i in range(0, len(new), 20_000)]])
        return np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.field.langs:
            return langs, scores
        per_text = [words_of(t) for t in texts]
        full = [i for i, w in enumerate(per_text) if w]
        if not full:
            return langs, scores
        lengths = np.array([len(per_text[i]) for i in full])
        words = [w for i in full for w in per_text[i]]
        post, _ = self.field.marginals(self._emissions(words), lengths, moves=False)
        mean = np.add.reduceat(post, np.cumsum(lengths) - lengths, axis=0) / lengths[:, None]
        for i, m in zip(full, mean, strict=True):
            langs[i], scores[i] = self.field.langs[int(m.argmax())], min(1.0, float(m.max()))
        return langs, scores

    def _emissions(self, words: list[str]) -> np.ndarray:
        numbers = self._numbers(words)
        return self.table[numbers]


def _lazy(shared):
    box: list[_Labeller] = []

    def run(texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not box:
            box.append(_Labeller(shared.value))
        return box[0].predict(texts)
    return run


def identify(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, lang_pred, score of every row."""
    run = _lazy(docs.sparkSession.sparkContext.broadcast(field))
    kind = docs.schema[id_col].dataType.simpleString()

    def label(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = run(texts_of(batch, "_text"))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores)], names=[id_col, "lang_pred", "score"])

    return map_batches(docs.select(F.col(id_col), F.col(text_col).alias("_text")), label, f"`{id_col}` {kind}, lang_pred string, score double")


def drop_unidentified(docs: DataFrame, field: Field, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all columns) whose language is known with a score of at least ``least``."""
    run = _lazy(docs.sparkSession.sparkContext.broadcast(field))

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = run(texts_of(batch, text_col))
        return batch.filter(pa.array([g != UNKNOWN and s >= least for g, s in zip(langs, scores, strict=True)], pa.bool_()))

    return map_batches(docs, keep, docs.schema)
