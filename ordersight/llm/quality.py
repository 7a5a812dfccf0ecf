"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL, scored as sparse dot products.

Tokens are words (all-capital words are marked), numbers and runs of other signs; a token that repeats the
one before it is the token "again".  Unigrams and bigrams are hashed into 2^18 features; a text's vector
holds their counts at unit length.  Null and empty texts have no features and get the bias's score; repeated
rows get equal scores; an empty table gives an empty result; without labels of both classes every score is
the smoothed class share.
"""
from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, hash_word, held_out, mix
from .learn import VECTORS, fit_in_one_task, ftrl, labelled, logistic, scored, vectors

BITS = 18
#: Labelled rows that a fit uses at most.
MAX_TRAIN = 6000
FOLDS, TEST_FOLD = 3, 1

_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+")
_AGAIN = np.uint64(hash_word("<again>"))


def _token_hash(token: str) -> int:
    if token.isalpha():
        return hash_word("^" + token.lower() if len(token) > 1 and token.isupper() else token.lower())
    return hash_word("#" if token[0].isdigit() else token)


_hashes = Memo(_token_hash)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted feature numbers and their values (counts at unit length)."""
    tokens = _TOKEN.findall(text)
    h = np.fromiter(map(_hashes.__getitem__, tokens), np.uint64, len(tokens))
    h = np.where(np.concatenate([[False], h[1:] == h[:-1]]), _AGAIN, h) if len(h) else h
    pairs = mix(h[:-1] * np.uint64(0x100000001B3) ^ h[1:], 2)
    both = np.concatenate([mix(h, 1), pairs]) >> np.uint64(64 - BITS)
    found, counts = np.unique(both.astype(np.int64), return_counts=True)
    return found, counts / max(1.0, float(np.sqrt((counts.astype(np.float64) ** 2).sum())))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        folds: int = FOLDS, test_fold: int = TEST_FOLD, max_train: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    sample = labelled(docs, labels, id_col, text_col, label_col, lambda i: ~held_out(i, folds, test_fold), max_train, "quality")
    return fit_in_one_task(sample, VECTORS, vectors(features), lambda rows: ftrl(rows, 1 << BITS, alpha=0.5, l1=0.02, epochs=4))


def score(docs: DataFrame, model: tuple[np.ndarray, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, score, predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: list[str]) -> np.ndarray:
        weights, bias = shared.value
        return logistic(np.array([bias + float(weights[f] @ x) for f, x in map(features, texts)]))

    return scored(docs, id_col, text_col, run)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             folds: int = FOLDS, test_fold: int = TEST_FOLD, max_train: int = MAX_TRAIN) -> DataFrame:
    """id_col, held_out, score, predicted: fitted without the held-out fold, scored on every row."""
    model = fit(docs, labels, id_col, text_col, label_col, folds, test_fold, max_train)
    out = score(docs, model, id_col, text_col)
    return out.select(id_col, held_out(F.col(id_col), folds, test_fold).alias("held_out"), "score", "predicted")
