"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over token positions: the tokens under its marks are hashed, the others are
ignored, so a substituted token under a gap does not break the match.  The hashes of the benchmark and of
the documents are joined; around every hit the two texts are compared position by position along the
hit's diagonal, and an overlap counts where a window of ``window`` tokens agrees in at least
``similarity`` of its positions (shorter items: the whole item).

The three masks together hit every 13-token window with up to two substitutions wherever they lie (a test
checks all placements); items under ``SHORT`` tokens are sought by runs of two tokens as well.

The benchmark is the query set: it is joined block by block, each block holding at most ``BLOCK_TOKENS``
tokens (broadcast, so its size is bounded whatever the benchmark's), against all documents.

Defined cases: null or empty texts overlap with nothing; items under ``MIN_TOKENS`` tokens cannot be
matched; repeated items or documents are each reported; an empty benchmark flags nothing; null item ids
are left out of the item lists but still contaminate.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, Memo, hash_word, map_batches, mix, small_batches, texts_of

#: Token positions that each mask looks at.
MASKS = ((0, 1, 2, 5, 7), (0, 1, 3, 4, 6), (0, 3, 4, 6, 7))
WINDOW = 13
SIMILARITY = 0.8
MIN_TOKENS = 5
#: Items under so many tokens are found by runs too: in 10 and 11, two substitutions can miss every mask.
SHORT = 12
#: Benchmark tokens of one broadcast block: 2 million tokens are about 100 MB of seeds and tokens.
BLOCK_TOKENS = 2_000_000

_words = Memo(hash_word)


def tokens(text: str | None) -> np.ndarray:
    """64-bit hashes of the lower-cased words."""
    words = WORD.findall((text or "").lower())
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def _seeds(toks: np.ndarray, number: int) -> np.ndarray:
    """Hashes of mask ``number`` at every position of ``toks``."""
    mask = MASKS[number]
    n = len(toks) - mask[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, number + 1, np.uint64)
    for at in mask:
        h = (h ^ toks[at:at + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
    return h


def _joined(parts: list[np.ndarray], pad: int, filler: int) -> tuple[np.ndarray, np.ndarray]:
    """The parts one after another with ``pad`` fillers around each; the start of each."""
    starts = np.cumsum([pad] + [len(p) + pad for p in parts])[:-1]
    out = np.full(pad + sum(len(p) + pad for p in parts), filler, np.uint64)
    for p, s in zip(parts, starts, strict=True):
        out[s:s + len(p)] = p
    return out, starts


class SeedIndex:
    """Seeds of a block of benchmark items; built on the driver from the bounded block, then broadcast."""

    def __init__(self, ids: list, texts: list[str | None], window: int, similarity: float):
        self.ids, self.window, self.similarity = ids, window, similarity
        self.span = max(m[-1] for m in MASKS) + 1
        self.pad = window + self.span
        parts = [tokens(t) for t in texts]
        self.lengths = np.array([len(p) for p in parts], np.int64)
        self.toks, starts = _joined(parts, self.pad, 0)
        hashes, items, places = [], [], []
        for i, p in enumerate(parts):
            if len(p) < MIN_TOKENS:
                continue
            # a mask longer than a short item looks at its first marks only where they fit
            for m in range(len(MASKS)):
                h = _seeds(p, m)
                hashes.append(h)
                items.append(np.full(len(h), i, np.int32))
                places.append(np.arange(len(h)) + starts[i])
            if len(p) < SHORT:
                hashes.append(_runs(p))
                items.append(np.full(len(hashes[-1]), i, np.int32))
                places.append(np.arange(len(hashes[-1])) + starts[i])
        cat = lambda xs, t: np.concatenate(xs).astype(t) if xs else np.empty(0, t)
        h = cat(hashes, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hashes, self.items, self.places = h[order], cat(items, np.int32)[order], cat(places, np.int64)[order]
        self.short = bool((self.lengths[self.lengths >= MIN_TOKENS] < SHORT).any()) if len(self.lengths) else False
        self.bits = 22
        self.present = np.zeros(1 << self.bits, bool)
        self.present[(self.hashes >> np.uint64(64 - self.bits)).astype(np.int64)] = True

    def overlaps(self, docs: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """Verified overlaps: document, item, first document token, first item token, length, agreeing tokens."""
        none = tuple(np.empty(0, np.int64) for _ in range(6))
        if not len(self.hashes):
            return none
        text, starts = _joined(docs, self.pad, 1)
        at, row = [], []
        for m in range(len(MASKS) + self.short):
            h = _seeds(text, m) if m < len(MASKS) else _runs(text)
            maybe = np.flatnonzero(self.present[(h >> np.uint64(64 - self.bits)).astype(np.int64)])
            lo = np.searchsorted(self.hashes, h[maybe])
            n = np.searchsorted(self.hashes, h[maybe], side="right") - lo
            keep = n > 0
            maybe, lo, n = maybe[keep], lo[keep], n[keep]
            at.append(np.repeat(maybe, n))
            row.append(np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        at, row = np.concatenate(at), np.concatenate(row)
        found = []
        for i in range(0, len(at), 200_000):
            found.append(self._verified(text, at[i:i + 200_000], row[i:i + 200_000]))
        if not found:
            return none
        pos, item, item_pos, length, same = (np.concatenate(x) for x in zip(*found, strict=True))
        doc = np.searchsorted(starts, pos, side="right") - 1
        return doc, item, pos - starts[doc], item_pos, length, same

    def _verified(self, text: np.ndarray, at: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
        w, reach = self.window, self.window - 1
        cols = np.arange(-reach, self.span + reach)
        q, item = self.places[row], self.items[row]
        same = text[at[:, None] + cols] == self.toks[q[:, None] + cols]
        total = np.concatenate([np.zeros((len(at), 1), np.int32), np.cumsum(same, axis=1, dtype=np.int32)], axis=1)
        counts = total[:, w:] - total[:, :-w]  # of each window that touches the seed
        best = counts.argmax(axis=1)
        size = np.minimum(self.lengths[item], w)
        need = np.ceil(self.similarity * size - 1e-9).astype(np.int64)
        top = counts[np.arange(len(at)), best]
        ok = top >= need
        at, q, item, best, top, same, size = at[ok], q[ok], item[ok], best[ok], top[ok], same[ok], size[ok]
        if not len(at):
            return at, item, q, size, top
        # trim the window to its agreeing ends
        inside = np.take_along_axis(same, best[:, None] + np.arange(w), axis=1)
        first, last = inside.argmax(axis=1), w - 1 - inside[:, ::-1].argmax(axis=1)
        shift = best - reach + first
        first_of = np.cumsum(np.concatenate([[self.pad], self.lengths + self.pad]))[:-1]
        return at + shift, item.astype(np.int64), q + shift - first_of[item], last - first + 1, top.astype(np.int64)


def _runs(toks: np.ndarray) -> np.ndarray:
    """Seeds of two neighbouring tokens, for items that the masks alone may miss."""
    if len(toks) < 2:
        return np.empty(0, np.uint64)
    return mix(toks[:-1] * np.uint64(31) + toks[1:], 77)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, similarity: float) -> Iterator[SeedIndex]:
    """Indexes over the benchmark, cut by a hash of the item into blocks of bounded size."""
    items = benchmark.select(F.col(item_col).alias("id"), F.col(text_col).alias("text"))
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // (2 * BLOCK_TOKENS)))  # a token has two characters at least, with its space
    block = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    for b in range(n):
        rows = items.filter(block == b).collect()
        yield SeedIndex([r["id"] for r in rows], [r["text"] for r in rows], window, similarity)


OVERLAP_SCHEMA = "item string, doc_token long, item_token long, length long, agreeing long"


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
             similarity: float = SIMILARITY) -> DataFrame:
    """One row per document and overlapping item: the best window (most agreeing tokens, then the first).

    Columns: id_col, item_col (as text), doc_token, item_token, length, agreeing.
    """
    slim = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))
    schema = pa.schema([("item", pa.string())] + [(n, pa.int64()) for n in ("doc_token", "item_token", "length", "agreeing")])
    out = None
    for index in _blocks(benchmark, item_col, item_text_col, window, similarity):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def find(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch | None:
            rows = _best(shared.value, texts_of(batch, "_text"))
            if not len(rows):
                return None
            ids = batch.column(0).take(pa.array(rows[:, 0]))
            names = pa.array([None if shared.value.ids[i] is None else str(shared.value.ids[i]) for i in rows[:, 1]], pa.string())
            return pa.RecordBatch.from_arrays([ids, names, *[pa.array(rows[:, k]) for k in range(2, 6)]],
                                              schema=pa.schema([pa.field(id_col, ids.type), *schema]))

        kind = docs.schema[id_col].dataType.simpleString()
        part = map_batches(slim, find, f"`{id_col}` {kind}, {OVERLAP_SCHEMA}")
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("item", item_col)


def _best(index: SeedIndex, texts: list[str]) -> np.ndarray:
    doc, item, pos, item_pos, length, same = index.overlaps([tokens(t) for t in texts])
    if not len(doc):
        return np.empty((0, 6), np.int64)
    order = np.lexsort((pos, -same, item, doc))
    rows = np.stack([doc, item, pos, item_pos, length, same], axis=1)[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[new]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                 similarity: float = SIMILARITY) -> DataFrame:
    """Every document once per input row: id_col, contaminated, items (sorted ids), best_agreeing.

    Verdicts are made where the row is read, so documents are neither joined nor grouped; with several
    benchmark blocks the row passes one index after the other.
    """
    indexes = [docs.sparkSession.sparkContext.broadcast(i) for i in _blocks(benchmark, item_col, item_text_col, window, similarity)]
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType
    slim = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("_text"))

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        hit, items, best = _verdicts(indexes, texts_of(batch, "_text"))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(hit), pa.array(items, pa.list_(pa.string())), pa.array(best, pa.int64())],
            names=[id_col, "contaminated", "items", "best_agreeing"])

    out = map_batches(slim, judge, f"`{id_col}` {kind}, contaminated boolean, items array<string>, best_agreeing long")
    return out.withColumn("items", F.array_sort(F.col("items").cast(f"array<{item_kind.simpleString()}>")))


def _verdicts(indexes: list, texts: list[str]) -> tuple[np.ndarray, list[list[str]], np.ndarray]:
    hit, best = np.zeros(len(texts), bool), np.zeros(len(texts), np.int64)
    items: list[list[str]] = [[] for _ in texts]
    for shared in indexes:
        index = shared.value
        for doc, item, _, _, _, same in _best(index, texts):
            hit[doc], best[doc] = True, max(best[doc], same)
            if index.ids[item] is not None:
                items[doc].append(str(index.ids[item]))
    return hit, items, best


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", window: int = WINDOW, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` (all columns) without an overlap."""
    indexes = [docs.sparkSession.sparkContext.broadcast(i) for i in _blocks(benchmark, item_col, item_text_col, window, similarity)]
    small_batches(docs.sparkSession)

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(~_verdicts(indexes, texts_of(batch, text_col))[0]))

    return map_batches(docs, keep, docs.schema)
