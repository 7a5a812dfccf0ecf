"""Cross-tokenizer alignment: which tokens of two vocabularies cover the same bytes, weighed by corpus-wide pair counts.

Both vocabularies encode the same bytes (a blank and the text).  Offsets where tokens of both end cut them into
groups; an A and a B token are linked where their bytes overlap.  Since the ends of both cut the bytes into pieces
that lie in one A and one B token each, and two overlapping tokens share one such piece, links are those pieces.

The number of links of each id pair is counted outside memory:

1. Spill.  A task collects the links of some documents (up to ``SPILL``), sorts them by radix partition, B id, A id
   and document, and writes one zstd run for every partition: a head (pairs and their totals) and a body
   (documents of each pair and how often it occurs there).  The radix is drawn from the B id.
2. Merge.  Runs of a radix are dealt over as many splits as its records ask for (``PER_TASK`` each, by spill), so a B id
   or a pair that holds a third of all links is spread like any other.  A k-way heap merge of a split's heads gives each pair's count
   there; the splits' counts are summed, and in the order of B ids each one's highest count is found (a B id has no
   more pairs than A has ids).
3. Back.  Every run meets the counts of its split's pairs and streams a sum for each of its documents back to its
   spill, where the parts of a document are added up.

Defined cases: null and empty texts, and texts whose joined A or B bytes differ from the blank and the text (U+2581 in the text
does that), have no tokens: zeros and an empty digest; strings of special tokens are plain text; repeated rows are
documents of their own, and null ids stay null; an empty table gives no rows; a very long text is one spill of its own.
"""
from __future__ import annotations

import hashlib
import heapq
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stage, texts_of
from .units import Store, Vocabulary, space_cuts

RADIX, SPILL, PER_TASK = 32, 2_000_000, 2_000_000
#: Cuts kept for good by a Python worker, with their groups and links.
CAP = 250_000
DOC_BITS = 16
BLANK = "▁"


def _byte_alphabet() -> dict[str, int]:
    """The letters of byte-level vocabularies: visible Latin-1 signs stand for themselves, other bytes follow from 256 on."""
    seen = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Groups and links of cuts under a byte-level vocabulary (A) and a piece vocabulary (B)."""

    def __init__(self, path_a: str, path_b: str, cap: int = CAP):
        import sentencepiece
        self.a = Vocabulary(path_a, plain=True, cap=0)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = _byte_alphabet()
        names = [self.a.tokenizer.id_to_token(i) or "" for i in range(self.a.size)]
        self.bytes_a = [bytes(letters[c] for c in n) if all(c in letters for c in n) else n.encode() for n in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.text_a, self.text_b = [str(i) for i in range(self.a.size)], [str(i) for i in range(len(pieces))]
        self.a_bits, self.b_bits = (self.a.size - 1).bit_length(), (len(pieces) - 1).bit_length()
        # a text may be cut before blanks if no piece of B has one behind another sign
        self.cuttable = not any(BLANK in p.lstrip(BLANK) for p in pieces)
        self.blank = self.b.piece_to_id(BLANK)
        self.store = Store(self._values, cap)

    def cuts(self, text: str) -> list[str]:
        return space_cuts(" " + text) if self.cuttable else [" " + text]

    def _values(self, cuts: list[str]) -> list[tuple]:
        """(groups as text, keys of the links as bytes, A tokens, B tokens, groups) of each cut; no groups where bytes differ."""
        a = [np.frombuffer(x, self.a.kind).tolist() for x in self.a.ids_of(cuts)]
        b = self.b.encode([c[1:] for c in cuts], num_threads=1)
        b = [ids or [self.blank] for ids in b]
        raw = [c.encode() for c in cuts]
        fits = [b"".join([self.bytes_a[i] for i in x]) == r == b"".join([self.bytes_b[i] for i in y]) for x, y, r in zip(a, b, raw, strict=True)]
        good = [k for k, ok in enumerate(fits) if ok]
        out: list[tuple] = [("", b"", 0, 0, 0)] * len(cuts)
        if not good:
            return out
        flat_a = np.array([i for k in good for i in a[k]], np.int64)
        flat_b = np.array([i for k in good for i in b[k]], np.int64)
        end_a, end_b = np.cumsum(self.size_a[flat_a]), np.cumsum(self.size_b[flat_b])
        cut_end = np.cumsum([len(raw[k]) for k in good])
        end = np.union1d(end_a, end_b)
        at_a, at_b = np.searchsorted(end_a, end), np.searchsorted(end_b, end)
        keys = ((flat_b[at_b].astype(np.uint64) << np.uint64(self.a_bits)) | flat_a[at_a].astype(np.uint64)).tobytes()
        both = np.flatnonzero((end_a[at_a] == end) & (end_b[at_b] == end))
        links = (np.searchsorted(end, cut_end) + 1).tolist()
        groups = (np.searchsorted(end[both], cut_end) + 1).tolist()
        last_a, last_b = (at_a[both] + 1).tolist(), (at_b[both] + 1).tolist()
        said_a, said_b = [self.text_a[i] for i in flat_a.tolist()], [self.text_b[i] for i in flat_b.tolist()]
        texts = [",".join(said_a[p:q]) + "|" + ",".join(said_b[r:s]) for p, q, r, s in zip([0, *last_a], last_a, [0, *last_b], last_b)]
        for k, l0, l1, g0, g1 in zip(good, [0, *links], links, [0, *groups], groups):
            out[k] = (";".join(texts[g0:g1]), keys[8 * l0:8 * l1], len(a[k]), len(b[k]), g1 - g0)
        return out

    def align(self, texts: list[str]) -> list[tuple]:
        """(groups as text, keys as bytes, A tokens, B tokens, groups) of each text."""
        out = []
        for text, found in zip(texts, self.store.values([self.cuts(t) if t else [] for t in texts]), strict=True):
            if not found:
                out.append(("", b"", 0, 0, 0))
                continue
            said, keys, na, nb, ng = zip(*found, strict=True)
            out.append((";".join(said), b"".join(keys), sum(na), sum(nb), sum(ng)) if all(ng) else ("", b"", 0, 0, 0))
        return out


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner, with its store, for all tasks of a Python worker."""
    return Aligner(path_a, path_b)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays in one zstd frame, each with its kind and length in front."""
    parts = []
    for x in arrays:
        parts += [struct.pack("<cBQ", x.dtype.kind.encode(), x.dtype.itemsize, len(x)), x.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpacked(blob: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(raw):
        kind, width, n = struct.unpack_from("<cBQ", raw, at)
        at += struct.calcsize("<cBQ")
        out.append(np.frombuffer(raw, f"<{kind.decode()}{width}", n, at))
        at += n * width
    return out


def _least_kind(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4" if top < 1 << 32 else "<u8")


def radix_of(b: np.ndarray) -> np.ndarray:
    return ((b * np.uint64(2654435761)) >> np.uint64(7)) % np.uint64(RADIX)


def runs_of(keys: np.ndarray, docs: np.ndarray, a_bits: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """(radix, records, head, body) of the links of some documents; ``docs`` numbers them from 0."""
    width = int(keys.max()).bit_length() if len(keys) else 0
    if width + DOC_BITS + (RADIX - 1).bit_length() > 64:
        raise ValueError("vocabularies too large for one 64-bit record")
    rows = (radix_of(keys >> np.uint64(a_bits)) << np.uint64(width + DOC_BITS)) | (keys << np.uint64(DOC_BITS)) | docs.astype(np.uint64)
    rows.sort()
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    times = np.diff(np.append(first, len(rows)))
    rows = rows[first]
    pair = rows >> np.uint64(DOC_BITS)
    starts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    total = np.add.reduceat(times, starts)
    in_docs = np.diff(np.append(starts, len(rows)))
    radix = (pair[starts] >> np.uint64(width)).astype(np.int64)
    key = pair[starts] & np.uint64((1 << width) - 1)
    doc = (rows & np.uint64((1 << DOC_BITS) - 1)).astype(np.int64)
    step = np.diff(doc, prepend=0)
    step[starts] = doc[starts]
    for r in np.unique(radix).tolist():
        lo, hi = np.searchsorted(radix, [r, r + 1]).tolist()
        x, y = int(starts[lo]), int(starts[hi]) if hi < len(starts) else len(rows)
        head = _packed(_least_kind(np.diff(key[lo:hi], prepend=np.uint64(0))), _least_kind(total[lo:hi]))
        yield r, y - x, head, _packed(_least_kind(in_docs[lo:hi]), _least_kind(step[x:y]), _least_kind(times[x:y]))


def head_of(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (rising) of a run, and how many links of each it holds."""
    steps, totals = _unpacked(blob)
    return np.cumsum(steps, dtype=np.uint64), totals.astype(np.int64)


def body_of(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each record of a run: the number of its pair, its document, and how often it occurs there."""
    in_docs, steps, times = _unpacked(blob)
    in_docs = in_docs.astype(np.int64)
    reach = np.cumsum(steps, dtype=np.int64)
    starts = np.cumsum(in_docs) - in_docs
    before = np.where(starts > 0, reach[np.maximum(starts, 1) - 1], 0)
    return np.repeat(np.arange(len(in_docs)), in_docs), reach - np.repeat(before, in_docs), times.astype(np.int64)


def merged(heads: list[bytes]) -> tuple[list[int], list[int]]:
    """Count of each pair over the runs, by a heap merge in the order of pairs; a run is read in slices."""
    def entries(blob: bytes) -> Iterator[tuple[int, int]]:
        keys, totals = head_of(blob)
        for i in range(0, len(keys), 4096):
            yield from zip(keys[i:i + 4096].tolist(), totals[i:i + 4096].tolist())

    keys, counts = [], []
    last = -1
    for key, n in heapq.merge(*map(entries, heads)):
        if key == last:
            counts[-1] += n
        else:
            keys.append(key)
            counts.append(n)
            last = key
    return keys, counts


def _summed(doc: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Exact sums of whole numbers by document (``bincount`` adds floats: two halves of 26 bits keep them exact)."""
    low = np.bincount(doc, (value & ((1 << 26) - 1)).astype(np.float64), n).astype(np.int64)
    return low + (np.bincount(doc, (value >> 26).astype(np.float64), n).astype(np.int64) << 26)


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    a_bits = Aligner(path_a, path_b, cap=0).a_bits

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al, number = aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        keys, sizes = [], []

        def rows(ids: pa.Array, cols: list[list], n: int) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            given = [pa.array(c if c else [None] * n, k) for c, k in zip(cols, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([ids, *given], names=["id", "spill", "at", "n_a", "n_b", "n_groups", "n_links", "digest", "radix", "records", "head", "body"])

        def runs() -> Iterator[pa.RecordBatch]:
            links = np.frombuffer(b"".join(keys), np.uint64)
            if len(links):
                made = list(runs_of(links, np.repeat(np.arange(len(sizes)), sizes), a_bits))
                yield rows(pa.nulls(len(made), id_kind), [[number] * len(made), *[[]] * 6, *map(list, zip(*made, strict=True))], len(made))

        held = 0
        for batch in batches:
            id_kind, first = batch.column("id").type, 0
            cols: list[list] = [[] for _ in range(7)]
            for i, (said, key, na, nb, ng) in enumerate(al.align(texts_of(batch, "text"))):
                links = len(key) // 8
                for c, v in zip(cols, (number, len(sizes), na, nb, ng, links, hashlib.sha256(said.encode()).hexdigest() if na else ""), strict=True):
                    c.append(v)
                keys.append(key)
                sizes.append(links)
                held += links
                if held >= SPILL or len(sizes) == 1 << DOC_BITS:
                    yield rows(batch.column("id").slice(first, i + 1 - first), [*cols, [], [], [], []], i + 1 - first)
                    yield from runs()
                    first, held, number = i + 1, 0, number + 1
                    cols = [[] for _ in range(7)]
                    keys.clear()
                    sizes.clear()
            if first < batch.num_rows:
                yield rows(batch.column("id").slice(first), [*cols, [], [], [], []], batch.num_rows - first)
        yield from runs()

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spilled = stage(texts.mapInArrow(spill, f"id {kind}, spill long, at int, n_a long, n_b long, n_groups long, n_links long, digest string, "
                                            "radix int, records long, head binary, body binary"), "runs")
    held = {r["radix"]: r["n"] for r in spilled.filter("radix is not null").groupBy("radix").agg(F.sum("records").alias("n")).collect()}  # RADIX rows
    splits = F.array(*[F.lit(max(1, -(-held.get(r, 0) // PER_TASK))) for r in range(RADIX)])
    runs = spilled.filter("radix is not null").withColumn("split", F.pmod(F.xxhash64("spill"), F.element_at(splits, F.col("radix") + 1)).cast("int"))

    def count(group: pa.Table) -> pa.Table:
        keys, counts = merged(group.column("head").to_pylist())
        n = len(keys)
        return pa.table({"radix": group.column("radix").combine_chunks()[:1].take(pa.array(np.zeros(n, np.int64))),
                         "split": group.column("split").combine_chunks()[:1].take(pa.array(np.zeros(n, np.int64))),
                         "pair": pa.array(keys, pa.int64()), "n": pa.array(counts, pa.int64())})

    parts = stage(runs.select("radix", "split", "head").groupBy("radix", "split").applyInArrow(count, "radix int, split int, pair long, n long"), "counts")
    side = F.shiftright("pair", a_bits)
    total = parts.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("most", F.max("total").over(Window.partitionBy(side)))
    known = parts.select("radix", "split", "pair").join(total, "pair")

    def back(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right.column("pair").to_numpy())
        pairs, totals, most = (right.column(c).to_numpy()[order] for c in ("pair", "total", "most"))
        out: list[tuple] = []
        for number, head, body in zip(*[left.column(c).to_pylist() for c in ("spill", "head", "body")], strict=True):
            at = np.searchsorted(pairs, head_of(head)[0].astype(np.int64))
            which, doc, times = body_of(body)
            n = int(doc.max()) + 1
            best = np.bincount(doc, times * (totals[at] == most[at])[which], n).astype(np.int64)
            sums = _summed(doc, totals[at][which] * times, n)
            some = np.flatnonzero(sums)
            out.append((number, _packed(_least_kind(np.diff(some, prepend=0)), _least_kind(best[some]), _least_kind(sums[some]))))
        return pa.table({"spill": pa.array([x[0] for x in out], pa.int64()), "sums": pa.array([x[1] for x in out], pa.binary())})

    sums = runs.select("radix", "split", "spill", "head", "body").groupBy("radix", "split").cogroup(known.groupBy("radix", "split")).applyInArrow(back, "spill long, sums binary")

    def whole(left: pa.Table, right: pa.Table) -> pa.Table:
        at = left.column("at").to_numpy()
        best, count_sum = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for blob in right.column("sums").to_pylist():
            steps, b, c = _unpacked(blob)
            doc = np.cumsum(steps, dtype=np.int64)
            best[doc] += b.astype(np.int64)
            count_sum[doc] += c.astype(np.int64)
        return left.drop_columns(["spill", "at"]).append_column("n_best", pa.array(best[at])).append_column("count_sum", pa.array(count_sum[at]))

    counted = spilled.filter("radix is null").select("spill", "at", "id", "n_a", "n_b", "n_groups", "n_links", "digest")
    out = counted.groupBy("spill").cogroup(stage(sums, "sums").groupBy("spill")).applyInArrow(
        whole, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, digest string, n_best long, count_sum long")
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("digest").alias("groups_sha256"))
