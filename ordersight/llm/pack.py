"""Packing along a space-filling curve: similar documents lie side by side in full sequences.

A document's hashed token vector is projected to three dimensions; the place of that point on a Hilbert curve
is its key.  Rows are tokenised where they are read; their keys and sizes alone are range-sorted (by key and id, so a
run of equal texts may lie over several ranges) and laid end to end, and each row's ids meet their place by the row's
number; the line of tokens is cut at every ``length`` tokens.  A piece's place
is its place in its range plus the tokens of all earlier ranges (one number per range).  Only the very end
is no full sequence; it is cut into powers of two, which need no padding, so no token is padding.

Each document is its token ids as the library gives them (strings of special tokens are those tokens), then id 0.
Null and empty texts are that id 0 alone; equal keys are ordered by id, nulls first; repeated rows are packed each;
an empty table gives no rows.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, mix, small_batches, stage, texts_of
from .units import vocabulary

DIMENSIONS, CURVE_BITS, VECTOR = 3, 16, 1024
LENGTH = 1024

SALT = 11


def _hashed(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dimension and sign of each token id."""
    h = mix(ids.astype(np.uint64), SALT)
    return (h >> np.uint64(54)).astype(np.int64), (h & np.uint64(1)).astype(np.float64) * 2 - 1


_SLOTS, _SIGNS = _hashed(np.arange(1 << 16))
_PROJECTION = np.random.default_rng(7).choice([-1.0, 1.0], (VECTOR, DIMENSIONS))


def hilbert(points: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Places on the Hilbert curve of integer points (rows) with ``bits`` bits in each dimension.

    From the highest bit down, the sub-cube that holds a point says how the curve is turned inside it: lower
    bits are mirrored or swapped with the first axis.  The axes' bits are then Gray-decoded and interleaved.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(dims):
            upper = (x[d] >> b) & 1 == 1
            swap = np.where(upper, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> b) & 1)
    return key


def curve_keys(documents: list[np.ndarray]) -> np.ndarray:
    """Places on the curve of documents given as token ids: each token adds its hashed sign to its hashed dimension."""
    at = np.zeros((len(documents), DIMENSIONS))
    for i, ids in enumerate(documents):
        if len(ids):
            slot, sign = (_SLOTS[ids], _SIGNS[ids]) if ids.itemsize == 2 else _hashed(ids)
            v = np.bincount(slot, sign, VECTOR)
            v = np.sign(v) * np.log1p(np.abs(v))
            at[i] = v @ _PROJECTION / max(1e-9, float(np.sqrt(v @ v)))
    unit = 1.0 / (1.0 + np.exp(-1.702 * at))  # about normal: the curve's cube is filled evenly
    return hilbert(np.minimum((unit * (1 << CURVE_BITS)).astype(np.int64), (1 << CURVE_BITS) - 1))


def ends_of(total: int, length: int) -> np.ndarray:
    """Ends of the last sequences: full ones are not listed, the rest is cut into falling powers of two."""
    at, rest = total - total % length, total % length
    ends = []
    while rest:
        size = 1 << (rest.bit_length() - 1)
        at, rest = at + size, rest - size
        ends.append(at)
    return np.array(ends, np.int64)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Pieces: id_col, start, length, ids (binary), ids_crc32, doc_tokens, sequence_id, offset."""
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary(tokenizer_path)
        end = np.zeros(1, encoder.kind).tobytes()
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = texts_of(batch, "text")
            plain = encoder.encode(texts)
            keys = curve_keys([np.frombuffer(t, encoder.kind) for t in plain])
            ids = [t + end for t in plain]
            sizes = np.array([len(t) // encoder.kind.itemsize for t in ids], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), pa.array(keys), pa.array(ids, pa.binary()), pa.array(sizes)],
                names=["id", "row", "key", "ids", "tokens"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column("tokens").to_numpy()
            first = at + np.cumsum(sizes) - sizes
            at += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("tokens"), pa.array(first), pa.array(np.full(len(sizes), part, np.int32))],
                names=["row", "tokens", "first", "part"])

    small_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # written before the range sort, whose sampling would otherwise map every text once more
    keys = stage(rows.mapInArrow(keyed, f"id {kind}, row long, key long, ids binary, tokens long"), "tokens")
    places = stage(keys.select("id", "row", "key", "tokens").repartitionByRange(n, "key", "id", "row").sortWithinPartitions("key", "id", "row").mapInArrow(
        placed, "row long, tokens long, first long, part int"), "places")
    totals = places.groupBy("part").agg(F.sum("tokens").alias("n")).orderBy("part").collect()  # one row per range
    before, total = {}, 0
    for r in totals:
        before[r["part"]], total = total, total + r["n"]
    # places grow with the documents: one plan at every size
    line = keys.select("id", "row", "ids", "tokens").join(places.select("row", "first", "part").hint("merge"), "row").drop("row")
    width, tail = total - total % length, ends_of(total, length)

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        from_doc, start, size, raw, crc, whole, seq, offset = ([] for _ in range(8))
        item = np.dtype("<u2")
        for i, (ids, tokens, first, part) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("ids", "tokens", "first", "part")], strict=True)):
            here = before[part] + first
            arr = np.frombuffer(ids, item if len(ids) == 2 * tokens else np.dtype("<u4"))
            marks = np.arange(here // length + 1, min(here + tokens - 1, width) // length + 1) * length
            marks = np.concatenate([[here], marks[(marks > here) & (marks < here + tokens)], tail[(tail > max(here, width)) & (tail < here + tokens)], [here + tokens]])
            for a, b in zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True):
                piece = arr[a - here:b - here]
                if a < width:
                    s, o = divmod(a, length)
                else:
                    k = int(np.searchsorted(tail, a, side="right"))
                    s, o = width // length + k, a - (width if k == 0 else int(tail[k - 1]))
                from_doc.append(i)
                start.append(a - here)
                size.append(b - a)
                raw.append(piece.tobytes())
                crc.append(zlib.crc32(piece.astype("<u4").tobytes()))
                whole.append(tokens)
                seq.append(s)
                offset.append(o)
        longs = [pa.array(x, pa.int64()) for x in (start, size, crc, whole, seq, offset)]
        return pa.RecordBatch.from_arrays(
            [batch.column("id").take(pa.array(from_doc, pa.int64())), longs[0], longs[1], pa.array(raw, pa.binary()), *longs[2:]],
            names=[id_col, "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return map_batches(line, cut, f"`{id_col}` {kind}, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
