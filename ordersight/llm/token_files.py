"""Token files with directly addressable codes: any token is read from its bits, without decoding a block.

An id is cut into chunks of ``CHUNK`` bits, lowest first.  Level 0 holds the first chunk of every id; a bit for each
chunk tells whether its id goes on, and those that go on lie in the next level in the same order.  So the place of
an id's next chunk is the number of ones before its bit: a rank, from a directory of counts at every
``RANK_BITS`` bits and one count inside.  Small ids take one chunk, large ones as many as they need, and a run of tokens
is a run in every level.

A token file is a folder: ``segments`` has one row for a run of whole documents (their ids, where each ends, the codes)
and ``parts`` the number of the first token of each range of documents.  Documents lie in ascending id order, nulls
first, equal ids in input order.  Texts are shuffled by id ranges and encoded there; a task writes its segments as
it goes, so it holds one segment and one batch of texts, and a lost executor repeats its range.

Defined cases: a document is its ids and the end id, so null and empty texts are the end id alone; strings of special
tokens are what the library makes of them; repeated rows are written each; an empty table gives files without rows.
"""
from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, small_batches, texts_of
from .units import vocabulary

CHUNK, RANK_BITS = 8, 512
#: Tokens after which a segment is closed; a longer document is a segment of its own.
SEGMENT = 1 << 15
MAGIC = b"DAC1"


class Codes:
    """The directly addressable codes of one segment."""

    def __init__(self, blob: bytes):
        magic, self.n, levels = struct.unpack_from("<4sQB", blob)
        if magic != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        at, self.levels = struct.calcsize("<4sQB"), []
        count = self.n
        for level in range(levels):
            chunks = np.frombuffer(blob, np.uint8, count, at)
            at += count
            if level == levels - 1:  # none of the last level's ids goes on
                self.levels.append((chunks, None, None))
                break
            size, marks = (count + 7) // 8, count // RANK_BITS + 1
            bits = np.frombuffer(blob, np.uint8, size, at)
            ranks = np.frombuffer(blob, "<u4", marks, at + size)
            at += size + 4 * marks
            self.levels.append((chunks, bits, ranks))
            count = self._rank(level, count)

    @staticmethod
    def pack(ids: np.ndarray) -> bytes:
        parts, rest = [], ids
        while True:
            parts.append((rest & rest.dtype.type((1 << CHUNK) - 1)).astype(np.uint8).tobytes())
            more = rest >> rest.dtype.type(CHUNK)
            goes_on = more > 0
            if not goes_on.any():
                break
            parts.append(np.packbits(goes_on, bitorder="little").tobytes())
            before = np.concatenate([[0], np.cumsum(goes_on)])
            parts.append(before[:len(rest) + 1:RANK_BITS].astype("<u4").tobytes())
            rest = more[goes_on]
        return b"".join([struct.pack("<4sQB", MAGIC, len(ids), len(parts) // 3 + 1), *parts])

    def _rank(self, level: int, i: int) -> int:
        """Ones before bit ``i``."""
        _, bits, ranks = self.levels[level]
        mark = i // RANK_BITS
        first, last = mark * RANK_BITS // 8, i // 8
        inside = int(np.bitwise_count(bits[first:last]).sum())
        part = int(bits[last] & ((1 << i % 8) - 1)).bit_count() if i % 8 else 0
        return int(ranks[mark]) + inside + part

    def __getitem__(self, i: int) -> int:
        """Id ``i``: one chunk and one rank for each of its levels."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[i]) << CHUNK * level
            if bits is None or not bits[i // 8] >> i % 8 & 1:
                break
            i = self._rank(level, i)
        return value

    def run(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``: the run that they are in every level."""
        out = np.zeros(stop - start, np.uint64)
        at = np.arange(stop - start)
        for level, (chunks, bits, _) in enumerate(self.levels):
            out[at] |= chunks[start:stop].astype(np.uint64) << np.uint64(CHUNK * level)
            if bits is None or start == stop:
                break
            goes_on = np.unpackbits(bits[start // 8:(stop + 7) // 8], bitorder="little")[start % 8:start % 8 + stop - start] == 1
            start = self._rank(level, start)
            at = at[goes_on]
            stop = start + len(at)
        return out


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the token files of ``docs`` to the new folder."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, part = vocabulary(tokenizer_path), TaskContext.get().partitionId()
        end = np.array([end_id], vocab.kind).tobytes()
        held, sizes, kept, at, count = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(kept), vocab.kind)
            names = pa.concat_arrays(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([at], pa.int64()), pa.array([len(ids)], pa.int64()), names[:1], names[-1:],
                 pa.ListArray.from_arrays([0, len(names)], names), pa.array([list(accumulate(sizes))], pa.list_(pa.int64())), pa.array([Codes.pack(ids)], pa.binary())],
                names=["part", "start", "n_tokens", "first_id", "last_id", "ids", "ends", "codes"])

        for batch in batches:
            if not batch.num_rows:
                continue
            names, first = batch.column("id"), 0
            for i, ids in enumerate(vocab.encode(texts_of(batch, "text"))):
                kept += [ids, end]
                sizes.append((len(ids) + len(end)) // vocab.kind.itemsize)
                count += sizes[-1]
                if count >= SEGMENT:
                    held.append(names.slice(first, i + 1 - first))
                    yield close()
                    at, first = at + count, i + 1
                    held, sizes, kept, count = [], [], [], 0
            if first < batch.num_rows:
                held.append(names.slice(first))
        if kept:
            yield close()

    schema = f"part int, start long, n_tokens long, first_id {kind}, last_id {kind}, ids array<{kind}>, ends array<long>, codes binary"
    rows.repartitionByRange(n, "id", "row").sortWithinPartitions("id", "row").mapInArrow(encoded, schema).write.option("compression", "zstd").parquet(f"{folder}/segments")
    sizes = spark.read.parquet(f"{folder}/segments").groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()  # one row per range
    starts = accumulate([r["n"] for r in sizes], initial=0)
    parts = [(r["part"], s) for r, s in zip(sizes, starts)]
    spark.createDataFrame(parts, "part int, part_start long").coalesce(1).write.parquet(f"{folder}/parts")


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """The segments of token files; ``start`` counts the tokens of all segments before."""
    parts = F.broadcast(spark.read.parquet(f"{folder}/parts"))  # one row per range of the writing shuffle
    return spark.read.parquet(f"{folder}/segments").join(parts, "part").withColumn("start", F.col("start") + F.col("part_start")).drop("part_start")


def documents(spark: SparkSession, folder: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """id_col, start, n_tokens, ids (little-endian 32-bit binary, left out without ``with_ids``), ids_crc32 of all documents in token files."""
    rows = segments(spark, folder).select("start", "ids", "ends", "codes")
    kind = rows.schema["ids"].dataType.elementType.simpleString()

    def decode(batch: pa.RecordBatch) -> pa.RecordBatch:
        start, size, raw, crc = [], [], [], []
        names = batch.column(1).flatten()
        for first, ends, blob in zip(*[batch.column(c).to_pylist() for c in ("start", "ends", "codes")], strict=True):
            ids = memoryview(Codes(blob).run(0, ends[-1]).astype("<u4").tobytes())
            for a, b in zip([0, *ends], ends):
                start.append(first + a)
                size.append(b - a)
                crc.append(zlib.crc32(ids[4 * a:4 * b]))
                if with_ids:
                    raw.append(bytes(ids[4 * a:4 * b]))
        cols = {id_col: names, "start": pa.array(start, pa.int64()), "n_tokens": pa.array(size, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
        return pa.RecordBatch.from_pydict(cols | ({"ids": pa.array(raw, pa.binary())} if with_ids else {}))

    return map_batches(rows, decode, f"`{id_col}` {kind}, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else ""))


def tokens_at(spark: SparkSession, folder: str, places: DataFrame, place_col: str = "place") -> DataFrame:
    """place_col, token: single tokens by their number in the files; numbers outside the files give no row.

    Places are met with segments by their number divided by the segment size: a segment lies in few such cells.  Only the
    segments asked for are sent on, each place reads its own bits.
    """
    cell = lambda c: F.floor(c / F.lit(SEGMENT))
    spans = segments(spark, folder).select("start", "n_tokens", "codes", F.explode(F.sequence(cell(F.col("start")), cell(F.col("start") + F.col("n_tokens") - 1))).alias("cell"))
    asked = places.select(F.col(place_col).cast("long").alias("place")).withColumn("cell", cell(F.col("place")))
    # places of a segment in lists of bounded length, so a segment asked for by many rows is sent many times, not in one list
    lists = asked.groupBy("cell", F.pmod(F.floor("place"), F.lit(64)).alias("salt")).agg(F.collect_set("place").alias("places"))
    met = spans.join(lists, "cell").select("start", "n_tokens", "codes", "places")

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        place, token = [], []
        for start, n, blob, asked_for in zip(*[batch.column(c).to_pylist() for c in ("start", "n_tokens", "codes", "places")], strict=True):
            codes = Codes(blob)
            for p in asked_for:
                if start <= p < start + n:
                    place.append(p)
                    token.append(codes[p - start])
        return pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(token, pa.int64())], names=["place", "token"])

    found = map_batches(met, look, "place long, token long")
    return asked.select("place").join(found, "place").select(F.col("place").alias(place_col), "token")
