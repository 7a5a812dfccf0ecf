"""Cross-entropy difference: how much likelier a text is under a target model than under the corpus.

Both models are word trigram models over one shared vocabulary, the distinct tokens of all texts, with the same
interpolation; the corpus counts are scaled to the target's size, so that smoothing weighs the same in both
(matched models).  The target corpus is given as rows of the documents (their ids).  A token is a word in lower
case, a sign, or one character of a script that is written without spaces; an edge mark ends a text.

Texts are cut into tokens once and dealt into chunks of about ``CHUNK`` bytes: the hashes of a chunk's words and the
words' numbers in text order, written by chunk into buckets, so that later steps read a chunk where it lies and only
counts are shuffled.  Counting has two rounds.  First a chunk's distinct 1- and 2-grams with their counts, sorted by
hash, are cut into radixes; a radix adds up the counts of all chunks and gives every chunk the others' share of its own
n-grams back.  A 3-gram with a 2-gram that no other chunk has is in no other chunk either: its count is known where it
is, and only the others go the same way.  With the totals the chunk scores its texts.  So the statistics cover all texts
and grow with them, a frequent n-gram is one entry per chunk, and neither a chunk nor a radix grows with the corpus; the
blocks between them are at most as many as the chunks' distinct n-grams.  Only sums reach the driver.

Per document: tokens (the end mark included), the mean loss of a token (natural log) under either model, and
score = background loss - target loss (higher: closer to the target).  Null and empty texts have the end mark
alone; a text is never cut, a very long one makes its chunk longer; repeated rows count and score each, ids of the target that occur in
no row or repeat count once; an empty target makes both models equal (score 0); an empty table gives no rows.
"""
from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, hash_word, scratch, small_batches, stage, texts_of

#: Bytes of text of a chunk, and bytes of text for each radix of n-grams.
CHUNK, RADIX = 8 << 20, 16 << 20
#: Buckets of chunks at most (Spark's own bound is 100,000).
BUCKETS = 50_000
#: Pseudo counts: of each word of the vocabulary, and of the shorter history's estimate.
BASE, BACK = 0.5, 5.0

# words; one by one: signs, and characters of Thai, Lao, Khmer, Kana and Han texts
_SPACELESS = "฀-໿ក-៿぀-ヿ㐀-鿿豈-﫿"
TOKEN = re.compile(rf"[^\W_{_SPACELESS}]+|\S")
_hashes = Memo(hash_word, cap=500_000)
_EDGE = np.uint64(0x9AE16A3B2F90404F)
_PRIME, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(3)


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def _stir(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def numbered(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the texts' distinct words, the last one of the edge; the place of each position's word among them, an
    edge after each text; each text's number of positions."""
    words = [tokens(t) for t in texts]
    n = np.array([len(w) + 1 for w in words], np.int64)
    coded = pa.array(list(chain.from_iterable(words)), pa.string()).dictionary_encode()
    hashes = np.array([*map(_hashes.__getitem__, coded.dictionary.to_pylist()), _EDGE], np.uint64)
    inside = np.ones(int(n.sum()), bool)
    inside[np.cumsum(n) - 1] = False
    numbers = np.full(len(inside), len(hashes) - 1, np.int32)
    numbers[inside] = coded.indices.to_numpy()
    return hashes, numbers, n


def grams(h: np.ndarray, n: np.ndarray, order: int) -> np.ndarray:
    """Hashes of the n-grams that end at each position of the texts (``n`` positions each), one after another.  The
    last two bits of a hash tell the order."""
    before = np.concatenate([[_EDGE], h[:-1]])  # a text follows the edge of the text before it
    if order == 1:
        out = _stir(h)
    elif order == 2:
        out = _stir(before * _PRIME + h)
    else:
        earlier = np.concatenate([[_EDGE], before[:-1]])
        earlier[np.cumsum(n) - n] = _EDGE
        out = _stir((_stir(earlier * _PRIME + before) + _PRIME) * _PRIME + h)
    return (out & ~_LAST) | np.uint64(order)


def _chunks(rows: DataFrame, kind: str, buckets: int) -> DataFrame:
    """chunk, ids, lengths (positions of each text), words (hashes, frequent ones first), numbers (a word's place among
    them, at each position); one row per chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, parts = TaskContext.get().partitionId() << 32, 0, []

        def packed() -> pa.RecordBatch:
            ids, found = [p for p, _ in parts], [f for _, f in parts]
            words, place = np.unique(np.concatenate([h for h, _, _ in found]), return_inverse=True)
            firsts = np.cumsum([0, *[len(h) for h, _, _ in found]]).tolist()
            at = np.concatenate([place[first:][numbers] for first, (_, numbers, _) in zip(firsts, found, strict=False)])
            order = np.argsort(-np.bincount(at), kind="stable")  # words of one count stay in the order of their hashes
            number = np.empty(len(words), np.uint32)
            number[order] = np.arange(len(words), dtype=np.uint32)
            every, lengths = pa.concat_arrays(ids), pa.array(np.concatenate([n for _, _, n in found]))
            row = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk]), row(every), row(lengths), pa.array([squeezed(np.diff(words[order], prepend=np.uint64(0)))], pa.binary()),
                 pa.array([squeezed(number[at])], pa.binary())], names=["chunk", "ids", "lengths", "words", "numbers"])

        for batch in batches:
            texts = texts_of(batch, "_text")
            sizes = [len(t.encode("utf-8", "surrogatepass")) + 1 for t in texts]
            at = 0
            while at < len(texts):
                to = at
                while to < len(texts) and (held == 0 or held + sizes[to] <= CHUNK):
                    held += sizes[to]
                    to += 1
                if to > at:
                    parts.append((batch.column(0).slice(at, to - at), numbered(texts[at:to])))
                if to < len(texts):
                    yield packed()
                    chunk, held, parts = chunk + 1, 0, []
                at = to
        if parts:
            yield packed()

    return bucketed(rows.mapInArrow(run, f"chunk long, ids array<{kind}>, lengths array<long>, words binary, numbers binary"), "chunks", buckets)


def bucketed(df: DataFrame, name: str, buckets: int) -> DataFrame:
    """``stage`` with the rows in buckets by chunk: what is grouped by chunk later reads them without a shuffle."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").bucketBy(buckets, "chunk").sortBy("chunk").saveAsTable(table, "parquet", path=scratch(spark, name))
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the catalogue's entry alone: the files lie in the shared folder
    return rows


def squeezed(x: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second, and so on, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes())


def restored(block: bytes, kind: type) -> np.ndarray:
    places = np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(places.T).view(kind).ravel()


def _cuts(ranked: np.ndarray, radixes: int) -> np.ndarray:
    """Where the radixes of sorted hashes start, and the end."""
    radix = ((ranked >> np.uint64(32)) * np.uint64(radixes)) >> np.uint64(32)
    return np.searchsorted(radix, np.arange(radixes + 1, dtype=np.uint64))


def _opened(chunk: pa.Table, notes: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's word hashes, the word's number at each position, its texts' numbers of positions, and which positions
    are of the target."""
    words = np.cumsum(restored(chunk.column("words")[0].as_py(), np.uint64))
    n = chunk.column("lengths").combine_chunks().flatten().to_numpy()
    wanted = np.zeros(len(n), bool)
    for marks in notes.filter(pc.equal(notes.column("step"), 0)).column("marks").to_pylist():
        wanted[marks] = True
    return words, restored(chunk.column("numbers")[0].as_py(), np.uint32), n, np.repeat(wanted, n)


def _own(h: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Distinct hashes, their counts in the chunk's texts and in those of the target."""
    ranked, corpus = np.unique(h, return_counts=True)
    mine, n = np.unique(h[wanted], return_counts=True)
    target = np.zeros(len(ranked), np.int64)
    target[np.searchsorted(ranked, mine)] = n
    return ranked, {"corpus": corpus, "target": target}


def _placed(at: np.ndarray, size: int, wanted: np.ndarray) -> dict[str, np.ndarray]:
    """The same counts by each position's place among the distinct hashes."""
    return {"corpus": np.bincount(at, minlength=size), "target": np.bincount(at[wanted], minlength=size)}


def _singles(words: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the 1-grams, each position's place among them."""
    h = grams(words, np.empty(0, np.int64), 1)
    order = np.argsort(h)
    place = np.empty(len(h), np.int64)
    place[order] = np.arange(len(h))
    return h[order], place[numbers]


def _others(notes: pa.Table, step: int) -> dict[str, np.ndarray]:
    """Counts in all other chunks of the n-grams of a step, sorted by hash."""
    rows = notes.filter(pc.equal(notes.column("step"), step)).sort_by("radix")
    return {c: np.concatenate([np.empty(0, np.int64), *[restored(b, np.int64) for b in rows.column(c).to_pylist()]]) for c in ("corpus", "target")}


def _is_single(single: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Which of the 1- and 2-grams, sorted by hash together, are 1-grams."""
    return np.sort(np.concatenate([single, ranked])) & _LAST == 1


def _may_recur(n: np.ndarray, at: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Positions whose 3-gram may be in another chunk: both of its 2-grams are, ``at`` being the places of the 2-grams.
    The first of the two at a text's first position is two edges, which every chunk has."""
    two = (others > 0)[at]
    one = np.roll(two, 1)
    one[np.cumsum(n) - n] = True
    return one & two


def _counted(chunks: DataFrame, notes: DataFrame, step: int, radixes: int) -> DataFrame:
    """chunk, radix, grams (steps from hash to hash), corpus, target (counts) of each chunk's 1- and 2-grams (step 1), or
    of its 3-grams that may be in other chunks (step 2)."""
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        words, numbers, n, wanted = _opened(left, right)
        h = words[numbers]
        two = grams(h, n, 2)
        if step == 1:
            single, at = _singles(words, numbers)
            ranked, counts = _own(two, wanted)
            order = np.argsort(np.concatenate([single, ranked]))
            ranked = np.concatenate([single, ranked])[order]
            counts = {c: np.concatenate([x, counts[c]])[order] for c, x in _placed(at, len(single), wanted).items()}
        else:
            ranked, at = np.unique(two, return_inverse=True)
            ones = _is_single(_singles(words, numbers)[0], ranked)
            some = _may_recur(n, at, _others(right, 1)["corpus"][~ones])
            ranked, counts = _own(grams(h, n, 3)[some], wanted[some])
        cuts = _cuts(ranked, radixes)
        spans = [(r, int(a), int(b)) for r, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
        return pa.table({"chunk": pa.array([key[0].as_py()] * len(spans), pa.int64()), "radix": pa.array([r for r, _, _ in spans], pa.int32()),
                         "grams": pa.array([squeezed(np.diff(ranked[a:b], prepend=np.uint64(0))) for _, a, b in spans], pa.binary()),
                         **{c: pa.array([squeezed(x[a:b].astype(np.uint32)) for _, a, b in spans], pa.binary()) for c, x in counts.items()}})

    return chunks.select("chunk", "lengths", "words", "numbers").groupBy("chunk").cogroup(notes.groupBy("chunk")).applyInArrow(
        run, "chunk long, radix int, grams binary, corpus binary, target binary")


def _totals(counted: DataFrame, step: int) -> DataFrame:
    """chunk, step, radix, corpus, target (the counts of the chunk's n-grams in all other chunks); words, n_corpus,
    n_target of the radix's single tokens, on one of its rows."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        chunks, blocks = table.column("chunk"), [np.cumsum(restored(b, np.uint64)) for b in table.column("grams").to_pylist()]
        ends = np.cumsum([len(b) for b in blocks]).tolist()
        spans = list(zip([0, *ends[:-1]], ends, strict=True))
        ranked, at = np.unique(np.concatenate(blocks), return_inverse=True)
        counts = {c: np.concatenate([restored(b, np.uint32) for b in table.column(c).to_pylist()]) for c in ("corpus", "target")}
        sums = {c: np.bincount(at, x, len(ranked)).astype(np.int64) for c, x in counts.items()}
        single = (ranked & _LAST) == 1
        once = lambda n: pa.array([int(n)] + [0] * (len(blocks) - 1), pa.int64())
        return pa.table({"chunk": chunks, "step": pa.array([step] * len(blocks), pa.int32()), "radix": table.column("radix"),
                         **{c: pa.array([squeezed(s[at[a:b]] - counts[c][a:b]) for a, b in spans], pa.binary()) for c, s in sums.items()},
                         "words": once(single.sum()), "n_corpus": once(sums["corpus"][single].sum()), "n_target": once(sums["target"][single].sum())})

    return stage(counted.groupBy("radix").applyInArrow(
        run, "chunk long, step int, radix int, corpus binary, target binary, words long, n_corpus long, n_target long"), "totals")


def losses(counts: np.ndarray, at: np.ndarray, starts: np.ndarray, edge: float, total: float, words: int, scale: float) -> np.ndarray:
    """The loss of each position: interpolated trigram estimates from the counts of the n-grams numbered ``at``
    (order, position).  A text's first position follows the edge, which every text has once (``edge`` times)."""
    one, two, three = counts[at] * scale
    history, longer = np.roll(one, 1), np.roll(two, 1)
    history[starts] = longer[starts] = edge * scale
    p = (one + BASE) / (total * scale + BASE * words)
    p = (two + BACK * p) / (history + BACK)
    return -np.log((three + BACK * p) / (longer + BACK))


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, tokens, target_loss, background_loss, score of every row; ``target_ids`` has one column of ids."""
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    chunks = _chunks(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), kind, min(BUCKETS, 1 + size // CHUNK))
    ids = target_ids.select(F.col(target_ids.columns[0]).alias("id")).dropna().distinct()
    # the ids grow with the documents: one plan at every size, a merge join of ids alone
    marks = chunks.select("chunk", F.posexplode("ids").alias("pos", "id")).join(ids.hint("merge"), "id").groupBy("chunk").agg(
        F.collect_list("pos").alias("marks"))
    # notes: of step 0 the marks, of steps 1 and 2 the totals, side by side
    marks = stage(marks.selectExpr("chunk", "0 AS step", "-1 AS radix", *[f"CAST(NULL AS BINARY) AS {c}" for c in ("corpus", "target")], "marks"), "marks")
    noted = lambda totals: totals.select("chunk", "step", "radix", "corpus", "target", F.lit(None).cast("array<int>").alias("marks"))
    radixes = 1 + size // RADIX
    totals = _totals(_counted(chunks, marks, 1, radixes), 1)
    sums = totals.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("words", "n_corpus", "n_target")]).first()
    words, n_corpus, n_target = sums["words"], sums["n_corpus"], sums["n_target"]
    model, scale = ("target", n_target / n_corpus) if n_target else ("corpus", 1.0)
    notes = marks.union(noted(totals))
    notes = notes.union(noted(_totals(_counted(chunks, notes, 2, radixes), 2)))

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        known, numbers, n, wanted = _opened(left, right)
        h = known[numbers]
        single, one = _singles(known, numbers)
        ranked, two = np.unique(grams(h, n, 2), return_inverse=True)
        longer, three = np.unique(grams(h, n, 3), return_inverse=True)
        counts = [_placed(x, len(g), wanted) for x, g in ((one, single), (two, ranked), (three, longer))]
        short, long, ones = _others(right, 1), _others(right, 2), _is_single(single, ranked)
        some = np.zeros(len(longer), bool)
        some[three[_may_recur(n, two, short["corpus"][~ones])]] = True
        for c in ("corpus", "target"):
            counts[0][c] += short[c][ones]
            counts[1][c] += short[c][~ones]
            counts[2][c][some] += long[c]
        at = np.stack([one, two + len(single), three + len(single) + len(ranked)])
        starts = np.cumsum(n) - n
        edge = at[0, -1]  # the last position is an edge
        made = []
        for name, part in ((model, 1.0), ("corpus", scale)):
            every = np.concatenate([x[name] for x in counts])
            total = n_target if name == "target" else n_corpus
            made.append(np.add.reduceat(losses(every, at, starts, float(every[edge]), total, words, part), starts) / n)
        return pa.table({id_col: pa.chunked_array([c.flatten() for c in left.column("ids").chunks], left.schema.field("ids").type.value_type),
                         "tokens": n, "target_loss": made[0], "background_loss": made[1], "score": made[1] - made[0]})

    return chunks.select("chunk", "ids", "lengths", "words", "numbers").groupBy("chunk").cogroup(notes.groupBy("chunk")).applyInArrow(
        run, f"`{id_col}` {kind}, tokens long, target_loss double, background_loss double, score double")
