"""Near-duplicate texts by Order MinHash, verified by banded alignment.

A text's k-mers are labelled with their occurrence number, so repeats count.  Each of ``SKETCHES`` hash functions
takes the two smallest of them and keeps their order in the text: texts that share words in another order do not
collide, texts at a small edit distance do.  ``FUNCTIONS`` says how many functions take k-mers of how many words:
five words find texts of equal passages, three words also those whose changed words lie apart, down to the
threshold.  A text shorter than a k-mer is one k-mer.  Equal word sequences are one class first; classes that share
a sketch value are candidates.

In a bucket (function, value) of at most ``SMALL`` classes all pairs are candidates.  A larger bucket pairs every
class with the bucket's leader, so it gives rows in proportion to its size.  Leaders are drawn by one hash for
all functions: a class mostly meets the same leader again, and the pair counts once.  Classes that
verification does not put into the leader's component meet again in finer buckets (this value and the next
functions', twice as many each time), until those are small or agree in all functions.  That only joins large
families early.  At last every class outside the largest component of a large bucket meets all classes of the
bucket that are in other components, in blocks of about ``BLOCK`` x ``BLOCK`` classes (fewer where texts are long).
A block verifies its pairs itself and unites components as it goes, so it leaves a spanning forest: fewer links
than it has rows.  A pair that shares a value is verified (under the first function whose value it shares), in one
component already, or ruled out by its lengths or word counts, which bound the distance from below.

Candidates are verified: the edit distance of the two word sequences, aligned inside the band that the
threshold allows, must leave a similarity ``1 - distance / longer length`` of at least 0.8.

Defined cases: texts without a word (null, empty, signs only) are never linked; ties of ids go to the
smaller id, null ids last; repeated rows are copies, of which one is kept; an empty table gives no rows.
"""
from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, Memo, hash_word, map_batches, mix, stage, texts_of
from .graph import components, merged

#: (words of a k-mer, hash functions)
FUNCTIONS = ((5, 8), (3, 20))
SKETCHES, SMALL = sum(n for _, n in FUNCTIONS), 8
BLOCK, BLOCK_WORDS, BINS = 512, 1 << 21, 512
SIMILARITY = 0.8

_SALTS = (np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x5851F42D4C957F2D))[:, None]
_words = Memo(hash_word)


def tokens(text: str) -> np.ndarray:
    words = WORD.findall(text.lower())
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def kmers(toks: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the occurrence-labelled k-mers of ``size`` words, in text order."""
    n = max(1, len(toks) - size + 1)
    width = min(size, len(toks))
    h = np.zeros(n, np.uint64)
    for i in range(width):
        h = (h ^ toks[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    ranked = h[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    if not new.all():
        at = np.arange(n)
        occurrence = np.empty(n, np.uint64)
        occurrence[order] = at - np.maximum.accumulate(np.where(new, at, 0))
        h = h + occurrence * np.uint64(0xD6E8FEB86659FD93)
    return h


def _smallest(hashes: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """Of each function the two smallest k-mers, in text order, as one value."""
    v = mix(hashes[None, :], salts)
    if v.shape[1] == 1:
        return v[:, 0]
    two = np.sort(np.argpartition(v, 1, axis=1)[:, :2], axis=1)
    first, second = np.take_along_axis(v, two, axis=1).T
    return first * np.uint64(0x9E3779B97F4A7C15) ^ second


def sketch(toks: np.ndarray) -> np.ndarray:
    """One value for each function."""
    ends = np.cumsum([n for _, n in FUNCTIONS])
    return np.concatenate([_smallest(kmers(toks, size), _SALTS[end - n:end]) for (size, n), end in zip(FUNCTIONS, ends, strict=True)])


def edit_distance(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Edit distance of two sequences, or limit + 1 where it is larger.

    Furthest-reaching points on the diagonals of the band |i - j| <= limit, one error after another; common
    ends are cut off first, and unlike word counts reject without alignment.
    """
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    n = min(len(a), len(b))
    unlike = np.flatnonzero(a[:n] != b[:n])
    front = int(unlike[0]) if len(unlike) else n
    a, b = a[front:], b[front:]
    n = min(len(a), len(b))
    unlike = np.flatnonzero(a[::-1][:n] != b[::-1][:n])
    back = int(unlike[0]) if len(unlike) else n
    a, b = a[:len(a) - back], b[:len(b) - back]
    if not len(a) or not len(b):
        return max(len(a), len(b)) if max(len(a), len(b)) <= limit else limit + 1
    values, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    excess = np.bincount(at[:len(a)], minlength=len(values)) - np.bincount(at[len(a):], minlength=len(values))
    if max(excess[excess > 0].sum(), -excess[excess < 0].sum()) > limit:
        return limit + 1
    la, lb, goal = len(a), len(b), len(b) - len(a)
    pa_, pb = np.append(at[:la], -1), np.append(at[la:], -2)
    reach = np.full(2 * limit + 3, -2, np.int64)  # furthest i on diagonal j - i = d, at d + limit + 1
    mid = limit + 1

    def slide(d: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Follow equal words down the diagonals."""
        live = np.arange(len(d))
        for _ in range(6):
            same = pa_[i[live]] == pb[np.minimum(i[live] + d[live], lb)]
            live = live[same]
            if not len(live):
                return i
            i[live] += 1
        for k in live.tolist():
            x, step = int(i[k]), 64
            while True:
                m = min(step, la - x, lb - x - int(d[k]))
                stop = np.flatnonzero(at[x:x + m] != at[la + x + int(d[k]):la + x + int(d[k]) + m])
                if len(stop):
                    x += int(stop[0])
                    break
                x, step = x + m, step * 4
                if x >= la or x + int(d[k]) >= lb:
                    break
            i[k] = x
        return i

    for e in range(limit + 1):
        lo, hi = max(-e, -la, -limit), min(e, lb, limit)
        d = np.arange(lo, hi + 1)
        at_d = d + mid
        if e == 0:
            i = np.zeros(1, np.int64)
        else:
            i = np.maximum(np.maximum(reach[at_d] + 1, reach[at_d - 1]), reach[at_d + 1] + 1)
            i = np.minimum(np.minimum(i, la), lb - d)
        ok = (i >= 0) & (i + d >= 0)
        i = np.where(ok, i, -2)
        which = np.flatnonzero(ok)
        i[which] = slide(d[which], i[which])
        reach[at_d] = i
        if lo <= goal <= hi and reach[goal + mid] >= la:
            return e
    return limit + 1


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    longer = max(len(a), len(b))
    limit = int(np.floor((1 - least) * longer + 1e-9))
    return longer > 0 and edit_distance(a, b, limit) <= limit


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number each, written to the shared folder, so that a number stays with its row."""
    name = "_row"
    while name in docs.columns:
        name += "_"
    return stage(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def _classes(rows: DataFrame) -> DataFrame:
    """row, id, key (equal for equal word sequences), words, sketch."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, sizes, sketches = [], [], []
        for text in texts_of(batch, "text"):
            t = tokens(text)
            sizes.append(len(t))
            keys.append(xxhash.xxh3_128_digest(t.tobytes()) if len(t) else None)
            sketches.append(sketch(t).view(np.int64) if len(t) else None)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.list_(pa.int64()))],
            names=["row", "id", "key", "words", "sketch"])

    return stage(map_batches(rows, run, f"row long, id {kind}, key binary, words long, sketch array<long>"), "sketches")


def _candidates(buckets: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Pairs (a < b) of the buckets (bucket, rep, words, ...), and the rows of buckets over ``SMALL``.

    Most buckets hold one class; the rows of the others are written once, for the pairs and for later rounds.
    """
    size = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("rep").alias("h"), "rep", "words")).alias("lead"))
    sized = stage(buckets.join(size.filter("n > 1"), "bucket").withColumns({"leader": F.col("lead.rep"), "leader_words": F.col("lead.words")}).drop("lead"), "shared")
    fits = lambda x, y: F.least(x, y) >= least * F.greatest(x, y) - 1e-9
    small = sized.filter(F.col("n") <= SMALL).select("bucket", "rep", "words")
    pairs = small.alias("s").join(small.alias("t"), "bucket").filter((F.col("s.rep") < F.col("t.rep")) & fits(F.col("s.words"), F.col("t.words"))).select(
        F.col("s.rep").alias("a"), F.col("t.rep").alias("b"))
    large = sized.filter(F.col("n") > SMALL)
    led = large.filter((F.col("leader") != F.col("rep")) & fits(F.col("words"), F.col("leader_words")))
    return pairs.union(led.select(F.least("rep", "leader").alias("a"), F.greatest("rep", "leader").alias("b"))), large


def word_counts(toks: np.ndarray) -> np.ndarray:
    """Words counted in ``BINS`` bins by hash, up to 255 each: differences are at most those of the words."""
    return np.minimum(np.bincount((toks % np.uint64(BINS)).astype(np.int64), minlength=BINS), 255).astype(np.uint8)


def _across(buckets: DataFrame, linked: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links (a < b) of similar classes that share one of the buckets, all over ``SMALL``, and lie in different components.

    A block's links are a spanning forest of its components under similarity, so they are fewer than its rows, and
    no component that its pairs connect stays apart.  The blocks grow with the classes outside the bucket's largest
    component, times the bucket.
    """
    named = buckets.select("bucket", "at", "rep", "words").join(linked.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
        "bucket", "at", "rep", "words", F.coalesce("component", "rep").alias("comp"))
    parts = named.groupBy("bucket", "comp").agg(F.count("*").alias("n"), F.sum("words").alias("w")).groupBy("bucket").agg(
        F.max(F.struct("n", "w", "comp")).alias("top"), F.sum("n").alias("n"), F.sum("w").alias("w")).filter((F.col("n") > SMALL) & (F.col("n") > F.col("top.n")))
    blocks = lambda n, w: F.greatest(F.ceil(n / BLOCK), F.ceil(w / BLOCK_WORDS)).cast("int")
    sizes = parts.select("bucket", F.col("top.comp").alias("main"), blocks(F.col("n"), F.col("w")).alias("all"),
                         blocks(F.col("n") - F.col("top.n"), F.col("w") - F.col("top.w")).alias("rest"))
    rows = stage(named.drop("words").join(sizes, "bucket"), "mixed")

    def spell(batch: pa.RecordBatch) -> pa.RecordBatch:
        toks = [tokens(t) for t in texts_of(batch, "text")]
        return pa.RecordBatch.from_arrays([batch.column("row"), pa.array([t.tobytes() for t in toks], pa.binary()), pa.array([sketch(t).tobytes() for t in toks], pa.binary())],
                                          names=["rep", "toks", "values"])

    asked = texts.select("row", "text").join(rows.select(F.col("rep").alias("row")).distinct(), "row", "left_semi")
    spelt = rows.join(stage(map_batches(asked, spell, "rep long, toks binary, values binary"), "words"), "rep")
    part = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    cols = ["at", "rep", "comp", "toks", "values"]
    rest = spelt.filter("comp <> main").select("bucket", part("rest").alias("i"), every("all").alias("j"), *cols, F.lit(True).alias("asks"), F.lit(False).alias("is_main"))
    whole = spelt.select("bucket", every("rest").alias("i"), part("all").alias("j"), *cols, F.lit(False).alias("asks"), (F.col("comp") == F.col("main")).alias("is_main"))

    def meet(key, table):
        asks, is_main, rep = (table.column(c).to_numpy() for c in ("asks", "is_main", "rep"))
        label = np.unique(table.column("comp").to_numpy(), return_inverse=True)[1]
        function = table.column("at")[0].as_py()
        toks = [np.frombuffer(t, np.uint64) for t in table.column("toks").to_pylist()]
        values = np.frombuffer(b"".join(table.column("values").to_pylist()), np.int64).reshape(-1, SKETCHES)
        words = np.array([len(t) for t in toks], np.int64)
        counts = np.stack([word_counts(t) for t in toks])
        sums = counts.sum(axis=1, dtype=np.int64)
        other = np.flatnonzero(~asks)
        a, b = [], []
        for x in np.flatnonzero(asks).tolist():
            # two classes of the rest meet twice: the smaller one asks
            y = other[(label[other] != label[x]) & (is_main[other] | (rep[x] < rep[other]))]
            # and under several functions: the first whose value they share
            y = y[(values[x] == values[y]).argmax(axis=1) == function]
            limit = np.floor((1 - least) * np.maximum(words[x], words[y]) + 1e-9)
            near = np.abs(words[x] - words[y]) <= limit
            y, limit = y[near], limit[near]
            unlike = np.maximum(sums[x], sums[y]) - np.minimum(counts[x], counts[y]).sum(axis=1, dtype=np.int64)
            y = y[unlike <= limit][np.argsort(unlike[unlike <= limit], kind="stable")]
            while len(y):
                z, y = int(y[0]), y[1:]
                if similar(toks[x], toks[z], least):
                    a.append(min(rep[x], rep[z]))
                    b.append(max(rep[x], rep[z]))
                    label[label == label[z]] = label[x]
                    y = y[label[y] != label[x]]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    # a block's work is far more than its bytes: a stated number of partitions is not merged by size
    spark = texts.sparkSession
    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    return rest.unionByName(whole).repartition(spread, "bucket", "i", "j").groupBy("bucket", "i", "j").applyInArrow(meet, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) of row numbers whose texts are similar."""
    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        left, right = texts_of(batch, "ta"), texts_of(batch, "tb")
        known = lru_cache(maxsize=64)(tokens)  # a leader's text comes again and again
        keep = [similar(known(x), known(y), least) for x, y in zip(left, right, strict=True)]
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # the pair's second text is met under the first's, so a hot class is split like any skewed join side
    one = pairs.join(docs.select(F.col("row").alias("a"), F.col("text").alias("ta")), "a")
    two = one.join(docs.select(F.col("row").alias("b"), F.col("text").alias("tb")), "b")
    return map_batches(two.select("a", "b", "ta", "tb"), check, "a long, b long")


def _asked(table: DataFrame, rows: DataFrame, by: str, name: str) -> DataFrame:
    """The rows of ``table`` whose number ``by`` is in ``rows`` (one column), written once.

    The numbers grow with the documents: one plan at every size, a merge join of numbers alone.
    """
    return stage(table.join(rows.toDF(by).distinct().hint("merge"), by, "left_semi"), name)


def groups(numbered: DataFrame, row_col: str, id_col: str, text_col: str, least: float = SIMILARITY) -> DataFrame:
    """row, id, rep (first row of the exact class), group (smallest rep of linked classes)."""
    texts = numbered.select(F.col(row_col).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = _classes(texts)
    reps = rows.filter("key is not null").groupBy("key").agg(F.min("row").alias("rep"), F.min("words").alias("words"), F.min_by("sketch", "row").alias("sketch"))
    reps = stage(reps, "classes")
    # a class has a row in every function: its sketch stays with the class and is joined where finer buckets ask for it
    level = reps.select("rep", "words", F.posexplode("sketch").alias("i", "v")).select(
        "rep", "words", F.col("i").alias("at"), F.lit(1).alias("depth"), F.xxhash64("i", "v").alias("bucket"))
    level = stage(level, "buckets")
    buckets, linked, tested = None, None, None
    while True:
        pairs, large = _candidates(level, least)
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        if buckets is None:
            # texts are the bulk of the data: all of them are dealt out once, to keep those of a pair or a large bucket
            buckets, hot = large, large.select("rep")
            texts = _asked(texts.select("row", "text"), pairs.select("a").union(pairs.select("b")).union(hot), "row", "asked")
        found = stage(_verified(pairs, texts, least), "verified")
        if tested is None:
            texts, sketches = _asked(texts, hot, "row", "asked"), _asked(reps.select("rep", "sketch"), hot, "rep", "asked")
        tested = pairs if tested is None else tested.union(pairs)
        linked = components(found) if linked is None else merged(linked, found)
        comp = lambda c: F.coalesce(F.col(f"{c}_comp"), F.col(c))
        named = lambda c: linked.select(F.col("node").alias(c), F.col("component").alias(f"{c}_comp"))
        open_rows = large.join(named("rep"), "rep", "left").join(named("leader"), "leader", "left").filter(comp("rep") != comp("leader"))
        steps = F.sequence(F.col("depth"), F.least(2 * F.col("depth"), F.lit(SKETCHES)) - 1)
        more = F.transform(steps, lambda k: F.element_at("sketch", (F.col("at") + k) % SKETCHES + 1))
        level = stage(open_rows.filter(F.col("depth") < SKETCHES).join(sketches, "rep").select(
            "rep", "words", "at", F.least(2 * F.col("depth"), F.lit(SKETCHES)).alias("depth"), F.xxhash64("bucket", more).alias("bucket")), "finer")
        if level.isEmpty():
            break
    linked = merged(linked, stage(_across(buckets, linked, texts, least), "verified"))
    group = rows.join(reps.select("key", "rep"), "key", "left").join(linked.withColumnRenamed("node", "rep"), "rep", "left")
    return group.select("row", "id", F.coalesce("rep", "row").alias("rep"), F.coalesce("component", "rep", "row").alias("group"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """id_col, class_id (smallest id of equal word sequences), group_id (smallest id of the linked group), kept.

    One row of each group is kept: the one with the smallest id, then the first.
    """
    numbered, row = _numbered(docs.select(id_col, text_col))
    named = stage(groups(numbered, row, id_col, text_col, least), "groups")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    by_class = named.groupBy("rep").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id"))["id"].alias("class_id"))
    by_group = named.groupBy("group").agg(F.min(first).alias("first"))
    return named.join(by_class, "rep").join(by_group, "group").select(
        F.col("id").alias(id_col), "class_id", F.col("first.id").alias("group_id"), (F.col("row") == F.col("first.row")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` (all columns), one of each group of near-duplicates."""
    numbered, row = _numbered(docs)
    named = stage(groups(numbered, row, id_col, text_col, least), "groups")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    kept = named.groupBy("group").agg(F.min(first)["row"].alias("_first"))
    # as in _asked: the kept rows grow with the documents, so the plan is a merge join at every size
    return numbered.join(kept.hint("merge"), numbered[row] == kept["_first"], "left_semi").select(*[numbered[c] for c in docs.columns])
