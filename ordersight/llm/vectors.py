"""Near-duplicate vectors by a robust-pruned flat graph.

Exactly equal vectors are one node.  Nodes are dealt to overlapping cluster shards (their nearest centroids);
a cell over ``MAX_SHARD`` nodes is cut into parts by hash, so no task gets more.  In each shard candidates are
robust-pruned into a graph; a node's lists of all its shards are united.  The shards are then searched: every
node starts a greedy search at the shard's medoid and, once inside the range, expands every node within
range.  Found pairs are verified: the cosine of the two unit vectors, summed anew in double precision, must reach
the range.  A recall audit compares the links of hash-chosen
nodes with brute force, in blocks: the mean of the nodes' own recalls, of nodes with at most ``FEW`` links and of
the others, the lower of which counts.  Nodes are drawn until ``LINKED`` of them have a link, ``MOST`` at most.
Below ``RECALL`` the search is run again with more cells and wider beams; what is still below it at the widest is
searched exactly, all nodes against all in blocks.

The centroids come from at most ``SAMPLE`` nodes; every node is indexed and searched.

Defined cases: null, empty or zero vectors, and vectors with null or non-finite components, link with
nothing; vectors of another length link only among themselves; equal ids are separate rows; null ids come last as
component names; an empty table gives no rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, small_batches, stage
from .graph import components

RANGE, RECALL = 0.9, 0.97
#: The search looks this far below the range, verification does not.
SLACK = 1e-9
SAMPLE, AUDIT = 8192, 256
LINKED, MOST, FEW = 64, 8192, 4
WIDEST, BLOCK = 24, 2048
SHARD, MAX_SHARD = 1500, 4000
DEGREE, POOL, ALPHA = 24, 48, 1.2


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, size)


def _nodes(rows: DataFrame, vec_col: str) -> DataFrame:
    """row, id, key, vec (unit vector as bytes, null where a vector links with nothing), size."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, vecs, sizes = [], [], []
        for v in batch.column("vec").to_pylist():
            x = np.array([np.nan if c is None else c for c in v], np.float64) if v else np.empty(0)
            top = np.abs(x).max() if len(x) else 0.0
            if not (np.isfinite(x).all() and top > 0):
                keys.append(None)
                vecs.append(None)
                sizes.append(0)
                continue
            x = x + 0.0  # a negative zero is a zero
            keys.append(xxhash.xxh3_128_digest(x.tobytes()))
            x = x / top
            vecs.append((x / np.sqrt(x @ x)).tobytes())
            sizes.append(len(x))
        return pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary()), pa.array(sizes, pa.int64())],
                                          names=["row", "id", "key", "vec", "size"])

    return stage(map_batches(rows, run, f"row long, id {kind}, key binary, vec binary, size long"), "vectors")


def centroids_of(sample: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means on a bounded sample; empty cells keep their centroid."""
    rng = np.random.default_rng(11)
    c = sample[rng.permutation(len(sample))[:count]].copy()
    for _ in range(rounds):
        near = np.concatenate([(sample[i:i + 1024] @ c.T).argmax(axis=1) for i in range(0, len(sample), 1024)])
        total = np.zeros_like(c)
        np.add.at(total, near, sample)
        length = np.sqrt((total ** 2).sum(axis=1))
        c = np.where((length > 1e-12)[:, None], total / np.maximum(length, 1e-12)[:, None], c)
    return c


def pruned_graph(x: np.ndarray, degree: int = DEGREE, pool: int = POOL, alpha: float = ALPHA) -> list[np.ndarray]:
    """Neighbour lists of unit vectors: candidates nearest first, a candidate stays unless a kept neighbour is
    nearer to it (by the factor alpha) than the node is; a few random candidates give long edges.  Edges are
    then mirrored, and what the medoid does not reach is tied to its nearest reached node."""
    n = len(x)
    if n == 1:
        return [np.empty(0, np.int64)]
    rng = np.random.default_rng(n)
    near = min(pool, n - 1)
    out: list[list[int]] = []
    for i in range(0, n, 256):
        block = x[i:i + 256]
        sims = block @ x.T
        sims[np.arange(len(block)), np.arange(i, i + len(block))] = -9
        cand = np.argpartition(-sims, near - 1, axis=1)[:, :near]
        cand = np.concatenate([cand, rng.integers(0, n, (len(block), 8))], axis=1)
        s = np.take_along_axis(sims, cand, axis=1)
        order = np.argsort(-s, axis=1, kind="stable")
        cand, s = np.take_along_axis(cand, order, axis=1), np.take_along_axis(s, order, axis=1)
        v = x[cand]
        far = np.sqrt(np.maximum(0.0, 2 - 2 * s))  # distance node - candidate
        between = np.sqrt(np.maximum(0.0, 2 - 2 * (v @ v.transpose(0, 2, 1))))
        alive, kept = s > -2, np.zeros(s.shape, bool)
        count = np.zeros(len(block), np.int64)
        for j in range(s.shape[1]):
            take = alive[:, j] & (count < degree)
            kept[take, j] = True
            count += take
            alive &= ~(take[:, None] & (alpha * between[:, j] <= far))
        out.extend(list(map(int, c[k])) for c, k in zip(cand, kept, strict=True))
    both = [set(a) for a in out]
    for i, a in enumerate(out):
        for j in a:
            both[j].add(i)
    start = medoid(x)
    seen, todo = np.zeros(n, bool), [start]
    seen[start] = True
    while True:
        while todo:
            new = [j for i in todo for j in both[i] if not seen[j]]
            seen[new] = True
            todo = list(dict.fromkeys(new))
        rest = np.flatnonzero(~seen)
        if not len(rest):
            return [np.array(sorted(b - {i}), np.int64) for i, b in enumerate(both)]
        reached = np.flatnonzero(seen)
        at = int(reached[(x[reached] @ x[rest[0]]).argmax()])
        both[at].add(int(rest[0]))
        both[int(rest[0])].add(at)
        seen[rest[0]] = True
        todo = [int(rest[0])]


def medoid(x: np.ndarray) -> int:
    return int((x @ x.mean(axis=0)).argmax())


def range_search(x: np.ndarray, table: np.ndarray, queries: np.ndarray, least: float, beam: int) -> list[np.ndarray]:
    """Nodes found within range of each query.  ``table``: neighbour numbers, filled up with -1.

    All queries of a block take a step together: the best node not yet expanded of each one's beam is expanded,
    until none is left; then, in turn, every node found within range that was not expanded.
    """
    n, start, found = len(x), medoid(x), []
    padded = np.where(table < 0, n, table)
    slack = least - 0.06  # nodes a little outside the range are expanded too: they bridge gaps
    for i in range(0, len(queries), 256):
        q = queries[i:i + 256]
        m = len(q)
        rows = np.arange(m)
        sims = np.full((m, n + 1), -9.0)  # of nodes met
        done = np.zeros((m, n + 1), bool)
        done[:, n] = True
        sims[:, start] = q @ x[start]
        live = rows
        width = min(beam, n)
        while len(live):
            open_sims = np.where(done[live], -9.0, sims[live])
            best = open_sims.argmax(axis=1)
            value = open_sims[np.arange(len(live)), best]
            bound = np.partition(sims[live], n + 1 - width, axis=1)[:, n + 1 - width]
            go = (value > -9) & ((value >= bound) | (value >= slack))
            live, best = live[go], best[go]
            if not len(live):
                break
            done[live, best] = True
            next_nodes = padded[best]
            flat_q, flat_n = np.repeat(live, next_nodes.shape[1]), next_nodes.ravel()
            new = (flat_n < n) & (sims[flat_q, flat_n] <= -9)
            flat_q, flat_n = flat_q[new], flat_n[new]
            sims[flat_q, flat_n] = np.einsum("ij,ij->i", q[flat_q], x[flat_n])
        for r in range(m):
            found.append(np.flatnonzero(sims[r, :n] >= least - SLACK))
    return found


def within(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Whether the rows' cosines are at least ``least``: one sum per pair, the same in either order of the two,
    unlike a matrix product, whose last digits depend on its shape."""
    return (x * y).sum(axis=1) >= least


def pairs_within(left: np.ndarray, right: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The rows of ``left`` and of ``right`` that are in range, by a matrix product; pairs at its edge by ``within``."""
    sims = left @ right.T
    p, q = np.nonzero(np.abs(sims - least) <= SLACK)
    sims[p, q] = np.where(within(left[p], right[q], least), 1, -1)
    return np.nonzero(sims >= least)


def _dealt(nodes: DataFrame, centroids: np.ndarray, size: int, cells: int) -> DataFrame:
    """node, vec, rank, cell: each node once for each of its nearest ``cells`` cells."""
    shared = nodes.sparkSession.sparkContext.broadcast(centroids)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = shared.value
        sims = _matrix(batch.column("vec"), size) @ c.T
        k = min(cells, len(c))
        near = np.argsort(-sims, axis=1, kind="stable")[:, :k]
        take = pa.array(np.repeat(np.arange(batch.num_rows), k))
        return pa.RecordBatch.from_arrays(
            [batch.column("node").take(take), batch.column("vec").take(take), pa.array(np.tile(np.arange(k), batch.num_rows).astype(np.int32)), pa.array(near.ravel().astype(np.int32))],
            names=["node", "vec", "rank", "cell"])

    return map_batches(nodes.select("node", "vec"), run, "node long, vec binary, rank int, cell int")


def _build(members: DataFrame, size: int) -> DataFrame:
    """(node, near): the lists of each shard's graph."""
    def run(key, table):
        table = table.sort_by("node")
        ids = table.column("node").to_numpy()
        graph = pruned_graph(_matrix(table.column("vec").combine_chunks(), size))
        return pa.table({"node": ids, "near": pa.array([ids[g] for g in graph], pa.list_(pa.int64()))})

    return members.groupBy("cell", "part").applyInArrow(run, "node long, near array<long>")


def _search(members: DataFrame, size: int, least: float, beam: int) -> DataFrame:
    """Pairs (a < b) of nodes found by searching each shard's part of the united graph for its queries."""
    def run(key, table):
        q, idx = table.filter(table.column("query")), table.filter(pa.compute.invert(table.column("query"))).sort_by("node")
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        if not idx.num_rows or not q.num_rows:
            return none
        ids = idx.column("node").to_numpy()
        x, asked = _matrix(idx.column("vec").combine_chunks(), size), _matrix(q.column("vec").combine_chunks(), size)
        near = idx.column("near").to_pylist()
        flat = np.array([j for a in near for j in a or ()], np.int64)
        of = np.repeat(np.arange(len(near)), [len(a or ()) for a in near])
        at = np.searchsorted(ids, flat)
        here = (at < len(ids)) & (ids[np.minimum(at, len(ids) - 1)] == flat)
        of, at = of[here], at[here]
        degree = np.bincount(of, minlength=len(ids))
        table_ = np.full((len(ids), max(1, int(degree.max()) if len(degree) else 1)), -1, np.int64)
        table_[of, np.arange(len(of)) - np.repeat(np.cumsum(degree) - degree, degree)] = at
        mine = q.column("node").to_numpy()
        a, b = [], []
        for r, hits in enumerate(range_search(x, table_, asked, least, beam)):
            node = mine[r]
            other = ids[hits[within(x[hits], asked[r], least)]]
            other = other[other != node]
            a.append(np.minimum(other, node))
            b.append(np.maximum(other, node))
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return members.groupBy("cell", "part").applyInArrow(run, "a long, b long")


def _pairs(nodes: DataFrame, size: int, count: int, sample: np.ndarray, least: float, cells: int, beam: int) -> DataFrame:
    """Verified pairs (a, b) of nodes of one vector length."""
    centroids = centroids_of(sample, max(1, min(4096, len(sample), -(-count // SHARD))))
    dealt = stage(_dealt(nodes, centroids, size, cells), "cells")
    sizes = dealt.groupBy("cell").agg(F.greatest(F.lit(1), F.ceil(F.count("*") / MAX_SHARD)).cast("int").alias("parts"))
    parted = dealt.join(sizes, "cell")
    own = parted.withColumn("part", F.pmod(F.xxhash64("node", "cell"), F.col("parts")).cast("int"))
    graph = _build(own.select("cell", "part", "node", "vec"), size)
    united = stage(graph.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")
    indexed = own.join(united, "node").select("cell", "part", "node", "vec", "near", F.lit(False).alias("query"))
    # a query goes to all parts of its nearest cells, indexed nodes lie in one part of each of theirs
    asked = parted.filter(F.col("rank") < max(1, cells - 1)).select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "node", "vec",
                                                                    F.lit(None).cast("array<long>").alias("near"), F.lit(True).alias("query"))
    return _search(indexed.unionByName(asked), size, least, beam).distinct()


def _exact(nodes: DataFrame, size: int, count: int, least: float) -> DataFrame:
    """All pairs (a < b) within range, by blocks of about ``BLOCK`` x ``BLOCK`` nodes."""
    parts = -(-count // BLOCK)
    dealt = nodes.select("node", "vec", F.pmod(F.xxhash64("node", F.lit("block")), F.lit(parts)).cast("int").alias("part"))
    others = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    met = dealt.select("node", "vec", "part", others.alias("other")).select("node", "vec", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))

    def run(key, table):
        i, j = (k.as_py() for k in key)
        part = table.column("part").to_numpy()
        ids, x = table.column("node").to_numpy(), _matrix(table.column("vec").combine_chunks(), size)
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for k in range(0, len(left), 256):
            p, q = pairs_within(x[left[k:k + 256]], x[right], least)
            u, v = ids[left[k:k + 256]][p], ids[right][q]
            keep = (u < v) if i == j else (u != v)
            a.append(np.minimum(u, v)[keep])
            b.append(np.maximum(u, v)[keep])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return met.groupBy("i", "j").applyInArrow(run, "a long, b long")


def _audit(nodes: DataFrame, pairs: DataFrame, size: int, least: float) -> float:
    """The mean recall of hash-chosen nodes that have brute-force links: of nodes with few or with many, the lower."""
    asked = AUDIT
    while True:
        chosen = nodes.orderBy(F.xxhash64("node", F.lit("audit"))).limit(asked).select("node", "vec").toArrow()
        if not chosen.num_rows:
            return 1.0
        shared = nodes.sparkSession.sparkContext.broadcast(
            (chosen.column("node").to_numpy(), _matrix(chosen.column("vec").combine_chunks(), size)))

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            ids, x = shared.value
            other = batch.column("node").to_numpy()
            i, j = pairs_within(_matrix(batch.column("vec"), size), x, least)
            i, j = i[other[i] != ids[j]], j[other[i] != ids[j]]
            return pa.RecordBatch.from_arrays([pa.array(ids[j]), pa.array(np.minimum(other[i], ids[j])), pa.array(np.maximum(other[i], ids[j]))], names=["node", "a", "b"])

        true = map_batches(nodes.select("node", "vec"), run, "node long, a long, b long")
        each = true.join(pairs.select("a", "b", F.lit(1).alias("hit")), ["a", "b"], "left").groupBy("node").agg(F.count("*").alias("n"), F.count("hit").alias("hit")).toArrow()
        if each.num_rows >= LINKED or chosen.num_rows < asked or asked >= MOST:
            break
        asked = min(MOST, 4 * asked)
    n, hit = each.column("n").to_numpy(), each.column("hit").to_numpy()
    return min([float((hit[g] / n[g]).mean()) for g in (n <= FEW, n > FEW) if g.any()], default=1.0)


def near_vectors(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = RANGE,
                 recall: float = RECALL, audits: list | None = None) -> DataFrame:
    """id_col, n_links, component_id, kept of every row.  ``audits`` gets the measured recalls."""
    small_batches(df.sparkSession)
    rows = _nodes(df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(vec_col).alias("vec")), vec_col)
    nodes = stage(rows.filter("key is not null").groupBy("key", "size").agg(
        F.min("row").alias("node"), F.count("*").alias("copies"), F.first("vec").alias("vec")).drop("key"), "nodes")
    links = None
    for r in nodes.groupBy("size").count().collect():  # one row per vector length
        size, count = r["size"], r["count"]
        mine = nodes.filter(F.col("size") == size)
        share = SAMPLE / count
        sample = _matrix(mine.filter(F.pmod(F.xxhash64("node", F.lit("kmeans")), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
                         .orderBy("node").limit(2 * SAMPLE).select("vec").toArrow().column("vec").combine_chunks(), size)
        if not len(sample):
            sample = _matrix(mine.limit(1).select("vec").toArrow().column("vec").combine_chunks(), size)
        cells, beam = 3, 24
        while True:
            pairs = stage(_pairs(mine, size, count, sample, least, cells, beam), "links")
            got = _audit(mine, pairs, size, least)
            if audits is not None:
                audits.append(got)
            if got >= recall:
                break
            if cells >= WIDEST:
                pairs = stage(_exact(mine, size, count, least), "links")
                break
            cells, beam = 2 * cells, 2 * beam
        links = pairs if links is None else links.union(pairs)
    who = rows.select("row", "id", "key").join(
        rows.filter("key is not null").groupBy("key").agg(F.min("row").alias("node"), F.count("*").alias("copies")), "key", "left")
    if links is None:
        joined = who.select("id", "row", "node", "copies", F.lit(0).alias("others"), F.lit(None).cast("long").alias("component"))
    else:
        copies = nodes.select("node", "copies")
        both = links.union(links.select(F.col("b"), F.col("a")))
        others = both.join(copies.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("copies").alias("others"))
        joined = who.join(others, "node", "left").join(components(links), "node", "left").select("id", "row", "node", "copies", "others", "component")
    named = stage(joined.select("id", "row", (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("others", F.lit(0))).cast("long").alias("n_links"),
                                F.coalesce("component", "node", "row").alias("group"), F.col("node").isNull().alias("alone")), "named")
    # rows without a usable vector are groups of their own; their row number names no other group
    first = named.groupBy("group", "alone").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first"))
    return named.join(first, ["group", "alone"]).select(
        F.col("id").alias(id_col), "n_links", F.col("first.id").alias("component_id"),
        (F.col("row") == F.col("first.row")).alias("kept"))
