"""Conversation prefix trie by an Euler tour: what conversations share, and how many words sharing saves.

Conversations that start with the same turns share a node for every shared prefix.  Nodes are found without walking
down the trie: each turn gets a 128-bit hash of its role, text and place, and a prefix is the exclusive or of its
turns' hashes, a running sum over the conversation (in blocks, so one conversation may be as long as it likes).

Every node has an arc that enters it and one that leaves it.  Children lie in the order of their smallest member, so an
arc's successor is known from the node's first child, its next sibling and its parent.  The tour is ranked as a
linked list spread over the cluster: in each round the arcs whose hash is smaller than both neighbours' step out and
hand their place to the arc before them, until at most ``BOTTOM`` arcs are left, which are walked; then the rounds are
undone and each arc that stepped out gets its place from the arc it left behind.  A round removes about a third,
so all rounds together move a fixed multiple of the arcs.  A node's subtree is the stretch of the tour between
its arcs, so its leaves and savings are differences of prefix sums at the two places.

Defined cases: turns are ordered by turn (null first), then role, then md5 of the text; null role or text is empty;
repeated rows are repeated turns; rows without a conversation id belong to no conversation; an empty table gives no
rows.  Turns of any length go through one hash and one word count and are not carried on.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, stage

#: Family of conversations that may borrow first turns, and the most turns borrowed.
FAMILY, BORROWED = 20, 3
#: Turns of one block of a conversation; arcs of one block of the tour; arcs walked in one task at the end.
BLOCK, ARCS, BOTTOM = 4096, 1 << 16, 1 << 14
#: Bytes of a piece of a node's list of members.
PIECE = 1 << 16

WORDS = r"[^\x20\x09-\x0D]+"


def _sorted(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Rows in global order of ``keys``, with ``at`` rising along it and ``block`` naming the range; written."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = df.withColumn("_tie", F.monotonically_increasing_id())  # equal rows may lie in several ranges
    ranged = tie.repartitionByRange(n, *keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    return stage(ranged.withColumn("at", F.monotonically_increasing_id()), name).withColumn("block", F.shiftright("at", 33))


def _before(df: DataFrame, group: list[str], block: str, value: Column, name: str) -> DataFrame:
    """group, block, ``name``: the sum of ``value`` over the group's earlier blocks; blocks after none are left out."""
    sums = df.groupBy(*group, block).agg(value.alias("v"))
    earlier = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn(name, F.sum("v").over(earlier)).filter(F.col(name).isNotNull()).drop("v")


def numbered_turns(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, place (1, 2, ... in the conversation), digest, words."""
    said = F.coalesce(F.col(text), F.lit(""))
    who = F.coalesce(F.col(role), F.lit(""))
    md5 = F.md5(F.encode(said, "UTF-8"))
    rows = df.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), who.alias("who"), md5.alias("text"),
        F.md5(F.encode(F.concat(F.length(who).cast("string"), F.lit(":"), who, md5), "UTF-8")).alias("digest"),
        F.regexp_count(said, F.lit(WORDS)).cast("long").alias("words"))
    line = _sorted(rows, ["conv", "turn", "who", "text"], "turns").select("conv", "digest", "words", "at", "block")
    earlier = _before(line, ["conv"], "block", F.count("*"), "n")
    inside = line.withColumn("place", F.row_number().over(Window.partitionBy("conv", "block").orderBy("at")).cast("long"))
    return inside.join(earlier, ["conv", "block"], "left").select("conv", (F.col("place") + F.coalesce("n", F.lit(0))).alias("place"), "digest", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, place, digest, words) and lengths (conv, n) after each conversation took its first turns from its family's."""
    own = turns.groupBy("conv").agg(F.max("place").alias("had"))
    takes = (F.crc32(F.encode(F.col("conv").cast("string"), "UTF-8")) % (BORROWED + 1)).alias("takes")
    heads = turns.filter((F.col("place") <= BORROWED) & (F.col("conv") % FAMILY == 0))
    gives = heads.groupBy(F.col("conv").alias("base")).agg(F.max("place").alias("gives"))
    plan = own.select("conv", "had", takes, (F.col("conv") - F.col("conv") % FAMILY).alias("base")).join(gives, "base", "left").select(
        "conv", "base", "had", "takes", F.least("takes", F.coalesce("gives", F.lit(0))).alias("got"))
    plan = stage(plan, "plan")
    kept = turns.join(plan.select("conv", "takes", "got"), "conv").filter("place > takes").select(
        "conv", (F.col("place") - F.col("takes") + F.col("got")).alias("place"), "digest", "words")
    taken = plan.select("conv", "base", "got").join(heads.withColumnRenamed("conv", "base"), "base").filter("place <= got").select("conv", "place", "digest", "words")
    lengths = plan.select("conv", (F.col("got") + F.greatest(F.col("had") - F.col("takes"), F.lit(0))).alias("n"))
    return kept.unionByName(taken), lengths


def memberships(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row for each conversation and prefix: conv, depth, k1, k2 (the prefix), p1, p2 (one turn less), words, ends."""
    hashed = turns.select("conv", "place", "words", F.xxhash64("place", "digest").alias("h1"), F.xxhash64("digest", F.lit("second"), "place").alias("h2"),
                          F.floor(F.col("place") / BLOCK).alias("block"))
    hashed = stage(hashed, "prefixes")
    sums = hashed.groupBy("conv", "block").agg(F.bit_xor("h1").alias("s1"), F.bit_xor("h2").alias("s2"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumns({"b1": F.bit_xor("s1").over(earlier), "b2": F.bit_xor("s2").over(earlier)}).filter("b1 is not null").drop("s1", "s2")
    here = Window.partitionBy("conv", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    run = hashed.withColumns({"r1": F.bit_xor("h1").over(here), "r2": F.bit_xor("h2").over(here)}).join(before, ["conv", "block"], "left")
    key = lambda r, b: F.col(r).bitwiseXOR(F.coalesce(F.col(b), F.lit(0).cast("long")))
    rows = run.select("conv", F.col("place").alias("depth"), key("r1", "b1").alias("k1"), key("r2", "b2").alias("k2"), "h1", "h2", "words").join(lengths, "conv")
    zero = F.lit(0).cast("long")
    inner = rows.select("conv", "depth", "k1", "k2", F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("h2")).alias("p2"), "words", (F.col("depth") == F.col("n")).alias("ends"))
    roots = lengths.select("conv", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("p1"), zero.alias("p2"), zero.alias("words"), (F.col("n") == 0).alias("ends"))
    return stage(inner.unionByName(roots), "members")


def member_digests(members: DataFrame) -> DataFrame:
    """node, ends_sha256: SHA-256 of the ids of conversations that end at a node, comma-joined, rising.

    Rows (node, conv) are sorted over ranges, so a node with very many ends lies over several; each range joins its ids to
    pieces of at most ``PIECE`` bytes, and a node's pieces go through its hash one after the other.
    """
    line = _sorted(members, ["node", "conv"], "ends").select("node", "conv", "at")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, at, held, size = None, 0, [], 0
        out: list[tuple] = []

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))], names=["node", "at", "ids"])
            out.clear()
            return made

        for batch in batches:
            for n, c, a in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
                if n != node or size > PIECE:
                    if held:
                        out.append((node, at, ",".join(held)))
                    node, at, held, size = n, a, [], 0
                held.append(str(c))
                size += len(held[-1]) + 1
            if out:
                yield batch_of()
        if held:
            out.append((node, at, ",".join(held)))
            yield batch_of()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if n != node:
                    if state:
                        done.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["node", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([state.hexdigest()], pa.string())], names=["node", "ends_sha256"])

    pieces = line.sortWithinPartitions("at").mapInArrow(join, "node long, at long, ids string")
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pieces.repartition(n, "node").sortWithinPartitions("node", "at").select("node", "ids").mapInArrow(digest, "node long, ends_sha256 string")


def siblings(nodes: DataFrame) -> DataFrame:
    """node, parent, older, younger: the children of a parent beside a node, by smallest member.

    All children lie in one global order, so the children of one parent may be spread over many ranges; the first and
    last row of each range (one row per range) connect it with its neighbours.
    """
    line = _sorted(nodes.filter("depth > 0").select("node", "parent", "conv"), ["parent", "conv"], "siblings")
    ends = line.groupBy("block").agg(F.min_by(F.struct("node", "parent"), "at").alias("head"), F.max_by(F.struct("node", "parent"), "at").alias("tail"))
    by_block = Window.orderBy("block")  # one row per range
    edges = F.broadcast(ends.select("block", F.lag("tail").over(by_block).alias("left"), F.lead("head").over(by_block).alias("right")))
    inside = Window.partitionBy("block").orderBy("at")
    row = F.struct("node", "parent")
    near = line.withColumns({"l": F.lag(row).over(inside), "r": F.lead(row).over(inside)}).join(edges, "block").withColumns(
        {"l": F.coalesce("l", "left"), "r": F.coalesce("r", "right")})
    same = lambda c: F.when(F.col(f"{c}.parent") == F.col("parent"), F.col(f"{c}.node"))
    return near.select("node", "parent", same("l").alias("older"), same("r").alias("younger"))


def list_ranks(links: DataFrame, bottom: int = BOTTOM) -> DataFrame:
    """(arc, rank) of a linked list (arc, prev, next; null at the two ends): 0 for the first arc, and so on."""
    spark = links.sparkSession
    small_batches(spark)
    rows = stage(links.select("arc", "prev", "next", F.lit(1).cast("long").alias("step")), "list")  # step: arcs to ``next``
    out: list[DataFrame] = []
    left, turn = rows.count(), 0
    while left > bottom:
        turn += 1
        mixed = lambda c: F.xxhash64(c, F.lit(turn))  # noqa: B023, E731
        # an arc steps out if its hash is below both neighbours'; the ends stay
        low = F.col("prev").isNotNull() & F.col("next").isNotNull() & (mixed("arc") < mixed("prev")) & (mixed("arc") < mixed("next"))
        marked = rows.withColumn("out", low)
        none = F.lit(None).cast("long")
        leaving = marked.filter("out")
        news = leaving.select(F.col("prev").alias("arc"), none.alias("prev"), F.col("next").alias("next"), F.col("step").alias("step"), F.lit(1).alias("what")).unionByName(
            leaving.select(F.col("next").alias("arc"), F.col("prev").alias("prev"), none.alias("next"), none.alias("step"), F.lit(2).alias("what")))
        # an arc's row (0), a new successor with the steps to add (1), a new predecessor (2)
        all_rows = marked.filter("not out").select("arc", "prev", "next", "step", F.lit(0).alias("what")).unionByName(news)
        pick = lambda c, k: F.max(F.when(F.col("what") == k, F.col(c)))
        joined = all_rows.groupBy("arc").agg(
            F.coalesce(pick("prev", 2), pick("prev", 0)).alias("prev"), F.coalesce(pick("next", 1), pick("next", 0)).alias("next"),
            (pick("step", 0) + F.coalesce(pick("step", 1), F.lit(0))).alias("step"), pick("step", 0).alias("gap"), (pick("next", 1).isNotNull()).alias("lost"), pick("next", 0).alias("lost_arc"))
        rows = stage(joined, "list")
        out.append(rows.filter("lost").select(F.col("lost_arc").alias("arc"), F.col("arc").alias("prev"), "gap"))
        rows = rows.select("arc", "prev", "next", "step")
        left = rows.count()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([b for b in batches if b.num_rows] or [], pa.schema([("arc", pa.int64()), ("prev", pa.int64()), ("next", pa.int64()), ("step", pa.int64())]))
        follow = {a: (n, s) for a, n, s in zip(*[table.column(c).to_pylist() for c in ("arc", "next", "step")], strict=True)}
        arcs, ranks, at = [], [], 0
        arc = next((a for a, p in zip(table.column("arc").to_pylist(), table.column("prev").to_pylist(), strict=True) if p is None), None)
        while arc is not None:
            arcs.append(arc)
            ranks.append(at)
            arc, step = follow[arc]
            at += step
        if arcs:
            yield pa.RecordBatch.from_arrays([pa.array(arcs, pa.int64()), pa.array(ranks, pa.int64())], names=["arc", "rank"])

    ranks = stage(rows.coalesce(1).mapInArrow(walk, "arc long, rank long"), "ranks")  # at most ``bottom`` arcs
    for gone in reversed(out):
        back = gone.join(ranks.withColumnRenamed("arc", "prev"), "prev").select("arc", (F.col("rank") + F.col("gap")).alias("rank"))
        ranks = stage(ranks.unionByName(back), "ranks")
    return ranks


def trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, lengths = rebuilt(stage(numbered_turns(df, conv, turn, role, text), "numbered"))
    members = memberships(turns, lengths)
    grouped = members.groupBy("depth", "k1", "k2").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    named = stage(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")
    up = named.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"))
    nodes = stage(named.join(up, ["depth", "p1", "p2"], "left").select("node", "parent", "parent_conv_id", "conv", "depth", "n_convs", "words", "k1", "k2"), "nodes")
    digests = member_digests(members.filter("ends").join(nodes.select("node", "depth", "k1", "k2"), ["depth", "k1", "k2"]).select("node", "conv"))

    beside = stage(siblings(nodes), "siblings")
    kids = beside.groupBy(F.col("parent").alias("node")).agg(
        F.max(F.when(F.col("older").isNull(), F.col("node"))).alias("first"), F.max(F.when(F.col("younger").isNull(), F.col("node"))).alias("last"), F.count("*").alias("n_children"))
    full = stage(nodes.join(kids, "node", "left").join(beside.select("node", "older", "younger"), "node", "left"), "family")
    enter, leave = (lambda c: F.col(c) * 2), (lambda c: F.col(c) * 2 + 1)
    arcs = full.select(
        enter("node").alias("arc"), F.coalesce(leave("older"), enter("parent")).alias("prev"), F.coalesce(enter("first"), leave("node")).alias("next")).unionByName(full.select(
            leave("node").alias("arc"), F.coalesce(leave("last"), enter("node")).alias("prev"), F.coalesce(enter("younger"), leave("parent")).alias("next")))
    ranks = list_ranks(arcs)

    # prefix sums over the tour: the entering arc counts its node
    value = full.select(enter("node").alias("arc"), F.col("n_children").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    tour = ranks.join(value, "arc", "left").select(
        "arc", "rank", F.floor(F.col("rank") / ARCS).alias("block"), F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("saved", F.lit(0)).alias("saved"))
    tour = stage(tour, "tour")
    sums = tour.groupBy("block").agg(F.sum("leaf").alias("l"), F.sum("saved").alias("s"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block of the tour
    before = sums.select("block", F.coalesce(F.sum("l").over(earlier), F.lit(0)).alias("l"), F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("s"))
    here = Window.partitionBy("block").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    prefix = tour.select("arc", "leaf", "saved", "block", F.sum("leaf").over(here).alias("hl"), F.sum("saved").over(here).alias("hs")).join(before, "block").select(
        F.shiftright("arc", 1).alias("node"), (F.col("arc") % 2 == 0).alias("enters"), (F.col("l") + F.col("hl")).alias("leaves"), (F.col("s") + F.col("hs")).alias("saves"), "leaf", "saved")
    at = lambda c, e: F.max(F.when(F.col("enters") == e, F.col(c)))
    # what the leaving arc has summed, less what stood before the entering arc
    subtree = prefix.groupBy("node").agg(
        (at("leaves", False) - at("leaves", True) + at("leaf", True)).alias("n_leaves"), (at("saves", False) - at("saves", True) + at("saved", True)).alias("saved_tokens"))
    nothing = hashlib.sha256(b"").hexdigest()
    return full.join(subtree, "node").join(digests, "node", "left").select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
