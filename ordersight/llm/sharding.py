"""Hierarchical weighted hash tree: rows descend region, rack and shard by weighted hash draws.

A node of weight w arrives after ``-ln(u) / w`` for a hash draw ``u`` of (id, node): the earliest of
several nodes is node i with probability w_i / sum(w).  Below a node the earliest child inherits the
node's arrival; every other child arrives later by one more draw (exponential times are memoryless, so
this equals independent draws on the leaves).  Nodes whose shards all exist take part with one draw; only
the region and the rack that are still being filled are opened.  A further shard therefore adds one
arrival to the race and changes no other: rows move into it and nowhere else.

Only ids and the shard count decide.  Null ids are one id.  Texts may be null (size 16, crc32 of '') or empty.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage


@dataclass(frozen=True)
class HashTree:
    """Shard i lies in rack i // shards_per_rack, and rack k in region k // racks_per_region.

    ``weights``: of shards 0, 1, ...; those beyond the list, also of shards still to come, weigh 1.
    """
    shards_per_rack: int = 4
    racks_per_region: int = 4
    weights: tuple[float, ...] = ()
    seed: int = 0

    def __post_init__(self):
        if self.shards_per_rack < 1 or self.racks_per_region < 1 or any(not w > 0 for w in self.weights):
            raise ValueError("a tree needs positive fan-outs and weights")

    @property
    def region_size(self) -> int:
        return self.shards_per_rack * self.racks_per_region

    def weight(self, shard: int) -> float:
        return float(self.weights[shard]) if shard < len(self.weights) else 1.0

    def shard_weights(self, n: int) -> list[float]:
        """Weights of the shards of all regions that ``n`` shards touch."""
        return [self.weight(i) for i in range(-(-n // self.region_size) * self.region_size)]


def _sums(values: list[float], size: int) -> list[float]:
    return [sum(values[i:i + size]) for i in range(0, len(values), size)]


def _doubles(values: list[float]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def with_shard(df: DataFrame, id_col: str, n_shards: int, out: str, tree: HashTree = HashTree()) -> DataFrame:
    """``df`` with the shard (0 .. n_shards - 1) of its id in ``out``.

    Every step is a column of its own, so no draw is evaluated twice.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    spr, rpr, size = tree.shards_per_rack, tree.racks_per_region, tree.region_size
    leaf = tree.shard_weights(n_shards)
    leaves, racks, regions = _doubles(leaf), _doubles(_sums(leaf, spr)), _doubles(_sums(leaf, size))
    tmp = lambda name: f"_{out}_{name}"

    def wait(kind: str, node: Column, weights: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(f"{tree.seed}:{kind}"), node), 11)
        return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / F.element_at(weights, node + 1)

    def nodes_below(parent: Column, count: int, fan_out: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: parent * fan_out + i)

    def earliest(kind: str, nodes: str, weights: Column) -> Column:
        """The child that inherits its parent's arrival."""
        return F.array_min(F.transform(F.col(nodes), lambda k: F.struct(wait(kind, k, weights).alias("t"), k.alias("k"))))["k"]

    def arrivals(kind: str, level: int, nodes: str, first: str, since: Column, weights: Column) -> Column:
        return F.transform(F.col(nodes), lambda k: F.struct(
            (since + F.when(k == F.col(first), F.lit(0.0)).otherwise(wait(f"{kind}+", k, weights))).alias("t"),
            F.lit(level).alias("level"), k.alias("k")))

    whole, rest = divmod(n_shards, size)
    racing = []  # arrays of (arrival, level, node)
    if whole:
        df = df.withColumn(tmp("regions"), F.transform(F.sequence(F.lit(0), F.lit(whole - 1)), lambda r: F.struct(
            wait("region", r, regions).alias("t"), F.lit(0).alias("level"), r.alias("k"))))
        racing.append(tmp("regions"))
    if rest:
        whole_racks, odd = divmod(rest, spr)
        df = df.withColumn(tmp("all_racks"), nodes_below(F.lit(whole), rpr, rpr))
        df = df.withColumn(tmp("rack1"), earliest("rack", tmp("all_racks"), racks))
        df = df.withColumn(tmp("open"), F.slice(F.col(tmp("all_racks")), 1, whole_racks + bool(odd)))
        df = df.withColumn(tmp("since"), wait("region", F.lit(whole), regions))
        df = df.withColumn(tmp("racks"), arrivals("rack", 1, tmp("open"), tmp("rack1"), F.col(tmp("since")), racks))
        if odd:
            df = df.withColumn(tmp("last"), F.element_at(F.col(tmp("racks")), -1))
            df = df.withColumn(tmp("all_shards"), nodes_below(F.lit(whole * rpr + whole_racks), spr, spr))
            df = df.withColumn(tmp("shard1"), earliest("shard", tmp("all_shards"), leaves))
            df = df.withColumn(tmp("some"), F.slice(F.col(tmp("all_shards")), 1, odd))
            df = df.withColumn(tmp("shards"), arrivals("shard", 2, tmp("some"), tmp("shard1"), F.col(tmp("last"))["t"], leaves))
            racing.append(tmp("shards"))
        if whole_racks:
            df = df.withColumn(tmp("full"), F.slice(F.col(tmp("racks")), 1, whole_racks))
            racing.append(tmp("full"))
    df = df.withColumn(tmp("won"), F.array_min(F.concat(*racing)))
    df = df.withColumn(tmp("in_region"), nodes_below(F.col(tmp("won"))["k"], rpr, rpr))
    df = df.withColumn(tmp("rack"), F.when(F.col(tmp("won"))["level"] == 0, earliest("rack", tmp("in_region"), racks))
                       .otherwise(F.col(tmp("won"))["k"]))
    df = df.withColumn(tmp("in_rack"), nodes_below(F.col(tmp("rack")), spr, spr))
    df = df.withColumn(out, F.when(F.col(tmp("won"))["level"] == 2, F.col(tmp("won"))["k"])
                       .otherwise(earliest("shard", tmp("in_rack"), leaves)).cast("int"))
    return df.drop(*[c for c in df.columns if c.startswith(f"_{out}_")])


def place(df: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
          tree: HashTree = HashTree(), buckets: int = 1024) -> DataFrame:
    """id, size, text_crc32, region, rack, shard, grown_shard and a gapless ``slot`` in the shard.

    Slots are dealt in order of (hash bucket, id, crc32, size): ranks inside (shard, bucket) plus the
    counts of the shard's earlier buckets, so no task ever sorts a whole shard.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = df.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"))
    placed = with_shard(with_shard(slim, "id", n_shards, "shard", tree), "id", n_shards + 1, "grown", tree)
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("id", "crc", "size"), F.lit(buckets)).cast("int"))
    rank = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("id", "crc", "size"))
    ranked = stage(placed.withColumn("rank", rank), "shards")
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    counts = ranked.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    first = counts.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("first"))
    return ranked.join(first, ["shard", "bucket"]).select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
        (F.col("shard") / tree.region_size).cast("int").alias("region"),
        (F.col("shard") / tree.shards_per_rack).cast("int").alias("rack"),
        "shard", (F.col("first") + F.col("rank") - 1).cast("long").alias("slot"), F.col("grown").alias("grown_shard"))
