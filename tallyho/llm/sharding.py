"""Sharding by k-d tree partitioning (DataFrame functions only).

A node that has to become k shards is split at the weighted quantile k_left / k (the
weighted median where k is even) along its widest metadata dimension, level by level,
until every node is one shard of about ``total bytes / shards``.  All nodes of a level
are searched together: a histogram of bytes per node (``BINS`` bins) narrows the range
that holds each node's cut, until the bin is light enough; only those histograms,
``nodes x BINS`` rows at most, reach the driver, and rows are never moved or sorted.

Dimensions are functions of the text alone (log bytes, log lines, share of non-ASCII
bytes), each on a ``GRID`` and followed by a hash of the text, so equal texts have equal
coordinates and stay together; only where a cut meets a group of copies heavier than
``GROUP_SHARE`` of a shard is the group split, by a hash of the row's id.

Defined cases: a null text has no bytes (size 16, as every row has 16 added); null ids
are one id; equal rows (id and text) stay together; with fewer distinct rows than
shards some shards are empty; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyho.llm.common import materialize
from tallyho.operators.indexing import exclusive_prefix_sum

ROW_BYTES = 16
TARGET_BYTES = 256 << 20
BIN_BITS = 10                # 1,024 bins
GRID_BITS, HASH_BITS = 22, 40
FINE = 0.001                 # of a shard: a bin this light isn't searched further
GROUP_SHARE = 0.02           # of a shard: heavier groups of equal texts may be cut


@dataclass
class Node:
    shards: int
    first: int                       # its first shard
    bytes: int
    dim: str = ""
    cut: tuple[int, int] = (0, 0)    # coordinate, id hash: smaller rows go left
    left: "Node | None" = None
    right: "Node | None" = None

    def column(self, fn) -> Column:
        """``fn(leaf)`` of the leaf that a row is in."""
        if self.left is None:
            return F.lit(fn(self))
        at, key = self.cut
        before = (F.col(self.dim) < at) | ((F.col(self.dim) == at) & (F.col("id_hash") < key))
        return F.when(before, self.left.column(fn)).otherwise(self.right.column(fn))

    def leaves(self) -> list["Node"]:
        return [self] if self.left is None else self.left.leaves() + self.right.leaves()


DIMENSIONS = ["by_bytes", "by_lines", "by_script"]


def measures(id_col: str, text: str) -> list[Column]:
    """Size, crc, hash of the id and coordinates of a row."""
    t = F.coalesce(F.col(text), F.lit(""))
    size, chars = F.octet_length(t), F.length(t)
    lines = size - F.octet_length(F.translate(t, "\n", ""))
    scale = [F.log2(size + 1.0) / 40, F.log2(lines + 1.0) / 40,
             F.when(size > 0, (size - chars) / size).otherwise(F.lit(0.0))]
    tail = F.xxhash64(t).bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    grid = (1 << GRID_BITS) - 1
    coordinates = [(F.shiftleft(F.floor(F.least(v, F.lit(1.0)) * grid).cast("bigint"), HASH_BITS) + tail).alias(k)
                   for k, v in zip(DIMENSIONS, scale)]
    return [(size + ROW_BYTES).cast("bigint").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"),
            F.shiftrightunsigned(F.xxhash64(F.col(id_col).cast("string")), 2).alias("id_hash"), *coordinates]


def _of_node(values: dict[int, int]) -> Column:
    """The value of the row's ``node``; -1 or null if it has none.  A literal in the plan: no job, join or broadcast."""
    return F.get(F.expr(f"array({', '.join(f'{values.get(i, -1)}L' for i in range(max(values) + 1))})"), F.col("node"))


def _coordinate() -> Column:
    """The row's coordinate in its node's dimension, the column ``dim``; null if that is null or -1."""
    return F.get(F.array(*DIMENSIONS), F.col("dim").cast("int"))


def _cuts(rows: DataFrame, nodes: list[Node], leaf_bytes: float) -> None:
    """Set ``cut`` of all ``nodes`` (leaves so far, their ``dim`` chosen); ``rows`` have their ``node``."""
    whole = GRID_BITS + HASH_BITS
    # by node: axis (0 the coordinate, 1 the id hash), the range [low, low + 2**bits), bytes before it
    state = {n.first: [0, 0, whole, 0, 0] for n in nodes}   # axis, low, bits, before, coordinate
    target = {n.first: n.bytes * (n.shards // 2) / n.shards for n in nodes}
    todo = {n.first: n for n in nodes}
    while todo:
        axis, low, bits, fixed = (_of_node({f: state[f][i] for f in todo}) for i in (0, 1, 2, 4))
        coordinate = _coordinate()
        place = F.when(axis == 0, coordinate).when(coordinate == fixed, F.col("id_hash")) - low
        found = (rows.withColumn("dim", _of_node({f: DIMENSIONS.index(n.dim) for f, n in todo.items()})).where("dim >= 0")
                 .select("node", place.alias("place"), bits.cast("int").alias("bits"), "size")
                 .where("place >= 0 AND shiftright(place, bits) = 0")
                 .select("node", F.expr(f"shiftright(place, greatest(bits - {BIN_BITS}, 0))").alias("bin"), "size")
                 .groupBy("node", "bin").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect())
        bins: dict[int, list] = {}
        for r in sorted(found, key=lambda r: (r["node"], r["bin"])):
            bins.setdefault(r["node"], []).append((r["bin"], r["bytes"], r["n"]))
        for first, node in list(todo.items()):
            axis_, low_, bits_, before, coordinate_ = state[first]
            shift_ = max(0, bits_ - BIN_BITS)
            done = None
            for b, size, n in bins.get(first, []):
                start, end = low_ + (b << shift_), low_ + ((b + 1) << shift_)
                if before + size >= target[first]:
                    nearer = start if target[first] - before <= before + size - target[first] else end
                    light = size <= FINE * leaf_bytes or n == 1
                    if light or (shift_ == 0 and (axis_ == 1 or size <= GROUP_SHARE * leaf_bytes)):
                        done = nearer
                    elif shift_ == 0:
                        state[first] = [1, 0, 62, before, start]
                    else:
                        state[first] = [axis_, start, shift_, before, coordinate_]
                    break
                before += size
            else:
                done = low_ + (1 << bits_)
            if done is not None:
                node.cut = (done, 0) if axis_ == 0 else (coordinate_, done)
                del todo[first]


def build(rows: DataFrame, shards: int) -> Node:
    """The tree over stored rows with ``measures``.  Each level's nodes are stored with the rows,
    so that every round runs the same small plan."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    root = Node(shards, 0, total)
    rows = rows.withColumn("node", F.lit(0))
    while True:
        level = [n for n in root.leaves() if n.shards > 1]
        if not level:
            return root
        spread = {r["node"]: r for r in rows.groupBy("node").agg(
            F.sum("size").alias("size"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]).collect()}
        for n in level:
            r = spread.get(n.first)
            n.bytes = r["size"] if r else 0
            n.dim = max(DIMENSIONS, key=lambda d: r[d]) if r else DIMENSIONS[0]
        _cuts(rows, level, total / shards)
        for n in level:
            k = n.shards // 2
            n.left, n.right = Node(k, n.first, 0), Node(n.shards - k, n.first + k, 0)
        at, key = (_of_node({n.first: n.cut[i] for n in level}) for i in (0, 1))
        right = _of_node({n.first: n.right.first for n in level}).cast("int")
        place = _coordinate()
        after = (place > at) | ((place == at) & (F.col("id_hash") >= key))
        moved = rows.withColumn("dim", _of_node({n.first: DIMENSIONS.index(n.dim) for n in level}))
        rows = materialize(moved.withColumn("node", F.when(after, right).otherwise(F.col("node"))).drop("dim"), "shard-nodes")


def planned(df: DataFrame, id_col: str, text: str, shards: int | None, target_bytes: int) -> tuple[DataFrame, Node]:
    """Stored rows (``id`` and ``measures``) and their tree.  Without ``shards`` there are as
    many as ``target_bytes`` asks for.  The tree becomes one expression over all rows:
    meant for up to some thousand shards."""
    rows = materialize(df.select(F.col(id_col).alias("id"), *measures(id_col, text)), "shard-rows")
    if shards is None:
        shards = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    return rows, build(rows, shards)


def with_shard(df: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int | None = None,
               target_bytes: int = TARGET_BYTES) -> DataFrame:
    """All columns of ``df`` and ``shard`` (last): no row is shuffled."""
    _, tree = planned(df, id_col, text, shards, target_bytes)
    inner = [f"c{i}" for i in range(len(df.columns))]
    id_at, text_at = df.columns.index(id_col), df.columns.index(text)
    rows = df.toDF(*inner).select(*inner, *measures(f"c{id_at}", f"c{text_at}"))
    return rows.select(*inner, tree.column(lambda leaf: leaf.first).alias("shard")).toDF(*df.columns, "shard")


def shard(df: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int | None = None,
          target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``id_col, size, text_crc32, shard, slot`` for every row."""
    rows, tree = planned(df, id_col, text, shards, target_bytes)
    placed = rows.select("id", "size", "text_crc32", "id_hash", tree.column(lambda leaf: leaf.first).alias("shard"))
    order = exclusive_prefix_sum(placed.withColumn("one", F.lit(1)), ["shard", "text_crc32", "id_hash", "id"], "one",
                                 "position")
    base = order.groupBy("shard").agg(F.min("position").alias("base"))  # a row per shard
    return (order.join(F.broadcast(base), "shard")
            .select(F.col("id").alias(id_col), "size", "text_crc32", "shard",
                    (F.col("position") - F.col("base")).alias("slot")))
