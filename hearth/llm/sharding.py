"""Sharding by a k-d tree over document metadata.

Each node of the tree covers some shards. It is cut along the metadata dimension
in which its rows spread widest, at the weighted quantile that gives either side
its share of the bytes (the median, where the shards are even in number). The
quantile is searched for all nodes of a level at once, by weight histograms over
ever narrower ranges of a row's order key; a histogram has a fixed number of
bins, and no rows move. Ties on the dimension go by a hash of the row, so equal
rows can part. Leaves hold the target bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import keyed, located, staged

BINS = 1024
TOLERANCE = 0.0005      # part of a node's bytes a cut may be off, if rows are that small
SLOT_ROWS = 20_000      # rows of one numbering group
LOW = 31                # bits of an order key that the row's hash takes


@dataclass
class Node:
    first: int          # shards [first, last) of this node
    last: int
    path: Column        # condition of its rows


def metadata(docs: DataFrame) -> DataFrame:
    """One small row per document, written once: row key, id, size, crc32, and the
    dimensions as numbers below 2^31 (null counts as 0): characters, language,
    source, id."""
    text = F.col("text").cast("binary")

    def hashed(c):
        return F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(0)).bitwiseAND((1 << 31) - 1)

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    return staged(keyed(located(docs.select("doc_id", "text", "lang", "source"))).select(
        F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).alias("crc"),
        F.least(size, F.lit((1 << 31) - 1)).alias("d0"), hashed("lang").alias("d1"), hashed("source").alias("d2"),
        F.pmod(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.lit((1 << 31) - 1)).alias("d3"),
        F.xxhash64("__k1", "__k2").bitwiseAND((1 << LOW) - 1).alias("tie"), F.xxhash64("__k1", "__k2").alias("row")))


DIMENSIONS = ("d0", "d1", "d2", "d3")


def order_key(dimension: str) -> Column:
    return F.shiftleft(F.col(dimension).cast("long"), LOW).bitwiseOR(F.col("tie"))


def _case(nodes: list, values: list) -> Column:
    """The value that belongs to a row's node (null outside all)."""
    out = None
    for node, value in zip(nodes, values):
        out = F.when(node.path, value) if out is None else out.when(node.path, value)
    return out


def _widest(rows: DataFrame, nodes: list[Node], spans: dict[str, int]) -> list[tuple[str, int]]:
    """Per node: the dimension with the widest range relative to all rows, and its bytes."""
    got = {r.node: r for r in rows.select(_case(nodes, [F.lit(i) for i in range(len(nodes))]).alias("node"), "size", *DIMENSIONS)
           .filter("node is not null").groupBy("node").agg(
               F.sum("size").alias("bytes"), *[(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]).collect()}
    out = []
    for i in range(len(nodes)):
        r = got.get(i)
        out.append(max(((r[d] / max(1, spans[d]), d) for d in DIMENSIONS), key=lambda x: x[0])[1] if r else DIMENSIONS[0])
    return [(d, got[i].bytes if i in got else 0) for i, d in enumerate(out)]


def _cuts(rows: DataFrame, nodes: list[Node], dims: list[str], wanted: list[float], total: list[int]) -> list[int]:
    """Per node the least order key with at least ``wanted`` bytes at or below it
    (to within ``TOLERANCE``): the cut is after that key."""
    lo, hi = [0] * len(nodes), [(1 << 62) - 1] * len(nodes)
    below = [0] * len(nodes)
    open_ = [i for i in range(len(nodes)) if total[i]]
    while open_:
        some = [nodes[i] for i in open_]
        width = [-(-(hi[i] - lo[i] + 1) // BINS) for i in open_]
        node = _case(some, [F.lit(i) for i in open_])
        key = _case(some, [order_key(dims[i]) for i in open_])
        index = _case(some, [F.expr(f"((shiftleft(cast({dims[i]} as bigint), {LOW}) | tie) - {lo[i]}L) div {w}L")
                             for i, w in zip(open_, width)])
        inside = _case(some, [(order_key(dims[i]) >= lo[i]) & (order_key(dims[i]) <= hi[i]) for i in open_])
        got = rows.select(node.alias("node"), index.alias("bin"), inside.alias("inside"), key.alias("key"), "size").filter(
            "inside").groupBy("node", "bin").agg(F.sum("size").alias("bytes"), F.min("key").alias("a"),
                                                 F.max("key").alias("b"), F.count(F.lit(1)).alias("n")).collect()
        after = []
        for i in open_:
            bins = sorted((r for r in got if r.node == i), key=lambda r: r.bin)
            for r in bins:
                if below[i] + r.bytes >= wanted[i] or r is bins[-1]:
                    break
                below[i] += r.bytes
            # the quantile lies in bin r; its keys run from a to b
            lo[i], hi[i] = r.a, r.b
            if r.a == r.b or r.bytes <= TOLERANCE * total[i]:
                # cut before or after the bin, whichever comes nearer
                before = wanted[i] - below[i] < below[i] + r.bytes - wanted[i]
                lo[i] = hi[i] = r.a - 1 if before else r.b
            else:
                after.append(i)
        open_ = after
    return hi


def tree(rows: DataFrame, shards: int) -> Column:
    """The shard of a metadata row, as an expression of ``shards - 1`` cuts."""
    ends = rows.agg(*[F.max(d).alias(f"{d}b") for d in DIMENSIONS], *[F.min(d).alias(f"{d}a") for d in DIMENSIONS]).first()
    spans = {d: (ends[f"{d}b"] or 0) - (ends[f"{d}a"] or 0) for d in DIMENSIONS}
    level = [Node(0, shards, F.lit(True))]
    leaves = []
    while level:
        leaves += [n for n in level if n.last - n.first == 1]
        level = [n for n in level if n.last - n.first > 1]
        if not level:
            break
        found = _widest(rows, level, spans)
        dims, total = [d for d, _ in found], [b for _, b in found]
        left = [(n.last - n.first) // 2 for n in level]
        wanted = [b * l / (n.last - n.first) for n, b, l in zip(level, total, left)]
        cuts = _cuts(rows, level, dims, wanted, total)
        level = [child for n, d, c, l in zip(level, dims, cuts, left) for child in (
            Node(n.first, n.first + l, n.path & (order_key(d) <= c)),
            Node(n.first + l, n.last, n.path & (order_key(d) > c)))]
    return _case(leaves, [F.lit(n.first) for n in leaves])


def shards_for(rows: DataFrame, target_bytes: int) -> int:
    """Leaves needed for ``target_bytes`` each."""
    return max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))


def numbered(placed: DataFrame) -> DataFrame:
    """``slot`` from 0 without gaps in every ``shard``: rows are numbered within
    small groups, which follow one another by the counts of the groups before."""
    placed = staged(placed)
    count = placed.count()
    groups = max(64, -(-count // SLOT_ROWS))
    dealt = placed.withColumn("part", F.pmod(F.xxhash64("row", F.lit(7)), F.lit(groups)).cast("int"))
    sizes = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.selectExpr("shard", "part", "sum(n) over (partition by shard order by part) - n as start")
    inner = dealt.selectExpr("*", "row_number() over (partition by shard, part order by doc_id, row) - 1 as i")
    return inner.join(before, ["shard", "part"]).withColumn("slot", (F.col("start") + F.col("i")).cast("long")).drop("part", "start", "i")


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """One row per document of ``docs`` (``doc_id, text, lang, source``): ``doc_id,
    size`` (UTF-8 bytes plus 1), ``crc, shard, slot``. Shards are as many as given,
    or as ``target_bytes`` asks for; their bytes differ by about a row per cut.

    Null texts weigh 1; null metadata sorts as 0; equal and repeated rows are
    spread by their place in the input. An empty table gives no rows.
    """
    rows = metadata(docs)
    shards = shards or shards_for(rows, target_bytes)
    placed = rows.withColumn("shard", tree(rows, shards).cast("int"))
    return numbered(placed.select("doc_id", "size", "crc", "row", "shard")).select("doc_id", "size", "crc", "shard", "slot")
