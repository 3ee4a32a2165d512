"""Hard-negative mining by angular triangle filtering.

Every row stores its angles to a few reference directions. For an anchor at angle
``a`` and a row at angle ``t`` to the same direction, the angle between the two lies
between ``|a - t|`` and ``min(a + t, 2 pi - a - t)``; over all directions that is an
interval of cosines, and times both norms an interval of scores, widened against
rounding. Rows are stored in windows of neighbours (one label, near one direction, by
angle), whose intervals hold for all their rows, and only the (anchor, window) pairs
whose interval overlaps the scores still wanted get the integer inner products.

The anchors are a stated query set: they are dealt into blocks of bounded size, and
each block meets all rows, window by window, in the tasks that hold the rows. A task
keeps the best few per anchor, and those meet by anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import Shipped, ensure_checkpoints, map_batches, staged

QUANTUM = 256
DIRECTIONS = 16
ANCHORS = 1 << 15           # anchors of a block, about
CHUNK = 2048                # anchors of a block that meet a window at a time
WINDOW = 250                # rows of a window at most
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90          # percent of the positive's score
SAFE_ANGLE = 1e-6           # more than an arc cosine of rounded doubles can be off
NONE = np.iinfo(np.int64).min
FITS = np.iinfo(np.int64).max


def valid_rows(rows: DataFrame) -> DataFrame:
    """``vec_id, label, q`` of the rows that take part: id, label and vector are not
    null, and no component is null or not finite. ``q`` is floor(256 x); labels of ids
    divisible by 7 move on by one."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    label = F.col("label").cast("long")
    return rows.filter(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull()).filter(finite).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform("embedding", lambda x: F.floor(F.lit(QUANTUM).cast("double") * x.cast("double")).cast("long")).alias("q"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows of 64-bit numbers; shorter ones end in zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    if len(flat) == width * len(column):
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), dtype=np.int64)
    for i, part in enumerate(np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []):
        out[i, :len(part)] = part
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products, by floating point where all sums are exact; what
    does not fit 64 bits becomes the nearest number that does."""
    most = (float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) + 1) * a.shape[1]
    if most < 2 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < 2 ** 62:
        return a @ b.T
    return np.clip(a.astype(object) @ b.T.astype(object), -FITS, FITS).astype(np.int64)


def angles_to(q: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(norms, angles to the unit directions); a zero vector's angles are right."""
    x = q.astype(np.float64)
    norms = np.sqrt((x * x).sum(axis=1))
    unit = x / np.where(norms > 0, norms, 1)[:, None]
    return norms, np.arccos(np.clip(unit @ directions.T, -1, 1))


def reference_directions(rows: DataFrame, width: int, most: int = DIRECTIONS) -> np.ndarray:
    """Unit vectors of ``most`` rows, drawn by a hash of the id (fewer, if there are
    fewer rows). They decide what is skipped, never what is found."""
    taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "label", "q").limit(most).toArrow()
    q = np.unique(matrix(taken.column("q").combine_chunks(), width), axis=0).astype(np.float64) if taken.num_rows else np.zeros((0, width))
    norms = np.sqrt((q * q).sum(axis=1))
    q, norms = q[norms > 0], norms[norms > 0]
    return q / norms[:, None] if len(q) else np.eye(1, width)


def stored_angles(rows: DataFrame, directions: np.ndarray, width: int) -> DataFrame:
    """``vec_id, label, near, angle, norm, angles, q``, written in the order of label,
    nearest direction and angle to it: neighbours in a file make a window. Copies
    differ by id, so a group of them spreads over partitions."""
    shipped = Shipped(rows.sparkSession, directions)

    def run(batches):
        held = shipped.get()
        for batch in batches:
            q = matrix(batch.column(2), width)
            norms, angles = angles_to(q, held)
            near = angles.argmin(axis=1)
            offsets = pa.array(np.arange(len(q) + 1, dtype=np.int32) * angles.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(near.astype(np.int32)), pa.array(angles[np.arange(len(q)), near]),
                 pa.array(norms), pa.ListArray.from_arrays(offsets, pa.array(angles.ravel())), batch.column(2)],
                names=["vec_id", "label", "near", "angle", "norm", "angles", "q"])

    out = map_batches(rows, run, "vec_id long, label long, near int, angle double, norm double, angles array<double>, q array<long>")
    order = ["label", "near", "angle", "vec_id"]
    return staged(out.repartitionByRange(*order).sortWithinPartitions(*order))


def windows(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(label, ids, norms, angles, vectors) of neighbouring rows of one label and one
    nearest direction."""
    if not batch.num_rows:
        return
    label, near, norm = (batch.column(i).to_numpy() for i in (1, 2, 4))
    angles = batch.column(5).flatten().to_numpy().reshape(batch.num_rows, -1)
    ids, q = batch.column(0).to_numpy(), matrix(batch.column(6), width)
    changes = np.flatnonzero((np.diff(label) != 0) | (np.diff(near) != 0)) + 1
    for a, b in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows]):
        for i in range(a, b, WINDOW):
            part = slice(i, min(b, i + WINDOW))
            yield int(label[a]), ids[part], norm[part], angles[part], q[part]


def score_bounds(norms: np.ndarray, angles: np.ndarray, row_norms: np.ndarray, row_angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) score that each anchor can have with any row of a window."""
    least, most = row_angles.min(axis=0) - SAFE_ANGLE, row_angles.max(axis=0) + SAFE_ANGLE
    low = np.maximum(angles - most, least - angles).max(axis=1) - SAFE_ANGLE
    a, b = angles + least, angles + most
    high = np.where((a <= np.pi) & (b >= np.pi), np.pi, np.maximum(np.minimum(a, 2 * np.pi - a), np.minimum(b, 2 * np.pi - b)))
    high = high.min(axis=1) + SAFE_ANGLE
    upper, lower = np.cos(np.clip(low, 0, np.pi)), np.cos(np.clip(high, 0, np.pi))
    top = norms * np.where(upper >= 0, row_norms.max(), row_norms.min()) * upper
    bottom = norms * np.where(lower >= 0, row_norms.min(), row_norms.max()) * lower
    slack = 1 + 1e-9 * norms * row_norms.max()
    return np.clip(np.floor(bottom - slack), -FITS, FITS), np.clip(np.ceil(top + slack), -FITS, FITS)


class Best:
    """The best ``k`` (score, id) of each of ``n`` lists: higher scores first, then
    smaller ids."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), NONE)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def wants(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
        last = self.scores[at, -1]
        return (scores > last) | (scores == last) & (ids < self.ids[at, -1])

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        lists = np.unique(at)
        at = np.concatenate([np.repeat(lists, self.k), at])
        scores = np.concatenate([self.scores[lists].ravel(), scores])
        ids = np.concatenate([self.ids[lists].ravel(), ids])
        order = np.lexsort((ids, np.where(scores == NONE, 1, 0), -np.maximum(scores, NONE + 1), at))
        at, scores, ids = at[order], scores[order], ids[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        top = rank < self.k
        self.scores[at[top], rank[top]] = scores[top]
        self.ids[at[top], rank[top]] = ids[top]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, rank = np.nonzero(self.scores != NONE)
        return at, self.scores[at, rank], self.ids[at, rank]


class Block:
    """Anchors of one block: ids, labels, vectors, norms, angles; later their
    positives' scores (anchor x place, ``NONE`` where there is none)."""

    def __init__(self, rows: pa.Table, directions: np.ndarray, width: int):
        self.ids, self.labels = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
        self.q = matrix(rows.column("q").combine_chunks(), width) if rows.num_rows else np.zeros((0, width), np.int64)
        self.norms, self.angles = angles_to(self.q, directions)
        self.positives: np.ndarray | None = None


def positive_candidates(block: Block, batches, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, score, id): the best of a task's rows of the anchor's label."""
    best = Best(len(block.ids), POSITIVES)
    for batch in batches:
        for label, ids, norms, angles, q in windows(batch, width):
            same = np.flatnonzero(block.labels == label)
            for i in range(0, len(same), CHUNK):
                at = same[i:i + CHUNK]
                _, top = score_bounds(block.norms[at], block.angles[at], norms, angles)
                at = at[top >= best.scores[at, -1]]
                if not len(at):
                    continue
                scores = inner(block.q[at], q)
                a, r = np.nonzero((scores >= best.scores[at, -1][:, None]) & (ids[None, :] != block.ids[at][:, None]))
                found, score = at[a], scores[a, r]
                keep = best.wants(found, score, ids[r])
                if keep.any():
                    best.add(found[keep], score[keep], ids[r][keep])
    return best.rows()


def wanted_scores(positives: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) score of a negative per positive; an empty range where there
    is no positive."""
    there = positives != NONE
    k, r = np.divmod(np.where(there, positives, 1), 100)        # no product leaves 64 bits
    low, high = LOW * k - (-LOW * r // 100), HIGH * k + HIGH * r // 100
    return np.where(there, low, 1), np.where(there, high, 0)


def negative_candidates(block: Block, batches, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, positive's place, score, id): the best of a task's rows of other
    labels within each positive's scores."""
    n = len(block.ids)
    low, high = wanted_scores(block.positives)
    open_ = low <= high
    best = Best(n * POSITIVES, NEGATIVES)
    floor = np.where(open_, low, np.iinfo(np.int64).max)
    for batch in batches:
        for label, ids, norms, angles, q in windows(batch, width):
            other = np.flatnonzero((block.labels != label) & open_.any(axis=1))
            for i in range(0, len(other), CHUNK):
                at = other[i:i + CHUNK]
                bottom, top = score_bounds(block.norms[at], block.angles[at], norms, angles)
                least = np.maximum(floor[at], best.scores[:, -1].reshape(n, POSITIVES)[at])
                overlaps = (top[:, None] >= least) & (bottom[:, None] <= high[at]) & open_[at]
                at, least = at[overlaps.any(axis=1)], least[overlaps.any(axis=1)]
                if not len(at):
                    continue
                scores = inner(block.q[at], q)
                greatest = np.where(open_[at], high[at], NONE).max(axis=1)
                a, r = np.nonzero((scores >= least.min(axis=1)[:, None]) & (scores <= greatest[:, None]))
                score = scores[a, r]
                for j in range(POSITIVES):
                    place = at[a] * POSITIVES + j
                    keep = (score >= least[a, j]) & (score <= high[at[a], j]) & open_[at[a], j]
                    keep[keep] = best.wants(place[keep], score[keep], ids[r[keep]])
                    if keep.any():
                        best.add(place[keep], score[keep], ids[r[keep]])
    place, score, ids = best.rows()
    return place // POSITIVES, place % POSITIVES, score, ids


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _mined(rows: DataFrame, block: Block, times: dict[int, int], width: int) -> DataFrame:
    spark = rows.sparkSession
    shipped = Shipped(spark, block)

    def positives(batches):
        a, score, ids = positive_candidates(shipped.get(), batches, width)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, score, ids)], names=["anchor", "score", "id"])

    chosen = staged(_best(map_batches(rows, positives, "anchor long, score long, id long"), ["anchor"], POSITIVES))
    taken = chosen.toArrow()        # POSITIVES rows for each anchor of the block
    block.positives = np.full((len(block.ids), POSITIVES), NONE)
    block.positives[taken.column("anchor").to_numpy(), taken.column("place").to_numpy() - 1] = taken.column("score").to_numpy()
    second = Shipped(spark, block)

    def negatives(batches):
        a, j, score, ids = negative_candidates(second.get(), batches, width)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, j, score, ids)], names=["anchor", "positive", "score", "id"])

    found = _best(map_batches(rows, negatives, "anchor long, positive long, score long, id long"), ["anchor", "positive"], NEGATIVES)
    named = spark.createDataFrame(pa.table({
        "anchor": pa.array(np.arange(len(block.ids)), pa.int64()), "anchor_id": pa.array(block.ids, pa.int64()),
        "times": pa.array([times.get(i, 1) for i in range(len(block.ids))], pa.int64())}))
    pairs = chosen.select("anchor", (F.col("place") - 1).cast("long").alias("positive"), F.col("id").alias("positive_id"),
                          F.col("score").alias("positive_score")).join(named, "anchor")
    return found.join(pairs, ["anchor", "positive"]).select(
        "anchor_id", "positive_id", F.col("place").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"), F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("t")).drop("t")


def mine(vectors: DataFrame, is_anchor: Column | None = None, block_anchors: int = ANCHORS) -> DataFrame:
    """Hard negatives of every anchor (default: ids divisible by 100) among all rows of
    ``vectors`` (``vec_id, embedding, label``; other columns are not read):
    ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A score is the integer inner product of floor(256 x) with the anchor; higher ones
    come first, ties by the smaller id. Positives are the first 5 other rows of the
    anchor's label; for each, the first 10 rows of other labels whose score is 30 to 90
    percent of the positive's. Rows without id, label or vector, or with a null or
    non-finite component, take no part. A shorter vector counts as ending in zeros.
    Rows with the anchor's own id are the anchor; other repeated rows each count, and a
    repeated anchor is mined as often. A score that does not fit 64 bits is the
    nearest number that does. An empty table gives no rows."""
    spark = vectors.sparkSession
    ensure_checkpoints(spark)
    rows = valid_rows(vectors)
    width = max(1, rows.agg(F.max(F.size("q"))).first()[0] or 1)
    directions = reference_directions(rows, width)
    stored = stored_angles(rows, directions, width)
    anchors = stored.filter(F.col("vec_id") % 100 == 0 if is_anchor is None else is_anchor).groupBy(
        "vec_id", "label", "q").agg(F.count(F.lit(1)).alias("times"))
    anchors = staged(anchors.withColumn("hash", F.xxhash64("vec_id", "label", "q")))
    blocks = max(1, -(-anchors.count() // block_anchors))
    parts = []
    for b in range(blocks):
        taken = anchors.filter(F.pmod("hash", F.lit(blocks)) == b).orderBy("vec_id", "label", "q").toArrow()
        times = {i: n for i, n in enumerate(taken.column("times").to_pylist()) if n > 1}
        found = _mined(stored, Block(taken, directions, width), times, width)
        parts.append(found if blocks == 1 else staged(found))
    return reduce(DataFrame.unionAll, parts)


ORACLE_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.q, r.q)::BIGINT AS score
      FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
