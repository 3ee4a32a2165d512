"""Exact dedup against history through minimal perfect hashing.

Texts are reduced to SHA-256 digests. The distinct digests of the historical rows
are dealt into buckets of bounded size; each bucket gets a minimal perfect hash
(hash and displace), whose slots hold the full digest, the winning row and the
group size. The distinct digests of the other rows are dealt the same way and
looked up: a slot whose stored digest equals byte for byte is a repeat, anything
else is new and forms its own group.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import ascii_lower, column, keyed, located, renamed, staged
from hearth.plans.joins import broadcast_if_small

BUCKET_KEYS = 2048
GROUP_SIZE = 2      # mean number of keys that share a displacement


def text_digest(text: Column) -> Column:
    """SHA-256 (binary) of the text with A-Z lower-cased; null counts as empty."""
    return F.unhex(F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256))


class PerfectHash:
    """Minimal perfect hash of distinct 32-byte digests: n keys, slots 0 to n-1.

    Keys fall into groups by one part of the digest. A group's displacement is the
    first whose mix with another part sends its keys to different free slots; a
    group of one key names a free slot directly, as ``-slot - 1``. A lookup is one
    displacement and one slot.
    """

    def __init__(self, digests: np.ndarray):
        self.n = len(digests)
        self.groups = max(1, self.n // GROUP_SIZE)
        self.shift = np.zeros(self.groups, np.int64)
        if not self.n:
            return
        group, key = self._parts(digests)
        order = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[order])) + 1
        members = sorted(np.split(order, cuts), key=len, reverse=True)
        taken = np.zeros(self.n, bool)
        single = []
        for keys in members:
            if len(keys) == 1:
                single.append(int(keys[0]))
                continue
            for d in itertools.count(step=64):
                tries = self._mix(key[keys][None, :], np.arange(d, d + 64)[:, None])
                ordered = np.sort(tries, axis=1)
                good = ~taken[tries].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
                if good.any():
                    break
            first = int(np.argmax(good))
            taken[tries[first]] = True
            self.shift[group[keys[0]]] = d + first
        for i, slot in zip(single, np.flatnonzero(~taken)):
            self.shift[group[i]] = -slot - 1

    def _parts(self, digests: np.ndarray):
        words = digests.reshape(-1, 32).view("<u8")
        return (words[:, 1] % np.uint64(self.groups)).astype(np.int64), words[:, 2] ^ words[:, 3]

    def _mix(self, key: np.ndarray, shift: np.ndarray) -> np.ndarray:
        x = key + shift.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(self.n)).astype(np.int64)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """A slot for every digest, member or not (-1 if there are no slots)."""
        if not self.n:
            return np.full(len(digests), -1, np.int64)
        group, key = self._parts(digests)
        d = self.shift[group]
        return np.where(d < 0, -d - 1, self._mix(key, np.maximum(d, 0)))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, column)), np.uint8).reshape(-1, 32).copy()


GROUP_SCHEMA = "digest binary, keep_doc long, keep_k1 long, keep_k2 long, size long, bucket long, slot long, historical boolean"


def _merge_bucket(history: pd.DataFrame, fresh: pd.DataFrame) -> pd.DataFrame:
    """Slot table of one bucket, updated with the other rows' groups; new digests follow."""
    frame = history if len(history) else fresh
    bucket = int(frame["bucket"].iloc[0])
    history, fresh = (x if len(x) else frame.iloc[:0] for x in (history, fresh))
    stored, asked = _matrix(history["digest"]), _matrix(fresh["digest"])
    mph = PerfectHash(stored)
    table = np.empty(mph.n, np.int64)           # slot -> row of the history
    own = mph.slots(stored)
    table[own] = np.arange(mph.n)
    at = mph.slots(asked)
    member = np.zeros(len(asked), bool)
    if mph.n and len(asked):
        member = (stored[table[at]] == asked).all(axis=1)

    def winner(r):
        # nulls first, then the larger id, then the larger row key
        return (r[0] is not None, r[0] or 0, r[1], r[2])

    new = []
    keep = list(zip(_longs(history["doc"]), history["k1"], history["k2"]))
    size = list(history["size"])
    asking = zip(fresh["digest"], zip(_longs(fresh["doc"]), fresh["k1"], fresh["k2"]), fresh["size"])
    for (digest, mine, count), target, hit in zip(asking, at, member):
        if hit:
            h = int(table[target])
            keep[h] = max(keep[h], mine, key=winner)
            size[h] += count
        else:
            new.append((digest, *mine, count, bucket, -1, False))
    out = [(d, *keep[j], size[j], bucket, int(own[j]), True) for j, d in enumerate(history["digest"])] + new
    result = pd.DataFrame(out, columns=["digest", "keep_doc", "keep_k1", "keep_k2", "size", "bucket", "slot", "historical"])
    result["keep_doc"] = result["keep_doc"].astype("Int64")
    return result


def _longs(column: pd.Series) -> list[int | None]:
    """Ids travel as text so that a null beside them cannot turn them into doubles."""
    return [None if x is None else int(x) for x in column]


def digest_rows(docs: DataFrame, history: Column) -> DataFrame:
    """One small row per document, written once: row key, id, digest, side."""
    rows = keyed(docs).select(
        F.col("__k1").alias("k1"), F.col("__k2").alias("k2"), F.col("doc_id").cast("long").alias("doc"),
        text_digest(F.col("text")).alias("digest"), F.coalesce(history, F.lit(False)).alias("historical"))
    return staged(rows)


def equal_groups(rows: DataFrame, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row per distinct digest: winner, size, and where the historical slot
    table holds it (``slot`` -1: not historical)."""
    groups = staged(rows.groupBy("digest", "historical").agg(
        F.max(F.struct("doc", "k1", "k2")).alias("w"), F.count(F.lit(1)).alias("size")))
    buckets = max(1, -(-groups.count() // bucket_keys))
    dealt = groups.select(F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket"), "digest", "historical",
                          F.col("w.doc").cast("string").alias("doc"), F.col("w.k1").alias("k1"), F.col("w.k2").alias("k2"), "size")
    # the sides need column identities of their own, or cogroup mixes them up
    old = dealt.filter("historical")
    new = dealt.filter(~F.col("historical")).select([F.col(c).alias(c) for c in dealt.columns])
    return old.groupBy("bucket").cogroup(new.groupBy("bucket")).applyInPandas(_merge_bucket, GROUP_SCHEMA)


def even_ids(doc_id: str = "doc_id") -> Column:
    """The default history: rows with an even id."""
    return F.pmod(F.col(doc_id).cast("long"), F.lit(2)) == 0


def decide(docs: DataFrame, history: Column | None = None) -> DataFrame:
    """One row per document of ``docs``: ``doc_id, keep_id, group_size, kept,
    digest, historical`` and the row key ``k1, k2``.

    Null texts count as empty. Of rows that share id and text, the one later in
    the input stays. A null id loses to any other; a group of null ids keeps one
    row and has a null ``keep_id``. ``history`` marks the historical rows.
    """
    # the needed columns only: others may have any names
    docs = docs.select("doc_id", "text", (even_ids() if history is None else history).alias("history"))
    rows = digest_rows(located(docs), F.col("history"))
    groups = equal_groups(rows)
    joined = rows.select("k1", "k2", "doc", "digest").join(groups, "digest")
    return joined.select(F.col("doc").alias("doc_id"), F.col("keep_doc").alias("keep_id"), F.col("size").alias("group_size"),
                         ((F.col("k1") == F.col("keep_k1")) & (F.col("k2") == F.col("keep_k2"))).alias("kept"),
                         "digest", "historical", "slot", "k1", "k2")


def dedup(docs: DataFrame, history: Column | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names.
    ``docs`` may be any table, a derived one too; null texts count as empty, repeated
    rows leave one, and an empty table stays empty."""
    inner = located(renamed(docs if history is None else docs.select("*", history)))
    told = inner.select(F.col(column(docs, "doc_id")).alias("doc_id"), F.col(column(docs, "text")).alias("text"),
                        *([] if history is None else [F.col(f"c{len(docs.columns)}").alias("history")]))
    dropped = staged(decide(told, None if history is None else F.col("history")).filter(~F.col("kept")).select(
        F.col("k1").alias("__k1"), F.col("k2").alias("__k2")))
    kept = keyed(inner).join(broadcast_if_small(dropped), ["__k1", "__k2"], "left_anti")
    return kept.select(*[f"c{i}" for i in range(len(docs.columns))]).toDF(*docs.columns)
