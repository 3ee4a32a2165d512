"""Language identification by rank-order n-gram profiles (out-of-place distance).

A profile lists a language's most frequent letter n-grams (1 to 3 letters; words
are padded with one blank) in order of frequency. A document's own list is
compared with each: every n-gram costs the difference of its two ranks, or the
profile's length where the profile lacks it; the smallest sum wins.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import Shipped, append_columns, id_crc32, map_batches

COUNT_GRAMS = 500_000 # n-grams of one language that a task gathers before it counts them
PROFILE = 300           # n-grams per profile
UNKNOWN = "und"
MIN_SCORE = 0.2         # the filter rejects texts below it: no profile is near at all


def folding() -> np.ndarray:
    """Per code point: its lower-case letter (the character itself where lower
    case is longer than one), or 0 for anything that is no letter. Built on the
    driver and shipped: a fixed 4 MB."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def grams(text: str, fold: np.ndarray) -> np.ndarray:
    """All n-grams of a text as numbers: three 21-bit places, a blank is 1."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = fold[codes]
    padded = np.zeros(len(letters) + 2, np.int64)
    padded[1:-1] = letters
    some = padded > 0
    # blanks next to a letter stay, others cannot be in an n-gram with a letter
    near = some.copy()
    near[1:] |= some[:-1]
    near[:-1] |= some[1:]
    near[1:] &= ~(~some[1:] & ~some[:-1] & ~np.concatenate([some[2:], [False]]))
    seq = padded[near]
    letter = seq > 0
    seq = np.where(letter, seq, 1)
    one = seq[letter]
    two = (seq[:-1] << 21 | seq[1:])[letter[:-1] | letter[1:]]
    # three places around a letter, never across a blank in the middle
    three = (seq[:-2] << 42 | seq[1:-1] << 21 | seq[2:])[letter[1:-1]]
    return np.concatenate([one, two, three])


def top_grams(text: str, size: int, fold: np.ndarray) -> np.ndarray:
    """A document's most frequent n-grams in rank order (ties: smaller number first)."""
    found, counts = np.unique(grams(text, fold), return_counts=True)
    if len(found) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        some = counts >= least
        found, counts = found[some], counts[some]
    return found[np.argsort(-counts, kind="stable")][:size]


def count_grams(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over the rows of ``docs`` (``lang, text``): every task
    counts its own rows first, so that a shuffle carries one row per task,
    language and n-gram."""
    shipped = Shipped(docs.sparkSession, folding())

    def run(batches):
        fold = shipped.get()
        held: dict[str, list] = {}
        sizes: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    held.setdefault(lang, []).append(grams(text, fold))
                    sizes[lang] = sizes.get(lang, 0) + len(held[lang][-1])
                    if sizes[lang] > COUNT_GRAMS:
                        yield _counted(lang, held.pop(lang))
                        sizes.pop(lang)
        for lang, arrays in held.items():
            yield _counted(lang, arrays)

    parts = map_batches(docs.select("lang", "text"), run, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _counted(lang: str, arrays: list[np.ndarray]) -> pa.RecordBatch:
    found, counts = np.unique(np.concatenate(arrays), return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(counts)],
                                      names=["lang", "gram", "n"])


def train(docs: DataFrame, learn_from: Column | None = None, size: int = PROFILE) -> dict[str, list[int]]:
    """Profiles of all languages in ``docs.lang``, from all rows that
    ``learn_from`` admits (default: all with text and lang). Result size: one list
    of ``size`` numbers per language, whatever the input."""
    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    if learn_from is not None:
        rows = rows.filter(learn_from)
    ranked = count_grams(rows).withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram")))
    profiles: dict[str, list[int]] = {}
    for row in ranked.filter(F.col("r") <= size).groupBy("lang").agg(
            F.array_sort(F.collect_list(F.struct("r", "gram"))).alias("g")).orderBy("lang").collect():
        profiles[row.lang] = [g.gram for g in row.g]
    return profiles


class Scorer:
    """Profiles as one table of ranks: n-gram number -> rank in each language."""

    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.langs = sorted(profiles)
        self.size = size
        self.fold = folding()
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        for j, lang in enumerate(self.langs):
            at = np.searchsorted(self.grams, np.array(profiles[lang], np.int64))
            self.ranks[at, j] = np.arange(len(at))

    def best(self, text: str | None) -> tuple[str, float]:
        """(language, 1 - distance / largest possible distance); of equally near
        languages, the first by name."""
        own = top_grams(text, self.size, self.fold) if text else np.zeros(0, np.int64)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, own)
        at = np.where((at < len(self.grams)) & (self.grams[np.minimum(at, len(self.grams) - 1)] == own), at, len(self.grams))
        ranks = self.ranks[at]
        cost = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        j = int(np.argmin(cost))
        return self.langs[j], float(1 - cost[j] / (self.size * len(own)))


FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())]


def identify(docs: DataFrame, profiles: dict[str, list[int]], size: int = PROFILE) -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``lang_score``, from the whole text alone.
    Null texts, texts without a letter, and any text where no profile was learned
    are ``und`` with score 0."""
    column = docs.columns.index("text")
    shipped = Shipped(docs.sparkSession, Scorer(profiles, size))

    def run(batches):
        scorer = shipped.get()
        for batch in batches:
            found = [scorer.best(t) for t in batch.column(column).to_pylist()]
            yield batch, [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

    return append_columns(docs, FIELDS, run)


def held_out(doc_id: Column, mod: int, remainder: int) -> Column:
    """Whether the id's crc32 falls on the held-out remainder (null id: no)."""
    return F.coalesce(F.pmod(id_crc32(doc_id), F.lit(mod)) == remainder, F.lit(False))


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Rows of ``docs`` in a language that can be told; profiles come from the
    labelled rows of ``docs`` itself. Rejected: ``und`` and scores below
    ``min_score``, so texts in a script of which no row is labelled go. Where no
    profile was learned (``lang`` all null) nothing can be told apart, and every text
    with a letter stays."""
    names = docs.columns
    profiles = train(docs)
    if not profiles:
        return with_letters(docs)
    found = identify(docs, profiles)
    plain = found.toDF(*[f"c{i}" for i in range(len(found.columns))])
    n = len(names)
    return plain.filter((F.col(f"c{n}") != UNKNOWN) & (F.col(f"c{n + 1}") >= min_score)).select(
        *[f"c{i}" for i in range(n)]).toDF(*names)


def with_letters(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose text has a letter."""
    column = docs.columns.index("text")
    shipped = Shipped(docs.sparkSession, folding())

    def run(batches):
        fold = shipped.get()
        for batch in batches:
            yield batch.filter(pa.array([bool(t) and len(grams(t, fold)) > 0 for t in batch.column(column).to_pylist()], pa.bool_()))

    return map_batches(docs, run, docs.schema)
