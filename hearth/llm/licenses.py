"""Licence scan by diagonal voting.

All rolling 2-, 3- and 5-word hashes of every document are joined to the places of
the same grams in licence templates: phrases of two words have 2-word grams, notices
3-word ones, and texts of more than ``LONG`` words, of which 3-word grams stand in any
prose, 5-word ones. Templates are a parameter. A match at document word p and template word
t votes for diagonal p - t; votes are counted per document, template and diagonal,
neighbouring diagonals (words left out or put in) are merged, and a span counts
once the matched words, compared as words, cover enough of its template. Where spans
of several templates overlap, as those of like licences do, the one with most matched
words stays (of equals, that which covers most of its template).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hearth.llm.common import WORD_TABLE, Shipped, binaries, byte_words, map_batches
from hearth.llm.hashing import WordHasher, rolled
from hearth.llm.license_texts import TEXTS
from hearth.plans.joins import BROADCAST_MAX_BYTES

#: Base phrases and their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: Notices looked for besides (label, words); ``TEXTS`` holds whole licences.
NOTICES = [
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files the software to deal in the software without restriction"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-3.0", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                "general public license as published by the free software foundation either version 3 of the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0"),
    ("cc-by-nc-4.0", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
]

COVER = 0.75        # least part of a template that a span must match
GAP = 3             # diagonals at most so far apart belong together
LONG = 48           # words of a template from which on its grams have five
SIZES = (2, 3, 5)   # words of a gram


class Grams:
    """Places of ``BASE`` and of ``templates`` (label, text) by gram hash: a
    configuration that the driver holds. A template without words takes no part, one of
    a single word cannot be told by its grams and is refused."""

    def __init__(self, templates: list[tuple[str, str]] | None = None):
        self.rows = []      # hash, template, place, gram, k, length, label, base
        hasher = WordHasher(WORD_TABLE)
        parts: dict[int, set[int]] = {k: set() for k in SIZES}
        others = NOTICES + TEXTS if templates is None else templates
        for number, (label, text, base) in enumerate([(l, t, True) for t, l in BASE] + [(l, t, False) for l, t in others]):
            words = [w.decode() for w in byte_words(text.encode())]
            if not words:
                continue
            if len(words) < 2:
                raise ValueError(f"a template needs two words: {label}")
            k = max(n for n in SIZES if n <= len(words) and (n < 5 or len(words) > LONG))
            hashes = np.concatenate([x.hashes for x in hasher.slabs([text.encode()])])
            parts[k].update(hashes.tolist())
            for place, gram in enumerate(rolled(hashes, k).tolist()):
                self.rows.append((gram, number, place, " ".join(words[place:place + k]), k, len(words), label, base))
        #: Hashes of the words that grams of each size are made of.
        self.parts = {k: np.array(sorted(v), np.uint64) for k, v in parts.items()}

    def bytes(self) -> int:
        """About what the table takes."""
        return sum(64 + len(r[3]) + len(r[6]) for r in self.rows)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, "hash long, template int, place int, gram string, k int, length int, "
                                                "label string, base boolean")


GRAM_SCHEMA = f"row long, doc long, at int, {', '.join(f'h{k} long' for k in SIZES)}, words string, n_words long"


def gram_rows(docs: DataFrame, grams: Grams) -> DataFrame:
    """One row per document word: the hashes of the words from there on, of each
    size (null at the end of the text), and the words themselves where all are words of
    templates. A further row per document (``at`` -1) carries its number of words.
    ``row`` numbers documents; all rows of one come from the same task attempt."""
    shipped = Shipped(docs.sparkSession, grams.parts)

    def ahead(values: np.ndarray, n: int, left: np.ndarray, k: int, none):
        """``values`` of each k words in a row, per word; none where the text ends before."""
        full = np.full(n, none, values.dtype)
        full[:len(values)] = values
        return np.where(left >= k, full, none)

    def rows_of(slab, ids, first, parts):
        n = len(slab.hashes)
        count = np.diff(slab.offsets)
        doc = np.repeat(np.arange(len(count)), count)
        at = np.arange(n) - np.repeat(slab.offsets[:-1], count)
        left = np.repeat(count, count) - at             # words from here to the end of the text
        held = np.zeros(n, bool)
        hashes = []
        for k in SIZES:
            hashes.append(pa.array(ahead(rolled(slab.hashes, k), n, left, k, 0), mask=left < k))
            known = np.isin(slab.hashes, parts[k])
            run = known[:max(0, n - k + 1)].copy()
            for i in range(1, k):
                run &= known[i:len(run) + i]
            held |= ahead(run, n, left, k, False)
        words = np.full(n, None, object)
        for i in np.flatnonzero(held).tolist():
            words[i] = b" ".join(slab.word(j) for j in range(i, i + min(SIZES[-1], int(left[i])))).decode()
        docs_of = pa.array(doc)
        none = pa.nulls(len(count), pa.int64())
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([first + doc, first + np.arange(len(count))])),
            pa.concat_arrays([ids.take(docs_of), ids]),
            pa.array(np.concatenate([at, np.full(len(count), -1)]).astype(np.int32)),
            *[pa.concat_arrays([h, none]) for h in hashes],
            pa.concat_arrays([pa.array(words, pa.string()), pa.nulls(len(count), pa.string())]),
            pa.array(np.concatenate([np.zeros(n, np.int64), count.astype(np.int64)]))],
            names=["row", "doc", "at", *[f"h{k}" for k in SIZES], "words", "n_words"])

    def run(batches):
        parts, hasher = shipped.get(), WordHasher(WORD_TABLE)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            done = 0
            for slab in hasher.slabs(binaries(batch.column(1))):
                size = len(slab.offsets) - 1
                yield rows_of(slab, batch.column(0).slice(done, size), number, parts)
                done += size
                number += size

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), run, GRAM_SCHEMA)


def _votes(docs: DataFrame, templates: list[tuple[str, str]] | None) -> DataFrame:
    """Votes per document, template and diagonal; documents as rows without template."""
    spark = docs.sparkSession
    grams = Grams(templates)
    places = grams.table(spark)
    if grams.bytes() <= BROADCAST_MAX_BYTES:    # Spark knows no size of a driver's list
        places = F.broadcast(places)
    rolled = gram_rows(docs, grams).select(
        "row", "doc", "at", "words", "n_words",
        F.explode(F.when(F.col("at") < 0, F.array(F.lit(None).cast("long"))).otherwise(F.array(*[f"h{k}" for k in SIZES]))).alias("hash"))
    met = rolled.join(places, "hash", "left").filter(
        (F.col("at") < 0) | F.col("template").isNotNull() & F.startswith(
            F.concat("words", F.lit(" ")), F.concat("gram", F.lit(" "))))
    return met.groupBy("row", "doc", "template", "k", "length", "label", "base", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.max("n_words").alias("n_words"), F.collect_set("place").alias("places"))


def spans(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """``row, doc, n_words, template, label, base, start, end, matched, cover``: one
    row per merged span (``matched``: its words), and one with null template per document."""
    votes = _votes(docs, templates)
    near = W.partitionBy("row", "template").orderBy("diagonal")
    apart = F.when(F.col("base") | (F.col("diagonal") - F.lag("diagonal").over(near) > GAP), 1).otherwise(0)
    regions = votes.withColumn("apart", apart).withColumn("region", F.sum("apart").over(near))
    merged = regions.groupBy("row", "doc", "template", "k", "length", "label", "base", "region").agg(
        F.max("n_words").alias("n_words"), F.min("diagonal").alias("first"), F.max("diagonal").alias("last"),
        F.flatten(F.collect_list("places")).alias("places"))
    words = F.expr("size(array_distinct(flatten(transform(places, p -> sequence(p, p + k - 1)))))")
    return merged.select(
        "row", "doc", "n_words", "template", "label", "base", (F.col("first") + F.array_min("places")).alias("start"),
        (F.col("last") + F.array_max("places") + F.col("k")).alias("end"), words.alias("matched"), (words / F.col("length")).alias("cover"))


def scan(docs: DataFrame, cover: float = COVER, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per document of ``docs`` (``doc_id, text``): ``doc_id, n_words,
    n_base, first_word, last_word, base_labels, labels, score``.

    A base place needs its whole phrase; other labels need ``cover`` of a template
    (label, text), by default of ``NOTICES`` and ``TEXTS``.
    ``score`` is the best cover, 1 where a base phrase stands. Null and wordless
    texts have no words, no places, empty labels and score 0; repeated rows and
    null ids are documents of their own.
    """
    found = spans(docs, templates)
    told = found.withColumn("other", F.coalesce(~F.col("base") & (F.col("cover") >= cover), F.lit(False)))
    # overlapping spans of a document are one cluster (0: rows that are no such spans)
    order = W.partitionBy("row").orderBy("other", "start", "end", "template")
    before = F.max(F.when(F.col("other"), F.col("end"))).over(order.rowsBetween(W.unboundedPreceding, -1))
    told = told.withColumn("apart", (F.col("other") & (before.isNull() | (F.col("start") >= before))).cast("int"))
    told = told.withColumn("cluster", F.sum("apart").over(order.rowsBetween(W.unboundedPreceding, 0)))
    rank = F.struct("matched", "cover")
    found = told.withColumn("other", F.col("other") & (rank == F.max(rank).over(W.partitionBy("row", "cluster"))))
    base = F.col("base") & (F.col("cover") == 1)
    other = F.col("other")

    def joined(c):
        return F.array_join(F.array_sort(F.collect_set(c)), ",")

    return found.groupBy("row", F.col("doc").alias("doc_id")).agg(
        F.max("n_words").alias("n_words"), F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.when(base | other, F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(base | other, F.col("cover"))), F.lit(0.0)).alias("score")).drop("row")


def oracle_sql(words: str, cover: float = COVER) -> str:
    """DuckDB text of ``scan`` over ``documents`` without hashes: word grams as
    strings, votes and merged spans as window sums. ``words``: its word list expression."""
    values = ", ".join(f"({n}, {p}, '{g}', {k}, {length}, '{label}', {base})"
                       for _, n, p, g, k, length, label, base in Grams().rows)
    return f"""
WITH t(template, place, gram, k, length, label, base) AS (VALUES {values}),
d AS (SELECT doc_id, {words} AS w FROM documents),
g AS (SELECT doc_id, k, unnest(range(0, len(w) - k + 1)) AS p,
             unnest([array_to_string(w[i + 1:i + k], ' ') FOR i IN range(0, len(w) - k + 1)]) AS gram
      FROM d, (VALUES {', '.join(f'({k})' for k in SIZES)}) AS s(k) WHERE len(w) >= k),
v AS (SELECT DISTINCT doc_id, template, k, length, label, base, p - place AS diagonal, place FROM g JOIN t USING (k, gram)),
dg AS (SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS step
       FROM (SELECT DISTINCT doc_id, template, base, diagonal FROM v)),
rg AS (SELECT doc_id, template, diagonal, count(*) FILTER (base OR step > {GAP})
              OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS region FROM dg),
s AS (SELECT doc_id, template, label, base, region, min(diagonal) + min(place) AS start,
             max(diagonal) + max(place) + any_value(k) AS stop, count(DISTINCT word) AS matched,
             count(DISTINCT word) / any_value(length) AS cover
      FROM (SELECT *, unnest(range(place, place + k)) AS word FROM v JOIN rg USING (doc_id, template, diagonal))
      GROUP BY doc_id, template, label, base, region),
own AS (SELECT *, max(stop) OVER (PARTITION BY doc_id ORDER BY start, stop, template ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
        FROM s WHERE NOT base AND cover >= {cover}),
clusters AS (SELECT *, count(*) FILTER (reach IS NULL OR start >= reach)
                       OVER (PARTITION BY doc_id ORDER BY start, stop, template ROWS UNBOUNDED PRECEDING) AS cluster FROM own),
ok AS (SELECT doc_id, label, base, start, cover FROM s WHERE base AND cover = 1
       UNION ALL
       SELECT doc_id, label, base, start, cover FROM clusters
       QUALIFY rank() OVER (PARTITION BY doc_id, cluster ORDER BY matched DESC, cover DESC) = 1)
SELECT d.doc_id, len(any_value(w))::BIGINT AS n_words, count(*) FILTER (base) AS n_base,
       min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(cover), 0)::DOUBLE AS score
FROM d LEFT JOIN ok USING (doc_id) GROUP BY d.doc_id
"""
