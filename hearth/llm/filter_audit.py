"""How filters interact: what each one removes, in every order they may run in.

Five conditions give every document a mask of five bits, and what the audit has to
know of the corpus is one row per part and mask: a cell with its number of
documents, good ones and toxic ones. Each cell is folded across the broadcast array
of all 120 orders with ``aggregate`` and ``transform``; that makes 600 structs, one
per order and step, weighted by the cell's counts. The cells of a part (32 at most)
are merged by elementwise sums.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import staged

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MIN_WORDS = 100
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
STEP = f"array<struct<filter:string,{','.join(f'{c}:bigint' for c in COUNTS)}>>"
BLANKS = " \t\n\x0b\x0c\r"


def text_mask(text: Column) -> Column:
    """Bits of A to D: what the text alone decides (null: empty)."""
    t = F.coalesce(text, F.lit(""))
    words = F.split(F.btrim(t, F.lit(BLANKS)), r"[\x20\x09-\x0D]+")
    n = F.when(words[0] == "", 0).otherwise(F.size(words))
    distinct = F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(t, "[^A-Z]+", ""))
    failures = [n < MIN_WORDS, F.lit(100) * distinct < F.lit(80) * n,
                F.lit(100).cast("long") * capitals > F.lit(10).cast("long") * F.length(t), t.rlike("[#$%&*|]")]
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(failures)), F.lit(0))


def documents_by_text(docs: DataFrame) -> DataFrame:
    """``doc_id, digest, mask, part, n``: equal rows of ``docs`` counted together, the
    text as its digest. No text is shuffled."""
    t = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.sha2(t.cast("binary"), 256)).alias("digest"),
                       text_mask(F.col("text")).alias("mask"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")
                       ).groupBy("doc_id", "digest", "mask", "part").agg(F.count(F.lit(1)).alias("n"))


def flags(labels: DataFrame) -> DataFrame:
    """``doc_id, good, toxic`` (0 or 1): 1 where any label row of the id says so."""
    def said(c):
        return F.max(F.coalesce(F.col(c) == 1, F.lit(False)).cast("int"))
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").filter("doc_id IS NOT NULL").groupBy(
        "doc_id").agg(said("quality").alias("good"), said("toxic").alias("toxic"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by part and by the filters they fail.

    Filter E fails for all copies of a text but those of its smallest id. A text's
    first rows come from one aggregate over (id, flags, parts) structs, combined before
    the shuffle, so copies never meet in one task and no row is joined back: all rows
    are counted as failing E, and the first ones are then moved. A row without an id
    has no smaller one, nor is it smaller than any, and does not fail E. The narrow
    rows are written once; texts are read once."""
    rows = staged(documents_by_text(docs).join(flags(labels), "doc_id", "left").select(
        "doc_id", "digest", "mask", "part", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))

    def summed(df: DataFrame, bit: int, sign: int = 1) -> DataFrame:
        n = F.col("n") * sign
        return df.select("part", (F.col("mask") + bit).alias("mask"), n.alias("n"), (n * F.col("good")).alias("good"),
                         (n * F.col("toxic")).alias("toxic"))

    named = rows.filter("doc_id IS NOT NULL")
    one_id = named.groupBy("digest", "mask", "doc_id", "good", "toxic").agg(
        F.sort_array(F.collect_list(F.struct("part", "n"))).alias("parts"))
    first = one_id.groupBy("digest", "mask").agg(F.min(F.struct("doc_id", "good", "toxic", "parts")).alias("f")).select(
        "mask", "f.good", "f.toxic", F.explode("f.parts").alias("p")).select("mask", "good", "toxic", "p.part", "p.n")
    copy = 1 << FILTERS.index("E")
    every = summed(named, copy).unionAll(summed(first, copy, -1)).unionAll(summed(first, 0)).unionAll(
        summed(rows.filter("doc_id IS NULL"), 0))
    return every.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic"))).filter("n > 0")


def fold_orders(mask: Column, n: Column, good: Column, toxic: Column) -> Column:
    """One cell across all orders: 600 structs, orders in turn, five steps each."""
    orders = F.array(*map(F.lit, ORDERS))

    def bit(letter: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1), F.ascii(letter) - ord("A"))

    def step(state: Column, letter: Column) -> Column:
        fails = mask.bitwiseAND(bit(letter)) != 0
        gone = state["gone"]
        first = fails & ~gone

        def weigh(condition, by):
            return F.when(condition, by).otherwise(F.lit(0).cast("long"))

        new = F.struct(letter.alias("filter"), weigh(~gone & ~fails, n).alias("kept"), weigh(first, n).alias("removed"),
                       weigh(fails & gone, n).alias("redundant"), weigh(mask == bit(letter), n).alias("unique_fails"),
                       weigh(first, good).alias("good_lost"), weigh(first, toxic).alias("toxic_lost"))
        return F.struct((gone | fails).alias("gone"), F.concat(state["steps"], F.array(new).cast(STEP)).alias("steps"))

    def order(letters: Column) -> Column:
        start = F.struct(F.lit(False).alias("gone"), F.array().cast(STEP).alias("steps"))
        each = F.transform(F.sequence(F.lit(1), F.length(letters)), lambda i: F.substring(letters, i, F.lit(1)))
        return F.aggregate(each, start, step, lambda s: s["steps"])

    return F.flatten(F.transform(orders, order))


def merged(folded: Column) -> Column:
    """Elementwise sums of arrays of 600 structs."""
    def add(a: Column, b: Column) -> Column:
        return F.struct(a["filter"].alias("filter"), *((a[c] + b[c]).alias(c) for c in COUNTS))
    return F.aggregate(F.slice(folded, 2, 31), folded[0], lambda x, y: F.zip_with(x, y, add).cast(STEP))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (``lang``; null: empty string), order of the five filters and
    step: ``part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley``.

    ``docs`` needs ``doc_id, text, lang`` and ``labels`` ``doc_id, quality, toxic``;
    other columns are not read. Null and empty texts have no words and fail A; a
    repeated row counts as often as it stands; documents without labels are neither
    good nor toxic. Empty ``docs`` give no rows."""
    folded = cells(docs, labels).select("part", fold_orders(F.col("mask"), F.col("n"), F.col("good"), F.col("toxic")).alias("steps"))
    parts = folded.groupBy("part").agg(F.collect_list("steps").alias("cells")).select("part", merged(F.col("cells")).alias("steps"))
    by_filter = F.create_map(*(x for f in FILTERS for x in (F.lit(f), F.aggregate(
        F.filter("steps", lambda s: s["filter"] == f), F.lit(0).cast("long"), lambda a, s: a + s["removed"]))))
    rows = parts.select("part", by_filter.alias("shapley"), F.posexplode("steps").alias("i", "s"))
    return rows.select("part", F.element_at(F.array(*map(F.lit, ORDERS)), (F.col("i") / 5).cast("int") + 1).alias("filter_order"),
                       (F.col("i") % 5 + 1).cast("int").alias("step"), *(F.col(f"s.{c}").alias(c) for c in COUNTS),
                       F.element_at("shapley", F.col("s.filter")).alias("shapley"))


def oracle_sql() -> str:
    """DuckDB text of ``audit`` over ``documents`` and ``labels``."""
    words = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
    return rf"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {words} AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             [len(w) < {MIN_WORDS}, 100 * len(list_distinct(w)) < 80 * len(w),
              100 * len(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * len(t),
              regexp_matches(t, '[#$%&*|]'), coalesce(w.doc_id > first, false)] AS fails
      FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY 1, 2),
o AS (SELECT unnest([{', '.join(f"'{x}'" for x in ORDERS)}]) AS filter_order),
s AS (SELECT filter_order, step, ascii(filter_order[step]) - 64 AS f,
             [ascii(filter_order[i]) - 64 FOR i IN range(1, step)] AS earlier FROM o, range(1, 6) r(step)),
x AS (SELECT part, filter_order, step, f, fails[f] AS fail, list_bool_or([fails[e] FOR e IN earlier]) IS TRUE AS gone,
             fails[f] AND len(list_filter(fails, lambda b: b)) = 1 AS only_it, n, good, toxic FROM c, s),
g AS (SELECT part, filter_order, step, f, sum(CASE WHEN NOT gone AND NOT fail THEN n ELSE 0 END)::BIGINT AS kept,
             sum(CASE WHEN NOT gone AND fail THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN gone AND fail THEN n ELSE 0 END)::BIGINT AS redundant,
             sum(CASE WHEN only_it THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN NOT gone AND fail THEN good ELSE 0 END)::BIGINT AS good_lost,
             sum(CASE WHEN NOT gone AND fail THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM x GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM g
"""
