"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Two sets of size >= n that overlap in at least ``a`` tokens share at least ``l`` tokens
among their first ``n - a + l`` in any one global order. The order here is rare
tokens first, by a frequency sketch counted over all documents; every document
picks the ``l`` whose longer prefix costs least, from the estimated lengths of the
posting lists it adds and the candidates that the stricter match count leaves.
A pair must then share ``min(l_x, l_y)`` prefix tokens before it is verified
on the full sets.

Documents with equal sets are one class from the start. Links are wanted for
connectivity, so each posting list is first matched against one hub; only pairs
that those links leave in different components are compared in full. No link
between components can be missed, and large groups of near copies do not turn
into all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from hearth.llm.common import Shipped, binaries, column, keyed, located, map_batches, release, renamed, staged
from hearth.llm.hashing import WordHasher, rolled
from hearth.plans.joins import broadcast_if_small

WORDS = 4                   # words per shingle
PERCENT = 85                # least Jaccard similarity
REGION = 5                  # per cent of a set counted for the order beyond the shortest prefix
SKETCH_CELLS = 1 << 23      # cells of the frequency sketch (one byte each)
FILTER_BITS = 1 << 26       # bits of the filter of rows whose sets are verified
FREQUENT = 3                # log2 of the document frequency from which a token goes last
MOST_MATCHES = 8            # largest l
SHORT_LIST = 8              # postings of a list whose pairs are all formed
VERIFY_COST = 0.2           # cost of verifying a candidate, in posting entries per token of the set
CLASS_ROWS = 10_000         # rows of a class that meet its component in one task
DECAY = 0.5                 # part of the candidates with l matches that has l + 1


#: ASCII blanks become spaces, A-Z lower case.
FOLD = bytes(32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_sets(texts: list[bytes | None], hasher: WordHasher, words: int) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct shingle hashes (words split at ASCII blanks,
    A-Z lower-cased); a text of fewer words is one shingle, without words none."""
    for slab in hasher.slabs(texts):
        grams = rolled(slab.hashes, words)
        for start, end in zip(slab.offsets[:-1].tolist(), slab.offsets[1:].tolist()):
            if end - start >= words:
                tokens = np.sort(grams[start:end - words + 1])
                fresh = np.empty(len(tokens), bool)
                fresh[0] = True
                np.not_equal(tokens[1:], tokens[:-1], out=fresh[1:])
                yield tokens[fresh]
            elif end > start:
                yield rolled(slab.hashes[start:end], end - start)
            else:
                yield np.zeros(0, np.int64)


def set_digest(tokens: np.ndarray) -> bytes:
    return blake2b(tokens.tobytes(), digest_size=16).digest()


def least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def region_size(n: int, percent: int) -> int:
    """Tokens of a set that are counted: its prefix mostly lies among them."""
    return min(n, n * (100 - percent + REGION) // 100 + MOST_MATCHES)


def _has(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & (len(table) * 8 - 1)
    return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))


def _counted(tokens: DataFrame) -> np.ndarray:
    """log2 of how often each token occurs (0: once), per cell; a cell keeps the most."""
    counted = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    cells = counted.select(F.col("token").bitwiseAND(SKETCH_CELLS - 1).cast("int").alias("cell"),
                           F.least(F.lit(15), F.floor(F.log2("n"))).cast("byte").alias("level"))
    got = cells.groupBy("cell").agg(F.max("level").alias("level")).toArrow()
    release(tokens.sparkSession)
    sketch = np.zeros(SKETCH_CELLS, np.uint8)
    sketch[got["cell"].to_numpy()] = got["level"].to_numpy().astype(np.uint8)
    return sketch


def frequency_sketch(texts: DataFrame, words: int, percent: int) -> np.ndarray:
    """log2 of the document frequency, per cell of hashed tokens. First all documents
    count the lowest tokens of their sets (``region_size``), where prefixes come
    from; then those with too many frequent tokens there, whose prefixes must
    reach further, count the rest of theirs. The result has a fixed size."""

    def emit(part):
        def run(batches):
            hasher, seen = WordHasher(FOLD), set()
            for batch in batches:
                out = [np.zeros(0, np.int64)]
                for tokens in shingle_sets(binaries(batch.column(0)), hasher, words):
                    digest = set_digest(tokens)
                    if digest not in seen:
                        seen.add(digest)
                        out.append(part(tokens))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out))], names=["token"])
        return map_batches(texts, run, "token long")

    sketch = _counted(emit(lambda tokens: tokens[:region_size(len(tokens), percent)]))
    shipped = Shipped(texts.sparkSession, sketch)

    def rest():
        known = []

        def part(tokens):
            if not known:
                known.append(shipped.get())
            region = region_size(len(tokens), percent)
            rare = np.count_nonzero(known[0][tokens[:region] & (SKETCH_CELLS - 1)] < FREQUENT)
            enough = rare >= len(tokens) - least_overlap(len(tokens), percent) + MOST_MATCHES
            return tokens[:0] if enough else tokens[region:]
        return part

    return np.maximum(sketch, _counted(emit(rest())))


def adaptive_prefix(tokens: np.ndarray, sketch: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """(prefix, l): the cheapest prefix length and the matches it requires. The
    order is by hash, with frequent tokens last, the most frequent at the end."""
    n = len(tokens)
    level = sketch[tokens & (len(sketch) - 1)]
    order = np.argsort(np.where(level < FREQUENT, 0, level), kind="stable")
    need = least_overlap(n, percent)
    most = min(MOST_MATCHES, need)
    first = order[:n - need + most]
    others = np.exp2(level.astype(np.float64)) - 1
    region = region_size(n, percent)     # beyond it counts may lack documents: take the mean at least
    others[region:] = np.maximum(others[region:], others[:region].mean())
    others = others[first]
    best, cost = 1, np.inf
    for l in range(1, most + 1):
        lists = others[:n - need + l]
        entries = float(lists.sum())
        # a candidate with l matches shows up outside the l - 1 longest lists
        rest = entries if l == 1 else float(np.sort(lists)[:-(l - 1)].sum())
        c = entries + VERIFY_COST * n * min(entries * DECAY ** (l - 1), rest)
        if c < cost:
            best, cost = l, c
    return tokens[first[:n - need + best]], best


PREFIX_SCHEMA = "k1 long, k2 long, doc long, n long, cid binary, l int, prefix array<long>"


def prefixes(rows: DataFrame, sketch: np.ndarray, words: int, percent: int) -> DataFrame:
    """One row per document: key, id, set size, class, and its prefix (empty where
    the same task has already given the class's)."""
    shipped = Shipped(rows.sparkSession, sketch)

    def run(batches):
        sketch, hasher, seen = shipped.get(), WordHasher(FOLD), set()
        none = np.zeros(0, np.int64)
        for batch in batches:
            n, cid, least, out = [], [], [], []
            for tokens in shingle_sets(binaries(batch.column(3)), hasher, words):
                digest = set_digest(tokens)
                prefix, l = none, 1
                if len(tokens) and digest not in seen:
                    seen.add(digest)
                    prefix, l = adaptive_prefix(tokens, sketch, percent)
                n.append(len(tokens))
                cid.append(digest)
                least.append(l)
                out.append(prefix)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n, pa.int64()), pa.array(cid, pa.binary()),
                 pa.array(least, pa.int32()), _lists(out)], names=["k1", "k2", "doc", "n", "cid", "l", "prefix"])

    return map_batches(rows, run, PREFIX_SCHEMA)


def _filter_table(values: DataFrame) -> np.ndarray:
    """Bit table over the long column ``v``: fixed size, may hold more, never less.
    Its 64-bit words are put together on the executors."""
    cell = F.col("v").bitwiseAND(FILTER_BITS - 1)
    words = values.groupBy(F.shiftright(cell, 6).cast("int").alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(63).cast("int"))).alias("b")).toArrow()
    release(values.sparkSession)
    table = np.zeros(FILTER_BITS >> 6, np.int64)
    table[words["w"].to_numpy()] = words["b"].to_numpy()
    return table.view(np.uint8)


def speakers(rows: DataFrame) -> DataFrame:
    """``cid, n, l, prefix``, one row per class: of the rows of several tasks that
    carry a class's prefix the first stays. Only classes with several are listed."""
    spoken = rows.filter(F.size("prefix") > 0)
    several = staged(spoken.groupBy("cid").agg(F.min(F.struct("k1", "k2")).alias("k"), F.count(F.lit(1)).alias("m")).filter(
        "m > 1").select("cid", "k"))
    return spoken.join(broadcast_if_small(several), "cid", "left").filter(
        F.col("k").isNull() | (F.col("k") == F.struct("k1", "k2"))).select("cid", "n", "l", "prefix")


def shared_postings(rows: DataFrame, percent: int) -> DataFrame:
    """One row per class and prefix token that occurs in two prefixes or more:
    ``token, cid, n, l``; ``at``, the token's place in the class's order; ``met``,
    how many such tokens come before it; ``share``, the part of the prefix that is
    left, in thousandths; and ``reach``, the largest set this class can link with if
    this is their first common token or a later one: the tokens before it that
    nobody shares are lost to any overlap."""
    # a class must not come twice: ``cross_pairs`` counts its postings against ``met``
    each = speakers(rows).select("cid", "n", "l", F.size("prefix").alias("size"), F.posexplode("prefix").alias("at", "token"))
    shared = staged(each.groupBy("token").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("token"))
    own = W.partitionBy("cid")
    kept = each.join(shared, "token", "left_semi").select(
        "token", "cid", "n", "l", "at", (F.row_number().over(own.orderBy("at")) - 1).alias("met"),
        F.expr("cast(1000 * count(1) over (partition by cid) div size as int)").alias("share"))
    return kept.withColumn("reach", F.expr(f"(n - (at - met)) * {100 + percent} div {percent} - n"))


def _may_link(x: str, y: str, percent: int):
    """Whether two postings of one token leave room for the similarity: at most the
    smaller ``met`` tokens match before, one here, and all that follow."""
    most = F.least(f"{x}met", f"{y}met") + 1 + F.least(F.col(f"{x}n") - F.col(f"{x}at"), F.col(f"{y}n") - F.col(f"{y}at")) - 1
    sizes = F.col(f"{x}n") + F.col(f"{y}n")
    return (most * (100 + percent) >= sizes * percent) & (
        F.least(f"{x}n", f"{y}n") * 100 >= F.greatest(f"{x}n", f"{y}n") * percent)


def _open_lists(post: DataFrame, percent: int) -> DataFrame:
    """Postings that may link with another component in their list, by the sizes
    there, in lists that still hold two components; ``members``: the list's length."""
    ends = post.groupBy("token").agg(F.min("n").alias("least_n"), F.max("reach").alias("most_n"),
                                     F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo != hi").drop("lo", "hi")
    some = staged(post.join(ends, "token").filter("reach >= least_n and n <= most_n").drop("least_n", "most_n"))
    both = some.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                     F.count(F.lit(1)).alias("members")).filter("lo != hi")
    return staged(some.join(both.select("token", "members"), "token"))


def hub_pairs(post: DataFrame, percent: int) -> DataFrame:
    """Candidates between each open list's hub (the class with most of its prefix
    shared) and the list's other classes."""
    lists = post.groupBy("token").agg(F.max(F.struct("share", "cid", "n", "l", "at", "met", "root")).alias("h"))
    hubs = lists.select("token", *[F.col(f"h.{c}").alias(f"h_{c}") for c in ("cid", "n", "l", "at", "met", "root")])
    met = post.join(hubs, "token").filter((F.col("root") != F.col("h_root")) & _may_link("", "h_", percent))
    return _matched(met.select(F.col("cid").alias("a"), F.col("h_cid").alias("b"), F.least("l", "h_l").alias("l")))


def cross_pairs(post: DataFrame, percent: int) -> DataFrame:
    """All candidates whose two classes lie in different components. Short lists
    give their pairs, which must match often enough. Of long lists, a pair comes
    from one only, that of its first common token: there a posting carries the
    tokens of its class that come before, and ``met`` counts only those in short
    lists, as the others do not match. A pair without a token in a long list has all
    its common tokens in short ones."""
    own = ["cid", "n", "l", "root"]

    def met(postings, columns, unless=None):
        x, y = (postings.select("token", *[F.col(c).alias(f"{side}_{c}") for c in columns]) for side in "xy")
        test = (F.col("x_root") < F.col("y_root")) & _may_link("x_", "y_", percent)
        return x.join(y, "token").filter(test if unless is None else test & ~unless)

    short = met(post.filter(F.col("members") <= SHORT_LIST), [*own, "at", "met"])
    counted = _matched(short.select(F.col("x_cid").alias("a"), F.col("y_cid").alias("b"), F.least("x_l", "y_l").alias("l")))
    whole = post.filter(F.col("members") > SHORT_LIST).groupBy(*own).agg(
        F.array_sort(F.collect_list(F.struct("at", "met", "token"))).alias("all"))
    tokens = whole.select(*own, F.posexplode("all").alias("i", "p"), F.transform("all", lambda t: t["token"]).alias("tokens"))
    long = tokens.select(*own, "p.at", (F.col("p.met") - F.col("i")).alias("met"), "p.token",
                         F.slice("tokens", F.lit(1), F.col("i")).alias("before"))
    once = met(long, [*own, "at", "met", "before"], F.arrays_overlap("x_before", "y_before"))
    return counted.union(once.select(F.col("x_cid").alias("a"), F.col("y_cid").alias("b"))).distinct()


def _matched(met: DataFrame) -> DataFrame:
    """Pairs with enough shared prefix tokens."""
    return met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("m"), F.max("l").alias("l")).filter("m >= l").drop("m", "l")


def class_sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``cid, tokens`` of the classes ``v`` that are wanted, each from one of its
    documents (a few more pass the filter)."""
    chosen = rows.filter(F.size("prefix") > 0).join(wanted.distinct(), F.col("cid") == F.col("v"), "left_semi").groupBy("cid").agg(
        F.min(F.struct("k1", "k2")).alias("k"))
    shipped = Shipped(docs.sparkSession, _filter_table(chosen.select(F.xxhash64("k.k1", "k.k2").alias("v"))))
    texts = keyed(docs).select(F.xxhash64("__k1", "__k2").alias("row"), "text")

    def run(batches):
        bits, hasher = shipped.get(), WordHasher(FOLD)
        for batch in batches:
            some = batch.filter(pa.array(_has(bits, batch.column(0).to_numpy())))
            sets = [x for x in shingle_sets(binaries(some.column(1)), hasher, words) if len(x)]
            yield pa.RecordBatch.from_arrays([pa.array([set_digest(x) for x in sets], pa.binary()), _lists(sets)],
                                             names=["cid", "tokens"])

    return map_batches(texts, run, "cid binary, tokens array<long>")


def verified(pairs: DataFrame, docs: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    wanted = pairs.select(F.col("a").alias("v")).union(pairs.select(F.col("b").alias("v")))
    sets = staged(class_sets(docs, rows, wanted, words))
    a = sets.select(F.col("cid").alias("a"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("cid").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.select("a", "b").join(b, "b").join(a, "a")
    shared = F.size(F.array_intersect("ta", "tb"))
    return both.filter(shared * 100 >= (F.size("ta") + F.size("tb") - shared) * percent).select("a", "b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` of the connected components of ``links``: alternating large
    and small stars, each round written to shared storage."""

    def arcs(e: DataFrame) -> DataFrame:
        return e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def hung(e: DataFrame, larger: bool) -> DataFrame:
        """Neighbours of every node hung under the least of them."""
        near = arcs(e)
        if not larger:
            near = near.filter("v < u")
        least = near.groupBy("u").agg(F.min("v").alias("m"))
        if larger:
            least = least.select("u", F.least("u", "m").alias("m"))
            out = near.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = near.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                least.select("u", F.col("m").alias("v")))
        return out.filter("u != v").distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    edges = staged(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct())
    state = mark(edges)
    while True:
        edges = staged(hung(hung(edges, True), False))
        now = mark(edges)
        if now == state:
            break
        state = now
    # every remaining edge leads from a node to its root
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _rooted(post: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return post.withColumn("root", F.col("cid"))
    return post.join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))


def similar_classes(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(rows, roots): one row per document with its class ``cid`` (``n`` 0: empty
    set), and ``node, root`` of all linked classes."""
    docs = located(docs.select("doc_id", "text"))
    texts = docs.select("text")
    sketch = frequency_sketch(texts, words, percent)
    rows = staged(prefixes(keyed(docs).select(F.col("__k1"), F.col("__k2"), F.col("doc_id").cast("long"), "text"),
                           sketch, words, percent))
    post = _open_lists(_rooted(staged(shared_postings(rows, percent)), None), percent)
    near = staged(verified(staged(hub_pairs(post, percent)), docs, rows, words, percent))
    roots = components(near)
    # components only grow together: what was closed stays closed
    rest = staged(cross_pairs(_open_lists(_rooted(post.drop("members", "root"), roots), percent), percent))
    if not rest.isEmpty():
        far = verified(rest, docs, rows, words, percent)
        roots = components(near.union(far))
    return rows.select("k1", "k2", "doc", "n", "cid"), roots


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document of ``docs`` (``doc_id, text``): ``doc_id, n_shingles,
    component_id``, the row key ``k1, k2``, and ``root``, a component's own class
    (null without shingles), which tells components apart whatever their ids are.

    Null and wordless texts have no shingles and link with nothing, so their
    component is their own id. Repeated rows share a component. A null id counts
    only where a component has no other. Shingles are compared by 64-bit hashes.
    """
    rows, roots = similar_classes(docs, words, percent)
    classes = rows.filter("n > 0").groupBy("cid").agg(F.min("doc").alias("doc")).join(
        roots.withColumnRenamed("node", "cid"), "cid", "left").select("cid", F.coalesce("root", "cid").alias("root"), "doc")
    least = classes.groupBy("root").agg(F.min("doc").alias("component"))
    named = classes.join(least, "root").select("cid", "component", "root")
    # a class of many copies is dealt over parts, and rows without shingles, which
    # share one class, meet nothing
    large = staged(rows.filter("n > 0").groupBy("cid").agg(F.count(F.lit(1)).alias("m")).filter(F.col("m") > CLASS_ROWS).select(
        "cid", F.ceil(F.col("m") / CLASS_ROWS).cast("int").alias("parts")))
    large = broadcast_if_small(large)
    one = F.coalesce("parts", F.lit(1))
    dealt = rows.filter("n > 0").join(large, "cid", "left").withColumn("part", F.pmod(F.xxhash64("k1", "k2"), one).cast("int")).drop("parts")
    spread = named.join(large, "cid", "left").withColumn("part", F.explode(F.sequence(F.lit(0), one - 1))).drop("parts")
    linked = dealt.join(spread, ["cid", "part"]).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "k1", "k2", "root")
    return linked.unionByName(rows.filter("n = 0").select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("doc").alias("component_id"), "k1", "k2",
        F.lit(None).cast("binary").alias("root")))


def dedup(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id (of equal
    ids, the first in the input). Rows without shingles all stay. ``docs`` may be any
    table, a derived one too, and its other columns may have any names."""
    inner = located(renamed(docs))
    told = inner.select(F.col(column(docs, "doc_id")).alias("doc_id"), F.col(column(docs, "text")).alias("text"))
    found = staged(join(told, words, percent).filter("n_shingles > 0").select("doc_id", "k1", "k2", "root"))
    # ids may be null or repeat: only the root tells components apart
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("o"), "doc_id", "k1", "k2")).alias("f"))
    kept_rows = first.select(F.col("f.k1").alias("k1"), F.col("f.k2").alias("k2"))
    dropped = staged(found.select("k1", "k2").join(kept_rows, ["k1", "k2"], "left_anti").select(
        F.col("k1").alias("__k1"), F.col("k2").alias("__k2")))
    kept = keyed(inner).join(broadcast_if_small(dropped), ["__k1", "__k2"], "left_anti")
    return kept.select(*inner.columns).toDF(*docs.columns)
