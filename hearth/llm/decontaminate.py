"""Benchmark decontamination by training suffix arrays.

Every task cuts its documents into shards of a bounded number of words and
builds a suffix array (prefix doubling) over each shard. The distinct windows of the
benchmark items are binary-searched in it, one word deeper at a time, which gives all
their occurrences; a document's items follow from the windows that it holds. Words
that no item holds end a match, and runs of known words shorter than the shortest
window cannot hold one, so neither enters the array.

Longest matches come from a second suffix array over what lies in occurring windows,
of the shard and of the items together: a suffix's longest match is with its nearest
neighbour of the other kind, and the ranks of prefix doubling give its length. The work
is that of sorting, whatever the length of a match.

The benchmark is read in blocks of bounded bytes; each block is shipped to the
executors and takes one pass over the documents. No shuffle is needed.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import Shipped, append_columns, binaries, byte_words, map_batches, staged

WINDOW = 10
SHARD_WORDS = 250_000
BLOCK_BYTES = 16 * 1024 * 1024
ITEMS_HELD = 1 << 18        # items of documents put together at a time, at least one document's


class TestBlock:
    """Items of one benchmark block as word numbers (0 is "no benchmark word"), and
    their distinct windows: a suffix each that starts with it, and its items."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.vocab: dict[bytes, int] = {}
        ids: list[np.ndarray] = []
        lengths = []
        for _, words in items:
            ids.append(np.fromiter((self.vocab.setdefault(w, len(self.vocab) + 1) for w in words), np.int32, len(words)))
            lengths.append(len(words))
        self.item_ids = [i for i, _ in items]
        self.window = window
        lengths = np.array(lengths, np.int64)
        self.text = np.concatenate([*ids, np.zeros(1, np.int32)])
        starts = np.cumsum(lengths) - lengths
        self.item_of = np.repeat(np.arange(len(items), dtype=np.int32), lengths)
        self.position = np.arange(len(self.item_of)) - np.repeat(starts, lengths)
        rest = np.repeat(lengths, lengths) - self.position
        width = np.minimum(lengths, window)[self.item_of]
        self.shortest, self.depth = int(width.min()), int(width.max())
        # windows are told apart a word deeper at a time; those of short items end in zeros
        start = np.flatnonzero(rest >= width)
        number = np.zeros(len(start), np.int64)
        for depth in range(self.depth):
            word = np.where(depth < width[start], self.text[np.minimum(start + depth, len(self.text) - 1)], 0)
            _, first, number = np.unique(number * (len(self.vocab) + 1) + word, return_index=True, return_inverse=True)
        self.window_of = np.full(len(self.item_of), -1, np.int64)    # -1: no window starts here
        self.window_of[start] = number
        self.first = start[first]
        self.width = width[self.first]
        held = np.unique(number * len(items) + self.item_of[start])
        self.window_items = (held % len(items)).astype(np.int32)
        self.window_ends = np.concatenate([[0], np.cumsum(np.bincount(held // len(items), minlength=len(first)))])

    def items_of(self, windows: np.ndarray) -> np.ndarray:
        """Numbers of the items that hold some of the windows."""
        return np.unique(np.concatenate([self.window_items[self.window_ends[w]:self.window_ends[w + 1]] for w in windows]
                                        or [np.zeros(0, np.int32)]))

    def id_keys(self) -> np.ndarray:
        """Per item a positive number, larger for an id earlier in the order of strings; null is last."""
        order = sorted({i for i in self.item_ids if i is not None})
        rank = {i: len(order) + 1 - at for at, i in enumerate(order)}
        return np.array([rank.get(i, 1) for i in self.item_ids], np.int64)


def _suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of non-zero words, sorted by the ``depth`` words from there on."""
    pos = np.flatnonzero(text)
    rank = text.astype(np.int64)
    order = np.argsort(rank[pos], kind="stable")
    h = 1
    while h < depth and len(pos):
        ahead = np.concatenate([rank[h:], np.zeros(min(h, len(rank)), np.int64)])
        key = rank[pos] * (int(rank.max()) + 1) + ahead[pos]
        order = np.argsort(key, kind="stable")
        inner = key[order]
        fresh = np.concatenate([[1], (inner[1:] != inner[:-1]).astype(np.int64)])
        numbers = np.cumsum(fresh)
        rank = np.zeros(len(text), np.int64)
        rank[pos[order]] = numbers
        if numbers[-1] == len(pos):
            break
        h *= 2
    return pos[order]


def _bound(text, sa, lo, hi, word, depth, after):
    """First index in ``[lo, hi)`` whose word at ``depth`` is >= (``after``: >) ``word``."""
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        seen = text[np.minimum(sa[np.minimum(mid, len(sa) - 1)] + depth, len(text) - 1)]
        less = (seen <= word) if after else (seen < word)
        lo = np.where(open_ & less, mid + 1, lo)
        hi = np.where(open_ & ~less, mid, hi)


def _search(block: TestBlock, text: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The occurring windows and the ranges [lo, hi) of their places in ``sa``."""
    found: list[tuple[np.ndarray, ...]] = []
    w = np.arange(len(block.first))
    lo, hi = np.zeros(len(w), np.int64), np.full(len(w), len(sa), np.int64)
    depth = 0
    while len(w) and len(sa):
        word = block.text[block.first[w] + depth]
        lo, hi = _bound(text, sa, lo, hi, word, depth, False), _bound(text, sa, lo, hi, word, depth, True)
        depth += 1
        whole = (lo < hi) & (block.width[w] == depth)
        found.append((w[whole], lo[whole], hi[whole]))
        more = (lo < hi) & (block.width[w] > depth)
        w, lo, hi = w[more], lo[more], hi[more]
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (w[:0], lo[:0], hi[:0])


class Shard:
    """Documents of one shard, reduced to the runs that can hold a match."""

    def __init__(self, block: TestBlock, docs: list[np.ndarray]):
        zero = np.zeros(1, np.int32)
        self.sizes = np.array([len(d) for d in docs], np.int64)
        words = np.concatenate([x for d in docs for x in (d, zero)] or [zero])
        self.starts = np.cumsum(self.sizes + 1) - (self.sizes + 1)
        self.n = len(words)
        known = np.concatenate([[0], (words > 0).astype(np.int8), [0]])
        edge = np.diff(known)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        keep = last - first >= block.shortest
        first, size = first[keep], (last - first)[keep] + 1     # with the zero after the run
        at = np.cumsum(size) - size
        self.origin = np.arange(int(size.sum())) - np.repeat(at - first, size)
        self.words = words
        self.text = words[self.origin]
        self.sa = _suffix_array(self.text, block.depth)
        self.windows, self.lo, self.hi = _search(block, self.text, self.sa)

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """(window, word where it starts) of all occurrences. A place starts one window
        of each width at most, so they are bounded by the shard, not by the items."""
        count = self.hi - self.lo
        at = np.repeat(self.lo - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        return np.repeat(self.windows, count), self.origin[self.sa[at]]

    def doc_of(self, word: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, word, side="right") - 1


def _largest(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Largest key of each range [lo, hi), none of them empty."""
    out, level = np.zeros(len(lo), np.int64), 0
    while len(lo) and 1 << level <= len(keys):
        size = 1 << level
        q = np.flatnonzero((hi - lo >= size) & (hi - lo < 2 * size))
        out[q] = np.maximum(keys[lo[q]], keys[hi[q] - size])
        keys = np.concatenate([np.maximum(keys[:-size], keys[size:]), keys[-size:]])   # of ``2 * size`` from each place on
        level += 1
    return out


def _ids(block: TestBlock, data: bytes | None) -> np.ndarray:
    words = byte_words(data) if data else []
    return np.fromiter(map(block.vocab.get, words, repeat(0)), np.int32, len(words))


def _stretches(starts: np.ndarray, width: int, n: int, cut: np.ndarray) -> np.ndarray:
    """The places that windows from ``starts`` on cover, -1 between stretches and at
    both ends. A stretch also ends before a place in ``cut``."""
    d = np.bincount(starts, minlength=n + 1) - np.bincount(starts + width, minlength=n + 1)
    covered = np.cumsum(d)[:n] > 0
    first = covered & ~np.concatenate([[False], covered[:-1]])
    first[cut] |= covered[cut]
    at = np.flatnonzero(covered)
    out = np.full(len(at) + int(first.sum()) + 1, -1, np.int64)
    out[np.arange(len(at)) + np.cumsum(first[at])] = at
    return out


class Matches:
    """Suffixes of the items and of a shard in one order, of the parts that whole
    windows cover. ``levels`` holds the ranks by 1, 2, 4, ... words."""

    def __init__(self, block: TestBlock, shard: Shard, windows: np.ndarray, places: np.ndarray):
        occurs = np.zeros(len(block.first) + 1, bool)
        occurs[windows] = True
        self.suffixes = np.flatnonzero(occurs[block.window_of] & (block.window_of >= 0))
        self.places = np.unique(places)
        tests = _stretches(self.suffixes, block.window, len(block.item_of), np.flatnonzero(block.position == 0))
        words = _stretches(self.places, block.window, shard.n, np.zeros(0, np.int64))
        self.origin = np.concatenate([tests, words])
        self.is_test = np.arange(len(self.origin)) < len(tests)
        stop = self.origin < 0
        text = np.concatenate([block.text[tests], shard.words[words]]).astype(np.int64)
        text[stop] = len(block.vocab) + 1 + np.arange(int(stop.sum()))   # no stop equals another
        rank, h, self.levels = np.unique(text, return_inverse=True)[1], 1, []
        while rank.max() + 1 < len(rank):
            self.levels.append((h, rank.astype(np.int32)))
            ahead = np.concatenate([rank[h:] + 1, np.zeros(min(h, len(rank)), np.int64)])
            rank = np.unique(rank * (len(rank) + 1) + ahead, return_inverse=True)[1]
            h *= 2
        self.rank, self.order = rank, np.argsort(rank)

    def at(self, test: bool, origin: np.ndarray) -> np.ndarray:
        """Where (sorted) places of the items or of the shard stand in the joint text."""
        index = np.flatnonzero((self.is_test == test) & (self.origin >= 0))
        return index[np.searchsorted(self.origin[index], origin)]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that two suffixes have in common."""
        n, last = np.zeros(len(a), np.int64), len(self.origin) - 1
        for h, rank in reversed(self.levels):
            n += np.where(rank[np.minimum(a + n, last)] == rank[np.minimum(b + n, last)], h, 0)
        return n

    def longest(self, at: np.ndarray, test: bool) -> np.ndarray:
        """Length of the longest match of each suffix with one of the items (``test``) or of the shard."""
        other = (self.is_test == test)[self.order]
        n, i = len(self.order), np.arange(len(self.order))
        before = np.maximum.accumulate(np.where(other, i, -1))[self.rank[at]]
        after = np.minimum.accumulate(np.where(other, i, n)[::-1])[::-1][self.rank[at]]
        return np.maximum(np.where(before < 0, 0, self.common(at, self.order[np.maximum(before, 0)])),
                          np.where(after == n, 0, self.common(at, self.order[np.minimum(after, n - 1)])))

    def range(self, at: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range [lo, hi) of the order whose suffixes have ``length`` words in common with each."""
        lo, top = np.zeros(len(at), np.int64), self.rank[at]
        while (lo < top).any():
            mid = (lo + top) >> 1
            far = self.common(self.order[mid], at) < length
            lo, top = np.where((lo < top) & far, mid + 1, lo), np.where((lo < top) & ~far, mid, top)
        low, lo, top = lo, self.rank[at] + 1, np.full(len(at), len(self.order), np.int64)
        while (lo < top).any():
            mid = (lo + top) >> 1
            near = self.common(self.order[np.minimum(mid, len(self.order) - 1)], at) >= length
            lo, top = np.where((lo < top) & near, mid + 1, lo), np.where((lo < top) & ~near, mid, top)
        return low, lo


def _shard_hits(block: TestBlock, docs: list[np.ndarray], longest: bool):
    """Per document: merged hit spans [start, end), numbers of occurring windows and,
    if asked for, (length, first word, item) of its longest match (of several, the first
    place and the first item id in the order of strings), else None."""
    shard = Shard(block, docs)
    spans: list[list[tuple[int, int]]] = [[] for _ in docs]
    windows: list[np.ndarray] = [np.zeros(0, np.int64)] * len(docs)
    best: list[tuple[int, int, int] | None] = [None] * len(docs)
    if not len(shard.windows):
        return spans, windows, best
    window, word = shard.places()
    cover = np.bincount(word, minlength=shard.n + 1) - np.bincount(word + block.width[window], minlength=shard.n + 1)
    hit = np.concatenate([[0], (np.cumsum(cover[:-1]) > 0).astype(np.int8), [0]])
    edge = np.diff(hit)
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    for d, a, b in zip(shard.doc_of(first).tolist(), first.tolist(), last.tolist()):
        spans[d].append((a - int(shard.starts[d]), b - int(shard.starts[d])))
    pairs = np.unique(shard.doc_of(word) * len(block.first) + window)
    doc = pairs // len(block.first)
    ends = np.flatnonzero(np.diff(doc, append=-1)) + 1
    for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
        windows[int(doc[a])] = pairs[a:b] % len(block.first)
    if longest:
        for d, *match in _longest_of_docs(block, shard, window, word):
            best[d] = tuple(match)
    return spans, windows, best


def _longest_of_docs(block: TestBlock, shard: Shard, window: np.ndarray, word: np.ndarray):
    """(document, length, first word, item) of each document with a match."""
    keys = block.id_keys()
    length = block.width[window].copy()
    whole = length == block.window
    if whole.any():
        matches = Matches(block, shard, window[whole], word[whole])
        at = matches.at(False, matches.places)
        length[whole] = matches.longest(at, True)[np.searchsorted(matches.places, word[whole])]
    doc = shard.doc_of(word)
    order = np.lexsort((word, -length, doc))
    win = order[np.flatnonzero(np.diff(doc[order], prepend=-1))]
    item = np.zeros(len(win), np.int64)
    for i in np.flatnonzero(~whole[win]).tolist():     # a short item stands there whole
        of = block.items_of(window[win[i:i + 1]])
        item[i] = of[np.argmax(keys[of])]
    some = np.flatnonzero(whole[win])
    if len(some):
        lo, hi = matches.range(matches.at(False, word[win[some]]), length[win[some]])
        tests = matches.is_test & (matches.origin >= 0)
        held = np.where(tests, block.item_of[np.where(tests, matches.origin, 0)], 0)
        by_key = np.zeros(int(keys.max()) + 1, np.int64)
        by_key[keys] = np.arange(len(keys))
        item[some] = by_key[_largest(np.where(tests, keys[held], 0)[matches.order], lo, hi)]
    return zip(doc[win].tolist(), length[win].tolist(), (word[win] - shard.starts[doc[win]]).tolist(), item.tolist())


def _shards(batches, column: int, block: TestBlock, shard_words: int):
    """(batches, their documents as word numbers) of up to ``shard_words`` words."""
    held, docs, size = [], [], 0
    for batch in batches:
        held.append((batch, 0))
        for data in binaries(batch.column(column)):
            docs.append(_ids(block, data))
            size += len(docs[-1])
        if size >= shard_words:
            yield [b for b, _ in held], docs
            held, docs, size = [], [], 0
    if held:
        yield [b for b, _ in held], docs


def _groups(docs: list[np.ndarray], shard_words: int):
    """Cut a list of documents into shards."""
    at, size = 0, 0
    for i, d in enumerate(docs):
        size += len(d)
        if size >= shard_words:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(docs):
        yield at, len(docs)


def benchmark_blocks(benchmark: DataFrame, window: int, block_bytes: int):
    """Items with words, in blocks of about ``block_bytes`` of text."""
    items, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").cast("binary").alias("t"))
    for row in rows.toLocalIterator():
        words = byte_words(bytes(row.t)) if row.t else []
        if not words:
            continue
        items.append((row.i, words))
        size += len(row.t)
        if size >= block_bytes:
            yield TestBlock(items, window)
            items, size = [], 0
    if items:
        yield TestBlock(items, window)


FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                         T.StructField("end", T.LongType())]))),
    T.StructField("hit_items", T.ArrayType(T.StringType())),
    T.StructField("match", T.StructType([T.StructField("length", T.LongType()), T.StructField("word", T.LongType()),
                                         T.StructField("item_id", T.StringType())])),
]
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_MATCH = pa.struct([("length", pa.int64()), ("word", pa.int64()), ("item_id", pa.string())])


def _scan(df: DataFrame, block: TestBlock | None, shard_words: int, longest: bool) -> DataFrame:
    column = df.columns.index("text")
    shipped = Shipped(df.sparkSession, block)

    def run(batches):
        block = shipped.get()
        if block is None:
            for batch in batches:
                counts = [len(byte_words(x)) if x else 0 for x in binaries(batch.column(column))]
                yield batch, [pa.array(counts, pa.int64()), pa.array([[]] * len(counts), _SPANS),
                              pa.array([[]] * len(counts), pa.list_(pa.string())), pa.nulls(len(counts), _MATCH)]
            return
        names = pa.array(block.item_ids, pa.string())
        for held, docs in _shards(batches, column, block, shard_words):
            spans, windows, best = [], [], []
            for a, b in _groups(docs, shard_words):
                for whole, part in zip((spans, windows, best), _shard_hits(block, docs[a:b], longest)):
                    whole += part
            at = 0
            for batch in held:
                # items are put together for a bounded number of them at a time
                row = 0
                while row < batch.num_rows:
                    start, items, size = row, [], 0
                    while row < batch.num_rows and (row == start or size < ITEMS_HELD):
                        items.append(block.items_of(windows[at + row]))
                        size += len(items[-1])
                        row += 1
                    one, two = at + start, at + row
                    yield batch.slice(start, row - start), [
                        pa.array([len(d) for d in docs[one:two]], pa.int64()),
                        pa.array([[{"start": x, "end": y} for x, y in s] for s in spans[one:two]], _SPANS),
                        pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, items)]), pa.int32()), names.take(pa.array(np.concatenate(items)))),
                        pa.array([m and {"length": m[0], "word": m[1], "item_id": block.item_ids[m[2]]} for m in best[one:two]], _MATCH)]
                at += batch.num_rows

    return append_columns(df, FIELDS, run)


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS,
         block_bytes: int = BLOCK_BYTES, longest: bool = False) -> DataFrame:
    """All columns of ``docs`` (``text`` among them) plus ``n_words``,
    ``hit_spans`` (word spans [start, end) covered by windows of items),
    ``hit_items`` (ids, as text, of items with an occurring window, one entry per
    item row; several rows may hold the same id) and, with ``longest``, ``match``: the
    longest stretch of the document, of at least a window of the item, that stands in
    one item (``length``, first ``word``, ``item_id``; of several, the first in the
    document and the first id in the order of strings, a null id last), else null.

    A null or wordless document has no words and no hits; a null or wordless item
    takes no part; an item with a null id marks hits under a null entry. Repeated
    rows are scanned like any other; empty tables give empty or hitless results. A
    very long text is a shard of its own.
    """
    out = None
    for block in benchmark_blocks(benchmark, window, block_bytes):
        if out is None:
            out = _scan(docs, block, shard_words, longest)
            continue
        # a further block: one more pass over the rows, merged into the columns
        base = staged(out)
        n = len(docs.columns)
        later = _scan(base, block, shard_words, longest)
        plain = later.toDF(*[f"c{i}" for i in range(len(later.columns))])
        rank = [F.struct(-F.col(f"{c}.length"), F.col(f"{c}.word"), F.col(f"{c}.item_id").isNull(), F.col(f"{c}.item_id"))
                for c in (f"c{n + 3}", f"c{n + 7}")]
        match = F.when(F.col(f"c{n + 3}").isNull() | (F.col(f"c{n + 7}").isNotNull() & (rank[1] < rank[0])),
                       F.col(f"c{n + 7}")).otherwise(F.col(f"c{n + 3}"))
        out = plain.select(*[f"c{i}" for i in range(n + 1)],
                           F.concat(f"c{n + 1}", f"c{n + 5}").alias("s"),
                           F.concat(f"c{n + 2}", f"c{n + 6}").alias("i"), match.alias("m")).toDF(*base.columns)
    return out if out is not None else _scan(docs, None, shard_words, longest)


def _hit_words():
    """Words covered by (possibly overlapping) spans."""
    return F.expr("""aggregate(array_sort(hit_spans),
        named_struct('n', 0L, 'e', 0L),
        (a, s) -> named_struct('n', a.n + greatest(0L, s.end - greatest(s.start, a.e)), 'e', greatest(a.e, s.end)),
        a -> a.n)""")


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated, items`` and the longest match ``longest`` (words, 0 if none),
    ``longest_word, longest_item`` (see ``scan`` for nulls; a null item id counts as an
    item but adds nothing to the digest)."""
    found = scan(docs.select("doc_id", "text"), benchmark, window, longest=True, **options)
    ids = F.array_sort(F.array_distinct("hit_items"))
    return found.select("doc_id", "n_words", _hit_words().alias("n_hit"), ids.alias("items"), "match").select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "items", F.coalesce("match.length", F.lit(0)).cast("long").alias("longest"),
        F.col("match.word").alias("longest_word"), F.col("match.item_id").alias("longest_item"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """The documents in which no benchmark window occurs, with their columns: every
    row is judged by its own text, so repeated rows stay or go together, and rows with
    a null, empty or wordless text stay (see ``scan``)."""
    names = docs.columns
    found = scan(docs, benchmark, window, **options)
    plain = found.toDF(*[f"c{i}" for i in range(len(found.columns))])
    return plain.filter(F.size(f"c{len(names) + 1}") == 0).select(*[f"c{i}" for i in range(len(names))]).toDF(*names)


def _longest_of_tests(block: TestBlock, shard: Shard, keys: np.ndarray):
    """(suffixes, lengths, keys): the longest match of each test suffix of which a
    window occurs, and the largest of ``keys`` (per word of the shard) at its places."""
    found = np.full(len(block.first) + 1, -1, np.int64)
    found[shard.windows] = np.arange(len(shard.windows))
    q = np.flatnonzero(found[block.window_of] >= 0)     # the last entry, no window, is -1
    length = block.width[block.window_of[q]]
    at = found[block.window_of[q]]
    best = _largest(keys[shard.origin[shard.sa]], shard.lo[at], shard.hi[at])
    whole = length == block.window
    if whole.any():
        window, word = shard.places()
        full = block.width[window] == block.window
        matches = Matches(block, shard, window[full], word[full])
        test = matches.at(True, q[whole])
        length[whole] = matches.longest(test, False)
        own = ~matches.is_test & (matches.origin >= 0)
        held = np.where(own, keys[np.where(own, matches.origin, 0)], -1)
        best[whole] = _largest(held[matches.order], *matches.range(test, length[whole]))
    return q, length, best


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per test suffix with a match of at least a window of its item: ``item_id,
    item_word, length`` of the longest verbatim match in the corpus and one place
    of it (``doc_id, doc_word``; of several, the largest id and word)."""
    schema = "item_row long, item_id string, item_word long, length long, doc_id long, doc_word long"
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for number, block in enumerate(benchmark_blocks(benchmark, window, block_bytes)):
        shipped = Shipped(source.sparkSession, block)

        def run(batches, shipped=shipped, number=number):
            block = shipped.get()
            for held, docs in _shards(batches, 1, block, shard_words):
                doc_ids = [x for b in held for x in b.column(0).to_pylist()]
                for a, b in _groups(docs, shard_words):
                    shard = Shard(block, docs[a:b])
                    if not len(shard.windows):
                        continue
                    # words in the order of their documents' ids (null least)
                    known = [(x is not None, x or 0) for x in doc_ids[a:b]]
                    ordered = sorted(set(known))
                    rank = {x: i for i, x in enumerate(ordered)}
                    docs_of = np.repeat(np.arange(len(known)), shard.sizes + 1)
                    keys = np.array([rank[x] for x in known], np.int64)[docs_of] * shard.n + np.arange(shard.n) - shard.starts[docs_of]
                    q, length, best = _longest_of_tests(block, shard, keys)
                    item = block.item_of[q]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(item.astype(np.int64) + (number << 40)),
                        pa.array(block.item_ids, pa.string()).take(pa.array(item)),
                        pa.array(block.position[q].astype(np.int64)), pa.array(length),
                        pa.array([ordered[i][1] if ordered[i][0] else None for i in (best // shard.n).tolist()], pa.int64()),
                        pa.array(best % shard.n)],
                        names=["item_row", "item_id", "item_word", "length", "doc_id", "doc_word"])

        part = map_batches(source, run, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = source.sparkSession.createDataFrame([], schema)
    return out.groupBy("item_row", "item_id", "item_word").agg(
        F.max(F.struct("length", "doc_id", "doc_word")).alias("m")).select("item_id", "item_word", "m.*")
