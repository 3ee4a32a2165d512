"""Packing documents into sequences of a fixed number of tokens.

Shortest-pack-first over the length histogram: documents are tokenized and cut into
pieces of at most ``size`` tokens, and only the histogram of piece lengths (at most
``size`` bins, whatever the corpus) reaches the driver. Lengths are placed longest
first, each time into the emptiest packs that have room; equal packs are one
packing pattern with a count, so a step moves counts, not documents. The patterns
become ranges of ranks per length, and pieces, numbered within their length in
parallel, find their range by rank.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearth.llm.common import Shipped, ensure_checkpoints, in_worker, keyed, map_batches, staged
from hearth.plans.joins import broadcast_if_small

SIZE = 4096
END_ID = 2                  # closes every document
CLASS_ROWS = 500            # rows of one numbering group, about
MEMO = 1_000_000            # words a task remembers, at most a batch's beyond that
TEXT_BYTES = 10 * 1024 * 1024   # texts tokenized at a time, at least a batch
JOINED = 200                # chunks tokenized in one call

#: Chunks that are one word and maybe ASCII punctuation (but no apostrophe, which may
#: begin a suffix of its own). Their letters have no other normal form, and one lower
#: case whatever stands beside them.
WORD = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<mark>[!-&(-/:-@\[-`{-~]*)$"


@dataclass
class Lists:
    """Lists of ids, one after the other."""

    offsets: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, lists: list[list[int]]) -> Lists:
        return cls(np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)]).astype(np.int32),
                   np.fromiter(chain.from_iterable(lists), dtype=np.uint32))

    def array(self) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(self.offsets, pa.int32()), pa.array(self.ids, pa.uint32()))

    @classmethod
    def taken(cls, lists: pa.ListArray, at: np.ndarray) -> Lists:
        found = lists.take(pa.array(at))
        offsets = found.offsets.to_numpy()
        return cls(offsets - offsets[0], found.flatten().to_numpy())


class ChunkIds:
    """Token ids of texts by a ``tokenizers`` model of byte-level words with ends, which
    normalises to NFC and lower case and whose words never cross white space. Texts
    are cut at ASCII white space and at special strings; the distinct chunks of a
    batch are told apart into words and marks, and a word that the task remembers is
    not tokenized again. Ids of chunks are gathered into ids of texts."""

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer, self.plain = Tokenizer.from_str(model), Tokenizer.from_str(model)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ends = [i for w, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if w.endswith("</w>")]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True) + 1, dtype=bool)
        self.ends[ends] = True
        self.words, self.known = pa.array([], pa.string()), Lists.of([])

    def _ids(self, texts: list[str], tokenizer=None) -> list[list[int]]:
        return [e.ids for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: pa.Array) -> None:
        """Remember lower-case words. Many are tokenized in a call; each ends in an
        end-of-word id, which tells them apart."""
        new = words.filter(pc.is_null(pc.index_in(words, value_set=self.words))) if len(self.words) else words
        if len(self.words) + len(new) > MEMO:
            self.words, self.known, new = self.words[:0], Lists.of([]), words
        text = new.to_pylist()
        found = Lists.of(self._ids([" ".join(text[i:i + JOINED]) for i in range(0, len(text), JOINED)], self.plain)).ids
        ends = np.flatnonzero(self.ends[found]) + 1
        if len(ends) != len(new):
            raise ValueError("the model does not close each word with one end-of-word id")
        before = len(self.known.ids)
        self.words = pa.concat_arrays([self.words, new])
        self.known = Lists(np.concatenate([self.known.offsets, (ends + before).astype(np.int32)]),
                           np.concatenate([self.known.ids, found]))

    def _chunk_ids(self, chunks: pa.Array) -> pa.ListArray:
        """Ids of distinct chunks: a word's and a mark's, or a chunk's as it is."""
        parts = pc.extract_regex(chunks, pattern=WORD)
        words, marks = pc.utf8_lower(pc.struct_field(parts, "word")), pc.struct_field(parts, "mark")
        whole = pc.is_null(words)
        self._learn(words.drop_null().unique())
        rest = pa.concat_arrays([marks.drop_null(), chunks.filter(whole)]).unique()
        table = pa.concat_arrays([self.known.array(), Lists.of(self._ids(rest.to_pylist())).array()])
        first = pc.index_in(words, value_set=self.words).fill_null(0).to_numpy(zero_copy_only=False)
        second = pc.index_in(pc.coalesce(marks, chunks), value_set=rest).to_numpy(zero_copy_only=False) + len(self.words)
        both = np.stack([np.where(whole.to_numpy(zero_copy_only=False), second, first), second], axis=1)
        keep = np.ones(both.shape, dtype=bool)
        keep[:, 0] = ~whole.to_numpy(zero_copy_only=False)
        found = Lists.taken(table, both[keep])
        return Lists(found.offsets[np.concatenate([[0], np.cumsum(keep.sum(axis=1))])], found.ids).array()

    def encode(self, texts: pa.Array, end: list[int]) -> Lists:
        """Ids of each text, closed by ``end``."""
        texts = texts.fill_null("")
        for s in self.special:
            texts = pc.replace_substring(texts, s, f" {s} ")
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        table = pa.concat_arrays([self._chunk_ids(coded.dictionary), Lists.of([end]).array()])
        ends = split.offsets.to_numpy()[1:] - split.offsets.to_numpy()[0]
        at = np.insert(coded.indices.to_numpy(), ends, len(table) - 1)
        found = Lists.taken(table, at)
        return Lists(found.offsets[np.concatenate([[0], ends + 1 + np.arange(len(ends))])], found.ids)


def gathered(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until they hold ``size`` bytes."""
    held = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= size:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def tokenized(docs: DataFrame, model: str, size: int = SIZE, end_id: int = END_ID) -> DataFrame:
    """``doc_id, doc_tokens, crcs, ids`` of every row of ``docs`` (``doc_id, text``),
    written once: ids (little-endian unsigned 32-bit) of the whole text, closed by
    ``end_id``, and the crc32 of each piece of ``size`` ids. A null or empty text is
    ``end_id`` alone; a repeated row is a document of its own."""
    shipped = Shipped(docs.sparkSession, model)

    def run(batches):
        chunks = in_worker(shipped.key, lambda: ChunkIds(shipped.get()))
        for batch in gathered(batches, TEXT_BYTES):
            found = chunks.encode(batch.column(1), [end_id])
            data = found.ids.astype("<u4").tobytes()
            ends = found.offsets.tolist()
            crcs = [[crc32(data[4 * i:4 * min(b, i + size)]) for i in range(a, b, size)] for a, b in zip(ends, ends[1:])]
            ids = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((found.offsets * 4).astype(np.int32)), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(found.offsets), pa.int64()), pa.array(crcs, pa.list_(pa.int64())), ids],
                names=["doc_id", "doc_tokens", "crcs", "ids"])

    return staged(map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                              "doc_id long, doc_tokens long, crcs array<long>, ids binary"))


def cut_pieces(tokens: DataFrame, size: int = SIZE) -> DataFrame:
    """``__k1, __k2, doc_id, doc_tokens, ids_crc32, start, length``: a row's key and its
    pieces, all of ``size`` tokens but the last. (The ids themselves are not read.)"""
    pieces = keyed(tokens).select("__k1", "__k2", "doc_id", "doc_tokens", F.posexplode("crcs").alias("i", "ids_crc32"))
    return pieces.withColumn("start", F.col("i").cast("long") * size).withColumn(
        "length", F.least(F.lit(size).cast("long"), F.col("doc_tokens") - F.col("start")).cast("int")).drop("i")


@dataclass
class Pattern:
    """``count`` packs alike: runs of (length, times) in order, ``space`` tokens left."""

    count: int
    space: int
    runs: tuple | None      # (earlier runs, length, times)


def pack_histogram(histogram: dict[int, int], size: int = SIZE) -> list[Pattern]:
    """Shortest-pack-first. Longest lengths first; a piece goes to the emptiest open
    pack, if it has room, else to a new one. All equal packs are filled in one step,
    and where nothing has room the pieces of a length fill new packs one by one."""
    by_space: list[list[Pattern]] = [[] for _ in range(size + 1)]
    top = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            while top > 0 and not by_space[top]:
                top -= 1
            if top < length or not by_space[top]:
                times = size // length
                for count, k in ((left // times, times), (1, left % times)):
                    if count and k:
                        by_space[size - k * length].append(Pattern(count, size - k * length, (None, length, k)))
                        top = max(top, size - k * length)
                left = 0
                continue
            p = by_space[top].pop()
            count = min(p.count, left)
            if p.count > count:
                by_space[top].append(Pattern(p.count - count, p.space, p.runs))
            before, last, times = p.runs
            runs = (before, length, times + 1) if last == length else (p.runs, length, 1)
            by_space[p.space - length].append(Pattern(count, p.space - length, runs))
            left -= count
    return [p for group in by_space for p in group]


@dataclass
class Ranges:
    """Ranks of a length -> their places. A range of a pattern with ``count`` packs
    holds ``count * times`` ranks; ``times`` neighbours lie in one pack."""

    key: np.ndarray         # length << 40 | first rank, ascending
    sequence: np.ndarray    # first sequence
    offset: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, patterns: list[Pattern]) -> Ranges:
        rows, used, sequence = [], {}, 0
        for p in patterns:
            runs, node = [], p.runs
            while node is not None:
                node, length, times = node
                runs.append((length, times))
            offset = 0
            for length, times in reversed(runs):
                rank = used.get(length, 0)
                rows.append((length << 40 | rank, sequence, offset, times))
                used[length] = rank + p.count * times
                offset += length * times
            sequence += p.count
        rows.sort()
        columns = np.array(rows, dtype=np.int64).reshape(-1, 4).T
        return cls(*(np.ascontiguousarray(c) for c in columns))

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, length << 40 | rank, side="right") - 1
        nth = rank - (self.key[at] & (1 << 40) - 1)
        return self.sequence[at] + nth // self.times[at], self.offset[at] + nth % self.times[at] * length


def numbered(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """``pieces`` plus ``rank``, from 0 within each length. A length of many pieces is
    dealt over groups of about ``CLASS_ROWS`` by the row's key; a group counts its
    own pieces, after those of the groups before it."""
    spark = pieces.sparkSession
    groups = spark.createDataFrame([(k, -(-n // CLASS_ROWS)) for k, n in histogram.items()], "length int, groups int")
    dealt = pieces.join(F.broadcast(groups), "length").withColumn(
        "part", F.pmod(F.xxhash64("__k1", "__k2", "start"), F.col("groups")).cast("int")).drop("groups")
    counts = dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).drop("n")
    own = F.row_number().over(Window.partitionBy("length", "part").orderBy("__k1", "__k2", "start")) - 1
    return dealt.withColumn("own", own).join(broadcast_if_small(staged(before)), ["length", "part"]).withColumn(
        "rank", F.col("own") + F.col("before")).drop("own", "before", "part")


def place(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` (``cut_pieces``) plus ``sequence_id`` and ``offset``. The histogram
    collected here has at most ``size`` rows, and the patterns some times that."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranges = Shipped(pieces.sparkSession, Ranges.of(pack_histogram(histogram, size)))
    columns = ["__k1", "__k2", "doc_id", "doc_tokens", "ids_crc32", "start", "length"]
    ranked = numbered(pieces, histogram).select(*columns, "rank")

    def run(batches):
        held = ranges.get()
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (6, 7))
            yield pa.RecordBatch.from_arrays([*batch.columns[:7], *map(pa.array, held.places(length, rank))],
                                             names=[*columns, "sequence_id", "offset"])

    return map_batches(ranked, run, T.StructType([*ranked.schema.fields[:7], T.StructField("sequence_id", T.LongType()),
                                                  T.StructField("offset", T.LongType())]))


def _slice(ids, start, length):
    return F.substring(ids, (4 * start + 1).cast("int"), (4 * length).cast("int"))


def pack(docs: DataFrame, model: str, size: int = SIZE, end_id: int = END_ID) -> tuple[DataFrame, DataFrame]:
    """(placed pieces, tokenized documents) of ``docs`` (``doc_id, text``; other columns
    are not read, whatever their names). One row per piece: the key ``__k1, __k2`` of
    its tokenized document, ``doc_id, doc_tokens, start, length, ids_crc32,
    sequence_id, offset``. Every id lies in exactly one piece; pieces of a sequence
    follow without gaps. Null ids and repeated rows are documents like others; an
    empty table has no pieces; a very long text becomes many full sequences."""
    ensure_checkpoints(docs.sparkSession)
    tokens = tokenized(docs, model, size, end_id)
    return place(cut_pieces(tokens, size), size), tokens


def sequences(placed: DataFrame, tokens: DataFrame, size: int = SIZE, pad_id: int = 0) -> DataFrame:
    """The packed sequences: ``sequence_id, n_tokens, ids`` (array of int), padded to
    ``size`` with ``pad_id`` unless the length is a power of two. A group is one
    sequence, so at most ``size`` tokens."""
    pieces = placed.join(keyed(tokens).select("__k1", "__k2", "ids"), ["__k1", "__k2"]).select(
        "sequence_id", F.struct("offset", _slice(F.col("ids"), F.col("start"), F.col("length")).alias("ids")).alias("piece"))
    whole = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list("piece")).alias("p")).select(
        "sequence_id", F.concat_ws("", F.transform("p", lambda x: F.hex(x["ids"]))).alias("digits"))

    def number(word):
        return F.conv(F.concat(*(F.substring(word, i, 2) for i in (7, 5, 3, 1))), 16, 10).cast("int")

    ids = F.transform(F.regexp_extract_all("digits", F.lit(".{8}"), F.lit(0)), number)
    n = F.size("ids")
    full = whole.select("sequence_id", ids.alias("ids")).withColumn("n_tokens", n)
    power = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    return full.withColumn("ids", F.when(power, F.col("ids")).otherwise(
        F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(size) - F.col("n_tokens")))))
