"""Byte-level BPE encoding and decoding with Spark higher-order functions.

Texts are split by the tokenizer's pattern in the scan. All words are counted; the
most frequent ones, up to a fixed number, are encoded by folding the ranked merges
over their byte pieces with higher-order functions, ranks coming from a literal
map, and shipped as a dictionary of bounded size. Documents gather the ids of
their words, and decoding concatenates the binary pieces of the ids. No text and
no word list of a document is shuffled.

Words outside the dictionary are merged with a heap where they stand: a fold costs
some 100 microseconds a word, a heap some 10, and folding every rare word of every
task would take more than all the rest (see the README). Pieces are folded in
hexadecimal, two digits a byte, because Spark keys and joins strings faster than
binaries.
"""

from __future__ import annotations

import heapq
import json
from base64 import b64decode
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import Shipped, map_batches, release, staged

CHUNK_WORDS = 250_000     # words gathered at a time, at least one document
DICTIONARY_WORDS = 1 << 18  # words of the shipped dictionary at most
FOLD_BYTES = 64             # longest word that is folded (folding is quadratic)
MEMO_WORDS = 200_000        # merged words a task keeps
BUCKETS = 1 << 14           # of the literal rank map
#: Unicode white space, as ``\s`` of the tokenizer's pattern means it.
SPACE = r"\t-\r \u0085   -     　"


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def java_pattern(pattern: str) -> str:
    r"""The pattern for Spark's regular expressions, whose ``\s`` is ASCII only."""
    return pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: lowest rank first, of equals the leftmost, by a heap."""
    if word in ranks:
        return [ranks[word]]
    pieces: list[bytes | None] = [word[i:i + 1] for i in range(len(word))]
    after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    heap = [(ranks[word[i:i + 2]], i, word[i:i + 2]) for i in range(len(word) - 1) if word[i:i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, merged = heapq.heappop(heap)
        j = after[i]
        if pieces[i] is None or j >= len(word) or pieces[i] + pieces[j] != merged:
            continue
        pieces[i], pieces[j] = merged, None
        after[i] = k = after[j]
        if k < len(word):
            before[k] = i
        for a, b in ((before[i], i), (i, k)):
            if a >= 0 and b < len(word) and pieces[a] + pieces[b] in ranks:
                heapq.heappush(heap, (ranks[pieces[a] + pieces[b]], a, pieces[a] + pieces[b]))
    return [ranks[p] for p in pieces if p is not None]


def split_words(docs: DataFrame, pattern: str) -> DataFrame:
    """``doc_id, words``: all matches of the pattern in the whole text."""
    return docs.select(F.col("doc_id").cast("long"), F.regexp_extract_all(
        F.coalesce("text", F.lit("")), F.lit(java_pattern(pattern)), F.lit(0)).alias("words"))


def frequent_words(split: DataFrame, most: int = DICTIONARY_WORDS) -> DataFrame:
    """``word``: the most frequent foldable words, at most ``most``. All words are
    counted, first within each task's chunks; whole classes of like frequency are taken."""

    def counts(held):
        found = pc.value_counts(pa.chunked_array(held))
        return pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["word", "n"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).flatten())
            size += len(held[-1])
            if size >= 4 * CHUNK_WORDS:
                yield counts(held)
                held, size = [], 0
        if held:
            yield counts(held)

    counted = map_batches(split.select("words"), run, "word string, n long").filter(
        F.octet_length("word") <= FOLD_BYTES).groupBy("word").agg(F.sum("n").alias("n"))
    counted = staged(counted.select("word", F.floor(F.log2("n") * 16).cast("int").alias("class")))
    least, total = None, 0
    for row in counted.groupBy("class").count().orderBy(F.desc("class")).collect():
        total += row["count"]
        if total > most:
            break
        least = row["class"]
    return counted.filter(F.col("class") >= least if least is not None else F.lit(False)).select("word")


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The rank map as a constant: maps by hash bucket, since a lookup scans a map."""
    maps: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        key = piece.hex().upper()
        maps[crc32(key.encode()) % BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(maps, separators=(",", ":"))), "array<map<string,int>>")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def encode_word(word: Column, maps: Column) -> Column:
    """Ids of a word (array of int): merges folded over its bytes. ``maps`` is bound
    once, so that a plan holds its literal once."""
    return _let(maps, lambda m: _encoded(word, m))


def _encoded(word: Column, maps: Column) -> Column:
    def rank(piece: Column) -> Column:
        return F.element_at(F.element_at(maps, (F.pmod(F.crc32(piece.cast("binary")), F.lit(BUCKETS)) + 1).cast("int")), piece)

    def step(pieces: Column, _: Column) -> Column:
        near = F.when(F.size(pieces) > 1, F.transform(
            F.sequence(F.lit(1), F.size(pieces) - 1),
            lambda i: rank(F.concat(F.element_at(pieces, i), F.element_at(pieces, i + 1))))).otherwise(F.array().cast("array<int>"))

        def first(r: Column) -> Column:
            return _let(F.array_position(r, F.array_min(r)).cast("int"), lambda i: F.concat(
                F.slice(pieces, F.lit(1), i - 1), F.array(F.concat(F.element_at(pieces, i), F.element_at(pieces, i + 1))),
                F.slice(pieces, i + 2, F.size(pieces))))

        return _let(near, lambda r: F.when(F.array_min(r).isNull(), pieces).otherwise(first(r)))

    def fold(digits: Column) -> Column:
        pieces = F.regexp_extract_all(digits, F.lit(".."), F.lit(0))
        folded = F.when(F.length(digits) < 4, pieces).otherwise(F.aggregate(
            F.sequence(F.lit(2), (F.length(digits) / 2).cast("int")), pieces, step))
        return F.transform(folded, rank)

    whole = F.hex(word.cast("binary"))
    return _let(whole, lambda d: _let(rank(d), lambda r: F.when(r.isNotNull(), F.array(r)).otherwise(fold(d))))


def dictionary(split: DataFrame, ranks: dict[bytes, int], most: int = DICTIONARY_WORDS) -> pa.Table:
    """``word, ids`` (as text) ``, n, decoded`` of the frequent words: bounded by
    ``most`` words of ``FOLD_BYTES`` bytes. Folded on the executors and staged, so
    that the job which brings them to the driver knows nothing of the literal map."""
    words = frequent_words(split, most).repartition(2 * split.sparkSession.sparkContext.defaultParallelism)
    folded = words.select("word", encode_word(F.col("word"), rank_literal(ranks)).alias("ids"))
    shipped = Shipped(split.sparkSession, ranks)

    def run(batches):
        pieces = piece_list(shipped.get())
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), *coded(batch.column(1).to_pylist(), pieces)],
                                             names=["word", "ids", "n", "decoded"])

    return staged(map_batches(folded, run, "word string, ids string, n int, decoded binary")).toArrow()


def piece_list(ranks: dict[bytes, int]) -> list[bytes]:
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, rank in ranks.items():
        pieces[rank] = piece
    return pieces


def coded(words: list[list[int]], pieces: list[bytes]) -> list[pa.Array]:
    """Ids as text, their number, and the decoded bytes, per word."""
    return [pa.array([" ".join(map(str, ids)) for ids in words], pa.string()), pa.array(list(map(len, words)), pa.int32()),
            pa.array([b"".join([pieces[i] for i in ids]) for ids in words], pa.binary())]


class Merges(dict):
    """Ids of words, remembered; forgets everything when full."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, word: bytes) -> list[int]:
        ids = merge(word, self.ranks)
        if len(word) <= FOLD_BYTES:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = ids
        return ids


class Assembler:
    """Ids and decoded bytes of documents from their words."""

    def __init__(self, known: bytes, ranks: dict[bytes, int]):
        table = pa.ipc.open_stream(known).read_all().combine_chunks()
        self.known, *self.columns = ((c.chunk(0) if c.num_chunks else pa.array([], c.type)) for c in table.columns)
        self.merges = Merges(ranks)
        self.pieces = piece_list(ranks)

    def documents(self, lists: pa.ListArray) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """(number of ids, ids as text, decoded bytes) per list of words."""
        flat = lists.flatten()
        numbers = pc.index_in(flat, value_set=self.known)
        rest = flat.filter(pc.is_null(numbers)).dictionary_encode()
        further = coded([self.merges[w] for w in rest.dictionary.cast(pa.binary()).to_pylist()], self.pieces)
        texts, counts, decoded = (pa.concat_arrays(list(x)) for x in zip(self.columns, further))
        numbers = numbers.fill_null(-1).to_numpy(zero_copy_only=False).copy()
        numbers[numbers < 0] = rest.indices.to_numpy() + len(self.known)
        total = np.concatenate([[0], np.cumsum(counts.to_numpy(zero_copy_only=False)[numbers], dtype=np.int64)])
        offsets = lists.offsets.to_numpy()
        ends = pa.array((offsets - offsets[0]).astype(np.int32))
        at, ends_np = pa.array(numbers), ends.to_numpy()
        return (total[ends_np[1:]] - total[ends_np[:-1]],
                pc.binary_join(pa.ListArray.from_arrays(ends, texts.take(at)), " "),
                pc.binary_join(pa.ListArray.from_arrays(ends, decoded.take(at)), b""))


def _assembled(docs: DataFrame, pattern: str, ranks: dict[bytes, int], finish, schema: str, chunk_words: int, most: int) -> DataFrame:
    split = split_words(docs, pattern)
    sink = pa.BufferOutputStream()
    table = dictionary(split, ranks, most)
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_table(table)
    del table
    shipped = Shipped(docs.sparkSession, (sink.getvalue().to_pybytes(), ranks))
    del sink
    release(docs.sparkSession)
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        assembler = Assembler(*shipped.get())
        for batch in batches:
            ends = batch.column(1).offsets.to_numpy().astype(np.int64)
            start = 0
            while start < batch.num_rows:
                end = int(np.searchsorted(ends, ends[start] + chunk_words, side="right")) - 1
                end = min(batch.num_rows, max(end, start + 1))
                ids = batch.column(0).slice(start, end - start)
                n, texts, decoded = assembler.documents(batch.column(1).slice(start, end - start))
                yield pa.RecordBatch.from_arrays([ids, pa.array(n), *finish(texts, decoded)], names=names)
                start = end

    return map_batches(split, run, schema)


def encode(docs: DataFrame, pattern: str, ranks: dict[bytes, int], chunk_words: int = CHUNK_WORDS,
           most: int = DICTIONARY_WORDS) -> DataFrame:
    """One row per document of ``docs`` (``doc_id, text``): ``doc_id, n_tokens, ids``
    (decimal, one space between) and ``decoded`` (binary, from the ids). Null texts
    count as empty and have no ids; repeated rows are encoded alike."""
    return _assembled(docs, pattern, ranks, lambda texts, decoded: [texts, decoded],
                      "doc_id long, n_tokens long, ids string, decoded binary", chunk_words, most)


def digests(docs: DataFrame, pattern: str, ranks: dict[bytes, int], chunk_words: int = CHUNK_WORDS,
            most: int = DICTIONARY_WORDS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of ``encode``'s results."""

    def finish(texts, decoded):
        return [pa.array([sha256(x).hexdigest() for x in c.cast(pa.binary()).to_pylist()], pa.string()) for c in (texts, decoded)]

    return _assembled(docs, pattern, ranks, finish, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
                      chunk_words, most)
