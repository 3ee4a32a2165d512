import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_fixtures import no_docs, odd_docs  # noqa: F401
from tokenizers import Tokenizer

from hearth.llm import packing as P

from conftest import SF_SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def model():
    with open(PATH, encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def lists(found):
    return [found.ids[a:b].tolist() for a, b in zip(found.offsets, found.offsets[1:])]


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [2]


ODD = ["", " ", "don't 'tis I'll  we'd'", "İstanbul İİ. İ", "é T̈ ẗ a≮b ≠", "word—word …... (x)", "日本語 のテキスト 😀😀",
       "<|endoftext|>a <|startoftext|><|endoftext|> <|startoftext", "x\x0by\x0cz\x1cq\x85w e r​t", "1234 5-6_7 a1b2 ²³ ½", "ΣΑΣ ſtraße ß ǅ ﬁ", "́ á.", "#%&*! !!a a!! a!b",
       "가가 한.", "﻿bom word\u0000nul"]


def test_chunks_give_the_librarys_ids(model, library):
    rnd = random.Random(7)
    alphabet = "abz ABZ'.,!é́İßΣςİ\n\t  1²-—<|>_日̈"
    texts = ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    chunks = P.ChunkIds(model)
    for part in (texts, texts[5:], texts[:0], [""], texts[:1] * 3):
        assert lists(chunks.encode(pa.array(part, pa.string()), [2])) == [ids_of(library, t) for t in part]
    assert lists(chunks.encode(pa.array([None, "a", None], pa.string())[1:], [])) == [library.encode("a").ids, []]


def test_forgetting_changes_nothing(model, monkeypatch):
    monkeypatch.setattr(P, "MEMO", 60)
    rnd = random.Random(1)
    texts = [" ".join(rnd.choice(["alpha", "beta.", "Gamma", "it's", "x" * 50]) + str(rnd.randint(0, 40)) for _ in range(20)) for _ in range(60)]
    small = P.ChunkIds(model)
    out = [x for i in range(0, 60, 4) for x in lists(small.encode(pa.array(texts[i:i + 4]), [2]))]
    monkeypatch.setattr(P, "MEMO", 10 ** 6)
    assert out == lists(P.ChunkIds(model).encode(pa.array(texts), [2]))


def one_by_one(lengths, size):
    """Shortest-pack-first, a piece at a time."""
    packs = []
    for n in sorted(lengths, reverse=True):
        fit = [p for p in packs if sum(p) + n <= size]
        if fit:
            min(fit, key=sum).append(n)
        else:
            packs.append([n])
    return sorted(size - sum(p) for p in packs)


@pytest.mark.parametrize("seed", range(6))
def test_histogram_packs_as_pieces_would(seed):
    rnd = random.Random(seed)
    size = rnd.choice([16, 60, 128])
    top = rnd.choice([3, size // 2, size])
    lengths = [rnd.randint(1, top) for _ in range(rnd.choice([1, 50, 600]))] + [rnd.randint(1, top)] * 200
    patterns = P.pack_histogram(Counter(lengths), size)
    assert sorted(p.space for p in patterns for _ in range(p.count)) == one_by_one(lengths, size)
    ranges = P.Ranges.of(patterns)
    used = Counter()
    for n, count in Counter(lengths).items():
        s, o = ranges.places(np.full(count, n), np.arange(count))
        for a, b in zip(s, o):
            used.update((int(a), x) for x in range(b, b + n))
    assert sum(used.values()) == sum(lengths) == len(used)
    ends = Counter(s for s, _ in used)
    assert all(max(o for s, o in used if s == q) + 1 == ends[q] <= size for q in list(ends)[:20])


def check(rows, docs, library, size):
    """Every id lies in one piece, pieces lie in their sequences without gaps."""
    want = Counter()
    for i, text in docs:
        ids = np.array(ids_of(library, text), "<u4")
        for a in range(0, len(ids), size):
            want[i, a, len(ids[a:a + size]), zlib.crc32(ids[a:a + size].tobytes()), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= size
    return by


@pytest.mark.parametrize("size", [64, 4096])
def test_every_id_in_one_piece(spark, model, library, odd_docs, no_docs, monkeypatch, size):  # noqa: F811
    monkeypatch.setattr(P, "CLASS_ROWS", 20)        # many numbering groups
    rnd = random.Random(5)
    docs = [(i, " ".join(rnd.choice(["alpha", "Beta,", "don't", "É."]) for _ in range(rnd.randint(0, 90)))) for i in range(400)]
    docs += [(1, "the same text")] * 300 + [(None, "no id"), (None, None)] + [(900 + i, t) for i, t in enumerate(ODD)]
    rnd.shuffle(docs)
    placed, tokens = P.pack(spark.createDataFrame([(*d, "k", 3) for d in docs], SCHEMA + ", __k1 string, length int").repartition(7), model, size)
    check(placed.collect(), docs, library, size)
    odd, _ = P.pack(odd_docs, model, size)
    check(odd.collect(), [(r.doc_id, r.text) for r in odd_docs.collect()], library, size)
    assert P.pack(no_docs, model, size)[0].count() == 0


def test_sequences_hold_the_ids(spark, model, library):
    docs = [(i, "alpha Beta gamma. " * (i % 30)) for i in range(120)]
    placed, tokens = P.pack(spark.createDataFrame(docs, SCHEMA), model, 64)
    by = {r.sequence_id: r for r in P.sequences(placed, tokens, 64).collect()}
    ids = {i: ids_of(library, t) for i, t in docs}
    length = Counter()
    for r in placed.collect():
        assert by[r.sequence_id].ids[r.offset:r.offset + r.length] == ids[r.doc_id][r.start:r.start + r.length]
        length[r.sequence_id] += r.length
    for s, r in by.items():
        n = length[s]
        assert r.n_tokens == n and len(r.ids) == (n if n & (n - 1) == 0 else 64) and not any(r.ids[n:])


def test_query_pads_little(spark, library):
    from hearth.llm.queries import QUERIES
    rows = QUERIES["op12_packing"](spark, SF_SMALL).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    by = check(rows, docs, library, 4096)
    held = [sum(n for _, n in p) for p in by.values()]
    assert sum(4096 - n for n in held if n & (n - 1)) <= 0.02 * sum(held) + 4096
