import random

import numpy as np

from hearth.llm import hashing as H
from hearth.llm.common import WORD_TABLE, byte_words


def test_words_are_those_of_a_plain_split(monkeypatch):
    random.seed(6)
    hasher = H.WordHasher(WORD_TABLE)
    texts = ["".join(random.choice("ab é.,\n Z9日") for _ in range(random.randint(0, 60))).encode() for _ in range(300)] + [None, b"", b"..."]
    for slab_bytes in (1 << 20, 50, 7):
        monkeypatch.setattr(H, "SLAB", slab_bytes)
        words, hashes = [], []
        for slab in hasher.slabs(texts):
            for start, end in zip(slab.offsets[:-1], slab.offsets[1:]):
                words.append([slab.word(i) for i in range(start, end)])
                hashes.append(slab.hashes[start:end].tolist())
        assert words == [byte_words(t) if t else [] for t in texts]
        seen = {}
        for ws, hs in zip(words, hashes):
            for w, h in zip(ws, hs):
                assert seen.setdefault(w, h) == h
        assert len(set(seen.values())) == len(seen)


def test_classes_part_tokens():
    classes = bytes(0 if c == 32 else 1 if chr(c).isalnum() else 2 for c in range(256))
    (slab,) = H.WordHasher(bytes(range(256)), classes).slabs([b"ab!! cd--x  "])
    assert [slab.word(i) for i in range(len(slab.hashes))] == [b"ab", b"!!", b"cd", b"--", b"x"]


def test_repeated_bytes_and_positions_differ():
    (slab,) = H.WordHasher(WORD_TABLE).slabs([b"a aa aaa aaaa ab ba a0 0a"])
    assert len(set(slab.hashes.tolist())) == 8
    grams = H.rolled(np.concatenate([slab.hashes[:2], slab.hashes[:2]]), 2)
    assert grams[0] == grams[2] != grams[1]
    assert len(H.rolled(slab.hashes[:1], 2)) == 0
