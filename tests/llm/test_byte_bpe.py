import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from llm_fixtures import no_docs, odd_docs  # noqa: F401

from hearth.llm import byte_bpe as B

from conftest import SF_SMALL

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return B.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("most", [1 << 18, 3, 0])
def test_ids_and_round_trip(spark, ranks, library, most):
    random.seed(2)
    parts = ["the", " ", "  ", "\n", "\n\n", "a", "ing", "'s", "'ll", "日本", "é", "\x85", " ", "\t", "0", "12", "!!", "aaaa", " he", "llo",
             "Ω", "😀", "'", "x" * 70, "=-" * 40, "\x1c", "\x1f", "​", "　", "\x00", "<|endoftext|>"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 40))) for _ in range(600)] + [None, "", "z" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in B.encode(docs, PATTERN, ranks, chunk_words=500, most=most).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = library.encode_ordinary(text or "")
        assert (got[i].ids, got[i].n_tokens) == (" ".join(map(str, want)), len(want)), text
        assert bytes(got[i].decoded) == (text or "").encode()


def test_folded_words_equal_the_heap(spark, ranks):
    from pyspark.sql import functions as F
    words = ["a", " the", "antidis", "éé", "日本語", "!!!!!", "'ll", "zzzzzzzzzzzzzzzzzzzz", "\n\n\n"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r.w: list(r.ids) for r in df.select("w", B.encode_word(F.col("w"), B.rank_literal(ranks)).alias("ids")).collect()}
    assert got == {w: B.merge(w.encode(), ranks) for w in words}


def test_dictionary_takes_the_most_frequent(spark, ranks):
    docs = spark.createDataFrame([(1, " a" * 100 + " b" * 50 + " c" * 2 + " d"), (2, "x" * 100)], "doc_id long, text string")
    split = B.split_words(docs, PATTERN)
    assert {r.word for r in B.frequent_words(split, 2).collect()} == {" a", " b"}
    assert {r.word for r in B.frequent_words(split, 9).collect()} == {" a", " b", " c", " d"}


def test_odd_rows(spark, odd_docs, no_docs, ranks, library):  # noqa: F811
    got = sorted((str(r.doc_id), r.ids) for r in B.encode(odd_docs, PATTERN, ranks).collect())
    assert got == sorted((str(r.doc_id), " ".join(map(str, library.encode_ordinary(r.text or "")))) for r in odd_docs.collect())
    assert B.encode(no_docs, PATTERN, ranks).count() == 0


def test_query(spark, library):
    from hearth.llm.queries import QUERIES
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op8_byte_level_bpe"](spark, SF_SMALL).collect()}
    want = {}
    for d in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        ids = library.encode_ordinary(d.text)
        want[d.doc_id] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(d.text.encode()).hexdigest())
    assert got == want
