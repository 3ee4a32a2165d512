import random

import public_tokenizers
import pytest
import sentencepiece

from llm_fixtures import no_docs, odd_docs  # noqa: F401

from hearth.llm import token_counts as C

from conftest import SF_SMALL

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return C.Vocabulary.load(PATH)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def odd_texts(n):
    random.seed(1)
    parts = ["the", " ", "  ", "\n", "\n\n", "a", "ing", "x", "日本", "é", C.BLANK, "\x00", "\t", "0", "12", "!!", "aaaa", " he", "llo",
             "Ω", "😀", "ﬁ", "́", "<s>", "<unk>", "xqzj" * 9]
    return ["".join(random.choice(parts) for _ in range(random.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("chunk", [1 << 16, 7, 1])
def test_counts_equal_the_library(vocabulary, library, monkeypatch, chunk):
    monkeypatch.setattr(C, "CHUNK_CHARS", chunk)
    texts = odd_texts(3000)
    assert C.counts_of(texts, C.Tokenizer(vocabulary)) == [len(x) for x in library.encode(texts)]


def test_memory_bounds_do_not_change_counts(vocabulary, library, monkeypatch):
    monkeypatch.setattr(C, "MEMO", 50)
    texts = odd_texts(500)
    assert C.counts_of(texts, C.Tokenizer(vocabulary)) == [len(x) for x in library.encode(texts)]


def test_state_maps_compose_associatively(vocabulary):
    tokenizer = C.Tokenizer(vocabulary)
    for text in odd_texts(300):
        text = C.normalised(text)
        cuts = sorted(random.choices(range(len(text) + 1), k=2)) if text else [0, 0]
        a, b, c = (tokenizer.map_of(x) for x in (text[:cuts[0]], text[cuts[0]:cuts[1]], text[cuts[1]:]))
        left, right = tokenizer.compose(tokenizer.compose(a, b), c), tokenizer.compose(a, tokenizer.compose(b, c))
        for m in (left, right):
            total = tokenizer.counts[m.head] + m.count + (tokenizer.counts[m.tail] if m.tail is not None else 0)
            assert total == tokenizer.count(text)


def test_vocabulary_without_cuts_is_run_as_a_whole():
    v = C.Vocabulary({p: i for i, p in enumerate(["b" + C.BLANK, "ab" + C.BLANK, C.BLANK + "a", "a", "b", C.BLANK])})
    assert not v.blank_cuts
    tokenizer = C.Tokenizer(v)
    for text in ["ab ab ab", "a b  ab", "b b b"]:
        assert tokenizer.count(C.normalised(text)) == len(v.merged(C.normalised(text)))


def test_rows(spark, odd_docs, no_docs, vocabulary, library):  # noqa: F811
    got = C.count_tokens(odd_docs, vocabulary)
    assert got.columns == [*odd_docs.columns, "n_tokens"]
    assert [r.n_tokens for r in got.collect()] == [len(library.encode(r.text or "")) for r in odd_docs.collect()]
    assert C.count_tokens(no_docs, vocabulary).count() == 0


def test_query(spark, library):
    from hearth.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op7_token_counts"](spark, SF_SMALL).collect()}
    assert got == {d.doc_id: (len(d.text.encode()), n, n > 4096) for d in docs for n in [len(library.encode(d.text))]}
