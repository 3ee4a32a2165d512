import hashlib
import random
import re
import time

import numpy as np
from llm_fixtures import no_docs, odd_docs  # noqa: F401

from hearth.llm import decontaminate as D

from conftest import SF_SMALL

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lowered)


def brute(docs, items, window=10):
    """{(doc position): (n_words, n_hit, items)} by comparing every window."""
    out = []
    for _, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, body in items:
            b = words(body)
            k = min(window, len(b))
            if not k:
                continue
            grams = {tuple(b[i:i + k]) for i in range(len(b) - k + 1)}
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in grams:
                    hit.update(range(i, i + k))
                    found.add(None if item is None else str(item))
        out.append((len(w), len(hit), found))
    return out


def brute_longest(docs, items, window=10):
    """Per document: (length, first word, item id) of its longest match, or None."""
    out = []
    for _, text in docs:
        w, best = words(text), []
        for item, body in items:
            b = words(body)
            k = min(window, len(b))
            for p in range(len(w)):
                for i in range(len(b)):
                    n = 0
                    while p + n < len(w) and i + n < len(b) and w[p + n] == b[i + n]:
                        n += 1
                    if n >= k:
                        best.append((-n, p, item is None, "" if item is None else str(item)))
        out.append(min(best, default=None))
    return out


def check(spark, docs, items, **options):
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(docs)], "k int, doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got, match = {}, {}
    for r in D.scan(d, b, longest=True, **options).collect():
        match[r.k] = r.match and (-r.match.length, r.match.word, r.match.item_id is None, r.match.item_id or "")
        covered = set()
        for s in r.hit_spans:
            covered.update(range(s.start, s.end))
        got[r.k] = (r.n_words, len(covered), set(r.hit_items))
    assert [got[i] for i in range(len(docs))] == brute(docs, items)
    assert [match[i] for i in range(len(docs))] == brute_longest(docs, items)


def test_against_brute_force(spark):
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(12)]
    def text(n):
        return " ".join(random.choice(vocabulary) for _ in range(n))
    items = [(i, text(random.choice([1, 2, 5, 10, 11, 25]))) for i in range(8)] + [(8, None), (9, "--"), (None, text(12))]
    items.append((3, text(14)))     # an id twice
    docs = [(i, text(random.randint(0, 80)) + " " + random.choice([b or "" for _, b in items])) for i in range(60)]
    docs += [(1, None), (None, items[0][1]), (2, ""), (2, "")]
    check(spark, docs, items)
    check(spark, docs, items, shard_words=50)
    check(spark, docs, items, shard_words=50, block_bytes=40)     # several benchmark blocks


def test_report_and_removal(spark):
    docs = spark.createDataFrame([(1, "a b c d", "x"), (2, "q A, b!", "y"), (None, None, None)], "doc_id long, text string, n_hit string")
    items = spark.createDataFrame([(10, "a b"), (9, "b c d")], "item_id long, text string")
    got = {r.doc_id: r for r in D.report(docs, items).collect()}
    assert (got[1].n_hit, got[1].n_items, got[1].items) == (4, 2, ["10", "9"])
    assert got[1].items_sha256 == hashlib.sha256(b"10,9").hexdigest()
    assert (got[2].n_hit, got[2].n_items, got[2].contaminated) == (2, 1, True)
    assert (got[None].n_words, got[None].contaminated) == (0, False)
    assert got[None].items_sha256 == hashlib.sha256(b"").hexdigest()
    kept = D.decontaminate(docs, items)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(None, None, None)]


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert D.report(no_docs, items).count() == 0
    assert D.decontaminate(odd_docs, items.limit(0)).count() == odd_docs.count()
    assert D.report(odd_docs, items).filter("contaminated").count() == 4


def test_long_item_takes_time_in_proportion():
    random.seed(6)
    body = [str(random.randrange(50_000)).encode() for _ in range(80_000)]
    block = D.TestBlock([("a", body)], 10)
    doc = np.fromiter((block.vocab[w] for w in body), np.int32, len(body))
    began = time.process_time()
    spans, windows, best = D._shard_hits(block, [doc], True)
    assert spans == [[(0, 80_000)]] and best == [(80_000, 0, 0)] and len(windows[0]) == 79_991
    assert time.process_time() - began < 20


def test_prompt_that_many_items_share(spark):
    prompt = " ".join(f"p{i}" for i in range(10))
    items = spark.createDataFrame([(i, f"{prompt} answer{i}") for i in range(3000)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"say {prompt} now") for i in range(400)], "doc_id long, text string").coalesce(1)
    rows = D.report(docs, items).drop("items").distinct().collect()
    assert len(rows) == 400 and {(r.n_hit, r.n_items, r.longest, r.longest_word, r.longest_item) for r in rows} == {(10, 3000, 10, 1, "0")}


def test_longest_matches(spark):
    docs = spark.createDataFrame([(1, "z a b c d e z"), (2, "b c d z")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "a b c d e f")], "item_id long, text string")
    got = {r.item_word: (r.length, r.doc_id, r.doc_word) for r in D.longest_matches(docs, items, window=2).collect()}
    assert got == {0: (5, 1, 1), 1: (4, 1, 2), 2: (3, 1, 3), 3: (2, 1, 4)}


def test_longest_match_lies_at_the_largest_place_however_documents_are_cut(spark):
    docs = spark.createDataFrame([(9, "a b c z a b c"), (2, "a b c d"), (5, "b c d a b"), (None, "a b c d"), (7, "a b c d z b c d"), (7, "z a b c d")],
                                 "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, "a b c"), (2, "a b c d")], "item_id long, text string")
    want = {("1", 0): (3, 9, 4), ("1", 1): (2, 9, 5), ("2", 0): (4, 7, 1), ("2", 1): (3, 7, 5), ("2", 2): (2, 7, 6)}
    for shard_words in (1, 10, 1000):
        found = D.longest_matches(docs, items, window=2, shard_words=shard_words).collect()
        assert {(r.item_id, r.item_word): (r.length, r.doc_id, r.doc_word) for r in found} == want, shard_words


def test_query_over_whole_table(spark):
    from hearth.llm.queries import QUERIES
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = {d[0]: (n, h, len(i)) for d, (n, h, i) in zip(docs, brute(docs, items))}
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in QUERIES["op1_benchmark_decontamination"](spark, SF_SMALL).collect()}
    assert got == want
