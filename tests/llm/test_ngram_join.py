import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_fixtures import no_docs, odd_docs  # noqa: F401

from hearth.llm import ngram_join as J

from conftest import SF_SMALL


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k=4, percent=85):
    """(id, set size, smallest id reachable) by comparing every pair that shares a shingle."""
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            where[g].append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in where[g] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted((str(d), len(sets[i]), str(least.get(top(i)))) for i, (d, _) in enumerate(rows))


def result(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in df.collect())


def near_copies(seed, n):
    """Families of near copies at all distances around the threshold, exact copies,
    chains, and a passage that unrelated texts share."""
    random.seed(seed)
    words = [f"w{i}" for i in range(400)]
    def text(k):
        return [random.choice(words) for _ in range(k)]
    passage = text(40)
    rows = []
    for _ in range(n // 10):
        base = text(random.choice([3, 8, 30, 80, 200]))
        for _ in range(5):
            copy = list(base)
            for _ in range(random.choice([0, 0, 1, 1, 2, 3, 5])):
                copy[random.randrange(len(copy))] = random.choice(words)
            rows.append(" ".join(copy))
        for _ in range(3):      # a chain: every link changes the one before
            base = list(base)
            base[random.randrange(len(base))] = "changed"
            rows.append(" ".join(base))
        rows.append(" ".join(passage + text(random.choice([2, 6, 10, 60]))))
        rows.append(rows[-1].upper())
    random.shuffle(rows)
    return [(i * 7 % 100_003, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_brute_force(spark, seed):
    rows = near_copies(seed, 400)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(J.join(docs)) == brute(rows)


def test_a_class_speaks_once_whatever_the_filter_holds(spark, monkeypatch):
    monkeypatch.setattr(J, "FILTER_BITS", 64)       # near full: much that is not wanted passes
    rows = [(i + 100_003 * c, t) for i, t in near_copies(4, 60) for c in range(3)]
    random.Random(4).shuffle(rows)
    docs = J.located(spark.createDataFrame(rows, "doc_id long, text string").repartition(6))
    sketch = J.frequency_sketch(docs.select("text"), 4, 85)
    spread = J.prefixes(J.keyed(docs).select("__k1", "__k2", "doc_id", "text"), sketch, 4, 85)
    post = J.shared_postings(J.staged(spread), 85).cache()
    assert post.count() == post.select("cid", "token").distinct().count() > 0
    # only tokens of two prefixes or more are postings, and ``met`` counts those before
    assert post.groupBy("token").count().filter("count < 2").isEmpty()
    places = defaultdict(list)
    for r in post.collect():
        places[bytes(r.cid)].append((r.at, r.met))
    assert all([m for _, m in sorted(p)] == list(range(len(p))) for p in places.values())
    assert result(J.join(docs)) == brute(rows)


def test_filter_table_holds_all_its_values(spark):
    values = np.random.default_rng(5).integers(-2**62, 2**62, 500)
    table = J._filter_table(spark.createDataFrame([(int(v),) for v in values], "v long"))
    assert len(table) * 8 == J.FILTER_BITS and J._has(table, values).all()
    assert np.unpackbits(table).sum() == len(np.unique(values & (J.FILTER_BITS - 1)))


def test_large_family_whose_links_run_over_one_text(spark):
    random.seed(9)
    base = [f"b{i}" for i in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 120):
        copy = list(base)
        for at in random.sample(range(300), random.choice([3, 6, 9, 12, 25])):
            copy[at] = f"x{i}_{at}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert result(J.join(docs)) == brute(rows)


def test_prefixes_of_similar_sets_share_enough():
    random.seed(3)
    sketch = np.random.default_rng(0).integers(0, 9, J.SKETCH_CELLS).astype(np.uint8)
    for _ in range(300):
        n = random.randint(1, 120)
        pool = np.random.default_rng(random.random().__hash__() & 0xffff).integers(-2**62, 2**62, 2 * n)
        x = np.unique(pool[:n])
        drop = random.randint(0, max(0, n // 10))
        y = np.unique(np.concatenate([x[drop:], pool[n:n + random.randint(0, n // 12)]]))
        shared = len(np.intersect1d(x, y))
        if len(y) == 0 or 100 * shared < 85 * (len(x) + len(y) - shared):
            continue
        (px, lx), (py, ly) = J.adaptive_prefix(x, sketch, 85), J.adaptive_prefix(y, sketch, 85)
        assert len(np.intersect1d(px, py)) >= min(lx, ly)


def test_components_of_plain_links(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 8), (8, 7), (7, 6), (3, 1)] + [(100, i) for i in range(101, 140)] + [(i, i + 1) for i in range(200, 230)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in J.components(df).collect()}
    want = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 6, 9: 6} | {i: 100 for i in range(100, 140)} | {i: 200 for i in range(200, 231)}
    assert got == want


def test_odd_rows_and_dedup(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    want = sorted((d, n, d if n == 0 else c) for d, n, c in brute(rows))
    assert result(J.join(odd_docs)) == want
    kept = J.dedup(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(map(str, ids)) == sorted(map(str, [1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 12, 13]))
    assert J.join(no_docs).count() == 0 and J.dedup(no_docs).count() == 0


def test_dedup_keeps_unrelated_texts_whose_ids_are_null_or_repeat(spark):
    rows = [(None, "one two three four five six"), (None, "red green blue black white grey"), (None, "ONE two three four five six"),
            (5, "north east south west up down"), (5, "iron gold tin lead zinc silver"), (5, "iron gold tin lead ZINC silver")]
    kept = J.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted((str(r.doc_id), r.text.lower()) for r in kept.collect()) == sorted({(str(d), t.lower()) for d, t in rows})


def test_query_over_whole_table(spark):
    from hearth.llm.queries import QUERIES
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert result(QUERIES["op10_ngram_jaccard_join"](spark, SF_SMALL)) == brute(rows)
