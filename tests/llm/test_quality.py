import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from llm_fixtures import no_docs, odd_docs  # noqa: F401

from hearth.llm import language as L
from hearth.llm import quality as Q

from conftest import SF_SMALL


def test_features_are_sets_of_one_and_two_grams():
    def one(text):
        return next(Q.features([text], Q.hasher()))
    assert len(one(b"a b")) == 3 and len(one(b"a b a b")) == 4
    assert list(one(b"a b")) == list(one(b"  a\nb "))
    assert len(one(b"")) == len(one(None)) == 0
    assert set(one(b"a")) < set(one(b"a!!"))
    assert [len(x) for x in Q.features([b"a b", None, b"", b"c", b"a b"], Q.hasher())] == [3, 0, 0, 1, 3]


def test_ftrl_step_by_hand():
    m = Q.Ftrl()
    at = np.array([3, 5])
    m.update(at, 1)
    g = -0.5 / np.sqrt(2)
    assert np.allclose(m.z[at], g) and np.allclose(m.n[at], g * g)
    assert np.allclose(m.weights(at), -(g + Q.L1) / ((Q.BETA + abs(g)) / Q.ALPHA + Q.L2))
    assert np.isclose(m.bias(), 0.5 / ((Q.BETA + 0.5) / Q.ALPHA))
    again = Q.Ftrl(m.vector())
    assert np.allclose(again.vector(), m.vector())


def test_held_out_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = L.held_out(F.col("doc_id"), 5, 0)
    weights = Q.train(Q.training_rows(docs, labels, ~held))
    found = Q.score(docs.filter(held).join(labels, "doc_id"), weights).select("quality", "quality_score").collect()
    good = [r.quality_score >= 0.3 for r in found if r.quality == 1]
    bad = [r.quality_score < 0.3 for r in found if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) >= 0.75 * len(bad)


def test_sample_is_bounded_and_leaves_held_out_rows(spark, odd_docs):  # noqa: F811
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 13)] + [(6, 0), (None, 1), (8, None)], "doc_id long, quality int")
    rows = Q.training_rows(odd_docs, labels, F.col("doc_id") != 5, rows=6).collect()
    assert len(rows) <= 6 and 5 not in {r.doc_id for r in rows} and len({r.doc_id for r in rows}) == len(rows)


def test_one_text_counts_for_an_id(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    texts = [(1, "a b c"), (1, "d e"), (1, "f")]
    least = min([int(x) for x in f] for f in Q.features([t.encode() for _, t in texts], Q.hasher()))
    for some in (texts, texts[::-1]):
        docs = spark.createDataFrame(some, "doc_id long, text string").repartition(3)
        rows = Q.training_rows(docs, labels, F.lit(True)).collect()
        assert [(r.doc_id, r.y, list(r.features)) for r in rows] == [(1, 1, least)]


def test_odd_rows(spark, odd_docs, no_docs):  # noqa: F811
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 13)], "doc_id long, quality int")
    weights = Q.train(Q.training_rows(odd_docs, labels, F.lit(True)))
    got = Q.score(odd_docs, weights)
    assert got.columns == [*odd_docs.columns, "quality_score"]
    rows = got.collect()
    assert all(0 <= r.quality_score <= 1 for r in rows)
    assert len({r.quality_score for r in rows if not (r.text or "").strip()}) == 1
    none = Q.train(Q.training_rows(no_docs, labels, F.lit(True)))
    assert not none.any() and Q.score(no_docs, none).count() == 0


def test_query_columns(spark):
    from hearth.llm.queries import QUERIES
    df = QUERIES["op3_quality_classifier"](spark, SF_SMALL)
    assert dict(df.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    assert df.count() == 200


def plain_features(text):
    """Distinct feature numbers of tokens and pairs of tokens, one byte at a time."""
    full, prime = (1 << 64) - 1, 0x9E3779B97F4A7C15
    table = [int(x) for x in Q.hasher().table]

    def mixed(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & full
        x = (x ^ x >> 27) * 0x94D049BB133111EB & full
        return x ^ x >> 31

    tokens = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^\x20\x09-\x0d0-9A-Za-z\x80-\xff]+", (text or "").encode())
    one = [mixed(sum(table[b] * pow(prime, j, 1 << 64) for j, b in enumerate(t)) & full) for t in tokens]
    two = [mixed(((2 * prime + a) * prime + b) & full) for a, b in zip(one, one[1:])]
    return sorted({h >> 44 for h in one + two})


def plain_ftrl(examples, start, rare):
    """Weights after FTRL over the examples, a feature at a time; -1 is the bias."""
    z = {i: (-w * Q.BETA / Q.ALPHA if i == -1 else -w * (Q.BETA / Q.ALPHA + Q.L2) - math.copysign(Q.L1, w)) for i, w in start.items()}
    n = {}

    def weight(i):
        v, root = z.get(i, 0.0), math.sqrt(n.get(i, 0.0))
        if i == -1:
            return -v / ((Q.BETA + root) / Q.ALPHA)
        return 0.0 if abs(v) <= Q.L1 else -(v - math.copysign(Q.L1, v)) / ((Q.BETA + root) / Q.ALPHA + Q.L2)

    for epoch in range(Q.EPOCHS):
        for e in np.random.default_rng(epoch).permutation(len(examples)):
            at, y = examples[e]
            x = 1 / math.sqrt(max(1, len(at)))
            old = {i: weight(i) for i in [*at, -1]}
            p = 1 / (1 + math.exp(-max(-35, min(35, x * sum(old[i] for i in at) + old[-1]))))
            for i, w in old.items():
                g = rare[y] * (p - y) * (1 if i == -1 else x)
                had = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(had + g * g) - math.sqrt(had)) / Q.ALPHA * w
                n[i] = had + g * g
    return {i: weight(i) for i in z}


def test_query_against_brute_force(spark):
    from hearth.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", F.pmod(F.hash("doc_id"), F.lit(Q.SHARDS)).alias("shard")).collect()
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    sets = {r.doc_id: plain_features(r.text) for r in docs}
    learn = [r for r in docs if zlib.crc32(str(r.doc_id).encode()) % 5 and quality.get(r.doc_id) is not None]
    count = {y: sum(quality[r.doc_id] == y for r in learn) for y in (0, 1)}
    rare = {y: max(count.values()) / max(1, c) for y, c in count.items()}
    weights = {}
    for _ in range(Q.ROUNDS):
        mean = {}
        for shard in range(Q.SHARDS):
            examples = [(sets[r.doc_id], quality[r.doc_id]) for r in sorted(learn, key=lambda r: r.doc_id) if r.shard == shard]
            if examples:
                start = {i: float(np.float32(w)) for i, w in weights.items() if w}
                for i, w in plain_ftrl(examples, start, rare).items():
                    mean[i] = mean.get(i, 0.0) + w * len(examples) / len(learn)
        weights = mean
    got = {r.doc_id: r for r in QUERIES["op3_quality_classifier"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for r in docs:
        at = sets[r.doc_id]
        s = sum(weights.get(i, 0.0) for i in at) / math.sqrt(max(1, len(at))) + weights.get(-1, 0.0)
        assert abs(got[r.doc_id].score - 1 / (1 + math.exp(-s))) < 1e-4, r.doc_id
        assert got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.3)
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
