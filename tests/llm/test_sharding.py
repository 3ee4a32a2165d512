import random
import zlib

from llm_fixtures import no_docs, odd_docs  # noqa: F401

from hearth.llm import sharding as S

from conftest import SF_SMALL


def loads(rows):
    out = {}
    for r in rows:
        out.setdefault(r.shard, []).append(r)
    for shard in out.values():
        assert sorted(r.slot for r in shard) == list(range(len(shard)))
    return {s: sum(r.size for r in rows) for s, rows in out.items()}


def test_leaves_are_even_despite_hot_values_and_copies(spark):
    random.seed(4)
    rows = [(i, "t" * random.randint(0, 200), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(6000)]
    rows += [(1, "same", "en", "hot")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(6)
    for n in (16, 5, 1):
        got = loads(S.shard(docs, shards=n).collect())
        assert sorted(got) == list(range(n)) and max(got.values()) - min(got.values()) < 0.03 * sum(got.values()) / n + 400


def test_target_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * 99, "en", "a") for i in range(1000)], "doc_id long, text string, lang string, source string")
    got = loads(S.shard(docs, target_bytes=10_000).collect())
    assert len(got) == 10 and all(9_500 <= b <= 10_500 for b in got.values())


def test_sizes_and_checksums(spark, odd_docs, no_docs):  # noqa: F811
    rows = S.shard(odd_docs, shards=4).collect()
    assert sorted((str(r.doc_id), r.size, r.crc) for r in rows) == sorted(
        (str(d.doc_id), len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in odd_docs.collect())
    loads(rows)
    assert S.shard(no_docs, shards=4).count() == 0 and S.shard(no_docs, target_bytes=10).count() == 0


def test_query(spark):
    from hearth.llm.queries import QUERIES
    df = QUERIES["op6_kd_tree_sharding"](spark, SF_SMALL)
    rows = df.collect()
    assert dict(df.dtypes)["grown_shard"] == "int" and len(rows) == 200 and {r.law for r in rows} == {"bytes"}
    assert {r.shard for r in rows} <= set(range(16))
    loads(rows)


def brute_shards(rows, shards):
    """{row: shard} by sorting every node's rows: cut where a row takes the bytes to
    the node's share, before or after it, whichever comes nearer."""
    spans = {d: max(r[d] for r in rows) - min(r[d] for r in rows) for d in S.DIMENSIONS}

    def split(some, first, last):
        if last - first == 1:
            return {r.row: first for r in some}
        left = (last - first) // 2
        wide = {d: (max(r[d] for r in some) - min(r[d] for r in some)) / max(1, spans[d]) if some else 0 for d in S.DIMENSIONS}
        by = next(d for d in S.DIMENSIONS if wide[d] == max(wide.values()))
        some = sorted(some, key=lambda r: (r[by], r.tie))
        wanted, below, cut = sum(r.size for r in some) * left / (last - first), 0, len(some)
        for i, r in enumerate(some):
            if below + r.size >= wanted:
                cut = i if wanted - below < below + r.size - wanted else i + 1
                break
            below += r.size
        return split(some[:cut], first, first + left) | split(some[cut:], first + left, last)

    return split(rows, 0, shards)


def test_query_against_brute_force(spark):
    from hearth.llm.queries import QUERIES
    rows = S.metadata(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()
    want = brute_shards(rows, 16)
    got = {r.doc_id: r for r in QUERIES["op6_kd_tree_sharding"](spark, SF_SMALL).collect()}
    assert {r.doc_id: (r.size, r.crc, want[r.row]) for r in rows} == {i: (r.size, r.text_crc32, r.shard) for i, r in got.items()}
