"""Inputs that are not plain scans, and columns with names that operators use."""

import pytest
from pyspark.sql import functions as F

from hearth.llm import archives, exact_dedup, ngram_join, sharding
from hearth.llm.common import _is_scan

WORDS = "one two three four five six seven eight nine ten eleven twelve thirteen"


def texts(i):
    return [f"{WORDS} first {i}", f"{WORDS} of the other kind {i} entirely " + " ".join(f"w{i}{j}" for j in range(40))]


@pytest.fixture(scope="module")
def scan(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scan") / "t")
    spark.createDataFrame([(i, texts(i)) for i in (1, 2, 3)], "doc int, texts array<string>").coalesce(1).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def exploded(scan):
    """Three rows of a file become six texts; ids 11 and 20 to 31, the first text twice."""
    six = scan.select("doc", F.posexplode("texts").alias("i", "text"))
    return six.select((F.col("doc") * 10 + F.col("i")).cast("long").alias("doc_id"),
                      F.when((F.col("doc") < 3) & (F.col("i") == 0), F.lit(texts(1)[0])).otherwise(F.col("text")).alias("text"))


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_a_scan_is_told_from_what_is_derived(scan, exploded, spark):
    assert _is_scan(scan) and _is_scan(scan.select("doc").filter("doc > 1"))
    path = scan.inputFiles()[0].rsplit("/", 1)[0]
    for derived in (exploded, scan.union(scan), scan.sample(0.9, seed=1), scan.join(scan.select("doc"), "doc"), scan.limit(2),
                    scan.withColumn("r", F.rand()), spark.read.parquet(path, path), spark.createDataFrame([(1,)], "doc int")):
        assert not _is_scan(derived)


def test_exploded_rows_are_rows_of_their_own(exploded):
    assert ids(exact_dedup.dedup(exploded)) == [11, 20, 21, 30, 31]
    assert len({(r.k1, r.k2) for r in exact_dedup.decide(exploded).collect()}) == 6
    kept = ids(ngram_join.dedup(exploded, words=5, percent=95))
    assert kept == [10, 11, 21, 30, 31]


def test_a_union_of_a_table_with_itself(scan):
    docs = scan.select(F.col("doc").cast("long").alias("doc_id"), F.col("texts")[1].alias("text"))
    assert ids(exact_dedup.dedup(docs.union(docs))) == [1, 2, 3]
    assert ids(ngram_join.dedup(docs.union(docs))) == [1, 2, 3]
    path = scan.inputFiles()[0].rsplit("/", 1)[0]
    twice = scan.sparkSession.read.parquet(path, path).select(F.col("doc").cast("long").alias("doc_id"), F.col("texts")[1].alias("text"))
    assert ids(exact_dedup.dedup(twice)) == [1, 2, 3]


CLASHES = ["__k1", "__k2", "_metadata", "k1", "root", "cid", "c0", "n", "history", "kept", "f", "dropped"]


@pytest.mark.parametrize("stored", [False, True])
def test_clashing_names(spark, tmp_path, stored):
    rows = [(1, "same " + WORDS), (2, "same " + WORDS), (3, "something else entirely in these words"), (4, None)]
    docs = spark.createDataFrame([(*r, *range(len(CLASHES))) for r in rows],
                                 "doc_id long, text string, " + ", ".join(f"{c} long" for c in CLASHES))
    if stored:
        docs.write.parquet(str(tmp_path / "t"))
        docs = spark.read.parquet(str(tmp_path / "t"))
    for found, want in ((exact_dedup.dedup(docs), [2, 3, 4]), (ngram_join.dedup(docs), [1, 3, 4]),
                        (exact_dedup.dedup(docs, F.col("doc_id") > 1), [2, 3, 4])):
        assert found.columns == docs.columns and ids(found) == want
        assert all(r[2:] == tuple(range(len(CLASHES))) for r in found.collect())
    assert len(exact_dedup.decide(docs).collect()) == 4 and len(ngram_join.join(docs).collect()) == 4
    more = docs.withColumn("lang", F.lit("en")).withColumn("source", F.lit("a"))
    assert len(sharding.shard(more, shards=2).collect()) == 4
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://a.b/").alias("url"), F.col("text").alias("html"), *CLASHES)
    assert len(archives.convert_pages(pages).collect()) == 4


def test_a_large_class_is_dealt_over_parts(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "CLASS_ROWS", 7)
    docs = spark.createDataFrame([(i, WORDS if i % 2 else " ") for i in range(100)] + [(200, WORDS + " x")], "doc_id long, text string")
    rows = ngram_join.join(docs).collect()
    assert {r.doc_id: r.component_id for r in rows} == {i: (1 if i % 2 else i) for i in range(100)} | {200: 1} and len(rows) == 101
    assert ids(ngram_join.dedup(docs)) == sorted([1, *range(0, 100, 2)])
