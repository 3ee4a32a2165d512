import hashlib
import os

import numpy as np
import pytest

from llm_fixtures import no_docs, odd_docs  # noqa: F401

from hearth.llm import exact_dedup as X
from pyspark.sql import functions as F


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("n", [0, 1, 2, 7, 500, 5000])
def test_perfect_hash_is_minimal_and_rejects_others(n):
    keys = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(n)), np.uint8).reshape(-1, 32)
    mph = X.PerfectHash(keys)
    assert sorted(mph.slots(keys)) == list(range(n))
    others = np.frombuffer(os.urandom(32 * 50), np.uint8).reshape(-1, 32)
    slots = mph.slots(others)
    assert ((slots >= 0) & (slots < n)).all() if n else (slots == -1).all()


def test_groups_and_winners(spark, odd_docs):
    rows = odd_docs.select("doc_id", "text").collect()
    groups = {}
    for r in rows:
        groups.setdefault(lowered(r.text), []).append(r.doc_id)
    got = X.decide(odd_docs).collect()
    assert len(got) == len(rows)
    want = sorted((str(r.doc_id), str(max((d for d in groups[lowered(r.text)] if d is not None), default=None)),
                   len(groups[lowered(r.text)])) for r in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    kept = X.dedup(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == len(groups)


@pytest.mark.parametrize("history", ["true", "false", "doc_id < 50"])
def test_any_history_gives_the_same_groups(spark, history):
    docs = spark.createDataFrame([(i, f"text {i % 17}") for i in range(100)], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in X.decide(docs, F.expr(history)).collect()}
    for i in range(100):
        group = [j for j in range(100) if j % 17 == i % 17]
        assert got[i] == (max(group), len(group), i == max(group))


def test_large_ids_stay_exact(spark):
    big = 9007199254740993
    docs = spark.createDataFrame([(big, "a"), (None, "a"), (big - 1, "A")], "doc_id long, text string")
    assert {r.keep_id for r in X.decide(docs).collect()} == {big}


def test_empty_table(no_docs):
    assert X.decide(no_docs).count() == 0
    assert X.dedup(no_docs).count() == 0


def test_parquet_rows_keep_their_key(spark, tmp_path, odd_docs):
    odd_docs.repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    assert X.dedup(docs).count() == X.dedup(odd_docs).count()
