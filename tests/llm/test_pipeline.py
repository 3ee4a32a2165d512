import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline as P
from hearth.llm import byte_bpe
from test_decontaminate import brute as hits
from test_exact_dedup import lowered
from test_ngram_join import brute as components

from conftest import SF_SMALL


def expected(docs, items):
    """The stages one after another, in plain Python (documents: (id, text))."""
    docs = [d for d in docs if any(c.isalpha() for c in d[1] or "")]
    last = {}
    for d in docs:
        last[lowered(d[1])] = max(d[0], last.get(lowered(d[1]), d[0]))
    docs = [d for d in docs if last[lowered(d[1])] == d[0]]
    first = {int(d): int(c) for d, _, c in components(docs, 5, 80)}
    docs = [d for d in docs if first[d[0]] == d[0]]
    docs = [d for d, (_, hit, _) in zip(docs, hits(docs, items)) if not hit]
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for d, text in docs:
        ids = library.encode_ordinary(text)
        out.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def test_whole_run_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert sorted(tuple(r) for r in P.run(spark, SF_SMALL).collect()) == expected(docs, items)


def test_each_stage_decides(spark, tmp_path):
    filler = " ".join(f"word{i} stays" for i in range(40))
    clean = [(1000 + i, f"{filler} number{i} and {' '.join(f'own{i}x{j}' for j in range(40))}") for i in range(20)]
    rows = clean + [(1, None), (2, "123 ..."), (3, clean[0][1].upper()), (4, clean[1][1] + " more"), (5, "a secret test passage of exactly ten plain words here " * 2)]
    rows = [(d, t, "en", "s", 0, "x") for d, t in rows]
    folder = str(tmp_path / "t")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, digest string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(7, "secret test passage of exactly ten plain words here a")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = []
    for name, stage in P.STAGES:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns or name == "byte_level_bpe"
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        left.append({r.doc_id for r in docs.select("doc_id").collect()})
    everything = {d for d, *_ in rows}
    assert left[0] == everything - {1, 2}
    assert left[1] == left[0] - {3}
    assert left[2] == left[1] - {1001}
    assert left[3] == left[2] - {5} and left[4] == left[3]


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "t")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert P.run(spark, folder).count() == 0
