"""Registered queries of the training-data operators and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm import (archives, byte_bpe, decontaminate, exact_dedup, filter_audit, hard_negatives, language, licenses, ngram_join,
                        packing, quality, sharding, token_counts)
from hearth.llm.common import LOWER, UPPER, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: DuckDB: the words of a text as operators 1 and 2 take them.
SQL_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


@register("op1_benchmark_decontamination", rf"""
WITH d AS (SELECT doc_id, {SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, w, least(10, len(w)) AS k FROM (SELECT item_id, {SQL_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS gram FROM b),
places AS (SELECT doc_id, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS gram,
                  unnest(range(1, len(w) - k + 2)) AS p
           FROM d JOIN (SELECT DISTINCT k FROM windows) ON len(w) >= k),
hits AS (SELECT doc_id, item_id, p, k FROM places JOIN windows USING (k, gram)),
covered AS (SELECT doc_id, count(DISTINCT word) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS word FROM hits) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY 1),
item_places AS (SELECT item_id, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS gram,
                       unnest(range(1, len(w) - k + 2)) AS i FROM b),
diagonals AS (SELECT doc_id, item_id, k, p, p - i AS d, p - row_number() OVER (PARTITION BY doc_id, item_id, k, p - i ORDER BY p) AS run
              FROM places JOIN item_places USING (k, gram)),
matches AS (SELECT doc_id, item_id::VARCHAR AS item, min(p) - 1 AS word, count(*) + k - 1 AS length
            FROM diagonals GROUP BY doc_id, item_id, k, d, run),
longest AS (SELECT * FROM matches QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, word, item) = 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, covered.n IS NOT NULL AS contaminated,
       coalesce(longest.length, 0)::BIGINT AS longest, longest.word::BIGINT AS longest_word, longest.item AS longest_item
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN longest USING (doc_id)
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


@register("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = language.held_out(F.col("doc_id"), 3, 1)
    profiles = language.train(docs, ~held)
    found = language.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@register("op9_exact_dedup", f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS x FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(x) AS text_sha256
FROM t WINDOW same AS (PARTITION BY x)
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.decide(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@register("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    vocabulary = token_counts.Vocabulary.load(public_tokenizers.path("piece_bpe_32k.model"))
    found = token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)
    return found.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens",
                        (F.col("n_tokens") > 4096).alias("over_limit"))


@register("op10_ngram_jaccard_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@register("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = language.held_out(F.col("doc_id"), 5, 0)
    weights = quality.train(quality.training_rows(docs, table(spark, sf_dir, "labels"), ~held))
    found = quality.score(docs, weights)
    return found.select("doc_id", held.alias("held_out"), F.col("quality_score").alias("score"),
                        (F.col("quality_score") >= 0.3).cast("int").alias("predicted"))


@register("op2_license_scan", licenses.oracle_sql(SQL_WORDS))
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register("op6_kd_tree_sharding")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), shards=16)
    return found.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


@register("op5_arc_to_warc", f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
m AS (SELECT *, n >= {archives.REVISIT_BYTES} AND page_id < max(page_id) OVER (PARTITION BY h) AS again,
             max(page_id) OVER (PARTITION BY h) AS top FROM d)
SELECT page_id, n AS payload_bytes, h AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN top END AS refers_to FROM m
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archives.convert_pages(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op8_byte_level_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.PATTERN, ranks)


@register("op11_filter_interaction_audit", filter_audit.oracle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op12_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        placed, _ = packing.pack(table(spark, sf_dir, "documents"), f.read())
    return placed.select("doc_id", "start", F.col("length").cast("long"), "ids_crc32", "doc_tokens", "sequence_id", "offset")


@register("op13_hard_negatives", hard_negatives.ORACLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))
