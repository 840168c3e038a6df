"""The queries of this subpackage: each applies one operator, with production parameters, to whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, hamming_search, jaccard_join, language, line_dedup, secrets, suffix_array, suffix_tree, tokens


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.dedup(_documents(spark, sf_dir), length=200).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), n=10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(_documents(spark, sf_dir), percent=80).select("doc_id", "n_lines", "n_removed", "kept_sha256")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return secrets.scan(docs, secrets.learn(docs))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(_documents(spark, sf_dir), n=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op8_topk_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return hamming_search.search(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=10, bits=256)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.dedup(_documents(spark, sf_dir), window=13).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return language.identify(docs, language.learn(docs))


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_array_dedup, op2_benchmark_decontamination, op3_token_counts, op4_line_dedup, op5_secret_scan,
        op6_bpe, op7_ngram_jaccard_join, op8_topk_hamming, op9_substring_dedup, op10_language_id,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM, _SPACED = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x20\x09-\x0D]+"

#: What SQL can express; the others are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_benchmark_decontamination": f"""
WITH items AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
windows AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g FROM items, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
spots AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM docs, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
found AS (SELECT doc_id, n, i, item_id FROM spots JOIN windows USING (n, g)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN listed USING (doc_id)
""",
    "op7_ngram_jaccard_join": f"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_SPACED}') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM docs, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_one AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN least_one USING (doc_id)
""",
    "op9_substring_dedup": f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACED}') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM docs, unnest(range(1, len(w) - 11)) AS t(i)),
first_one AS (SELECT g, min(doc_id) AS m FROM windows GROUP BY g),
gone AS (SELECT DISTINCT doc_id, p FROM windows JOIN first_one USING (g), unnest(range(i, i + 13)) AS t(p) WHERE m < doc_id),
kept AS (SELECT doc_id, string_agg(w[p], ' ' ORDER BY p) AS kept, count(*) AS n FROM (SELECT doc_id, w, p FROM docs, unnest(range(1, len(w) + 1)) AS t(p)) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (doc_id)
""",
}
