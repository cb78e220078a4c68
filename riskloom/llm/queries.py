"""Registered queries of the operators over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.llm import (
    alignment, byte_runs, centroids, decontamination, graph_search, jaccard_join, language, line_runs, mixing,
    norm_search, packing, sharding, token_files,
)
from riskloom.llm.common import read_table, scratch_path

WEIGHTS = {
    "domain": {"reference": 2.0, "web": 1.0},
    "lang": {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0},
}


def domain() -> Column:
    """Documents name no domain; here the last digit of the source's name stands for one."""
    return F.when(F.col("source").rlike("[0-4]$"), "reference").otherwise("web")


def op1_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(
        read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json")
    )
    return token_files.read_token_files(spark, path)


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = byte_runs.remove_repeats(read_table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256",
        (F.col("n_bytes") - F.col("n_removed")).alias("kept_bytes"),
    )


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"), domain(), WEIGHTS, budget_share=0.6, max_epochs=2)


def op7_norm_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_search.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op8_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    model = language.learn(docs.filter(~held_out))
    return language.identify(docs.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"]).select(
        "doc_id", "held_out", "lang_pred", "score"
    )


def op9_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_runs.without_repeated_lines(read_table(spark, sf_dir, "documents"))
    return done.select(
        "doc.doc_id", "n_lines", "n_removed",
        F.octet_length("text").cast("long").alias("kept_bytes"),
        F.crc32(F.col("text").cast("binary")).alias("kept_crc32"),
    )


def op10_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = alignment.aligned_documents(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    return done.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op12_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_plane_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, table = centroids.cluster(read_table(spark, sf_dir, "embeddings"))
    return assigned.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pack_documents": op1_pack_documents,
    "op2_suffix_array": op2_suffix_array,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_graph_search": op4_graph_search,
    "op5_token_files": op5_token_files,
    "op6_mix_sources": op6_mix_sources,
    "op7_norm_search": op7_norm_search,
    "op8_language_mixture": op8_language_mixture,
    "op9_line_runs": op9_line_runs,
    "op10_feistel_shards": op10_feistel_shards,
    "op11_token_alignment": op11_token_alignment,
    "op12_benchmark_windows": op12_benchmark_windows,
    "op13_plane_centroids": op13_plane_centroids,
}


def _words_sql(text: str) -> str:
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


BENCHMARK_WINDOWS = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_words_sql('text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words_sql('text')} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item, w[s : s + least(len(w), 10) - 1] AS g
    FROM b, unnest(range(1, len(w) - least(len(w), 10) + 2)) u(s) WHERE len(w) > 0
),
lengths AS (SELECT DISTINCT len(g) AS m FROM windows),
places AS (
    SELECT r, s, m, w[s : s + m - 1] AS g FROM d, lengths, unnest(range(1, len(w) - m + 2)) u(s)
),
hits AS (SELECT r, s, m, item FROM places JOIN windows USING (g)),
words AS (
    SELECT r, count(DISTINCT s + k) AS n_hit FROM hits, unnest(range(0, m)) u(k) GROUP BY r
),
items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS found
    FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(found, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


def _centroids_sql(k: int = 40, rounds: int = 5) -> str:
    """Each round restated: nearest centroid of every vector, then floors of the means."""
    steps = [
        """kept AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings WHERE len(embedding) = 64
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""c0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS INTEGER) AS cluster, q AS c
    FROM kept ORDER BY cluster LIMIT {k}
)""",
    ]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
    SELECT vec_id, q, min({{'d': CAST(list_sum(list_transform(range(1, 65), lambda i: (q[i] - c[i]) * (q[i] - c[i]))) AS BIGINT),
        'c': cluster}}) AS best
    FROM kept, c{n} GROUP BY vec_id, q
)""")
        if n < rounds:
            steps.append(f"""c{n + 1} AS MATERIALIZED (
    SELECT c{n}.cluster, coalesce(m, c) AS c FROM c{n} LEFT JOIN (
        SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM (
            SELECT best.c AS cluster, i, sum(q[i]) AS s, count(*) AS n
            FROM a{n}, unnest(range(1, 65)) u(i) GROUP BY ALL
        ) GROUP BY cluster
    ) means ON means.cluster = c{n}.cluster
)""")
    return f"""
WITH {", ".join(steps)}
SELECT vec_id, best.c AS cluster, best.d AS distance,
    CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
    CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON best.c = cluster
"""


SQL: dict[str, str] = {
    "op12_benchmark_windows": BENCHMARK_WINDOWS,
    "op13_plane_centroids": _centroids_sql(),
}
