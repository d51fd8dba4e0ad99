"""The operators as registered queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, langid, licences, packing, pii, quality, secret_scan, simhash, spelling, substrings, suffixes, token_store, vafile
from tidemark.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(function):
    QUERIES[function.__name__] = function
    return function


@register
def op1_robust_outliers(spark, sf_dir):
    return quality.quality(documents(spark, sf_dir))


@register
def op5_simhash_near_duplicates(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir)).select("doc_id", simhash.hex_print().alias("fingerprint"), "component_id")


@register
def op7_trigram_secret_scan(spark, sf_dir):
    return secret_scan.secrets(documents(spark, sf_dir))


@register
def op9_decontaminate(spark, sf_dir):
    return decontaminate.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@register
def op4_best_fit_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir))


@register
def op2_suffix_dedup(spark, sf_dir):
    return suffixes.suffix_dedup(documents(spark, sf_dir))


@register
def op10_level_wise_substrings(spark, sf_dir):
    return substrings.substring_dedup(documents(spark, sf_dir))


@register
def op3_feistel_pseudonyms(spark, sf_dir):
    return pii.pseudonyms(documents(spark, sf_dir))


@register
def op6_language_families(spark, sf_dir):
    return langid.identify(documents(spark, sf_dir))


@register
def op8_dice_licences(spark, sf_dir):
    return licences.licences(documents(spark, sf_dir))


@register
def op11_perfect_hash_index(spark, sf_dir):
    return token_store.store_digest(documents(spark, sf_dir))


@register
def op12_letter_count_trees(spark, sf_dir):
    return spelling.spelling_variants(documents(spark, sf_dir))


@register
def op13_va_file_centroids(spark, sf_dir):
    return vafile.centroid_clusters(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _centroid_rounds(k: int = vafile.CENTROIDS, rounds: int = vafile.ROUNDS, dimensions: int = vafile.DIMENSIONS) -> str:
    """Plain Lloyd rounds over all distances."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (SELECT r, any_value(vec_id) AS vec_id, any_value(q) AS q, min(d * 64 + k) % 64 AS k, min(d) AS d FROM (
    SELECT r, vec_id, q, k, list_sum(list_transform(list_zip(q, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM kept, c{i}) GROUP BY r)""")
        if i < rounds:
            steps.append(f"""
s{i} AS (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
    SELECT k, i, sum(q[i])::BIGINT AS s, count(*) AS n FROM a{i}, range(1, {dimensions + 1}) t(i) GROUP BY k, i) GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT c{i}.k, coalesce(s{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN s{i} ON c{i}.k = s{i}.k)""")
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({vafile.SCALE} * x::DOUBLE)::BIGINT) AS q
    FROM embeddings WHERE len(embedding) = {dimensions} AND len(list_filter(embedding, lambda x: isfinite(x::DOUBLE))) = {dimensions}),
c0 AS MATERIALIZED (SELECT k, c FROM (SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), q) - 1 AS k, q AS c FROM kept) WHERE k < {k}),
{",".join(steps)}
SELECT vec_id, a{rounds}.k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a{rounds}.k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON a{rounds}.k = c{rounds}.k"""


ORACLE["op13_va_file_centroids"] = _centroid_rounds()
