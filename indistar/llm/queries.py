"""The corpus operators with production parameters, each over its whole
table, and their DuckDB SQL where SQL can express the operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indistar.llm.clusters import cluster_vectors
from indistar.llm.common import table
from indistar.llm.decontaminate import contamination
from indistar.llm.exact_dedup import exact_groups
from indistar.llm.langid import identify_languages
from indistar.llm.minhash import near_groups
from indistar.llm.packing import pack_documents
from indistar.llm.repair import repair_report
from indistar.llm.repeats import remove_repeats
from indistar.llm.sharding import shard_records
from indistar.llm.simhash import simhash_groups
from indistar.llm.token_count import token_counts
from indistar.llm.toxicity import toxicity
from indistar.llm.wavelet import token_files

SHARDS = 40


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"), keep="max")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_records(table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(table(spark, sf_dir, "conversations"))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_repeats, op2_decontaminate, op3_exact_dedup, op4_toxicity, op5_near_dedup,
                                   op6_sharding, op7_token_counts, op8_packing, op9_language, op10_token_files, op11_simhash, op12_repair, op13_clusters)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _clusters_sql(clusters: int = 8, rounds: int = 10) -> str:
    """Every round written out: assign, then floors of the exact means."""
    square = "list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"

    def assigned(i: int) -> str:
        return f"""a{i} AS MATERIALIZED (SELECT r, vec_id, x, min(d) AS d, arg_min(k, d * {clusters} + k) AS k
  FROM (SELECT v.r, v.vec_id, v.x, c.k, {square} AS d FROM v, c{i} c) GROUP BY r, vec_id, x)"""

    steps = [f"""{assigned(i)},
c{i + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
  SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY p) AS x
  FROM (SELECT k, p, sum(y)::BIGINT AS s, count(*) AS n FROM (SELECT k, unnest(x) AS y, unnest(range(len(x))) AS p FROM a{i})
        GROUP BY k, p) GROUP BY k) m USING (k))""" for i in range(rounds)]
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda y: floor(1024 * y::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: isfinite(y))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS k, x
  FROM (SELECT sha256('3:' || vec_id) AS h, x FROM v ORDER BY h NULLS LAST, x LIMIT {clusters})),
{", ".join(steps)},
{assigned(rounds)},
i AS (SELECT k, sum(d)::BIGINT AS part FROM a{rounds} GROUP BY k)
SELECT a.vec_id, a.k::INTEGER AS cluster, a.d::BIGINT AS distance, i.part AS cluster_inertia,
       (SELECT sum(part)::BIGINT FROM i) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN i USING (k) JOIN c{rounds} c USING (k)"""


ORACLE_SQL = {
    "op13_clusters": _clusters_sql(),
    "op3_exact_dedup": f"""
WITH d AS (SELECT doc_id, {_LOWER.format("coalesce(text, '')")} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g USING (norm)""",
    "op2_decontaminate": f"""
WITH dw AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
              '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
          array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dg AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
m AS (SELECT dg.doc_id, dg.n, dg.i, win.item_id FROM dg JOIN win ON dg.n = win.n AND dg.g = win.g),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT dw.doc_id, len(dw.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)""",
}
