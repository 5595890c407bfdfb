"""The registered queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import clustering, decontaminate, fill_middle, langid, line_dedup, ngram_join, packing, pieces, quality, secrets, sharding, suffix_dedup, token_files
from skyledger.llm.common import scratch_path, table

BLANK_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_documents(table(spark, sf_dir, "documents"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.train_and_identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score_quality(docs, keep_text=False).select("doc_id", *quality.FEATURES, "base_failed", "kept")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), out)
    return token_files.read_token_files(spark, out, with_ids=False)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op11_cluster_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_vectors(table(spark, sf_dir, "embeddings"), k=40, rounds=5, seed=2)


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pieces.decode_pieces(pieces.encode_pieces(table(spark, sf_dir, "documents")))
    ids = F.concat_ws(" ", F.transform("ids", lambda i: i.cast("string")))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"), seed=7, percent=100, spm_percent=50)
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


OP9_SQL = f"""
WITH split AS (
  SELECT doc_id, u.pos, u.line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
       unnest(list_transform(range(1, len(ls) + 1), lambda i: {{'pos': i, 'line': ls[i]}})) AS t(u)),
keyed AS (
  SELECT *, translate(trim(line, {BLANK_SQL}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM split),
common AS (
  SELECT k, max(doc_id) AS keep_id FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT a.doc_id, a.pos, a.line, c.k IS NOT NULL AND a.doc_id <> c.keep_id AS dropped FROM keyed a LEFT JOIN common c ON a.k = c.k)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (WHERE dropped) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP13_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS s FROM documents),
drawn AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS u, CAST('0x' || s[1:8] AS BIGINT) AS h1, CAST('0x' || s[9:16] AS BIGINT) AS h2,
    CAST('0x' || s[17:24] AS BIGINT) AS h3, CAST('0x' || s[25:32] AS BIGINT) AS h4 FROM docs),
cut AS (
  SELECT doc_id, t, u, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
         WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""


def op11_sql(k: int = 40, rounds: int = 5, seed: int = 2, dim: int = 64) -> str:
    """One step of the chain for each round: distances to all centroids by plain sums, the first of the nearest, floors of means."""
    steps = [
        f"""kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim})""",
        f"""c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY h, v) - 1 AS INTEGER) AS cluster, v AS c
  FROM (SELECT v, sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM kept ORDER BY h, v LIMIT {k}))""",
    ]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, v, list_sort(list_transform(cs, lambda p: {{'d': list_sum(list_transform(list_zip(v, p.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'n': p.cluster}}))[1] AS best
  FROM kept, (SELECT list({{'cluster': cluster, 'c': c}} ORDER BY cluster) AS cs FROM c{r}))""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT o.cluster, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c
    FROM (SELECT best.n AS cluster, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, range(1, {dim + 1}) AS t(i) GROUP BY 1, 2) GROUP BY 1) m ON o.cluster = m.cluster)""")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, best.n AS cluster, CAST(best.d AS BIGINT) AS distance, CAST(sum(best.d) OVER (PARTITION BY best.n) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON best.n = cluster"""


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_packing": op2_packing,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_language_id": op4_language_id,
    "op5_quality_rules": op5_quality_rules,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_token_files": op7_token_files,
    "op8_decontamination": op8_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_cluster_centroids": op11_cluster_centroids,
    "op12_pieces": op12_pieces,
    "op13_fill_middle": op13_fill_middle,
}
ORACLE_SQL = {"op9_line_dedup": OP9_SQL, "op11_cluster_centroids": op11_sql(), "op13_fill_middle": OP13_SQL}
