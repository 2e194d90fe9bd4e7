"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphvec.llm import bpe, decontam, filter_audit, fim, licenses, lm_score, ngram_join, quality, secrets, simhash, suffix_dedup, token_counts, warc
from graphvec.storage import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), carry=["doc_id"])
    return r.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("llr", 9).alias("llr"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = secrets.secret_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda k: F.size(F.filter("base_spans", lambda x: x["kind"] == k)).cast("bigint")
    return r.select(
        "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(secrets.spans_text("base_spans"), 256).alias("base_sha256"), secrets.spans_text("secret_spans").alias("spans"), "n_confirmed")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return r.withColumn("coverage", F.round("coverage", 9))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return r.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json")))


LIMITS = tuple(1 << k for k in range(7, 18))  # 128 to 131,072 tokens
SHARES = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of three kinds: each distinct length, the standard context limits, and quantiles
    (key: how many documents in a thousand do not exceed n_tokens)."""
    lengths = token_counts.encoded_lengths(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    t = materialize(token_counts.context_table(token_counts.histogram(lengths)), "contexts")
    rows = t.select(F.lit("length").alias("kind"), F.col("n_tokens").alias("key"), *t.columns)
    limits = token_counts.at_limits(t, LIMITS)
    rows = rows.unionByName(limits.select(F.lit("limit").alias("kind"), F.col("context_limit").alias("key"), F.col("docs_over").alias("docs_at_least"), F.col("tokens_kept").alias("truncated_tokens")), allowMissingColumns=True)
    shares = token_counts.quantiles(t, SHARES)
    return rows.unionByName(shares.select(F.lit("quantile").alias("kind"), F.round(F.col("share") * 1000).cast("bigint").alias("key"), "n_tokens"), allowMissingColumns=True)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_bundles(table(spark, sf_dir, "pages"))
    return warc.read_bundles(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return r.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = fim.restore(fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return r.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents"))


QUERIES = {
    "op2_suffix_dedup": op2_suffix_dedup,
    "op10_lm_score": op10_lm_score,
    "op1_token_counts": op1_token_counts,
    "op5_license_scan": op5_license_scan,
    "op9_warc": op9_warc,
    "op6_simhash": op6_simhash,
    "op7_bpe": op7_bpe,
    "op3_secret_scan": op3_secret_scan,
    "op8_decontaminate": op8_decontaminate,
    "op4_quality_rules": op4_quality_rules,
    "op11_fim": op11_fim,
    "op12_filter_audit": op12_filter_audit,
    "op13_ngram_join": op13_ngram_join,
}

OP9_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages
), first AS (
  SELECT sha, min(page_id) AS first_id FROM p GROUP BY sha
)
SELECT page_id, octet_length(encode(html)) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(sha, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), '') AS payload_digest,
  CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p JOIN first USING (sha)
"""

OP11_SQL = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u, sha256('42:' || doc_id) AS h FROM documents
), k AS (
  SELECT *, len(u) AS n, list_transform([0, 1, 2, 3], lambda i: CAST('0x' || substr(h, 1 + 8 * i, 8) AS BIGINT)) AS k FROM u
), c AS (
  SELECT *, list_sort([k[1] % (n + 1), k[2] % (n + 1)]) AS ends, CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR k[3] % 100 >= 50 THEN 'plain' WHEN k[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM k
), p AS (
  SELECT *, CASE WHEN form <> 'plain' THEN array_to_string(u[1:ends[1]], '') END AS a, CASE WHEN form <> 'plain' THEN array_to_string(u[ends[1] + 1:ends[2]], '') END AS b,
    CASE WHEN form <> 'plain' THEN array_to_string(u[ends[2] + 1:], '') END AS z FROM c
)
SELECT doc_id, n::BIGINT AS n, form, length(a)::BIGINT AS prefix_chars, length(b)::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || b ELSE '<S>' || z || '<P>' || a || '<M>' || b END) AS output_sha256, sha256(text) AS restored_sha256 FROM p
"""

OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * (doc_id > min(doc_id) OVER (PARTITION BY t))::INT AS s, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM d LEFT JOIN l USING (doc_id)
), x AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), s AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS filter, 1 << instr('ABCDE', substr(filter_order, step, 1)) - 1 AS own,
    list_sum(list_transform(range(1, step), lambda i: 1 << instr('ABCDE', substr(filter_order, i, 1)) - 1)) AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5])::INT AS step)
), r AS (
  SELECT part, filter_order, step, filter, count(*) FILTER (s & own = 0 AND s & b = 0) AS kept, count(*) FILTER (s & own <> 0 AND s & b = 0) AS removed, count(*) FILTER (s & own <> 0 AND s & b <> 0) AS redundant,
    count(*) FILTER (s = own) AS unique_fails, count(*) FILTER (s & own <> 0 AND s & b = 0 AND good = 1) AS good_lost, count(*) FILTER (s & own <> 0 AND s & b = 0 AND toxic = 1) AS toxic_lost
  FROM f, (SELECT *, coalesce(before, 0)::INT AS b FROM s) GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM r
"""

OP13_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * common >= 85 * (x.n + y.n - common)
), reach AS (
  SELECT u, v FROM l UNION SELECT reach.u, l.v FROM reach JOIN l ON reach.v = l.u
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(least(doc_id, c), doc_id) AS component_id FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT u AS doc_id, min(v) AS c FROM reach GROUP BY u) USING (doc_id)
"""

#: the others hash with functions, or split and merge by rules, that SQL does not have
SQL: dict[str, str] = {"op9_warc": OP9_SQL, "op11_fim": OP11_SQL, "op12_filter_audit": OP12_SQL, "op13_ngram_join": OP13_SQL}
