"""The registered queries of the operators, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.tables import load
from . import (classifier, fim, licenses, lm, packing, phrases, pieces, rules, secrets, sharding, simhash, token_counts,
               topk)


def op1_quality_rules(spark, sf_dir):
    return rules.audited(load(spark, sf_dir, "documents"))


def op2_simhash(spark, sf_dir):
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def op3_sentencepiece(spark, sf_dir):
    return pieces.summary(load(spark, sf_dir, "documents"), with_ids=True)


def op4_sharding(spark, sf_dir):
    return sharding.assign(load(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_lm_scoring(spark, sf_dir):
    return lm.score(load(spark, sf_dir, "documents"))


def op6_packing(spark, sf_dir):
    return packing.pack(load(spark, sf_dir, "documents"))


def op7_license_scan(spark, sf_dir):
    return licenses.scan_licenses(load(spark, sf_dir, "documents"))


def op8_quality_classifier(spark, sf_dir):
    return classifier.classified(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op9_secret_scan(spark, sf_dir):
    return secrets.scan_secrets(load(spark, sf_dir, "documents"))


def op10_exact_topk(spark, sf_dir):
    vectors = topk.integer_vectors(load(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.filter("vec_id % 20 = 0"))


def op11_phrase_mining(spark, sf_dir):
    return phrases.collocations(load(spark, sf_dir, "documents"))


def op12_token_counts(spark, sf_dir):
    return token_counts.count_tokens(load(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark, sf_dir):
    made = fim.fill_in_middle(load(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2(F.encode("output", "utf-8"), 256).alias("output_sha256"),
        F.sha2(F.encode(fim.restored(F.col("output"), F.col("form")), "utf-8"), 256).alias("restored_sha256"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_simhash, op3_sentencepiece, op4_sharding, op5_lm_scoring, op6_packing,
                                   op7_license_scan, op8_quality_classifier, op9_secret_scan, op10_exact_topk, op11_phrase_mining,
                                   op12_token_counts, op13_fill_in_middle)}
ORACLE: dict[str, str] = {
    "op1_quality_rules": r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
base AS (
    SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM texts),
windows AS (
    SELECT r, i, array_to_string(w[i:i + 7], ' ') AS words
    FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM base WHERE len(w) >= 8)),
again AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, words) > 1),
covered AS (
    SELECT r, count(DISTINCT i + j) AS n FROM again, range(0, 8) AS t(j) GROUP BY r),
features AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
           CAST(length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS BIGINT) AS n_upper,
           CAST(length(regexp_replace(text, '[^\p{L}]', '', 'g')) AS BIGINT) AS n_letters,
           CAST(len(lines) AS BIGINT) AS n_lines
    FROM base LEFT JOIN covered USING (r)),
judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM features)
SELECT *, NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > 3 * n_words
               OR 10 * n_dup_lines > 3 * n_lines OR 2 * n_upper > n_letters) AS kept
FROM judged""",
    "op10_exact_topk": """
WITH vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.r <> c.r
    WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20""",
    "op11_phrase_mining": r"""
WITH pieces AS (
    SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents)),
found AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, range(1, 4) AS t(k) WHERE len(w) >= k)),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS a FROM found GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, a FROM f WHERE k > 1 AND a >= 10),
halves AS MATERIALIZED (
    SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:k], ' ') AS y
    FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates)),
often AS MATERIALIZED (SELECT lang, phrase, a FROM f WHERE a >= 10),
cuts AS (
    SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, c.j,
           CAST((CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
    FROM halves c JOIN often x ON x.lang = c.lang AND x.phrase = c.x
    JOIN often y ON y.lang = c.lang AND y.phrase = c.y),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
longer AS (
    SELECT lang, phrase, max(a) AS a
    FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
          FROM candidates WHERE k = 3)
    GROUP BY ALL),
ranked AS (
    SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY c.score DESC, c.a DESC, c.phrase) AS rank
    FROM lowest c LEFT JOIN longer g USING (lang, phrase)
    WHERE g.a IS NULL OR 100 * g.a < 50 * c.a)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
    "op13_fill_in_middle": r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
units AS (
    SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n,
           CAST('0x' || h[1:8] AS BIGINT) % (length(text) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (length(text) + 1) AS b,
           CAST('0x' || h[17:24] AS BIGINT) % 100 AS h3, CAST('0x' || h[25:32] AS BIGINT) % 100 AS h4
    FROM texts),
forms AS (
    SELECT *, least(a, b) AS x, greatest(a, b) AS y,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90
                THEN 'plain' WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM units)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN x END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN y - x END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || substr(text, 1, x) || '<S>' || substr(text, y + 1) || '<M>' || substr(text, x + 1, y - x)
                        ELSE '<S>' || substr(text, y + 1) || '<P>' || substr(text, 1, x) || '<M>' || substr(text, x + 1, y - x) END)
           AS output_sha256,
       sha256(text) AS restored_sha256
FROM forms""",
}
