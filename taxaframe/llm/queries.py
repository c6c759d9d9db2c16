"""Registered queries of the corpus operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxaframe.llm.common import id_crc32


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from taxaframe.llm.packing import pack_documents

    pieces = pack_documents(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=1, tiers=(2048, 1024, 512, 256))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens", "step_id")


def op2_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    from taxaframe.llm.license_scan import scan_licenses

    found = scan_licenses(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from taxaframe.llm.ann import nearest_neighbours

    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from taxaframe.llm.minhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from taxaframe.llm.lm import interpolated_scores

    return interpolated_scores(_table(spark, sf_dir, "documents"), train=id_crc32("doc_id") % 7 != 2)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from taxaframe.llm.toxicity import fit_toxicity, score_toxicity

    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels, train=id_crc32("id") % 4 != 2)
    return score_toxicity(docs, model).select(
        "doc_id", (id_crc32("doc_id") % 4 == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("offences").alias("n_offences")
    )


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from taxaframe.llm.html_extract import extract_pages, fit_extractor

    pages = _table(spark, sf_dir, "pages")
    return extract_pages(pages, fit_extractor(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from taxaframe.llm.decontam import match_benchmark

    return match_benchmark(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from taxaframe.llm.secrets import scan_documents

    docs = _table(spark, sf_dir, "documents")
    return scan_documents(docs, owner=F.col("source"), repository=F.concat_ws("/", "source", "lang"))


def op10_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    from taxaframe.llm.tokenbin import read_token_file, write_token_file

    blocks = write_token_file(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), end_id=2)
    return read_token_file(blocks).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from taxaframe.llm.filter_audit import audit_filters

    return audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_zone_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from taxaframe.llm.zone_kmeans import cluster_report, cluster_vectors

    return cluster_report(*cluster_vectors(_table(spark, sf_dir, "embeddings"), k=16, rounds=3))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from taxaframe.llm.chat import format_conversations, read_formatted
    from taxaframe.llm.common import stored

    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return read_formatted(stored(format_conversations(rows.unionByName(more)), "chat"))


QUERIES = {
    f.__name__: f
    for f in (op1_packing, op2_license, op3_ann, op4_near_duplicates, op5_language_model, op6_toxicity, op7_html, op8_decontamination, op9_secrets, op10_token_file, op11_filter_audit, op12_zone_clusters, op13_chat_format)
}


#: op11: flags of every text, a window for E, and every order and step over the mask counts.
_AUDIT = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
masks AS (
  SELECT doc_id, part,
         (CASE WHEN len(w) < 100 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS mask FROM words),
marked AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM masks LEFT JOIN marked USING (doc_id) GROUP BY part, mask),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(c, bit)),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a JOIN letters b ON b.bit <> a.bit JOIN letters c ON c.bit NOT IN (a.bit, b.bit)
  JOIN letters d ON d.bit NOT IN (a.bit, b.bit, c.bit) JOIN letters e ON e.bit NOT IN (a.bit, b.bit, c.bit, d.bit)),
steps AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, bits[s] AS bit, CAST(coalesce(list_sum(bits[1:s - 1]), 0) AS INTEGER) AS before
  FROM orders, range(1, 6) AS g(s)),
figures AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (before + bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM figures
"""


def _clusters_sql(k: int = 16, rounds: int = 3, size: int = 64) -> str:
    """op12: the vectors in long form, compared with every centroid in every round."""
    ctes = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""x AS MATERIALIZED (
  SELECT r, i, CAST(floor(64 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS v FROM kept, range(1, {size + 1}) AS g(i))""",
        f"""c0 AS MATERIALIZED (
  SELECT s.c, x.i, x.v FROM (SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, r) - 1 AS c FROM kept) s JOIN x USING (r) WHERE s.c < {k})""",
    ]
    for n in range(rounds + 1):
        ctes.append(f"""a{n} AS MATERIALIZED (
  SELECT r, c, d FROM (SELECT r, c, d, row_number() OVER (PARTITION BY r ORDER BY d, c) AS place
    FROM (SELECT x.r, c.c, CAST(sum((x.v - c.v) * (x.v - c.v)) AS BIGINT) AS d FROM x JOIN c{n} c ON c.i = x.i GROUP BY x.r, c.c)) WHERE place = 1)""")
        if n < rounds:
            ctes.append(f"""c{n + 1} AS MATERIALIZED (
  SELECT c.c, c.i, coalesce(m.v, c.v) AS v FROM c{n} c
  LEFT JOIN (SELECT a.c, x.i, CAST((sum(x.v) - (sum(x.v) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS v FROM a{n} a JOIN x USING (r) GROUP BY a.c, x.i) m ON m.c = c.c AND m.i = c.i)""")
    ctes.append(f"digests AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS h FROM c{rounds} GROUP BY c)")
    return f"""WITH {", ".join(ctes)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
FROM a{rounds} a JOIN kept USING (r) JOIN digests g ON g.c = a.c"""


#: op13: digests from the rows, which reading the output back must give; the formatted length from the
#: lengths of markers and texts, with a character more for every backslash and every control string.
_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')) AS v(a, b, c, d)),
sized AS (
  SELECT *, length(t) + length(regexp_replace(t, '[^\\]', '', 'g')) + len(regexp_extract_all(t, '\[/?INST\]|<</?SYS>>|</?s>|<\|role\|>|<\|text\|>|<\|end\|>')) AS n,
         CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 WHEN 'system' THEN 17 ELSE 23 + length(role) END AS marks FROM turns)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(t) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n + marks) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

ORACLES: dict[str, str] = {"op11_filter_audit": _AUDIT, "op12_zone_clusters": _clusters_sql(), "op13_chat_format": _CHAT}
