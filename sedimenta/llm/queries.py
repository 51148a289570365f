"""The opN queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import chat, common, decontamination, lm_scoring, packing, quality, sharding, simhash, token_counts, token_files, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), radius=2, words=3)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), packing.Capacity(2048, 2048, 2048 * 2048), end_id=0)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), limit=8 * 2**20)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    back = chat.read_back(chat.chat(rows.unionByName(more), misfit="empty"))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("key").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.char_length(F.array_join("learnt", "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join("learnt", ""), 256).alias("loss_sha256"), F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.shared_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read_back(spark, path)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"), order=3, backoff=0.4, least=1).withColumns({"log_score": F.round("log_score", 4), "score": F.round("score", 6)})


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_token_counts, op2_simhash, op3_packing, op4_quality, op5_sharding, op6_chat, op7_urls, op8_token_files, op9_decontamination, op10_lm_scores, pipeline)
    return {f.__name__: f for f in own}


def _escaped(x: str) -> str:
    return rf"regexp_replace(regexp_replace(replace({x}, '\', '\\'), '<(\||/?s>|</?SYS>>)', '<\\\1', 'g'), '\[(/?INST\])', '[\\\1', 'g')"


_SHARDING = """
WITH d AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
l AS (SELECT doc_id, n_bytes, h, k AS depth, h >> CAST(60 - k AS INTEGER) AS q FROM d, range(0, 31) r(k)),
s AS (SELECT depth, q, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_docs FROM l GROUP BY ALL)
SELECT doc_id, n_bytes, substr(lpad(bin(h), 60, '0'), 1, CAST(depth AS INTEGER)) AS shard, depth, 0::BIGINT AS page, shard_bytes, shard_docs
FROM l JOIN s USING (depth, q) WHERE shard_bytes <= 8388608 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1
"""
_CHAT = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn, r, t) AS turns,
  coalesce(string_agg(t, '' ORDER BY turn, r, t) FILTER (r = 'assistant'), '') AS learnt, CAST(sum(24 + length({_escaped("r")}) + length({_escaped("t")})) AS BIGINT) AS formatted_chars FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(learnt) AS BIGINT) AS loss_chars, sha256(learnt) AS loss_sha256, formatted_chars FROM g
"""


def _hits(terms: tuple[str, ...]) -> str:
    return " + ".join(rf"CAST(regexp_matches(low, '(^|[^\p{{L}}\p{{N}}]){t}($|[^\p{{L}}\p{{N}}])') AS INTEGER)" for t in terms)


_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_URLS = rf"""
WITH u AS (SELECT page_id, {_LOW.format("coalesce(url, '')")} AS low, {_LOW.format("coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1), '')")} AS host, coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
k(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
f AS (SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict FROM u JOIN k ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT page_id, host, path, f.rule AS rule, coalesce(f.verdict, CASE WHEN {_hits(url_filter.STRICT)} > 0 OR {_hits(url_filter.SOFT)} >= 2 THEN 'block' ELSE 'allow' END) AS verdict FROM u LEFT JOIN f USING (page_id)
"""


_LM = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS k FROM d),
g AS (SELECT r, k, w[k] AS g1, CASE WHEN k > 1 THEN array_to_string(w[k - 1:k], ' ') END AS g2, CASE WHEN k > 2 THEN array_to_string(w[k - 2:k], ' ') END AS g3,
  CASE WHEN k > 1 THEN w[k - 1] END AS h1, CASE WHEN k > 2 THEN array_to_string(w[k - 2:k - 1], ' ') END AS h2 FROM p),
c1 AS (SELECT g1 AS g, count(*) AS n FROM g GROUP BY g1), c2 AS (SELECT g2 AS g, count(*) AS n FROM g GROUP BY g2), c3 AS (SELECT g3 AS g, count(*) AS n FROM g GROUP BY g3),
s AS (SELECT r, CASE WHEN k > 2 AND c3.n >= 1 THEN ln(c3.n / b2.n) WHEN k > 1 AND c2.n >= 1 THEN ln(c2.n / b1.n) + CASE WHEN k > 2 THEN ln(0.4) ELSE 0 END
  ELSE ln(c1.n / (SELECT sum(n) FROM c1)) + CASE WHEN k > 2 THEN 2 * ln(0.4) WHEN k > 1 THEN ln(0.4) ELSE 0 END END AS v
  FROM g JOIN c1 ON c1.g = g1 LEFT JOIN c2 ON c2.g = g2 LEFT JOIN c3 ON c3.g = g3 LEFT JOIN c1 b1 ON b1.g = h1 LEFT JOIN c2 b2 ON b2.g = h2),
t AS (SELECT r, sum(v) AS v FROM s GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(v, 0), 4) AS log_score, round(v / len(w), 6) AS score FROM d LEFT JOIN t USING (r)
"""


def oracle_sql() -> dict[str, str]:
    """For the queries that SQL can express; tokenizers, XXH64 and the forest can't be, and the others are tested against brute force."""
    return {"op5_sharding": _SHARDING, "op6_chat": _CHAT, "op7_urls": _URLS, "op10_lm_scores": _LM}
