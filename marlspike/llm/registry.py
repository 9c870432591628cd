"""The queries of the corpus operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlspike.llm import alignment, bpe, exact_dedup, filter_audit, language_id, media, mixing, passages, sharding, simhash, suffix_dedup, token_counts, toxicity, warc


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_documents(spark, sf_dir), report=passages.shared_passages)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_passage_words")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_documents(spark, sf_dir)).drop("text_sha256")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    out = warc.derivatives(warc.responses(pages))
    return out.withColumns({c: F.decode(c, "UTF-8") for c in ("metadata_record", "conversion_record")})


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.bpe_encode(_documents(spark, sf_dir), path, want=("n_tokens", "ids_sha256", "decoded_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_documents(spark, sf_dir)).drop("_k1", "_k2")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(_documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(_documents(spark, sf_dir))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.scored_alignment(_documents(spark, sf_dir), *paths)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return language_id.identify(docs, language_id.train(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_sharding, op3_warc, op4_mixing, op5_bpe, op6_exact_dedup, op7_toxicity, op8_token_counts, op9_simhash,
        op10_media_columns, op11_alignment, op12_filter_audit, op13_language_id,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op6_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
            FROM documents
        )
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
               doc_id = first_value(doc_id) OVER w AS kept, h AS text_sha256
        FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
    """,
    "op12_filter_audit": r"""
        WITH RECURSIVE p AS (
            SELECT '' AS o UNION ALL SELECT o || l FROM p, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(l) WHERE instr(o, l) = 0
        ),
        steps AS (SELECT o AS filter_order, CAST(k AS INTEGER) AS step, o[k:k] AS letter, o[1:k - 1] AS earlier FROM p, range(1, 6) r(k) WHERE length(o) = 5),
        t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x FROM documents),
        w AS (SELECT *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS words, doc_id > min(doc_id) OVER (PARTITION BY x) AS again FROM t),
        f AS (
            SELECT doc_id, part, CASE WHEN len(words) < 50 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
                || CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 5 * length(x) THEN 'C' ELSE '' END
                || CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN again THEN 'E' ELSE '' END AS fails
            FROM w
        ),
        m AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        c AS (
            SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f LEFT JOIN m USING (doc_id) GROUP BY ALL
        ),
        x AS (SELECT *, instr(fails, letter) > 0 AS hit, length(translate(fails, earlier, '')) < length(fails) AS gone FROM c, steps),
        y AS (
            SELECT part, filter_order, step, letter, coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0) AS kept, coalesce(sum(n) FILTER (hit AND NOT gone), 0) AS removed,
                   coalesce(sum(n) FILTER (hit AND gone), 0) AS redundant, coalesce(sum(n) FILTER (fails = letter), 0) AS unique_fails,
                   coalesce(sum(good) FILTER (hit AND NOT gone), 0) AS good_lost, coalesce(sum(toxic) FILTER (hit AND NOT gone), 0) AS toxic_lost
            FROM x GROUP BY ALL
        )
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
               CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
        FROM y
    """,
}
