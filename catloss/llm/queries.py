"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catloss.llm import (
    bpe_codec, chat_format, embeddings, language_crf, lexical, licenses, line_dedup, mixing, ngram_lm, quality_rules, resampling, simhash, token_counts,
)
from catloss.llm.common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.col("matches.license")))
    best = F.array_max(F.col("matches.containment"))
    return found.select("doc_id", F.size(names).cast("long").alias("n_licenses"), F.array_join(names, ",").alias("licenses"), best.alias("containment"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.encode_documents(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_rules.score_documents(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", *[f"_m.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 10 == 0
    scored = ngram_lm.score_texts(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.queue(table(spark, sf_dir, "documents"), ["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = lambda d: F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_crf.fit(docs.where(~held_out(docs)).select("text", "lang"))
    return language_crf.predict(docs, model).withColumn("held_out", held_out(docs)).select("doc_id", "held_out", "lang_pred", "score")


#: A conversation whose texts hold the control strings of chat templates.
CONTROL = r"\### Assistant: </turn> ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string"))
    return chat_format.read_back(chat_format.format_turns(chat_format.table_turns(rows))).withColumnRenamed("key", "conv_id")


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = resampling.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_lm_scoring, op2_mixing, op3_token_counts, op4_licenses, op5_bpe_codec, op6_line_dedup, op7_embedding_dedup, op8_quality_rules, op9_simhash,
        op10_language, op11_chat_format, op12_resampling, op13_lexical_search,
    )
}
#: Characters that the chat template escapes with one more.
_ESCAPES = r"length(regexp_replace({0}, '[^\\<>]', '', 'g'))"
ORACLE_SQL: dict[str, str] = {
    "op11_chat_format": f"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, turn, role, '{CONTROL}' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role))
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(length('<turn >' || chr(10) || '</turn>' || chr(10)) + length(role) + length(text)
                + {_ESCAPES.format("role")} + {_ESCAPES.format("text")}) AS BIGINT) AS formatted_chars
        FROM rows GROUP BY conv_id
    """,
    "op13_lexical_search": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words, row_number() OVER () AS r FROM documents),
            q AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words, row_number() OVER () AS i FROM benchmark),
            counted AS (SELECT r, doc_id, CAST(len(words) AS BIGINT) AS n FROM d WHERE len(words) > 0),
            whole AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM counted),
            posting AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM d) GROUP BY r, term),
            weight AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
                FROM posting, whole GROUP BY term, n_docs),
            asked AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(words) AS term FROM q) GROUP BY ALL),
            scored AS (SELECT i, item_id, r, doc_id,
                    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
                FROM asked JOIN posting USING (term) JOIN weight USING (term) JOIN counted USING (r), whole GROUP BY i, item_id, r, doc_id),
            ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
}
