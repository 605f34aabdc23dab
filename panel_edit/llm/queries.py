"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panel_edit.llm.common import read
from panel_edit.llm import (bpe, chat, collocations, decontaminate, exact_dedup, hard_negatives, html_text, quality, quality_rules, sharding, simhash,
                            toxicity, url_rules)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items it holds (see :mod:`decontaminate`)."""
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for its text (see :mod:`exact_dedup`)."""
    return exact_dedup.exact_groups(read(spark, sf_dir, "documents")).drop("raw_hash")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal size (see :mod:`sharding`)."""
    return sharding.shard_by_size(read(spark, sf_dir, "documents"), shards=16)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token digests of every document (see :mod:`bpe`)."""
    return bpe.token_digests(read(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (see :mod:`simhash`)."""
    groups = simhash.near_groups(read(spark, sf_dir, "documents"), shingle=3, budget=2)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page (see :mod:`html_text`)."""
    return html_text.extract(read(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document (see :mod:`toxicity`)."""
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


#: A conversation whose texts hold control strings, beside those of the table.
CONTROL_TEXT = "\\### Assistant: </turn> ok"


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their format (see :mod:`chat`)."""
    own = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.text_messages(rows.unionByName(own)))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document (see :mod:`quality`)."""
    return quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url (see :mod:`url_rules`)."""
    return url_rules.judge(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of each language (see :mod:`collocations`)."""
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document (see :mod:`quality_rules`)."""
    return quality_rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row against all rows (see :mod:`hard_negatives`)."""
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_sharding": op3_sharding,
    "op4_bpe": op4_bpe,
    "op5_simhash": op5_simhash,
    "op6_html_text": op6_html_text,
    "op7_toxicity": op7_toxicity,
    "op8_chat_format": op8_chat_format,
    "op9_quality": op9_quality,
    "op10_url_rules": op10_url_rules,
    "op11_collocations": op11_collocations,
    "op12_quality_rules": op12_quality_rules,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLE: dict[str, str] = {
    "op2_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS kept,
               sha256(norm) AS text_sha256
        FROM n""",
    "op8_chat_format": r"""
        WITH r AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
        e AS (
            SELECT *, replace(replace(replace(role, '\', '\0'), '<', '\1'), '>', '\2') AS erole, replace(replace(text, '\', '\0'), '<', '\1') AS etext
            FROM r)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length('<turn ' || erole || '>') + 1 + length(etext) + length('</turn>') + 1) AS BIGINT) AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op11_collocations": r"""
        WITH pieces AS (
            SELECT row_number() OVER () AS piece, lang, words FROM (
                SELECT coalesce(lang, 'und') AS lang,
                       list_filter(regexp_split_to_array(unnest(regexp_split_to_array(
                           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')),
                           '[\x20\x09]+'), lambda w: w <> '') AS words
                FROM documents)
            WHERE len(words) > 0),
        k AS (SELECT unnest([1, 2, 3, 4]) AS k),
        grams AS (
            SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(list_slice(words, i, i + k - 1), ' '))) AS phrase
            FROM pieces, k WHERE len(words) >= k),
        f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
        n AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM pieces GROUP BY lang),
        c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
        cuts AS (
            SELECT lang, phrase, a, cut, array_to_string(list_slice(w, 1, cut), ' ') AS left_part, array_to_string(list_slice(w, cut + 1, k), ' ') AS right_part
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
        scored AS (
            SELECT u.lang, u.phrase, u.a, x.f AS l, y.f AS r, CAST((CAST(2000000 AS HUGEINT) * u.a) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score,
                   row_number() OVER (PARTITION BY u.lang, u.phrase ORDER BY (CAST(2000000 AS HUGEINT) * u.a) // (CAST(x.f AS HUGEINT) + y.f), u.cut) AS pick
            FROM cuts u JOIN f x ON x.lang = u.lang AND x.phrase = u.left_part JOIN f y ON y.lang = u.lang AND y.phrase = u.right_part),
        inner_phrases AS (
            SELECT lang, a AS longer, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS phrase
            FROM (SELECT *, unnest(range(1, k - size + 2)) AS pos FROM (SELECT *, unnest(range(2, k)) AS size FROM c WHERE k > 2))),
        m AS (SELECT lang, phrase, max(longer) AS longer FROM inner_phrases GROUP BY ALL),
        ranked AS (
            SELECT s.lang, s.phrase, s.a, s.l, s.r, s.score,
                   row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, encode(s.phrase)) AS rank
            FROM scored s LEFT JOIN m ON m.lang = s.lang AND m.phrase = s.phrase
            WHERE s.pick = 1 AND (m.longer IS NULL OR CAST(100 AS HUGEINT) * m.longer < CAST(80 AS HUGEINT) * s.a))
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
    "op13_hard_negatives": r"""
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM e a JOIN e b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
        p AS (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS pick FROM s WHERE same),
        n AS (
            SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                   CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
            FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
            WHERE p.pick <= 5)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
}
