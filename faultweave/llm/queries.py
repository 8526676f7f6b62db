"""The registered queries of this package and the SQL that some of them are checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

import corpus_pipeline
from faultweave.llm import (
    decontamination, line_dedup, line_quality, lm_score, merkle, mixing, near_dedup, packing, pii, prefix_trie,
    sql_trees, token_counts, token_store, toxicity,
)
from faultweave.llm.common import BYTE_BPE, WORD_BPE, fold_of, table, vocabulary
from faultweave.sources.workspace import new_path

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def op1_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    found = near_dedup.near_duplicates(documents(spark, sf), k=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.remove(documents(spark, sf)).select("doc_id", "n_lines", "n_removed", "text")


def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf), vocabulary(BYTE_BPE))


def op4_lm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return lm_score.lm_scores(documents(spark, sf))


def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf, "labels")))


def op6_line_quality(spark: SparkSession, sf: str) -> DataFrame:
    return line_quality.quality(documents(spark, sf))


def op7_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.taken(documents(spark, sf))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    return pii.find(docs, pii.train(docs))


def op9_token_store(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "token-store")
    token_store.write_store(documents(spark, sf), vocabulary(WORD_BPE), path)
    return token_store.read_documents(spark, path)


def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.contamination(documents(spark, sf), table(spark, sf, "benchmark"))


def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the documents are received without their line ends and checked against the manifest."""
    received = F.when(fold_of("doc_id", 2) == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    listed = merkle.manifest(documents(spark, sf), {"received": merkle.leaf_hash(received)})
    checked = merkle.verified(listed, "received")
    return checked.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root", "verified",
    )


def op12_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations that borrow their openings from every twentieth one."""
    ordered = prefix_trie.turns_in_order(table(spark, sf, "conversations"))
    return prefix_trie.trie(prefix_trie.shared_openings(ordered)).drop("key")


def op13_packing(spark: SparkSession, sf: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf), vocabulary(WORD_BPE))
    return packing.with_crc(packed).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"
    )


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Query] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_line_dedup": op2_line_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_lm_scores": op4_lm_scores,
    "op5_toxicity": op5_toxicity,
    "op6_line_quality": op6_line_quality,
    "op7_source_mix": op7_source_mix,
    "op8_personal_data": op8_personal_data,
    "op9_token_store": op9_token_store,
    "op10_decontamination": op10_decontamination,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_packing": op13_packing,
    "pipeline": pipeline,
}

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

SQL: dict[str, str] = {}

LOWER_WORDS = WORDS.replace(
    "coalesce(text, '')",
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')",
)

SQL["op1_near_duplicates"] = rf"""
WITH RECURSIVE docs AS MATERIALIZED (
    SELECT doc_id, {LOWER_WORDS} AS ws FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) < 2 THEN ws
        ELSE list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) END) AS s
    FROM docs
), sizes AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
    FROM shingles AS x JOIN shingles AS y USING (s) WHERE x.doc_id < y.doc_id GROUP BY ALL
), links AS MATERIALIZED (
    SELECT a, b FROM common JOIN sizes AS x ON x.doc_id = a JOIN sizes AS y ON y.doc_id = b
    WHERE 100 * c >= 80 * (x.n + y.n - c)
), both_ways AS MATERIALIZED (
    SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM docs
    UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(reach.b) AS component_id, doc_id = min(reach.b) AS kept
FROM docs LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.a = doc_id GROUP BY doc_id, n
"""

SQL["op2_line_dedup"] = rf"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents
), lines AS MATERIALIZED (
    SELECT r, doc_id, source, i, line, nullif(trim(regexp_replace(
        translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+', ' ', 'g')), '') AS norm
    FROM (SELECT r, doc_id, source, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs)
), boilerplate AS (
    SELECT norm FROM lines WHERE norm IS NOT NULL
    GROUP BY norm HAVING count(DISTINCT source) >= {line_dedup.MIN_SITES}
), marked AS (
    SELECT *, norm IS NOT NULL AND norm IN (SELECT norm FROM boilerplate) AS cut FROM lines
)
SELECT any_value(doc_id) AS doc_id, count(norm)::BIGINT AS n_lines, count(*) FILTER (cut)::BIGINT AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT cut), '') AS text
FROM marked GROUP BY r
"""

SQL["op6_line_quality"] = rf"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text, {WORDS} AS words FROM documents
), windows AS (
    SELECT r, i, words[i:i + 2] AS w FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM docs)
), twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
), repeats AS (
    SELECT r, count(DISTINCT i + k) AS n FROM twice, range(3) AS t(k) GROUP BY r
), spoken AS (
    SELECT r, line FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), dups AS (
    SELECT r, count(*) - count(DISTINCT line) AS n FROM spoken GROUP BY r
), lines AS (
    SELECT r, doc_id, source, line, sum(n) AS n FROM (
        SELECT r, doc_id, source, array_to_string(ws, ' ') AS line, len(ws) AS n FROM (
            SELECT r, doc_id, source, list_filter(regexp_split_to_array(
                translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws
            FROM spoken JOIN docs USING (r))
    ) GROUP BY ALL
), frequent AS (
    SELECT source, line FROM lines GROUP BY ALL
    HAVING count(DISTINCT coalesce(doc_id::VARCHAR, 'row ' || r)) > {line_quality.MAX_DOCS}
), removed AS (
    SELECT r, sum(n) AS n FROM lines AS l WHERE EXISTS (
        SELECT 1 FROM frequent AS f WHERE f.line = l.line AND f.source IS NOT DISTINCT FROM l.source) GROUP BY r
), figures AS (
    SELECT doc_id, len(words) AS n_words,
        length(array_to_string(words, '')) AS word_chars,
        length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(dups.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
        coalesce(removed.n, 0) AS n_removed_words
    FROM docs LEFT JOIN repeats USING (r) LEFT JOIN dups USING (r) LEFT JOIN removed USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    n_removed_words::BIGINT AS n_removed_words,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
        AND (n_words - n_removed_words) * 100 >= n_words * {line_quality.KEEP_PERCENT} AS kept
FROM figures
"""

SQL["op7_source_mix"] = rf"""
WITH docs AS MATERIALIZED (
    SELECT doc_id, source, len({WORDS}) AS size FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS s FROM docs GROUP BY source
), ranked AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank, sum(s) OVER () AS total FROM totals
), weighted AS (
    SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM ranked
), levels AS (
    SELECT *, sum(s) OVER f AS full_s, sum(weight) OVER f AS full_w, sum(weight) OVER () AS all_w
    FROM weighted WINDOW f AS (ORDER BY s / weight, rank)
), marked AS (
    SELECT *, (total * 150 - full_s * 200) * weight >= s * 200 * (all_w - full_w) AS is_full FROM levels
), level AS (
    SELECT coalesce(max(full_s) FILTER (is_full), 0) AS full_s, coalesce(max(full_w) FILTER (is_full), 0) AS full_w
    FROM marked
), targets AS (
    SELECT m.source, m.s, CASE WHEN is_full THEN (s * 2)::DOUBLE
        ELSE (weight * (total * 150 - l.full_s * 200))::DOUBLE / ((all_w - l.full_w) * 100)::DOUBLE END AS target
    FROM marked AS m, level AS l
), placed AS (
    SELECT doc_id, size, s AS source_size, target, floor(target + 0.5)::BIGINT AS words,
        (sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size
            ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
    FROM docs AS d JOIN targets AS t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
    CASE WHEN source_size = 0 THEN 0 ELSE
        (words // source_size) * size + greatest(0, least(start + size, words % source_size) - start)
    END::BIGINT AS taken
FROM placed
"""

SQL["op11_merkle_manifest"] = sql_trees.MERKLE
SQL["op12_prefix_trie"] = sql_trees.PREFIX_TRIE


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
