"""The registered queries of this package, and what they return in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import (
    chat,
    exact_dedup,
    hard_negatives,
    language_id,
    mixing,
    packing,
    passages,
    periodic,
    quality,
    secrets,
    simhash,
    token_matrices,
    topk_search,
)
from cohortlens.llm.common import documents
from cohortlens.llm.vectors import embeddings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


SQL["op2_exact_dedup"] = r"""
WITH d AS (
    SELECT doc_id, length(coalesce(text, '')) AS points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER ranked AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER ranked = 1 AS kept,
       text_sha256
FROM d
WINDOW ranked AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST)
"""


@query
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op4_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(documents(spark, sf_dir))


SQL["op4_host_quality"] = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
    SELECT doc_id, source,
           regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS bare,
           list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM t
),
windows AS (
    SELECT doc_id, i, words[i:i+2] AS three
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)
),
repeated AS (
    SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, three) > 1
),
covered AS (
    SELECT doc_id, sum(least(coalesce(following - i, 3), 3)) AS n_repeat_words
    FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following FROM repeated)
    GROUP BY doc_id
),
m AS (
    SELECT w.doc_id, source, len(words) AS n_words, length(bare) AS word_chars,
           length(regexp_replace(bare, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN covered USING (doc_id)
),
f AS (
    SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repetitive,
           100 * n_symbols > 10 * n_words AS symbols
    FROM m
),
hosts AS (
    SELECT source, rule, count(*) AS docs, count(*) FILTER (failed) AS failed
    FROM (UNPIVOT f ON short, repetitive, symbols INTO NAME rule VALUE failed)
    GROUP BY source, rule
),
sums AS (
    SELECT rule, sum(failed) / sum(docs) AS mean, sum(failed::DOUBLE * failed / docs) AS spread, sum(docs) AS all_docs,
           count(*) - 1 AS by_chance, sum(docs) - count(*) - sum(docs::DOUBLE * docs) / sum(docs) + 1 AS beyond
    FROM hosts GROUP BY rule
),
prior AS (
    SELECT rule, mean,
           CASE WHEN beyond > 0 AND mean > 0 AND mean < 1
                THEN ((spread - all_docs * mean * mean) / (mean * (1 - mean)) - by_chance) / beyond ELSE 0 END AS correlation
    FROM sums
),
weighed AS (
    SELECT rule, mean,
           CASE WHEN correlation > 0 THEN least(greatest(1 / correlation - 1, 1), 1000) ELSE 1000 END AS weight
    FROM prior
),
rejected AS (
    SELECT DISTINCT source FROM hosts JOIN weighed USING (rule) WHERE (failed + mean * weight) / (docs + weight) > 0.5
)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repetitive AS base_failed,
       NOT (short OR repetitive) AND NOT EXISTS (SELECT 1 FROM rejected r WHERE r.source IS NOT DISTINCT FROM f.source) AS kept
FROM f
"""


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


SQL["op9_mixing"] = r"""
WITH sizes AS (
    SELECT doc_id, source, md5('0:' || coalesce(doc_id::VARCHAR, '')) AS key,
           len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size
    FROM documents
),
s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           (1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) AS weight
    FROM sizes GROUP BY source
),
levels AS (
    SELECT *, (sum(source_size) OVER ()
               - coalesce(sum(3 * source_size) OVER (fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(weight) OVER (fill ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM s WINDOW fill AS (ORDER BY 3 * source_size / weight, source NULLS LAST)
),
targets AS (
    SELECT source, source_size,
           least(max(level) FILTER (level * weight <= 3 * source_size) OVER () * weight, 3.0 * source_size) AS target
    FROM levels
),
placed AS (
    SELECT doc_id, size, source_size, target, least(floor(target + 0.5)::BIGINT, 3 * source_size) AS budget,
           coalesce(sum(size) OVER (PARTITION BY sizes.source ORDER BY key
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
       CASE WHEN source_size = 0 THEN 0
            ELSE budget // source_size * size + greatest(least(budget % source_size - before, size), 0) END::BIGINT AS taken
FROM placed
"""


@query
def op1_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_matrices.token_matrices(documents(spark, sf_dir))


@query
def op6_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir))


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir))

    def written(spans) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    base = F.filter("found", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in ("assign", "access", "hex")]
    return found.select(
        "doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("found")).alias("spans")
    )


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    def written(spans: str) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ","
        ).alias(spans)

    return passages.drop_repeated_passages(documents(spark, sf_dir)).select(
        "doc_id", "n_removed", "n_lines", written("removed"), written("kept"), "text"
    )


SQL["op5_line_dedup"] = r"""
WITH pieces AS (
    SELECT doc_id, text,
           string_split(replace(regexp_replace(text, '([.!?])([\x20\x09-\x0D])', '\1' || chr(1) || '\2', 'g'),
                                chr(10), chr(10) || chr(1)), chr(1)) AS parts
    FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
),
placed AS (
    SELECT doc_id, text, i, rtrim(part, chr(10)) AS piece,
           (sum(length(part)) OVER (PARTITION BY doc_id ORDER BY i) - length(part))::BIGINT AS start,
           count(*) FILTER (part LIKE '%' || chr(10)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS line
    FROM (SELECT doc_id, text, unnest(range(1, len(parts) + 1)) AS i, unnest(parts) AS part FROM pieces)
),
units AS (
    SELECT doc_id, text, line, start, start + length(piece) AS "end", row_number() OVER (PARTITION BY doc_id ORDER BY i) AS unit,
           list_filter(string_split_regex(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM placed WHERE regexp_matches(piece, '[^\x20\x09-\x0D]')
),
repeats AS (
    SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS run
    FROM (SELECT *, row_number() OVER (PARTITION BY words ORDER BY doc_id, unit) AS nth FROM units)
    WHERE nth > 1
),
sized AS (
    SELECT *, sum(len(words)) OVER (PARTITION BY doc_id, run) >= 25 AS gone FROM repeats
),
lines AS (
    SELECT doc_id, min(text) AS text, min(start) AS start, max("end") AS "end", min(unit) AS unit,
           flatten(list(words ORDER BY unit)) AS words
    FROM units GROUP BY doc_id, line
),
lines_again AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY words ORDER BY doc_id, unit) AS nth FROM lines) WHERE nth > 1
),
spans_gone AS (
    SELECT doc_id, min(text) AS text, min(start) AS start, max("end") AS "end", count(*) AS units, 0 AS lines
    FROM sized WHERE gone GROUP BY doc_id, run
    UNION ALL
    SELECT l.doc_id, l.text, l.start, l."end", 0, 1
    FROM lines_again l JOIN sized s ON l.doc_id = s.doc_id AND l.unit = s.unit WHERE NOT gone
),
removed AS (
    SELECT doc_id, sum(units)::BIGINT AS n_removed, sum(lines)::BIGINT AS n_lines, min(text) AS text,
           list({'start': start, 'end': "end"} ORDER BY start) AS removed
    FROM spans_gone GROUP BY doc_id
),
spans AS (
    SELECT doc_id, n_removed, n_lines, removed, text,
           list_filter(list_transform(range(1, len(removed) + 2), lambda i: {
               'start': CASE WHEN i = 1 THEN 0 ELSE removed[i - 1]['end'] END::BIGINT,
               'end': CASE WHEN i > len(removed) THEN length(text) ELSE removed[i]['start'] END::BIGINT
           }), lambda s: s['start'] < s['end']) AS kept
    FROM removed
)
SELECT d.doc_id, coalesce(n_removed, 0) AS n_removed, coalesce(n_lines, 0) AS n_lines,
       coalesce(array_to_string(list_transform(removed, lambda k: concat(k['start'], '-', k['end'])), ','), '') AS removed,
       CASE WHEN s.doc_id IS NOT NULL
            THEN coalesce(array_to_string(list_transform(kept, lambda k: concat(k['start'], '-', k['end'])), ','), '')
            WHEN length(coalesce(d.text, '')) = 0 THEN ''
            ELSE concat(0, '-', length(d.text)) END AS kept,
       CASE WHEN s.doc_id IS NULL THEN coalesce(d.text, '')
            ELSE coalesce(array_to_string(list_transform(kept, lambda k: substring(s.text, k['start'] + 1, k['end'] - k['start'])), ''), '')
       END AS text
FROM documents d LEFT JOIN spans s USING (doc_id)
"""


@query
def op7_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


SQL["op7_chat_snapshots"] = r"""
WITH turns AS (
    SELECT conv_id, turn, role, text, {'turn': turn, 'role': role, 'text': text} AS said,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n
    FROM conversations
),
prefixes AS (
    SELECT conv_id, n, md5(list(said) OVER (PARTITION BY conv_id ORDER BY n)::VARCHAR) AS prefix,
           max(n) OVER (PARTITION BY conv_id) AS turns
    FROM turns
),
stay AS (
    SELECT min(conv_id) AS conv_id, count(*) AS copies, turns
    FROM prefixes
    WHERE n = turns AND prefix NOT IN (SELECT prefix FROM prefixes WHERE n < turns)
    GROUP BY prefix, turns
)
SELECT conv_id, ((n - 1) // 256)::INT AS part, turns, copies,
       string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY n) AS text
FROM stay JOIN turns USING (conv_id)
GROUP BY ALL
"""


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language_id.identify(docs, language_id.learned(docs)).select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score"
    )


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("bigint")
    return hard_negatives.hard_negatives(
        embeddings(spark, sf_dir),
        F.col("vec_id") % 50 == 0,
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label),
    )


WHOLE_VECTORS = r"""
rows AS (
    SELECT *, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)
"""

SQL["op11_hard_negatives"] = f"""
WITH {WHOLE_VECTORS},
labelled AS (
    SELECT vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM rows WHERE label IS NOT NULL
),
pairs AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
    FROM labelled a JOIN labelled b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 50 = 0
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER best)::INT AS rank, vec_id AS negative_id, positive_score,
       score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 3
"""


@query
def op12_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_products(embeddings(spark, sf_dir), F.col("vec_id") % 50 == 0)


SQL["op12_top_products"] = f"""
WITH {WHOLE_VECTORS},
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM rows q JOIN rows c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER best)::INT AS rank, vec_id, score
FROM pairs
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(documents(spark, sf_dir), planted=True)
