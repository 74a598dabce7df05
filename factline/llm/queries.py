"""Queries over the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, exact, langid, lines, lm, mixing, negatives, quality, repair, simhash, suffix, tokens, windows
from .common import read_benchmark, read_documents


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(read_documents(spark, sf_dir))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(read_documents(spark, sf_dir))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(read_documents(spark, sf_dir))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(read_documents(spark, sf_dir), read_benchmark(spark, sf_dir)).drop("_row")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.suffix_dedup(read_documents(spark, sf_dir)).drop("spans")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_documents(spark, sf_dir)).drop("_row")


def op7_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("_row")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(read_documents(spark, sf_dir).select("doc_id", "text", "lang")).drop("text", "lang")


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(read_documents(spark, sf_dir))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op10_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.training_order(read_documents(spark, sf_dir), with_ids=False)


def op11_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.window_dedup(read_documents(spark, sf_dir)).drop("spans")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


OP1_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS squeezed FROM documents)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY squeezed ORDER BY length(text) DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY squeezed) AS group_size,
       row_number() OVER (PARTITION BY squeezed ORDER BY length(text) DESC, doc_id) = 1 AS kept,
       sha256(squeezed) AS text_sha256
FROM t
"""

OP2_SQL = r"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS ix FROM docs),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
hot AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.doc_id, k.ix, k.line, hot.keeper IS NOT NULL AND hot.keeper <> k.doc_id AS dropped FROM k LEFT JOIN hot USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY ix) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


OP11_SQL = r"""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
win AS (SELECT doc_id, ix, array_to_string(words[ix:ix + 12], ' ') AS gram FROM (SELECT *, unnest(range(1, len(words) - 11)) AS ix FROM t)),
least AS (SELECT gram, min(doc_id) AS first_id FROM win GROUP BY gram),
gone AS (SELECT DISTINCT doc_id, unnest(range(ix, ix + 13)) AS place FROM win JOIN least USING (gram) WHERE first_id < doc_id),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM t),
kept AS (SELECT w.doc_id, count(*) FILTER (WHERE gone.place IS NOT NULL) AS n_removed,
                string_agg(word, ' ' ORDER BY w.place) FILTER (WHERE gone.place IS NULL) AS rest
         FROM w LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.place = gone.place GROUP BY w.doc_id)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM t LEFT JOIN kept ON t.doc_id = kept.doc_id
"""

OP12_SQL = r"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), n)) AS steps),
rows0 AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, row_number() OVER () AS row_no,
                 list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS bytes
          FROM conversations),
picked AS (SELECT r.*, xor(list_reduce(bytes, lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) % 20 AS kind FROM rows0 r, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, row_no, copy,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM picked WHERE kind <> 0)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), sha256(CAST(length(role) AS VARCHAR) || ':' || role || text), row_no, copy) AS i,
                  regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS body FROM damaged),
faulty AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                          WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                  left(role, 1) AS initial, lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS following FROM placed),
inserts(was, now, more, letters, added) AS (VALUES ('', '', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
    ('', 'u', 5, 'I', chr(10) || 'user:'), ('s', 'u', 5, 'I', chr(10) || 'user:'), ('u', 'a', 5, 'I', chr(10) || 'assistant:'), ('a', 'u', 5, 'I', chr(10) || 'user:'),
    ('', 'a', 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), ('s', 'a', 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
moves(was, edit, initial, now, more, role) AS (VALUES ('', 'K', 's', 's', 0, NULL), ('', 'K', 'u', 'u', 0, NULL), ('s', 'K', 'u', 'u', 0, NULL), ('u', 'K', 'a', 'a', 0, NULL),
    ('a', 'K', 'u', 'u', 0, NULL), ('', 'R', NULL, 'u', 1, 'user'), ('s', 'R', NULL, 'u', 1, 'user'), ('u', 'R', NULL, 'a', 1, 'assistant'), ('a', 'R', NULL, 'u', 1, 'user'),
    ('', 'D', NULL, '', 2, NULL), ('s', 'D', NULL, 's', 2, NULL), ('u', 'D', NULL, 'u', 2, NULL), ('a', 'D', NULL, 'a', 2, NULL)),
way AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '' AS state, {'c': CAST(0 AS BIGINT), 'a': '', 'r': ''} AS best FROM conversations
  UNION ALL
  SELECT w.conv_id, w.i + 1, m.now, min({'c': CAST(w.best.c + n.more + m.more + CASE WHEN m.edit <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END AS BIGINT), 'a': w.best.a || n.letters || m.edit,
         'r': w.best.r || n.added || CASE WHEN m.edit = 'D' THEN '' ELSE chr(10) || coalesce(m.role, f.role) || ':' || f.text END})
  FROM way w JOIN inserts n ON n.was = w.state JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
       JOIN moves m ON m.was = n.now AND (m.initial IS NULL OR m.initial = f.initial) AND (m.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
  GROUP BY w.conv_id, w.i + 1, m.now),
counted AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
                   count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
                   count(*) FILTER (WHERE following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id),
ended AS (SELECT w.conv_id, min({'c': w.best.c + n.more, 'a': w.best.a || n.letters, 'r': w.best.r || n.added}) AS best
          FROM way w JOIN inserts n ON n.was = w.state LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
          WHERE n.now IN ('', 'a') AND w.i = coalesce(c.n, 0) GROUP BY w.conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(e.best.c AS BIGINT) AS cost, e.best.a AS audit, sha256(substr(e.best.r, 2)) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""

OP13_SQL = r"""
WITH v AS (SELECT row_number() OVER () AS row_no, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.row_no AS anchor, a.vec_id AS anchor_id, b.row_no, b.vec_id, a.label = b.label AS same,
             CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))) AS BIGINT) AS score
      FROM v a JOIN v b ON a.row_no <> b.row_no WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row_no) AS k FROM s WHERE same) WHERE k <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER (PARTITION BY p.anchor, p.row_no ORDER BY s.score DESC, s.vec_id, s.row_no) AS rank,
             s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
      FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1_SQL.strip(), "op2_line_dedup": OP2_SQL.strip(), "op11_window_dedup": OP11_SQL.strip(),
            "op12_conversation_repair": OP12_SQL.strip(), "op13_hard_negatives": OP13_SQL.strip()}
