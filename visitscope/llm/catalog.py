"""Registered queries of the operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import importlib.util
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conversation_repair, decontamination, edit_embedding, hard_negatives, html_text, personal_data, piece_encoding, preferences, sharding, simhash, substring_dedup, toxicity, warc
from .common import read_table

# Folder of the public vocabularies; a parameter of the engine, not part of it.
TOKENIZER_DIR = os.environ.get("VISITSCOPE_TOKENIZERS", "")


def tokenizer_path(name: str) -> str:
    if TOKENIZER_DIR:
        return os.path.join(TOKENIZER_DIR, name)
    spec = importlib.util.find_spec("public_tokenizers")
    if spec is None:
        raise RuntimeError("set VISITSCOPE_TOKENIZERS to the folder of the vocabulary files")
    return os.path.join(os.path.dirname(spec.origin), name)


PIECE_MODEL = "piece_bpe_32k.model"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by a model fitted on the labels that are not held out."""
    return toxicity.scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, with their likeness."""
    return edit_embedding.edit_report(read_table(spark, sf_dir, "documents"))


def op3_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece counts and hashes of the ids and the decoded text of every document."""
    return piece_encoding.encode_digest(read_table(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(read_table(spark, sf_dir, "pages"))


def op5_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every two neighbouring conversations as a preference pair; spans as text `begin-end,...`."""
    def spans(name: str):
        return F.array_join(F.transform(name, lambda s: F.concat_ws("-", s["begin"].cast("string"), s["end"].cast("string"))),
                            ",").alias(name)

    pairs = preferences.format_pairs(preferences.neighbour_pairs(read_table(spark, sf_dir, "conversations")))
    return pairs.select("pair_id", F.col("prefix_turns").cast("long").alias("prefix_turns"), "prompt", "chosen",
                        spans("chosen_spans"), "rejected", spans("rejected_spans"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot among 40 shards of nearly equal bytes."""
    placed = sharding.assign(read_table(spark, sf_dir, "documents"), shards=40)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back."""
    archives = warc.archive_pages(read_table(spark, sf_dir, "pages"))
    return warc.read_archives(archives, with_payload=False).drop("url")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that smaller ids hold in windows of 50, removed."""
    return substring_dedup.remove_digest(read_table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, links at up to 2 differing bits."""
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that contains 0.8 or more of the 5-word shingles of a benchmark item, with the item."""
    return decontamination.find_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First negatives of every anchor and positive within 30 to 90 percent of the positive's score."""
    rows = hard_negatives.quantised(read_table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved)).drop("anchor_row", "positive_rank")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base spans of fixed patterns and the field's spans."""
    return personal_data.report(read_table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and repaired text's hash of every conversation, after planted damage."""
    return conversation_repair.repair(conversation_repair.damage(read_table(spark, sf_dir, "conversations")))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_edit_fingerprints, op3_piece_encoding, op4_html_text, op5_preference_format, op6_sharding, op7_warc, op8_substring_dedup, op9_simhash, op10_decontamination,
                                   op11_hard_negatives, op12_personal_data, op13_conversation_repair)}

_OP5_SQL = """
WITH t AS (
  SELECT DISTINCT conv_id // 2 AS pair_id, conv_id % 2 = 0 AS is_chosen, coalesce(turn, 9223372036854775807) AS turn,
         coalesce(role, 'user') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (
  SELECT *, row_number() OVER (PARTITION BY pair_id, is_chosen ORDER BY turn, role, text) AS pos,
         '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS shown
  FROM t),
side AS (
  SELECT pair_id, count(*) FILTER (is_chosen) AS nc, count(*) FILTER (NOT is_chosen) AS nr FROM n GROUP BY pair_id),
diff AS (
  SELECT c.pair_id, min(c.pos) AS first_diff FROM n c JOIN n r ON c.pair_id = r.pair_id AND c.pos = r.pos
  WHERE c.is_chosen AND NOT r.is_chosen AND (c.role <> r.role OR c.text <> r.text) GROUP BY c.pair_id),
p AS (
  SELECT side.pair_id, nc, nr, coalesce(first_diff - 1, least(nc, nr)) AS prefix_turns
  FROM side LEFT JOIN diff ON side.pair_id = diff.pair_id),
m AS (
  SELECT n.*, p.prefix_turns, n.pos <= p.prefix_turns AS in_prompt,
         sum(CASE WHEN n.pos > p.prefix_turns THEN length(shown) ELSE 0 END)
           OVER (PARTITION BY n.pair_id, n.is_chosen ORDER BY n.pos) AS upto
  FROM n JOIN p ON n.pair_id = p.pair_id),
s AS (
  SELECT *, (upto - length(shown) + 13 + length(role))::BIGINT || '-' || upto::BIGINT AS span FROM m)
SELECT p.pair_id::BIGINT AS pair_id, p.prefix_turns::BIGINT AS prefix_turns,
  coalesce(string_agg(shown, '' ORDER BY pos) FILTER (is_chosen AND in_prompt), '') AS prompt,
  CASE WHEN any_value(nc) > 0 THEN coalesce(string_agg(shown, '' ORDER BY pos) FILTER (is_chosen AND NOT in_prompt), '') END AS chosen,
  CASE WHEN any_value(nc) > 0 THEN
    coalesce(string_agg(span, ',' ORDER BY pos) FILTER (is_chosen AND NOT in_prompt AND role = 'assistant'), '') END AS chosen_spans,
  CASE WHEN any_value(nr) > 0 THEN coalesce(string_agg(shown, '' ORDER BY pos) FILTER (NOT is_chosen AND NOT in_prompt), '') END AS rejected,
  CASE WHEN any_value(nr) > 0 THEN
    coalesce(string_agg(span, ',' ORDER BY pos) FILTER (NOT is_chosen AND NOT in_prompt AND role = 'assistant'), '') END AS rejected_spans
FROM p JOIN s ON p.pair_id = s.pair_id GROUP BY p.pair_id, p.prefix_turns
"""

_OP7_SQL = """
WITH h AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT hex, min(page_id) AS first FROM h GROUP BY hex),
b AS (
  SELECT hex, first, array_to_string(list_transform(string_split(hex, ''), lambda c:
           substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * strpos('0123456789abcdef', c) - 3, 4)), '') AS bits
  FROM f),
d AS (
  SELECT hex, first, array_to_string(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT
             + 4 * substr(bits, 5 * i + 3, 1)::INT + 2 * substr(bits, 5 * i + 4, 1)::INT + substr(bits, 5 * i + 5, 1)::INT, 1)), '') AS digest
  FROM b)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM h JOIN d ON h.hex = d.hex
"""

_OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.uid, a.vec_id AS anchor_id, a.label = o.label AS alike, o.uid AS other, o.vec_id, list_inner_product(a.e, o.e)::BIGINT AS score
  FROM v a JOIN v o ON a.uid <> o.uid WHERE a.vec_id % 100 = 0),
p AS (
  SELECT uid, anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id NULLS LAST, other) AS nth
  FROM s WHERE alike QUALIFY nth <= 5)
SELECT p.anchor_id, p.positive_id, row_number() OVER (PARTITION BY p.uid, p.nth ORDER BY s.score DESC, s.vec_id NULLS LAST, s.other)::INT AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.uid = p.uid AND NOT s.alike AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""

_OP10_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') AS ws FROM benchmark),
i AS (
  SELECT DISTINCT item_id, least(len(ws), 5) AS n, unnest(list_transform(range(1, len(ws) - least(len(ws), 5) + 2),
           lambda p: array_to_string(ws[p:p + least(len(ws), 5) - 1], ' '))) AS shingle
  FROM b WHERE len(ws) > 0),
d AS (
  SELECT DISTINCT doc_id, n, unnest(list_transform(range(1, len(ws) - n + 2), lambda p: array_to_string(ws[p:p + n - 1], ' '))) AS shingle
  FROM w, (SELECT DISTINCT n FROM i) WHERE len(ws) >= n),
q AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id)
SELECT doc_id, q.item_id, count(*)::BIGINT AS n_shared, any_value(n_shingles)::BIGINT AS n_shingles,
  count(*)::DOUBLE / any_value(n_shingles) AS containment
FROM d JOIN i ON d.shingle = i.shingle AND d.n = i.n JOIN q ON q.item_id = i.item_id
GROUP BY doc_id, q.item_id HAVING count(*) >= 0.8 * any_value(n_shingles)
"""

_OP13_SQL = r"""
WITH RECURSIVE
c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations),
crc AS (  -- CRC-32, a bit at a time
  SELECT *, xor(list_reduce(
           list_concat([4294967295::BIGINT], list_transform(string_split(name, ''), lambda h: ord(h)::BIGINT)),
           lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)),
             lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 20 AS fault
  FROM c),
d AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM crc WHERE fault <> 0),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
         left(role, 1) AS initial
  FROM d),
r AS (
  SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE 'none' END AS fault
  FROM n),
-- States: 0 nothing yet, 1 after s, 2 after u, 3 after a. Up to two made-up turns lead from one to another.
made(st, mid, k, lines) AS (VALUES
  (0, 0, 0, NULL), (0, 2, 1, 'user:'), (0, 3, 2, 'user:' || chr(10) || 'assistant:'),
  (1, 1, 0, NULL), (1, 2, 1, 'user:'), (1, 3, 2, 'user:' || chr(10) || 'assistant:'),
  (2, 2, 0, NULL), (2, 3, 1, 'assistant:'), (2, 2, 2, 'assistant:' || chr(10) || 'user:'),
  (3, 3, 0, NULL), (3, 2, 1, 'user:'), (3, 3, 2, 'user:' || chr(10) || 'assistant:')),
fits(mid, initial, after) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
w(conv_id, i, st, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': '', 'lines': ''} FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, st, min({'cost': cost, 'audit': audit, 'lines': lines})
  FROM (
    SELECT w.conv_id, r.i, CASE e.edit WHEN 'D' THEN m.mid WHEN 'K' THEN f.after WHEN 'R' THEN CASE WHEN m.mid = 2 THEN 3 ELSE 2 END END AS st,
           w.best.cost + 2 * m.k + CASE e.edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
             + CASE WHEN e.edit <> 'D' AND r.fault = 'truncated' THEN 1 ELSE 0 END AS cost,
           w.best.audit || repeat('I', m.k) || e.edit AS audit,
           concat_ws(chr(10), nullif(w.best.lines, ''), m.lines, CASE e.edit WHEN 'K' THEN r.role || ':' || r.text
             WHEN 'R' THEN CASE WHEN m.mid = 2 THEN 'assistant:' ELSE 'user:' END || r.text END) AS lines
    FROM w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
      JOIN made m ON m.st = w.st
      JOIN (VALUES ('D'), ('K'), ('R')) e(edit) ON e.edit = 'D' OR r.fault NOT IN ('blank', 'duplicate')
      LEFT JOIN fits f ON f.mid = m.mid AND f.initial = r.initial
    WHERE e.edit <> 'K' OR f.after IS NOT NULL)
  GROUP BY conv_id, i, st),
q AS (
  SELECT conv_id, count(role) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT conv_id, role, turn, fault, pair FROM r
        UNION ALL SELECT DISTINCT conv_id, NULL, NULL, NULL, NULL FROM conversations)
  GROUP BY conv_id)
SELECT q.conv_id, gaps, blank, duplicate, truncated, illegal, best.cost AS cost, best.audit AS audit, sha256(best.lines) AS repaired_sha256
FROM q JOIN (
  SELECT w.conv_id, w.i, min({'cost': best.cost + 2 * m.k, 'audit': best.audit || repeat('I', m.k),
                              'lines': concat_ws(chr(10), nullif(best.lines, ''), m.lines)}) AS best
  FROM w JOIN made m ON m.st = w.st WHERE m.mid IN (0, 3) GROUP BY w.conv_id, w.i) x
ON x.conv_id IS NOT DISTINCT FROM q.conv_id AND x.i = q.n
"""

ORACLE = {"op13_conversation_repair": _OP13_SQL,
          "op10_decontamination": _OP10_SQL, "op11_hard_negatives": _OP11_SQL, "op5_preference_format": _OP5_SQL, "op7_warc": _OP7_SQL}
