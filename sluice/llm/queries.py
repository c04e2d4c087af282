"""Registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe_counts, bpe_duckdb, collocations, license_scan, pareto_mix, parity_join, prefix_trie, repetition,
               reply_trees, rule_ensemble, secret_markov, warc_chunks, winnowing)
from .common import prepare, table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return rule_ensemble.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return license_scan.license_query(table(spark, sf_dir, "documents"))


def op3_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return parity_join.join_query(table(spark, sf_dir, "documents"))


def op4_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return repetition.quality_query(table(spark, sf_dir, "documents"))


def op5_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secret_markov.secret_query(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return winnowing.winnow_query(table(spark, sf_dir, "documents"))


def op8_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return warc_chunks.warc_query(table(spark, sf_dir, "pages"))


def op9_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pareto_mix.mix_query(table(spark, sf_dir, "documents"))


def op10_bpe_duckdb(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe_duckdb.bpe_query(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.tiktoken"))


def op11_trie_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return collocations.phrase_query(table(spark, sf_dir, "documents"))


def op12_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return reply_trees.chat_query(table(spark, sf_dir, "conversations"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return prefix_trie.trie_query(table(spark, sf_dir, "conversations"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_quality_rules, op2_license_scan, op3_parity_join, op4_repetition, op5_secret_markov,
                            op6_token_counts, op7_winnowing, op8_warc_chunks, op9_pareto_mix, op10_bpe_duckdb,
                            op11_trie_phrases, op12_reply_trees, op13_prefix_trie)}

#: The other operators' results cannot be stated in SQL; they are tested against brute force.
SQL: dict[str, str] = {
    "op8_warc_chunks": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha1(body) AS h FROM p
), b AS (
  SELECT page_id, payload_bytes, h,
    array_to_string(list_transform(range(8), lambda i:
      list_aggregate(list_transform(range(4), lambda j:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               ((('0x' || substr(h, (5 * i + 1)::INT, 5))::INT >> (15 - 5 * j)::INT) & 31)::INT + 1, 1)), 'string_agg', '')), '')
      AS payload_digest,
    min(page_id) OVER (PARTITION BY h) AS first
  FROM d
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to,
  CASE WHEN page_id <> first THEN 1 ELSE greatest(1, ceil(payload_bytes / 32768.0)) END::BIGINT AS n_chunks,
  true AS intact
FROM b
""",
    "op11_trie_phrases": """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM words
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words
), totals AS (
  SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang
), f AS (
  SELECT lang, k, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 10
), cuts AS (
  SELECT p.lang, p.k, p.phrase, p.a, p.w, c.cut, x.a AS l, y.a AS r,
    (1000000::HUGEINT * p.a * p.a) // (x.a::HUGEINT * y.a) AS score
  FROM f p JOIN (VALUES (1), (2)) c(cut) ON c.cut < p.k
  JOIN f x ON x.lang = p.lang AND x.phrase = array_to_string(p.w[1:c.cut], ' ')
  JOIN f y ON y.lang = p.lang AND y.phrase = array_to_string(p.w[c.cut + 1:], ' ')
  WHERE p.k >= 2
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), covers AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM f WHERE k = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM f WHERE k = 3) GROUP BY lang, phrase
), kept AS (
  SELECT b.* FROM best b LEFT JOIN covers c ON c.lang = b.lang AND c.phrase = b.phrase
  WHERE b.k = 3 OR c.a IS NULL OR 100 * c.a < 50 * b.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
    "op12_reply_trees": """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, replace(replace(role, '\\', '\\\\'), chr(10), '\\n') AS head,
    '[<\\[]\\\\*(s>|/s>|INST\\]|/INST\\]|<SYS>>|</SYS>>|\\|im_start\\|>|\\|im_end\\|>|\\|endoftext\\|>)' AS control
  FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(9 + length(head) + len(regexp_extract_all(head, control)) + length(text) + len(regexp_extract_all(text, control)))::BIGINT
    AS formatted_chars
FROM marked GROUP BY conv_id
""",
    "op13_prefix_trie": """
WITH own AS (
  SELECT conv_id, list({'k': sha256(coalesce(role, '') || chr(1) || coalesce(text, '')), 'b': strlen(coalesce(text, ''))}
    ORDER BY turn NULLS FIRST) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), shared AS (
  SELECT conv_id, t, conv_id - conv_id % 5 AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
      lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)),
        lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 9 AS h
  FROM own
), rebuilt AS (
  SELECT s.conv_id, list_concat(coalesce(b.t, [])[1:s.h], s.t[s.h + 1:]) AS t
  FROM shared s LEFT JOIN own b ON b.conv_id = s.base
), keyed AS (
  SELECT conv_id, len(t) AS n, t, list_transform(t, lambda x: x.k) AS k FROM rebuilt
), prefixes AS (
  SELECT conv_id, n, 0 AS depth, '' AS key, NULL AS up, 0 AS bytes FROM keyed
  UNION ALL
  SELECT conv_id, n, d, array_to_string(k[1:d], ''), array_to_string(k[1:d - 1], ''), t[d].b
  FROM (SELECT *, unnest(range(1, n + 1)) AS d FROM keyed)
), nodes AS (
  SELECT key, depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY key, depth
), children AS (
  SELECT up AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up
), every AS (
  SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.key = n.key
), inside AS (
  SELECT DISTINCT p.key AS top, q.key FROM prefixes p JOIN prefixes q ON q.conv_id = p.conv_id AND q.depth >= p.depth
), sums AS (
  SELECT i.top AS key, count(*) FILTER (e.n_children = 0) AS n_leaves, sum((e.n_convs - 1) * e.bytes) AS saved
  FROM inside i JOIN every e ON e.key = i.key GROUP BY i.top
)
SELECT e.conv_id, e.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, e.n_convs::BIGINT AS n_convs,
  e.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, e.ends_sha256
FROM every e JOIN sums s ON s.key = e.key LEFT JOIN every p ON e.depth > 0 AND p.key = e.up
""",
}
