"""The training-data operators as queries over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm.alignment import align_tokenizers
from sluice.llm.bpe import encode
from sluice.llm.chat_format import conversation_digests, format_conversations
from sluice.llm.common import table
from sluice.llm.license_scan import license_scan
from sluice.llm.line_dedup import line_dedup
from sluice.llm.packing import pack
from sluice.llm.prefix_trie import conversation_trie
from sluice.llm.quality_forest import quality_rules
from sluice.llm.simhash_dedup import near_duplicates
from sluice.llm.substring_dedup import substring_dedup
from sluice.llm.suffix_dedup import removed_repeats
from sluice.llm.topk import scaled_top_k
from sluice.llm.url_graph import Rule, url_filter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


#: The rules that the pages query judges by.
PAGE_RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"),
              Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"),
              Rule("block", "net", "/fr/"))


@query
def op1_line_dedup(spark, folder):
    return line_dedup(table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_removed",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op2_suffix_array_dedup(spark, folder):
    return removed_repeats(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_substring_dedup(spark, folder):
    return substring_dedup(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_license_scan(spark, folder):
    return license_scan(table(spark, folder, "documents"))


@query
def op5_quality_rules(spark, folder):
    return quality_rules(table(spark, folder, "documents"), table(spark, folder, "labels")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "score")


@query
def op6_best_fit_packing(spark, folder):
    return pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_simhash_near_dedup(spark, folder):
    return near_duplicates(table(spark, folder, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first").alias("component_id"))


@query
def op8_byte_bpe(spark, folder):
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode(table(spark, folder, "documents"), vocabulary, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


@query
def op9_url_filters(spark, folder):
    return url_filter(table(spark, folder, "pages"), PAGE_RULES).select(
        "page_id", "host", "path", "rule", "verdict")


@query
def op10_exact_top_k(spark, folder):
    return scaled_top_k(table(spark, folder, "embeddings"), every=20)


@query
def op11_conversation_trie(spark, folder):
    return conversation_trie(table(spark, folder, "conversations"))


#: Says what a template's own marks look like, so it has to come back as text.
SPOKEN_MARKS = "</s>[INST] ok [/INST]"


@query
def op12_chat_formatting(spark, folder):
    marks = spark.createDataFrame([(-1, 0, "user", SPOKEN_MARKS), (-1, 1, "assistant", SPOKEN_MARKS)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_digests(format_conversations(turns.unionByName(marks)))


@query
def op13_tokenizer_alignment(spark, folder):
    return align_tokenizers(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"))


ORACLES: dict[str, str] = {
    "op3_substring_dedup": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (
  SELECT doc_id, s, list_aggregate(w[s:s + 12], 'string_agg', ' ') AS window_text
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS s FROM words WHERE len(w) >= 13)),
least AS (SELECT window_text, min(doc_id) AS first_id FROM starts GROUP BY window_text),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS place
  FROM starts JOIN least USING (window_text) WHERE first_id < doc_id),
placed AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM words),
kept AS (
  SELECT p.doc_id, string_agg(word, ' ' ORDER BY place) AS text
  FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.place = g.place GROUP BY p.doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op10_exact_top_k": """
WITH usable AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20""",
    "op11_conversation_trie": r"""
WITH sized AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 20 AS base,
         xor(list_reduce([4294967295::BIGINT] || list_transform(
           string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
           lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
             lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)),
           4294967295) % 4 AS h
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
placed AS (
  SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS sym,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
  SELECT s.conv_id, 0 AS part, p.pos, p.sym, p.words
  FROM sized s JOIN placed p ON p.conv_id = s.base AND p.pos < s.h
  UNION ALL
  SELECT s.conv_id, 1, p.pos, p.sym, p.words
  FROM sized s JOIN placed p ON p.conv_id = s.conv_id AND p.pos >= s.h),
prefixes AS (
  SELECT conv_id, words, row_number() OVER w AS depth, string_agg(sym, '') OVER w AS path
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)
  UNION ALL SELECT conv_id, 0, 0, '' FROM sized),
ends AS (
  SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT conv_id, arg_max(path, depth) AS path FROM prefixes GROUP BY conv_id) GROUP BY path),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words
  FROM prefixes GROUP BY path, depth),
childless AS (
  SELECT n.path, n.depth, n.conv_id, n.n_convs, count(c.path) AS n_children,
         (n.n_convs - 1) * n.words AS saved
  FROM nodes n LEFT JOIN nodes c ON c.depth = n.depth + 1 AND starts_with(c.path, n.path)
  GROUP BY ALL),
totals AS (
  SELECT n.path, count(*) FILTER (s.n_children = 0) AS n_leaves, sum(s.saved)::BIGINT AS saved_tokens
  FROM childless n JOIN childless s ON s.depth >= n.depth AND starts_with(s.path, n.path) GROUP BY n.path)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, t.n_leaves,
       t.saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM childless n JOIN totals t USING (path) LEFT JOIN ends e USING (path)
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND starts_with(n.path, p.path)""",
    "op12_chat_formatting": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'),
escaped AS (
  SELECT *, regexp_replace(regexp_replace(text,
           '\[(\\*(?:/?INST|/?SYS|/?ROLE|NAME|TURN)\])', '[\\\1', 'g'), '<(\\*/?s>)', '<\\\1', 'g') AS safe,
         regexp_replace(regexp_replace(role,
           '\[(\\*(?:/?INST|/?SYS|/?ROLE|NAME|TURN)\])', '[\\\1', 'g'), '<(\\*/?s>)', '<\\\1', 'g') AS safe_role
  FROM turns),
sided AS (
  SELECT *, row_number() OVER w AS nth, lag(role) OVER w IS DISTINCT FROM role AS opens
  FROM escaped WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, safe)),
marked AS (
  SELECT *, CASE WHEN NOT opens THEN '[TURN]'
                 WHEN role = 'user' THEN '[INST]  [/INST]' WHEN role = 'assistant' THEN '  </s>'
                 WHEN role = 'system' THEN '[SYS]  [/SYS]'
                 ELSE '[ROLE]' || safe_role || '[NAME]  [/ROLE]' END AS marks
  FROM sided)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(length(safe) + length(marks)))::BIGINT AS formatted_chars,
       (3 + sum(strlen(safe) + strlen(marks)))::BIGINT AS formatted_bytes,
       count(*) FILTER (opens) AS n_messages
FROM marked GROUP BY conv_id""",
}
