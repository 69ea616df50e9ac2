"""The queries of this subpackage, over whole tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    decontaminate,
    fingerprints,
    jaccard_join,
    lexical_search,
    lm,
    prefix_trie,
    quality,
    quotes,
    substring_dedup,
    suffix_dedup,
    toxicity,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# Parts of queries that SQL can say when it cannot say the whole.
VIEWS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
VIEW_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


@query()
def op3_substring_dedup(spark, sf_dir):
    return substring_dedup.remove_repeated_words(_table(spark, sf_dir, "documents"), digests=True)


@query()
def op4_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeated_bytes(_table(spark, sf_dir, "documents"), digests=True)


@query()
def op5_decontamination(spark, sf_dir):
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_PHRASES = " OR ".join(f"contains(line, '{phrase}')" for phrase in quality.BOILERPLATE)

# Words, lines and windows of the documents; a row number stands for the document, whose id may repeat.
QUALITY_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
windows AS (
  SELECT rid, pos, array_to_string(words[pos:pos + {quality.WINDOW - 1}], ' ') AS shown
  FROM (SELECT rid, words, unnest(range(1, len(words) - {quality.WINDOW - 2})) AS pos FROM docs)),
covered AS (
  SELECT DISTINCT rid, unnest(range(pos, pos + {quality.WINDOW})) AS position
  FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, shown) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT rid, count(*) AS n_repeat_words FROM covered GROUP BY rid),
lines AS (
  SELECT rid, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words
  FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs)),
judged AS (
  SELECT rid, line, len(words) AS n,
         len(regexp_extract_all(line, '[|»›•]')) >= {quality.MIN_SEPARATORS}
         OR 100 * len(regexp_extract_all(line, '[#*$%&|<>]')) > {quality.SYMBOL_PERCENT} * length(line)
         OR 50 * (length(line) - length(replace(line, '!!', ''))) > {quality.SHOUT_PERCENT} * len(words)
         OR {_PHRASES}
         OR (len(words) >= {quality.STUTTER_WORDS}
             AND 100 * len(list_distinct(words)) < {quality.STUTTER_PERCENT} * len(words))
         OR (len(words) < {quality.STUB_WORDS}
             AND NOT regexp_matches(line, '[.!?:;"'')\]}}…。！？][\x20\x09-\x0D]*$')) AS failed
  FROM lines),
by_line AS (
  SELECT rid, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS n_dup_lines,
         coalesce(sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) FILTER (n = 0 OR NOT failed), 0)
           AS clean_chars
  FROM judged GROUP BY rid),
measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(clean_chars AS BIGINT) AS clean_chars
  FROM docs JOIN by_line USING (rid) LEFT JOIN repeats USING (rid))
SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words
         AS base_failed,
       NOT (n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words)
         AND 100 * clean_chars >= {quality.KEEP_PERCENT} * word_chars AS kept
FROM measured"""


@query(QUALITY_SQL)
def op8_quality_rules(spark, sf_dir):
    judged = quality.judge(_table(spark, sf_dir, "documents"))
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "clean_chars"]
    return judged.select("doc_id", *measures, "base_failed", "kept")


def public_ranks() -> dict[bytes, int]:
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query()
def op9_byte_bpe(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents")
    give = ["n_tokens", "ids_sha256", "decoded_sha256"]
    return bpe.encode(documents, public_ranks(), public_tokenizers.PATTERN, give=give)


@query()
def op10_lm_scoring(spark, sf_dir):
    return lm.score(_table(spark, sf_dir, "documents"))


@query()
def op2_toxicity(spark, sf_dir):
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query()
def op6_chat_formatting(spark, sf_dir):
    return quotes.threads(_table(spark, sf_dir, "conversations"))


@query()
def op7_url_filter(spark, sf_dir):
    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.RULES)


URL_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
         AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
rules (verdict, rule_host, rule_path) AS (VALUES """ + ", ".join(map(str, map(tuple, url_filter.RULES))) + r""")
SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
       arg_max(verdict, length(rule_host || rule_path)) AS rule_verdict
FROM (SELECT row_number() OVER () AS rid, * FROM named)
LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY rid, page_id, host, path"""


def url_rules(spark, sf_dir):
    """What the rules alone say of every url."""
    rows = url_filter.decided(_table(spark, sf_dir, "pages"), url_filter.RULES)
    verdict = [F.col("found.rule").alias("rule"), F.col("found.verdict").alias("rule_verdict")]
    return rows.select(F.col("__id").alias("page_id"), "host", "path", *verdict)


VIEWS["url_rules"], VIEW_ORACLES["url_rules"] = url_rules, URL_SQL


# The conversations' paths as lists of turn names; CRC-32 is folded bit by bit.
TRIE_SQL = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, name) AS p, name, words
  FROM (SELECT conv_id, turn, md5(concat(length(role), ':', role, text)) AS name,
               len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
              FROM conversations WHERE conv_id IS NOT NULL))),
convs AS (
  SELECT conv_id, conv_id - conv_id % 20 AS head, count(*) AS own,
         list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
             lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)) AS crc
  FROM turns GROUP BY conv_id),
plan AS (
  SELECT c.conv_id, c.head, xor(c.crc, 4294967295::BIGINT) % 4 AS h,
         least(xor(c.crc, 4294967295::BIGINT) % 4, coalesce(f.own, 0)) AS taken
  FROM convs c LEFT JOIN convs f ON f.conv_id = c.head),
rebuilt AS (
  SELECT conv_id, p - h + taken AS p, name, words FROM turns JOIN plan USING (conv_id) WHERE p > h
  UNION ALL
  SELECT plan.conv_id, p, name, words FROM plan JOIN turns ON turns.conv_id = head AND p <= taken),
paths AS (
  SELECT conv_id, coalesce(names, []) AS names, coalesce(counts, []) AS counts FROM plan LEFT JOIN (
    SELECT conv_id, list(name ORDER BY p) AS names, list(words ORDER BY p) AS counts
    FROM rebuilt GROUP BY conv_id) USING (conv_id)),
members AS (
  SELECT conv_id, d, names[1:d] AS node, CASE WHEN d = 0 THEN 0 ELSE counts[d] END AS words, d = len(names) AS ends
  FROM (SELECT *, unnest(range(0, len(names) + 1)) AS d FROM paths)),
nodes AS (
  SELECT node, any_value(d) AS d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY node),
children AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
above AS (SELECT *, unnest(range(0, d + 1)) AS e FROM counted),
subtrees AS (
  SELECT node[1:e] AS node, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM above GROUP BY 1)
SELECT c.conv_id, CAST(c.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(c.n_convs AS BIGINT) AS n_convs,
       CAST(c.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN subtrees USING (node) LEFT JOIN nodes p ON c.d > 0 AND p.node = c.node[1:c.d - 1]"""


@query(TRIE_SQL)
def op11_prefix_trie(spark, sf_dir):
    turns = prefix_trie.ordered_turns(_table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(turns))


# Row numbers stand for documents and items, whose ids may repeat.
SEARCH_SQL = r"""
WITH d AS (
  SELECT rid, doc_id, unnest(terms) AS term FROM (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents)),
tf AS (SELECT rid, doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
size AS (SELECT rid, sum(tf)::BIGINT AS n FROM tf GROUP BY rid),
whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM size),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (
  SELECT DISTINCT qid, item_id, unnest(terms) AS term FROM (
    SELECT row_number() OVER () AS qid, item_id, regexp_extract_all(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM benchmark)),
scored AS (
  SELECT qid, item_id, rid, doc_id,
    sum(CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT)
        * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // total))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN size USING (rid) CROSS JOIN whole
  GROUP BY qid, item_id, rid, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50"""


@query(SEARCH_SQL)
def op12_lexical_search(spark, sf_dir):
    return lexical_search.top_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query()
def op13_fingerprints(spark, sf_dir):
    return fingerprints.edited(_table(spark, sf_dir, "documents"))
