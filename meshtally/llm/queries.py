"""The queries of this package's operators, over whole tables, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from meshtally.llm import (bpe, conversation, fingerprint, license_scan, lines, minhash, packing, quality, scoring, secret_scan,
                           urls, vectors, whitening)
from meshtally.llm.common import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), WORD_BPE)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, with_ids=False)


# The rules of the query.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
             ("block", "net/fr/")]


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES, whole=True).drop("score")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op9_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.scores(table(spark, sf_dir, "documents"))


def op10_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation.report(table(spark, sf_dir, "conversations"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_bpe, op2_packing, op3_urls, op4_quality, op5_fingerprints, op6_line_dedup, op7_secrets,
                            op8_minhash, op9_scoring, op10_vectors, op11_whitening, op12_conversations,
                            op13_licenses)}

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LINES_SQL = f"""
WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                      unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents),
     keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                   '{UPPER}', '{UPPER.lower()}') AS key FROM lines),
     common AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
                GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
     judged AS (SELECT doc_id, i, line, coalesce(doc_id < last, false) AS gone FROM keyed LEFT JOIN common USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""
VECTORS_SQL = """
WITH RECURSIVE unit AS (
       SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS u
       FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
       WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
     links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b
               ON a.vec_id <> b.vec_id AND list_inner_product(a.u, b.u) >= 0.95),
     reach AS (SELECT a AS vec_id, a AS other FROM links UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
     LEFT JOIN (SELECT vec_id, min(other) AS component FROM reach GROUP BY vec_id) USING (vec_id)"""

# The same repair row by row: a recursion from each conversation's end carries the best (cost, audit) of four states.
CONVERSATIONS_SQL = r"""
WITH RECURSIVE hashed AS (
       SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
              xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
                      string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                      lambda ch: [CAST(ord(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
                  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) % 20 AS f
       FROM conversations),
     damaged AS (
       SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
              CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
       FROM hashed, unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) WHERE f <> 0),
     placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM damaged),
     judged AS (
       SELECT *, role[1] AS initial, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair,
              CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
       FROM placed),
     counts AS (
       SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
              count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
              count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
       FROM judged GROUP BY conv_id),
     best AS (
       SELECT conv_id, n AS i, [{'c': 0, 'a': ''}, {'c': 4, 'a': 'II'}, {'c': 2, 'a': 'I'}, {'c': 0, 'a': ''}] AS v FROM counts
       UNION ALL
       SELECT conv_id, i, [list_sort([e[1], {'c': e[3].c + 2, 'a': 'I' || e[3].a}, {'c': e[4].c + 4, 'a': 'II' || e[4].a}])[1],
                           list_sort([e[2], {'c': e[3].c + 2, 'a': 'I' || e[3].a}, {'c': e[4].c + 4, 'a': 'II' || e[4].a}])[1],
                           list_sort([e[3], {'c': e[4].c + 2, 'a': 'I' || e[4].a}])[1],
                           list_sort([e[4], {'c': e[3].c + 2, 'a': 'I' || e[3].a}])[1]]
       FROM (SELECT b.conv_id, b.i - 1 AS i, list_transform([0, 1, 2, 3], lambda q: list_sort(list_filter([
                      {'c': v[q + 1].c + 3, 'a': 'D' || v[q + 1].a},
                      CASE WHEN fault NOT IN ('blank', 'duplicate')
                           THEN {'c': v[if(q = 2, 4, 3)].c + 2 + if(fault = 'truncated', 1, 0), 'a': 'R' || v[if(q = 2, 4, 3)].a} END,
                      CASE WHEN fault NOT IN ('blank', 'duplicate') AND initial = 's' AND q = 0
                           THEN {'c': v[2].c + if(fault = 'truncated', 1, 0), 'a': 'K' || v[2].a}
                           WHEN fault NOT IN ('blank', 'duplicate') AND initial = 'u' AND q <> 2
                           THEN {'c': v[3].c + if(fault = 'truncated', 1, 0), 'a': 'K' || v[3].a}
                           WHEN fault NOT IN ('blank', 'duplicate') AND initial = 'a' AND q = 2
                           THEN {'c': v[4].c + if(fault = 'truncated', 1, 0), 'a': 'K' || v[4].a} END],
                    lambda way: way IS NOT NULL))[1]) AS e
             FROM best b JOIN judged r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i)),
     answers AS (SELECT conv_id, v[1].c AS cost, v[1].a AS audit FROM best WHERE i = 0),
     letters AS (
       SELECT conv_id, p, audit[p] AS letter, length(regexp_replace(audit[1:p], 'I', '', 'g')) AS i,
              length(regexp_replace(audit[1:p], 'D', '', 'g')) AS t
       FROM answers, unnest(range(1, length(audit) + 1)) AS u(p)),
     lines AS (
       SELECT l.conv_id, p, letter, role, text, t - max(if(t = 1 AND letter = 'K' AND initial = 's', 1, 0)) OVER (PARTITION BY l.conv_id) AS t
       FROM letters l LEFT JOIN judged r ON r.conv_id IS NOT DISTINCT FROM l.conv_id AND r.i = l.i AND letter <> 'I' WHERE letter <> 'D'),
     repaired AS (
       SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN t % 2 = 1 THEN 'user' ELSE 'assistant' END
                                         || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS digest
       FROM lines GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
     LEFT JOIN answers a ON a.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id"""

ORACLE: dict[str, str] = {"op6_line_dedup": LINES_SQL, "op10_vectors": VECTORS_SQL, "op12_conversations": CONVERSATIONS_SQL}
