"""Queries of the operators that judge or encode one document at a time."""

import hashlib

import public_tokenizers
from pyspark.sql import functions as F

from ledgertone.llm.byte_bpe import byte_bpe
from ledgertone.llm.quality_rules import quality_rules
from ledgertone.llm.registry import documents, query
from ledgertone.llm.secret_scan import secret_scan
from ledgertone.llm.token_counts import token_counts

OP2_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (
    SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS win
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
),
again AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM again) GROUP BY doc_id
),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
lw AS (SELECT doc_id, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM l),
m AS (
    SELECT doc_id, line, len(ws) AS n, strlen(array_to_string(ws, '')) AS solid,
        len(regexp_extract_all(line, '[#*$%&|<>]')) AS dressed,
        len(list_filter(ws, lambda x: regexp_matches(x, '[!?][!?]'))) AS shouts,
        len(list_filter(ws, lambda x: x IN ('|', '»', '•', '›', '>', '/'))) AS bars,
        len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS twice,
        regexp_matches(line, '[0-9A-Za-z]') OR strlen(line) > length(line) AS letter,
        regexp_matches(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            'all rights reserved|licensed under|released under the|this work is licensed|terms of use|terms of service|privacy policy|cookie policy|accept cookies|enable javascript|subscribe to our newsletter|powered by wordpress|copyright ©|copyright \(c\)') AS notice
    FROM lw WHERE len(ws) > 0
),
f AS (
    SELECT *, NOT letter OR 10 * dressed > solid OR 10 * shouts > 3 * n OR (bars >= 2 AND 5 * bars >= n)
        OR (n >= 4 AND 2 * twice > n) AS bad, n <= 20 AND notice AS notice_line FROM m
),
lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines,
        coalesce(sum(solid) FILTER (WHERE bad OR notice_line), 0) AS lost, sum(solid) AS solid,
        coalesce(sum(n) FILTER (WHERE NOT bad AND NOT notice_line), 0) AS words_left
    FROM f GROUP BY doc_id
),
r AS (
    SELECT w.doc_id, len(ws)::BIGINT AS n_words,
        (length(text) - length(regexp_replace(text, '[^\x20\x09-\x0D]', '', 'g')))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
        coalesce(words_left >= 20 AND 100 * lost <= 50 * solid, false) AS enough
    FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN lines USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND enough AS kept
FROM r
"""


@query("op2_quality_rules", OP2_SQL)
def op2(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir)).drop("n_bad_lines", "lost_pct", "clean_text")


def _span_text(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


@query("op5_secret_scan")
def op5(spark, sf_dir):
    found = secret_scan(documents(spark, sf_dir))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), count("novel"),
        F.sha2(_span_text(F.filter("spans", lambda s: s["kind"] != "novel")), 256).alias("base_sha256"),
        _span_text(F.col("spans")).alias("spans"),
    )


def _digests(ids, decoded):
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()


@query("op6_byte_bpe")
def op6(spark, sf_dir):
    return byte_bpe(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN,
        derive=_digests, derived="ids_sha256 string, decoded_sha256 string",
    )


@query("op9_token_counts")
def op9(spark, sf_dir):
    return token_counts(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
