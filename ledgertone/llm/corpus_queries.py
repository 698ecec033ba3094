"""Queries of the operators that compare, learn from or pack the whole corpus."""

import public_tokenizers
from pyspark.sql import functions as F

from ledgertone.llm.digest_tree import exact_dedup
from ledgertone.llm.jaccard_join import jaccard_components
from ledgertone.llm.language_id import fit_on, predict
from ledgertone.llm.line_dedup import line_dedup
from ledgertone.llm.packing import pack
from ledgertone.llm.ppm_scoring import ppm_scores
from ledgertone.llm.registry import documents, query

END_ID = 1

OP1_SQL = r"""
WITH l AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
    FROM documents WHERE text IS NOT NULL AND text <> ''
),
h AS (SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM l),
b AS (
    SELECT *, ((h + 31 * lag(h, 1, 0) OVER (PARTITION BY doc_id ORDER BY i)) % 4294967296) % 3 = 0 AS ends FROM h
),
c AS (
    SELECT doc_id, i, line, coalesce(sum(ends::INT) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS chunk
    FROM b
),
bodies AS (
    SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n_lines,
        count(*) FILTER (WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) AS n_full
    FROM c GROUP BY doc_id, chunk
),
coarse AS (
    SELECT doc_id, chunk, row_number() OVER (PARTITION BY body ORDER BY doc_id, chunk) > 1 AS again
    FROM bodies WHERE n_full >= 2
),
f AS (
    SELECT *, lead(line) OVER w AS line2, lead(i) OVER w AS i2, lead(n) OVER w AS n2
    FROM (SELECT doc_id, i, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l) WHERE n > 0
    WINDOW w AS (PARTITION BY doc_id ORDER BY i)
),
fine AS (
    SELECT doc_id, i, i2, row_number() OVER (PARTITION BY line, line2 ORDER BY doc_id, i) > 1 AS again
    FROM f WHERE n + n2 >= 10
),
long AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) > 1 AS again FROM f WHERE n >= 50
),
gone AS (
    SELECT doc_id, i FROM c JOIN coarse USING (doc_id, chunk) WHERE again
    UNION SELECT doc_id, i FROM fine WHERE again
    UNION SELECT doc_id, i2 FROM fine WHERE again
    UNION SELECT doc_id, i FROM long WHERE again
),
kept AS (
    SELECT c.doc_id, count(DISTINCT c.chunk)::BIGINT AS n_chunks,
        count(DISTINCT c.chunk) FILTER (WHERE again)::BIGINT AS n_removed_chunks,
        count(gone.i)::BIGINT AS n_removed_lines,
        coalesce(string_agg(line, chr(10) ORDER BY c.i) FILTER (WHERE gone.i IS NULL), '') AS text
    FROM c LEFT JOIN coarse USING (doc_id, chunk) LEFT JOIN gone ON gone.doc_id = c.doc_id AND gone.i = c.i
    GROUP BY c.doc_id
)
SELECT d.doc_id, coalesce(n_chunks, 0) AS n_chunks, coalesce(n_removed_chunks, 0) AS n_removed_chunks,
    coalesce(n_removed_lines, 0) AS n_removed_lines,
    CASE WHEN d.text IS NULL OR d.text = '' THEN d.text ELSE kept.text END AS text
FROM documents d LEFT JOIN kept USING (doc_id)
"""


@query("op1_line_dedup", OP1_SQL)
def op1(spark, sf_dir):
    return line_dedup(documents(spark, sf_dir), report=True)


OP3_SQL = """
WITH n AS (
    SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
    FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
    doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM n
"""


@query("op3_exact_dedup", OP3_SQL)
def op3(spark, sf_dir):
    return exact_dedup(documents(spark, sf_dir), keep="largest")


def remainder(divisor):
    return F.crc32(F.col("doc_id").cast("string")) % divisor


@query("op7_language_id")
def op7(spark, sf_dir):
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(remainder(4) == 2, F.lit(True))
    model = fit_on(docs, ~held_out)
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op10_packing")
def op10(spark, sf_dir):
    pieces = pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query("op8_ppm_scoring")
def op8(spark, sf_dir):
    held_out = F.coalesce(remainder(5) == 1, F.lit(True))
    return ppm_scores(documents(spark, sf_dir), ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


OP4_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS ws
    FROM documents
),
s AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
),
e AS (
    SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)
),
r AS (
    SELECT doc_id, doc_id AS reached FROM d
    UNION
    SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached
)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(reached) AS component_id
FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""


@query("op4_jaccard_join", OP4_SQL)
def op4(spark, sf_dir):
    return jaccard_components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")
