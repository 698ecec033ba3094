"""Queries of personal data, resampling and fill-in-the-middle."""

from pyspark.sql import functions as F

from ledgertone.llm.fill_middle import digests, fill_in_middle
from ledgertone.llm.importance import importance_ranks
from ledgertone.llm.pii_scan import KINDS, pii_scan
from ledgertone.llm.registry import documents, query


def _told(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


@query("op11_pii")
def op11(spark, sf_dir):
    """The counts are those of the plain spans, as is ``base_sha256``; ``n_hidden`` counts the disguised ones."""
    found = pii_scan(documents(spark, sf_dir))
    plain = F.filter("spans", lambda s: ~s["hidden"])

    def count(kind):
        return F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, KINDS), F.size(F.filter("spans", lambda s: s["hidden"])).cast("long").alias("n_hidden"),
        F.sha2(_told(plain), 256).alias("base_sha256"), _told(F.col("spans")).alias("spans"),
    )


OP12_SQL = r"""
WITH step AS (
    SELECT list(c ORDER BY b) AS crc_of FROM (
        SELECT b, list_reduce(list_concat([b], range(8)),
            lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256)) AS b)
    )
),
lower_documents AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
),
lower_benchmark AS (
    SELECT translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark
),
dw AS (
    SELECT doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM lower_documents
),
bw AS (SELECT unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM lower_benchmark),
words AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
hashed AS (
    SELECT w, xor(list_reduce(
        list_concat([4294967295], list_transform(range(1, length(h), 2), lambda i: ('0x' || substr(h, i, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
    FROM words, step
),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN hashed USING (w) GROUP BY bucket),
gains AS (
    SELECT bucket, floor(1000 * ln(
        ((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE)
        / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM (SELECT unnest(range(10000)) AS bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
),
weights AS (
    SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM dw JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY doc_id
),
scored AS (
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln(
            (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296)))::BIGINT AS score
    FROM documents LEFT JOIN weights USING (doc_id)
),
placed AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS eligible
    FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (10 * eligible) // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""


@query("op12_importance", OP12_SQL)
def op12(spark, sf_dir):
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return importance_ranks(documents(spark, sf_dir), target).drop("n_words")


OP13_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
        sha256('42:' || doc_id) AS h
    FROM documents
),
n AS (
    SELECT doc_id, text, u, len(u)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1,
        ('0x' || substr(h, 9, 8))::BIGINT AS h2, ('0x' || substr(h, 17, 8))::BIGINT AS h3,
        ('0x' || substr(h, 25, 8))::BIGINT AS h4
    FROM d
),
c AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
            THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM n
),
p AS (
    SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
        array_to_string(u[b + 1:n], '') AS suffix
    FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM p
"""


@query("op13_fill_in_middle", OP13_SQL)
def op13(spark, sf_dir):
    return fill_in_middle(
        documents(spark, sf_dir), derive=digests, derived="output_sha256 string, restored_sha256 string"
    )
