"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import functions as F

from affinis.llm import bpe, chat, decontaminate, html_text, lm, simhash, substring, topk, toxicity, warc
from affinis.llm import queries_rules  # noqa: F401
from affinis.llm.registry import query, table

#: Distinct five-word shingles of a text as list; the words are runs of letters and digits.
SQL_SHINGLES = """list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))"""
SQL_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2f\x3a-\x60\x7b-\x7f]+')"

SQL_DECONTAMINATION = f"""WITH i AS MATERIALIZED (SELECT item_id, {SQL_SHINGLES} AS s FROM (SELECT item_id, {SQL_WORDS} AS w FROM benchmark)),
d AS MATERIALIZED (SELECT doc_id, unnest({SQL_SHINGLES}) AS s FROM (SELECT doc_id, {SQL_WORDS} AS w FROM documents)),
u AS (SELECT item_id, len(s) AS n_item, unnest(s) AS s FROM i)
SELECT doc_id, item_id, CAST(n_item AS BIGINT) AS n_item, count(*) AS n_shared, count(*) / n_item AS containment
FROM d JOIN u USING (s) GROUP BY doc_id, item_id, n_item HAVING count(*) >= 0.8 * n_item - 1e-9"""


@query("op1_decontamination", SQL_DECONTAMINATION)
def op1(spark, sf):
    return decontaminate.contained_items(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op2_chat_format")
def op2(spark, sf):
    return chat.repaired(table(spark, sf, "conversations"))


#: File of the tokenizer; every executor has it at this place.
TOKENIZER = os.environ.get("WORD_BPE_FILE") or public_tokenizers.path("word_bpe_49k.json")


@query("op3_bpe")
def op3(spark, sf):
    coded = bpe.coded(table(spark, sf, "documents"), TOKENIZER)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


SQL_WARC = """WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest,
  min(page_id) OVER (PARTITION BY html) AS least FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > least THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > least THEN least END AS refers_to FROM d"""


@query("op4_warc", SQL_WARC)
def op4(spark, sf):
    return warc.round_trip(table(spark, sf, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL_LM = f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, {SQL_WORDS} AS w FROM documents),
t AS MATERIALIZED (SELECT r, unnest(w) AS w, unnest(range(len(w))) AS i FROM d),
b AS MATERIALIZED (SELECT a.r, p.w AS u, a.w FROM t a LEFT JOIN t p ON p.r = a.r AND p.i = a.i - 1),
c1 AS MATERIALIZED (SELECT w, count(*) AS n FROM t GROUP BY w),
c2 AS MATERIALIZED (SELECT u, w, count(*) AS n FROM b WHERE u IS NOT NULL GROUP BY u, w HAVING count(*) >= 2),
s AS (SELECT r, count(*) AS n_words, count(c2.n) AS n_seen, sum(CASE WHEN c2.n IS NOT NULL THEN ln(c2.n / h.n)
    ELSE ln(o.n / (SELECT count(*) FROM t)) + CASE WHEN b.u IS NULL THEN 0 ELSE ln(0.4) END END) AS score
  FROM b JOIN c1 o ON o.w = b.w LEFT JOIN c1 h ON h.w = b.u LEFT JOIN c2 ON c2.u = b.u AND c2.w = b.w GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_seen, 0) AS n_seen, round(coalesce(score, 0), 3) AS log_score FROM d LEFT JOIN s USING (r)"""


@query("op5_lm_score", SQL_LM)
def op5(spark, sf):
    found = lm.scored(table(spark, sf, "documents"))
    return found.withColumn("log_score", F.round("log_score", 3))


SQL_LM_TRIGRAMS = f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, {SQL_WORDS} AS w FROM documents),
t AS MATERIALIZED (SELECT r, unnest(w) AS w, unnest(range(len(w))) AS i FROM d),
b AS MATERIALIZED (SELECT a.r, q.w AS v, p.w AS u, a.w FROM t a LEFT JOIN t p ON p.r = a.r AND p.i = a.i - 1 LEFT JOIN t q ON q.r = a.r AND q.i = a.i - 2),
c1 AS MATERIALIZED (SELECT w, count(*) AS n FROM t GROUP BY w),
c2 AS MATERIALIZED (SELECT u, w, count(*) AS n FROM b WHERE u IS NOT NULL GROUP BY u, w HAVING count(*) >= 2),
c3 AS MATERIALIZED (SELECT v, u, w, count(*) AS n FROM b WHERE v IS NOT NULL GROUP BY v, u, w HAVING count(*) >= 2),
s AS (SELECT r, count(*) AS n_words, count(c2.n) AS n_seen, sum(CASE WHEN c3.n IS NOT NULL THEN ln(c3.n / g.n)
    ELSE CASE WHEN b.v IS NULL THEN 0 ELSE ln(0.4) END + CASE WHEN c2.n IS NOT NULL THEN ln(c2.n / h.n)
    ELSE ln(o.n / (SELECT count(*) FROM t)) + CASE WHEN b.u IS NULL THEN 0 ELSE ln(0.4) END END END) AS score
  FROM b JOIN c1 o ON o.w = b.w LEFT JOIN c1 h ON h.w = b.u LEFT JOIN c2 ON c2.u = b.u AND c2.w = b.w
  LEFT JOIN c2 g ON g.u = b.v AND g.w = b.u LEFT JOIN c3 ON c3.v = b.v AND c3.u = b.u AND c3.w = b.w GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_seen, 0) AS n_seen, round(coalesce(score, 0), 3) AS log_score FROM d LEFT JOIN s USING (r)"""


@query("op5_lm_score_trigrams", SQL_LM_TRIGRAMS)
def op5_trigrams(spark, sf):
    found = lm.scored(table(spark, sf, "documents"), order=3)
    return found.withColumn("log_score", F.round("log_score", 3))


SQL_TOP_K = """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)) WHERE rank <= 5"""


@query("op6_top_k", SQL_TOP_K)
def op6(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", topk.scaled("embedding").alias("vec"))
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5)


@query("op7_main_text")
def op7(spark, sf):
    pages = table(spark, sf, "pages")
    return html_text.extracted(pages, html_text.fit(pages))


SQL_SUBSTRING = r"""WITH d AS MATERIALIZED (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS MATERIALIZED (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d)),
again AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, i + j AS p FROM win JOIN again USING (s) CROSS JOIN range(0, 35) AS t(j)),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


@query("op8_substring_dedup", SQL_SUBSTRING)
def op8(spark, sf):
    found = substring.without_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op9_toxicity")
def op9(spark, sf):
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    return toxicity.scored(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", toxicity.predicted().alias("predicted"))


@query("op10_simhash")
def op10(spark, sf):
    return simhash.components(table(spark, sf, "documents"))
