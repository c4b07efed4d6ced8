"""Queries on tokens, vocabularies and term vectors."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from affinis.functions.text import tokens
from affinis.operators import vocabulary as voc
from affinis.operators.estimator import ml_vectors, vectoriser
from affinis.operators.recommend import ProfileIndex
from affinis.plans import orders_profile as op
from affinis.plans.registry import query, table
from affinis.session import scratch_path, written
from affinis.sources import landing
from affinis.streaming import scoring

SQL_DOC_TERMS = f"""doc_terms AS MATERIALIZED (SELECT doc_id, token, count(*) AS cnt FROM
  (SELECT doc_id, unnest({op.sql_tokens('text')}) AS token FROM documents) GROUP BY doc_id, token),
stats AS MATERIALIZED (SELECT token, CAST(sum(cnt) AS BIGINT) AS tf, count(*) AS df FROM doc_terms GROUP BY token)"""

SQL_LIMITED = SQL_DOC_TERMS + """,
limited AS MATERIALIZED (SELECT token, row_number() OVER (ORDER BY token) - 1 AS idx, tf, df FROM
  (SELECT * FROM stats WHERE df >= 2 AND df <= 0.5 * (SELECT count(*) FROM documents)
   ORDER BY tf DESC, token LIMIT 1000))"""


def document_counts(spark, sf):
    return voc.token_counts(table(spark, sf, "documents"), "doc_id", "text")


def profile_texts(spark, sf):
    return written(op.features(spark, sf).select(op.SPEC.entity, op.SPEC.text), "features")


def limited_vocabulary(spark, sf):
    return voc.fit_vocabulary(document_counts(spark, sf), max_features=1000, min_df=2, max_df=0.5)


@query(
    "tokenised",
    f"""SELECT conv_id, turn, CAST(len(w) AS BIGINT) AS n_tokens, md5(array_to_string(w, ' ')) AS words
    FROM (SELECT conv_id, turn, {op.sql_tokens('text')} AS w FROM conversations)""",
)
def tokenised(spark, sf):
    words = table(spark, sf, "conversations").select("conv_id", "turn", tokens(F.col("text")).alias("w"))
    return words.select(
        "conv_id", "turn", F.size("w").cast("bigint").alias("n_tokens"), F.md5(F.array_join("w", " ")).alias("words")
    )


@query("term_counts", f"WITH {op.SQL_TERMS} SELECT id AS id_municipio, token, cnt FROM terms")
def term_counts(spark, sf):
    return voc.token_counts(profile_texts(spark, sf), op.SPEC.entity, op.SPEC.text)


@query(
    "document_vectors",
    f"""WITH {SQL_DOC_TERMS} SELECT d.doc_id, count(token) AS n_terms, CAST(coalesce(sum(cnt * cnt), 0) AS BIGINT) AS sq,
    CAST(coalesce(sum(cnt), 0) AS BIGINT) AS l1 FROM documents d LEFT JOIN doc_terms t ON d.doc_id = t.doc_id GROUP BY d.doc_id""",
)
def document_vectors(spark, sf):
    vectors = voc.term_vectors(table(spark, sf, "documents"), "doc_id", "text", stemming=False)
    return vectors.select("doc_id", F.size("terms").cast("bigint").alias("n_terms"), "sq", "l1")


@query(
    "vocabulary",
    f"WITH {SQL_DOC_TERMS} SELECT token, row_number() OVER (ORDER BY token) - 1 AS idx, tf, df FROM stats",
)
def vocabulary(spark, sf):
    return voc.fit_vocabulary(document_counts(spark, sf))


@query("vocabulary_with_limits", f"WITH {SQL_LIMITED} SELECT * FROM limited")
def vocabulary_with_limits(spark, sf):
    return limited_vocabulary(spark, sf)


@query(
    "vectoriser_saved",
    f"WITH {SQL_LIMITED} SELECT doc_id, idx, cnt FROM doc_terms JOIN limited USING (token)",
)
def vectoriser_saved(spark, sf):
    """The limited vocabulary as an ML model of term counts, saved, loaded and applied; the places of its vectors that are not zero."""
    path = scratch_path(spark, "vectoriser")
    landing.save_vectoriser(vectoriser(limited_vocabulary(spark, sf)), path)
    vectors = voc.term_vectors(table(spark, sf, "documents"), "doc_id", "text", False)
    counted = ml_vectors(vectors, landing.load_vectoriser(path)).select("doc_id", vector_to_array("counts").alias("counts"))
    places = F.filter(F.transform("counts", lambda n, i: F.struct(i.cast("bigint").alias("idx"), n.cast("bigint").alias("cnt"))), lambda at: at["cnt"] > 0)
    return counted.select("doc_id", F.inline(places))


SQL_FROZEN = SQL_DOC_TERMS + """,
known AS MATERIALIZED (SELECT token, row_number() OVER (ORDER BY token) - 1 AS idx FROM stats)"""


def frozen_vocabulary(spark, sf):
    """Every token of the documents, written once."""
    return written(voc.fit_vocabulary(document_counts(spark, sf)), "vocabulary")


@query(
    "frozen_transform",
    f"""WITH {SQL_FROZEN},
    asked AS (SELECT item_id, unnest({op.sql_tokens('text')}) AS token FROM benchmark)
    SELECT item_id, idx, token, count(*) AS cnt FROM asked JOIN known USING (token) GROUP BY ALL""",
)
def frozen_transform(spark, sf):
    known = frozen_vocabulary(spark, sf)
    vectors = voc.term_vectors(table(spark, sf, "benchmark"), "item_id", "text", False, known)
    return voc.indexed_terms(vectors, known, "item_id")


@query(
    "frozen_transform_lengths",
    f"""WITH {SQL_FROZEN},
    asked AS (SELECT item_id, unnest({op.sql_tokens('text')}) AS token FROM benchmark),
    hits AS (SELECT item_id, token, count(*) AS cnt FROM asked JOIN known USING (token) GROUP BY ALL)
    SELECT b.item_id, CAST(coalesce(sum(cnt), 0) AS BIGINT) AS l1 FROM benchmark b LEFT JOIN hits USING (item_id)
    GROUP BY b.item_id""",
)
def frozen_transform_lengths(spark, sf):
    known = frozen_vocabulary(spark, sf)
    return voc.term_vectors(table(spark, sf, "benchmark"), "item_id", "text", False, known).select("item_id", "l1")


@query(
    "token_statistics",
    f"WITH {SQL_DOC_TERMS} SELECT token, tf, df FROM stats",
)
def token_statistics(spark, sf):
    return voc.token_statistics(document_counts(spark, sf))


@query(
    "top_tokens",
    f"WITH {SQL_DOC_TERMS} SELECT token, tf, df FROM stats ORDER BY tf DESC, token LIMIT 20",
)
def top_tokens(spark, sf):
    return voc.top_tokens(voc.token_statistics(document_counts(spark, sf)))


@query(
    "vocabulary_summary",
    f"""WITH {SQL_DOC_TERMS}, n AS (SELECT (SELECT count(*) FROM documents) AS n_entities,
      (SELECT count(*) FROM stats) AS n_tokens, (SELECT count(*) FROM doc_terms) AS n_nonzero)
    SELECT *, round(n_nonzero / (n_entities::DOUBLE * n_tokens), 9) AS density FROM n""",
)
def vocabulary_summary(spark, sf):
    return voc.density(document_counts(spark, sf), "doc_id").withColumn("density", F.round("density", 9))


@query(
    "tf_idf",
    f"""WITH {SQL_DOC_TERMS} SELECT doc_id, token, cnt,
    round(cnt * (ln((1.0 + (SELECT count(*) FROM documents)) / (1 + df)) + 1), 6) AS weight FROM doc_terms JOIN stats USING (token)""",
)
def tf_idf(spark, sf):
    weighted = voc.tf_idf(written(document_counts(spark, sf), "counts"), "doc_id")
    return weighted.withColumn("weight", F.round("weight", 6))


@query("stemmed_vocabulary")
def stemmed_vocabulary(spark, sf):
    """Vocabulary of stems over the profile texts (the rule table has no SQL form)."""
    counts = voc.text_counts(profile_texts(spark, sf), op.SPEC.entity, op.SPEC.text, stemming=True)
    return voc.fit_vocabulary(counts)


@query(
    "index_saved",
    f"""WITH {op.SQL_TERMS} SELECT token, row_number() OVER (ORDER BY token) - 1 AS idx,
    CAST(sum(cnt) AS BIGINT) AS tf, count(*) AS df FROM terms GROUP BY token""",
)
def index_saved(spark, sf):
    path = scratch_path(spark, "index")
    landing.save_index(ProfileIndex.build(written(op.features(spark, sf), "features"), op.SPEC, stemming=False), path)
    landing.load_index(spark, path, op.SPEC, stemming=False)
    return landing.load(spark, f"{path}/vocabulary")


@query(
    "streamed_terms",
    f"""WITH known AS MATERIALIZED (SELECT token, row_number() OVER (ORDER BY token) - 1 AS idx FROM (SELECT DISTINCT unnest({op.sql_tokens('text')}) AS token FROM benchmark))
    SELECT doc_id, idx, token, count(*) AS cnt FROM (SELECT doc_id, unnest({op.sql_tokens('text')}) AS token FROM documents) JOIN known USING (token) GROUP BY ALL""",
)
def streamed_terms(spark, sf):
    """Documents as a stream against the frozen vocabulary of the test items, run twice from one checkpoint."""
    known = written(voc.fit_vocabulary(voc.token_counts(table(spark, sf, "benchmark"), "item_id", "text")), "vocabulary")
    stream = scoring.known_tokens(scoring.stream_of(spark, f"{sf}/documents.parquet"), known, "doc_id", "text")
    return scoring.landed(stream, "streamed-terms").groupBy("doc_id", "idx", "token").agg(F.count(F.lit(1)).alias("cnt"))
