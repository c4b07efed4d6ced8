"""From raw documents to encoded ones; every stage applies one of the operators in ``affinis.llm``.

1. toxicity: documents that score as toxic go.
2. SimHash near-dedup: of each component of near copies the document of the smallest id stays.
3. Substring dedup: passages of 35 words or more that occur again are cut out.
4. Benchmark decontamination: documents that hold a test item go.
5. BPE: the ids of what is left, and the digest of what they decode to.

Each stage works on all that the one before it kept. Any table may be empty; nulls and
repeated rows are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.llm import bpe, decontaminate, simhash, substring, toxicity
from affinis.llm.queries import TOKENIZER
from affinis.llm.registry import table
from affinis.llm.scratch import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring.cleaned(docs)


def drop_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_items(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): ids as little-endian unsigned 32-bit numbers, the digest of the text decoded from them."""
    coded = bpe.coded(docs, TOKENIZER, text_chars=4 << 20, out_tokens=1 << 18)  # small blocks: earlier stages left the executors little room
    return coded.select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_benchmark_items),
    ("bpe", encode),
]

#: SQL has no learned scores, no XXH64 and no tokenizer; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.written(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
