"""Benchmark decontamination: which short test items lie inside which documents.

Containment of an item is the share of its distinct five-word shingles that the
document has. MinHash works on the short side here: of an item the ``m`` shingles
with the smallest hash are kept, and the document is asked for any of them. Items
are partitioned by size; within a partition of items of up to ``u`` shingles,
``m`` is ``floor((1 - threshold) * u) + 1``. A document that holds the threshold's
share of an item lacks fewer than ``m`` of its shingles, so at least one of any
``m`` is found: nothing is lost, however long the document is. (Signatures of whole
documents would compare sets whose Jaccard index is near zero.) Candidates are
verified by exact containment of the shingles as text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.scratch import Scratch
from affinis.llm.tasks import releasing
from affinis.llm.words import NOT_ALNUM, Words, byte_slices, mix, plain, shingles

SIZE = 5
THRESHOLD = 0.8
FILTER_BITS = 27  # of the filter sent to the tasks: 16 MB at most, whatever the number of items
WORD = regex.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(plain(texts))


def shingle_texts(text: str | None, size: int = SIZE) -> set[str]:
    words = WORD.findall(pc.utf8_lower(pa.scalar(text or "")).as_py())
    return {" ".join(words[i : i + size]) for i in range(len(words) - size + 1)}


def sketch_size(n_shingles: int, threshold: float) -> int:
    """Shingles kept of each item in the partition by size that ``n_shingles`` falls in."""
    upper = 1 << max(0, n_shingles - 1).bit_length()
    return int(np.floor((1 - threshold) * upper + 1e-9)) + 1


def _sketches(size: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = lowered(batch.column("item_text"))
            hashes, sizes = [], []
            for first, last in byte_slices(texts):
                words = Words(texts, first, last, NOT_ALNUM)
                all_of, bounds = shingles(words.hashes(), words.bounds, size)
                for i in range(last - first):
                    own = np.unique(all_of[bounds[i] : bounds[i + 1]])
                    kept = own[np.argsort(mix(own ^ np.uint64(size)), kind="stable")][: sketch_size(len(own), threshold)]
                    hashes.append(kept.view(np.int64).tolist())
                    sizes.append(len(own))
            yield pa.RecordBatch.from_pydict(
                {
                    "item_at": batch.column("item_at"),
                    "sketch": pa.array(hashes, pa.list_(pa.int64())),
                    "n_item": pa.array(sizes, pa.int64()),
                }
            )

    return run


def filter_words(hashes: DataFrame, column: str, count: int) -> np.ndarray:
    """A Bloom filter with two bits for each hash, of a bounded number of bits."""
    bits = min(FILTER_BITS, max(20, (count * 64).bit_length()))
    places = hashes.select(
        F.explode(
            F.array(
                F.col(column).bitwiseAND(F.lit((1 << bits) - 1)),
                F.shiftrightunsigned(F.col(column), 32).bitwiseAND(F.lit((1 << bits) - 1)),
            )
        ).alias("bit")
    )
    rows = (
        places.groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
        .collect()
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    for row in rows:
        out[row.word] = row.bits & 0xFFFFFFFFFFFFFFFF
    return out


def passes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    mask = np.uint64(len(words) * 64 - 1)
    kept = np.flatnonzero(_bit(words, hashes & mask))
    return kept[_bit(words, (hashes[kept] >> np.uint64(32)) & mask)]


def _bit(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def _probe(size: int, sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            texts = lowered(batch.column("text"))
            rows, found, sizes = [], [], []
            for first, last in byte_slices(texts):
                words = Words(texts, first, last, NOT_ALNUM)
                hashes, bounds = shingles(words.hashes(), words.bounds, size)
                at = passes(known, hashes)
                owner = np.searchsorted(bounds, at, "right") - 1
                for i in np.unique(owner):
                    rows.append(first + int(i))
                    found.append(np.unique(hashes[at[owner == i]]).view(np.int64).tolist())
                    sizes.append(int(bounds[i + 1] - bounds[i]))
            if rows:
                hit = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*hit.columns, pa.array(found, pa.list_(pa.int64())), pa.array(sizes, pa.int64())],
                    names=[*batch.schema.names, "hits", "n_most"],
                )

    return run


def _verify(size: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, shares, last, own = [], [], [], None, set()
            for at, (text, item_text) in enumerate(
                zip(batch.column("text").to_pylist(), batch.column("item_text").to_pylist(), strict=True)
            ):
                if text != last:
                    own, last = shingle_texts(text, size), text
                wanted = shingle_texts(item_text, size)
                shared = len(wanted & own)
                if wanted and shared >= threshold * len(wanted) - 1e-9:
                    rows.append(at)
                    sizes.append(len(wanted))
                    shares.append(shared)
            hit = batch.select(["doc_id", "item_id"]).take(pa.array(rows, pa.int64()))
            n_item, n_shared = pa.array(sizes, pa.int64()), pa.array(shares, pa.int64())
            containment = pc.divide(n_shared.cast(pa.float64()), n_item.cast(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*hit.columns, n_item, n_shared, containment], names=["doc_id", "item_id", "n_item", "n_shared", "containment"]
            )

    return run


def contained_items(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, size: int = SIZE, scratch: Scratch | None = None
) -> DataFrame:
    """Pairs (doc_id, item_id, n_item, n_shared, containment) at or above the threshold.

    ``docs`` has ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``; other
    columns are not looked at. Words are runs of letters and digits in lower case.
    A null or empty text, and an item of fewer than ``size`` words, has no shingles
    and is in no pair. Repeated rows, also with null ids, give a pair each.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "contained")
    doc_type, item_type = (df.schema[c].dataType.simpleString() for df, c in ((docs, "doc_id"), (items, "item_id")))
    items = scratch.written(
        items.select("item_id", F.col("text").alias("item_text"))
        .filter(F.col("item_text").isNotNull())
        .withColumn("item_at", F.monotonically_increasing_id()),
        "items",
    )
    sketches = scratch.written(
        items.select("item_at", "item_text").mapInArrow(releasing(_sketches(size, threshold)), "item_at long, sketch array<long>, n_item long"),
        "sketches",
    )
    asked = sketches.select("item_at", "n_item", F.explode("sketch").alias("hash"))
    count = asked.count()
    sent = spark.sparkContext.broadcast(filter_words(asked, "hash", count))
    hit = scratch.written(
        docs.select("doc_id", "text")
        .mapInArrow(releasing(_probe(size, sent)), f"doc_id {doc_type}, text string, hits array<long>, n_most long")
        .withColumn("doc_at", F.monotonically_increasing_id()),
        "hit",
    )
    pairs = (
        hit.select("doc_at", "n_most", F.explode("hits").alias("hash"))
        .join(asked, "hash")
        .filter(F.col("n_most") >= F.ceil(F.col("n_item") * threshold - 1e-9))
        .select("doc_at", "item_at")
        .distinct()
    )
    return (
        pairs.join(items, "item_at")
        .join(hit.select("doc_at", "doc_id", "text"), "doc_at")
        .select("doc_id", "text", "item_id", "item_text")
        .mapInArrow(releasing(_verify(size, threshold)), f"doc_id {doc_type}, item_id {item_type}, n_item long, n_shared long, containment double")
    )


def without_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, size: int = SIZE) -> DataFrame:
    """The documents that contain no item; rows with a null ``doc_id`` are judged by their text.

    All columns are kept. Equal texts share their fate.
    """
    scratch = Scratch(docs.sparkSession, "without")
    key = F.md5(F.coalesce("text", F.lit("")))
    known = docs.select(key.alias("doc_id"), "text")
    bad = contained_items(known, items, threshold, size, scratch).select(F.col("doc_id").alias("__key")).distinct()
    keyed = docs.withColumn("__key", key)
    return keyed.join(scratch.written(bad, "bad"), "__key", "left_anti").select(*docs.columns)
