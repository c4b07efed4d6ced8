"""Language-model scores by stupid backoff.

The texts are dealt to stretches of a few megabytes. A stretch's distinct n-grams, by
hash, with their number travel to the count table, which is partitioned by ranges of
the hash; there the stretches' numbers are added up, and the totals travel back to
each stretch that asked, where they meet its exploded n-grams and are summed per
document. An n-gram that is everywhere is one entry for each stretch, so no key is hot.
N-grams travel as packed columns of hashes, never as rows, and are known by 61 bits of hash alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.decontaminate import lowered
from affinis.llm.scratch import Scratch
from affinis.llm.tasks import releasing
from affinis.llm.words import NOT_ALNUM, STEP, Words, byte_slices, mix, spans

ORDER = 2
LEAST = 2  # occurrences from which an n-gram of two words or more is kept
BACKOFF = 0.4
STRETCH_BYTES = 8 << 20  # of text
TABLE_BYTES = 8 << 20  # of hashes, about, in one part of the count table
TEXT_LEVEL = 9  # of compression; texts are written once and moved once


def packed_grams(grams: np.ndarray) -> bytes:
    """Sorted hashes by their distances, byte by byte: the upper bytes are nearly all zero."""
    planes = np.diff(grams, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T
    return pa.Codec("zstd", compression_level=1).compress(planes.tobytes(), asbytes=True)


def unpacked_grams(packed: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(packed, 8 * count), np.uint8).reshape(8, count)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_ids, sizes, texts, n_words): the texts of a stretch, one after another, packed."""
    ids, texts, size, text_codec = [], [], 0, pa.Codec("zstd", compression_level=TEXT_LEVEL)

    def packed() -> pa.RecordBatch:
        sizes = np.fromiter(map(len, texts), "<i8", len(texts))
        return pa.RecordBatch.from_arrays(
            [pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)), pa.array([sizes.tobytes()], pa.binary()), pa.array([text_codec.compress(b"".join(texts), asbytes=True)], pa.binary()), pa.array([words], pa.int64())],
            names=["doc_ids", "sizes", "texts", "n_words"],
        )

    words = 0
    for batch in batches:
        low = lowered(batch.column("text"))
        for first, last in byte_slices(low):
            words += len(Words(low, first, last, NOT_ALNUM).start)
            ids.append(batch.column("doc_id").slice(first, last - first))
            texts += [t.as_buffer().to_pybytes() for t in low[first:last]]
            size += sum(map(len, texts[len(texts) - (last - first) :]))
            if size >= STRETCH_BYTES:
                yield packed()
                ids, texts, size, words = [], [], 0, 0
    if ids:
        yield packed()


class Stretch:
    """The n-grams of a stretch: hashes by position and order, the order in the lowest bits."""

    def __init__(self, sizes: bytes, texts: bytes, order: int):
        bounds = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, "<i8"))])
        data = pa.Codec("zstd").decompress(texts, int(bounds[-1]), asbytes=True)
        whole = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype("<i8").tobytes()), pa.py_buffer(data))
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for first, last in byte_slices(whole):
            words = Words(whole, first, last, NOT_ALNUM)
            hashes.append(words.hashes())
            counts.append(words.counts())
        words, self.counts = np.concatenate(hashes), np.concatenate(counts)
        n, ends = len(words), np.cumsum(self.counts)
        self.place = np.arange(n) - np.repeat(ends - self.counts, self.counts)  # of a word in its text
        self.at, distinct, numbers, inverses = [], [], [], []
        for k in range(order):
            at = np.flatnonzero(self.place >= k)
            tagged = mix(spans(words, at - k, at + 1, STEP) ^ np.uint64(k)) & ~np.uint64(7) | np.uint64(k)
            own, inverse, counts = np.unique(tagged, return_inverse=True, return_counts=True)
            self.at.append(at.astype(np.int32))
            distinct.append(own)
            numbers.append(counts.astype(np.uint32))
            inverses.append(inverse.astype(np.int32))
        together = np.concatenate(distinct)
        ranks = np.argsort(together)
        self.grams, self.numbers = together[ranks], np.concatenate(numbers)[ranks]
        place = np.empty(len(ranks), np.int32)
        place[ranks] = np.arange(len(ranks), dtype=np.int32)
        starts = np.cumsum([0, *map(len, distinct)])
        self.inverse = [place[first + inverse] for first, inverse in zip(starts, inverses, strict=False)]  # of each order's positions


def parts_of(grams: np.ndarray, bits: int) -> np.ndarray:
    """Where each part of the count table begins in sorted hashes."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(grams, edges), [len(grams)]])


def _asked(order: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, sizes, texts in zip(*(batch.column(c) for c in ("stretch", "sizes", "texts")), strict=True):
                own = Stretch(sizes.as_py(), texts.as_py(), order)
                cuts = parts_of(own.grams, bits)
                full = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full.astype(np.int32)),
                        pa.array([number.as_py()] * len(full), pa.int64()),
                        pa.array([packed_grams(own.grams[cuts[p] : cuts[p + 1]]) for p in full], pa.binary()),
                        pa.array([zlib.compress(own.numbers[cuts[p] : cuts[p + 1]].astype("<u4").tobytes(), 1) for p in full], pa.binary()),
                    ],
                    names=["part", "stretch", "grams", "numbers"],
                )

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the numbers of each part and answer every stretch in the order of its own hashes."""
    part, rows = None, []

    def answered() -> pa.RecordBatch:
        numbers = [np.frombuffer(zlib.decompress(r[2]), "<u4") for r in rows]
        grams = [unpacked_grams(r[1], len(own)) for r, own in zip(rows, numbers, strict=True)]
        known, inverse = np.unique(np.concatenate(grams), return_inverse=True)
        total = np.zeros(len(known), np.int64)
        np.add.at(total, inverse, np.concatenate(numbers).astype(np.int64))
        cuts = np.cumsum([0, *map(len, grams)])
        answers = [zlib.compress(total[inverse[a:b]].astype("<i8").tobytes(), 1) for a, b in zip(cuts, cuts[1:], strict=False)]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([part] * len(rows), pa.int32()), pa.array(answers, pa.binary())],
            names=["stretch", "part", "totals"],
        )

    for batch in batches:
        for own, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "stretch", "grams", "numbers")), strict=True):
            if rows and own != part:
                yield answered()
                rows = []
            part = own
            rows.append(row)
    if rows:
        yield answered()


def log_scores(own: Stretch, totals: np.ndarray, everything: int, order: int, least: int, backoff: float) -> tuple[np.ndarray, np.ndarray]:
    """log S of each word, and how many words of history it was scored with."""
    n = len(own.place)
    by_order = []
    for at, inverse in zip(own.at, own.inverse, strict=True):
        counts = np.zeros(n, np.int64)
        counts[at] = totals[inverse]
        by_order.append(counts)
    score, used = np.log(np.maximum(by_order[0], 1) / max(1, everything)), np.zeros(n, np.int64)
    for k in range(1, order):
        has = own.place >= k
        seen = has & (by_order[k] >= least)
        history = np.concatenate([[1], by_order[k - 1][:-1]])[:n]
        better = np.log(np.maximum(by_order[k], 1) / np.maximum(history, 1))
        score = np.where(seen, better, np.where(has, score + np.log(backoff), score))
        used = np.where(seen, k, used)
    return score, used


def _scores(order: int, least: int, backoff: float, everything: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sizes, texts, answers in zip(*(batch.column(c) for c in ("doc_ids", "sizes", "texts", "answers")), strict=True):
                own = Stretch(sizes.as_py(), texts.as_py(), order)
                parts = sorted((a["part"], a["totals"]) for a in answers.as_py() or [])
                totals = np.concatenate([np.zeros(0, "<i8"), *(np.frombuffer(zlib.decompress(t), "<i8") for _, t in parts)])
                score, used = log_scores(own, totals, everything, order, least, backoff)
                edges = np.concatenate([[0], np.cumsum(own.counts)])
                whole = [float(score[a:b].sum()) for a, b in zip(edges, edges[1:], strict=False)]
                seen = np.concatenate([[0], np.cumsum(used > 0)])
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(own.counts), pa.array(seen[edges[1:]] - seen[edges[:-1]]), pa.array(whole, pa.float64())],
                    names=["doc_id", "n_words", "n_seen", "log_score"],
                )

    return run


def scored(
    docs: DataFrame, order: int = ORDER, least: int = LEAST, backoff: float = BACKOFF, scratch: Scratch | None = None
) -> DataFrame:
    """(doc_id, n_words, n_seen, log_score) of every row by a model of all rows' texts.

    Words are runs of letters and digits in lower case. A word's score is count(n-gram) /
    count(history) for the longest n-gram up to ``order`` words that occurs at least
    ``least`` times in the corpus, times ``backoff`` for each shorter history; a single
    word's is its share of all words. ``log_score`` is the sum of natural logarithms,
    ``n_seen`` the number of words scored with a history. A null, empty or wordless text
    scores 0 with no words; repeated rows and null ids stay, other columns are ignored.
    """
    if not 1 <= order <= 8:
        raise ValueError("order must be between 1 and 8")
    scratch = scratch or Scratch(docs.sparkSession, "lm")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    stretches = scratch.written(
        docs.select("doc_id", "text")
        .mapInArrow(releasing(_stretches), f"doc_ids array<{id_type}>, sizes binary, texts binary, n_words long")
        .withColumn("stretch", F.monotonically_increasing_id()),
        "stretches",
    )
    everything = stretches.agg(F.sum("n_words")).first()[0] or 0
    bits = max(0, (everything * order * 8 // TABLE_BYTES).bit_length())
    asked = stretches.mapInArrow(releasing(_asked(order, bits)), "part int, stretch long, grams binary, numbers binary")
    totals = asked.repartition(1 << bits, "part").sortWithinPartitions("part").mapInArrow(releasing(_totals), "stretch long, part int, totals binary")
    answers = totals.groupBy("stretch").agg(F.collect_list(F.struct("part", "totals")).alias("answers"))
    return stretches.join(answers, "stretch", "left").mapInArrow(
        releasing(_scores(order, least, backoff, everything)), f"doc_id {id_type}, n_words long, n_seen long, log_score double"
    )
