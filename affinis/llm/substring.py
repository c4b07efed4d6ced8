"""Removal of repeated passages, found by recompression.

A text's words are renamed in rounds: runs of one symbol become one symbol, then
pairs of a left and a right symbol do; a symbol's side and a new symbol's name are
hashes of names, so every task names alike and no dictionary is needed. Only short symbols are
joined, hence whether two symbols stay apart at a place depends on the ``REACH`` words
about it, and equal passages have the same symbols inside. Between the symbols of the
last round lie the cuts. A window of words takes the cut inside it whose surroundings
hash lowest: equal windows take equal cuts. So only windows whose cut's surroundings
occur again can be repeated (a window without a cut, in a long run, stands for
itself); those alone are compared, by the hash of all their words together with that
of the cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinis.llm.decontaminate import filter_words, passes
from affinis.llm.scratch import Scratch
from affinis.llm.tasks import releasing
from affinis.llm.words import STEP, Words, byte_slices, mix, plain, spans
from affinis.operators.joins import weighted_lookup

WINDOW = 35
ROWS_AT_ONCE = 500  # rows in one batch handed on
#: Rounds: what is joined, and the longest symbol (in words) that takes part.
ROUNDS = [("run", 1), ("pair", 1), ("pair", 1), ("pair", 1), ("pair", 2), ("pair", 2)]
REACH = sum(longest for _, longest in ROUNDS)
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def cuts(names: np.ndarray, first_of_text: np.ndarray) -> np.ndarray:
    """Word positions at which a symbol of the last round begins."""
    start = np.arange(len(names))
    first = np.zeros(len(names), bool)
    first[first_of_text] = True
    for turn, (kind, longest) in enumerate(ROUNDS):
        short = np.diff(start, append=len(first_of_text) and len(first)) <= longest
        able = short[1:] & short[:-1] & ~first[start[1:]]
        if kind == "run":
            joined = able & (names[1:] == names[:-1])
        else:
            right = mix(names ^ np.uint64(turn + 1)) >> np.uint64(63) != 0
            joined = able & ~right[:-1] & right[1:]
        heads = np.flatnonzero(np.r_[True, ~joined]) if len(names) else start
        size = np.diff(heads, append=len(names))
        if kind == "run":
            fresh = mix(names[heads] + size.astype(np.uint64) * np.uint64(STEP))
        else:
            fresh = mix(names[heads] * np.uint64(STEP) + names[np.minimum(heads + 1, len(names) - 1)])
        names = np.where(size > 1, fresh, names[heads])
        start = start[heads]
    return start


def slid(values: np.ndarray, width: int, best, fill) -> np.ndarray:
    """best(values[i : i + width]) for each i; beyond the end are ``fill``."""
    out, have = values, 1
    while have < width:
        by = min(have, width - have)
        moved = np.full_like(out, fill)
        moved[:-by] = out[by:] if len(out) > by else fill
        out, have = best(out, moved), have + by
    return out


class Windows:
    """Cut and hash of every window of a slice of texts."""

    def __init__(self, texts: pa.Array, first: int, last: int, window: int = WINDOW):
        words = Words(texts, first, last)
        self.bounds, n = words.bounds, len(words.start)
        hashes = words.hashes()
        counts = np.maximum(words.counts() - window + 1, 0)
        begun = np.cumsum(counts) - counts
        self.at = np.arange(counts.sum()) + np.repeat(self.bounds[:-1] - begun, counts)  # windows, by first word
        self.text = np.repeat(np.arange(last - first), counts)
        self.hash = mix(spans(hashes, self.at, self.at + window, STEP)) if n else np.zeros(0, np.uint64)
        around = np.full(n, NONE)
        if n:
            place = cuts(hashes, self.bounds[:-1][words.counts() > 0])
            begin, end = self.bounds[:-1], self.bounds[1:]
            own = np.searchsorted(end, place, "right")
            place = place[(place - REACH >= begin[own]) & (place + REACH <= end[own])]
            around[place] = mix(spans(hashes, place - REACH, place + REACH, STEP) ^ np.uint64(REACH)) >> np.uint64(1)
        least = slid(around, window - 2 * REACH + 1, np.minimum, NONE)
        cut = np.full(n, NONE)
        cut[self.at] = least[np.minimum(self.at + REACH, max(0, n - 1))] if n else NONE
        self.alone = cut[self.at] == NONE
        self.cut = np.where(self.alone, self.hash | np.uint64(1 << 63), cut[self.at])
        # A cut is taken if some window that holds it has no lower one.
        taken = np.zeros(n, np.uint64)
        valid = np.zeros(n, np.uint64)
        valid[self.at] = np.where(self.alone, 0, cut[self.at])
        back = slid(valid[::-1], window - 2 * REACH + 1, np.maximum, np.uint64(0))[::-1]
        taken[REACH:] = back[: n - REACH] if n > REACH else 0
        chosen = np.flatnonzero((around != NONE) & (around == taken))
        self.taken = np.concatenate([around[chosen], self.cut[self.alone]])
        self.taken_text = np.concatenate([np.searchsorted(self.bounds, chosen, "right") - 1, self.text[self.alone]])


def _cuts(window: int, by_text: bool):
    """Rows (cut, n) of a slice, or the distinct (cut, key) of its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys = plain(batch.column("text")), batch.column("key").to_numpy()
            for first, last in byte_slices(texts):
                found = Windows(texts, first, last, window)
                if by_text:
                    order = np.lexsort((found.taken, found.taken_text))
                    cut, owner = found.taken[order], found.taken_text[order]
                    fresh = np.r_[True, (cut[1:] != cut[:-1]) | (owner[1:] != owner[:-1])][: len(cut)]
                    columns = [cut[fresh].view(np.int64), keys[first + owner[fresh]]]
                else:
                    cut, n = np.unique(found.taken, return_counts=True)
                    columns = [cut.view(np.int64), n.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["cut", "key" if by_text else "n"])

    return run


def _in_question(sent, wanted: bool):
    """Rows whose key passes the filter of texts with repeated cuts, or those whose key doesn't."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            hit = np.zeros(len(keys), bool)
            hit[passes(sent.value, keys)] = True
            yield batch.filter(pa.array(hit == wanted))

    return run


def _windows(window: int):
    """The windows (cut, hash, row, at) of each text that take one of its repeated cuts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows = plain(batch.column("text")), batch.column("row_at").to_numpy()
            lists = batch.column("cuts")
            for first, last in byte_slices(texts):
                found = Windows(texts, first, last, window)
                kept = np.zeros(len(found.at), bool)
                ends = np.searchsorted(found.text, np.arange(last - first + 1))
                for i in range(last - first):
                    if lists[first + i].is_valid and ends[i + 1] > ends[i]:
                        wanted = np.asarray(lists[first + i].values, np.int64).view(np.uint64)
                        kept[ends[i] : ends[i + 1]] = np.isin(found.cut[ends[i] : ends[i + 1]], wanted)
                text = found.text[kept]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.cut[kept].view(np.int64)),
                        pa.array(found.hash[kept].view(np.int64)),
                        pa.array(rows[first + text]),
                        pa.array((found.at[kept] - found.bounds[text]).astype(np.int32)),
                    ],
                    names=["cut", "hash", "row_at", "at"],
                )

    return run


def _kept(window: int):
    """Cover the repeated windows and join what is left."""

    def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
        totals, removed, left = [], [], []
        repeated = batch.column("repeated") if "repeated" in batch.schema.names else None
        for i, text in enumerate(batch.column("text")):
            words = text.as_buffer().to_pybytes().split() if text.is_valid else []
            gone = 0
            totals.append(len(words))
            if repeated is not None and repeated[i].is_valid and len(repeated[i]):
                starts = np.asarray(repeated[i].values, np.int64)
                edges = np.zeros(len(words) + 1, np.int64)
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + window, -1)
                free = np.cumsum(edges[:-1]) == 0
                gone = len(words) - int(free.sum())
                words = [words[j] for j in np.flatnonzero(free).tolist()]
            removed.append(gone)
            left.append(b" ".join(words))
        return pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("text"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(left, pa.binary()).cast(pa.string())],
            names=["row", "text", "n_words", "n_removed", "kept"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_AT_ONCE):
                yield kept(batch.slice(first, ROWS_AT_ONCE))

    return run


def without_repeats(docs: DataFrame, window: int = WINDOW, scratch: Scratch | None = None) -> DataFrame:
    """Each row of ``docs`` with what is left of its ``text`` after the repeated windows.

    Returns (row, text, n_words, n_removed, kept): ``row`` is the struct of the other
    columns, whatever their names. Words are runs without ASCII white space, unchanged;
    every word in a window of ``window`` words that also starts anywhere else, in any
    row, goes. Repeated rows repeat each other's windows. A null, empty or short text
    loses nothing.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "substring")
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    texts = docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    counted = texts.mapInArrow(releasing(_cuts(window, False)), "cut long, n long").groupBy("cut").agg(F.sum("n").alias("n"))
    again = scratch.written(counted.filter("n > 1").select("cut"), "again")
    owners = texts.mapInArrow(releasing(_cuts(window, True)), "cut long, key long")
    lists = scratch.written(owners.join(again, "cut").groupBy("key").agg(F.collect_set("cut").alias("cuts")), "lists")
    sent = spark.sparkContext.broadcast(filter_words(lists, "key", lists.count()))
    row_type = rows.schema["row"].dataType
    plain_rows = T.StructType([T.StructField("row", row_type), T.StructField("text", T.StringType()), T.StructField("key", T.LongType())])
    whole = scratch.written(
        rows.mapInArrow(releasing(_in_question(sent, True)), plain_rows).join(lists, "key", "left").drop("key").withColumn("row_at", F.monotonically_increasing_id()),
        "in-question",
    )
    held = whole.filter("cuts is not null").select("text", "cuts", "row_at").mapInArrow(releasing(_windows(window)), "cut long, hash long, row_at long, at int")
    repeated = scratch.written(held.groupBy("cut", "hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated")
    found = weighted_lookup(held, repeated, ["cut", "hash"], "n", "row_at")  # a window of very many rows goes to several tasks
    places = found.groupBy("row_at").agg(F.collect_list("at").alias("repeated"))
    out = T.StructType(
        [T.StructField("row", row_type), T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
    )
    changed = whole.select("row", "text", "row_at").join(places, "row_at", "left").select("row", "text", "repeated").mapInArrow(releasing(_kept(window)), out)
    look, keep = _in_question(sent, False), _kept(window)
    untouched = rows.mapInArrow(releasing(lambda batches: keep(look(batches))), out)  # one worker for both steps
    return changed.unionByName(untouched)


def cleaned(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text`` and ``n_chars`` counted again where something went.

    Every row stays, null ids and texts and repeated rows included (which lose each other's windows); texts that
    lose nothing stay as they are, white space included. An empty table gives none.
    """
    found = without_repeats(docs, window)
    lost = F.col("n_removed") > 0
    text = F.when(lost, F.col("kept")).otherwise(F.col("text"))
    columns = {c: F.col("row").getField(c) for c in docs.columns if c != "text"} | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(lost, F.char_length("kept").cast("long")).otherwise(columns["n_chars"])
    return found.select(*[columns[c].alias(c) for c in docs.columns])
