"""Exact inner-product search by aggregation of sorted lists without random access.

A block of vectors is one sorted list for each component. A query reads a list from
its upper end where its own component is positive, from its lower end where it is
negative. After each depth every vector has a lower bound (what was read, plus the
least that the rest can add) and an upper bound (what was read, plus the values at
the reading points). Vectors whose upper bound is below the k-th lower bound are out;
reading stops when the others are few, and their scores are resolved. The bounds of
many queries are matrix products over one block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4_096  # vectors in one block
QUERY_BLOCK = 2_048  # queries that meet a block in one task row
AT_ONCE = 128  # queries whose bounds are held together
DEPTHS = (0.25, 0.5, 0.75)  # of the lists, after which bounds are compared
ENDS = 2.0**63
ROUNDING = 2.0**-44  # share of the largest product that bounds may be wrong by, for each component


def scaled(column: str, factor: int = 256):
    """floor(factor * x) of each component as long; null where a component is null or not finite."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(column, lambda x: F.floor(x.cast("double") * factor))
    return F.when(F.col(column).isNotNull() & ~bad, whole)


def products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Whole inner products; beyond the range of long they are its ends."""
    if len(vectors) and len(query) * float(np.abs(vectors.astype(np.float64)).max()) * float(np.abs(query.astype(np.float64)).max()) >= 2.0**62:
        exact = [sum(x * y for x, y in zip(v, query.tolist(), strict=True)) for v in vectors.tolist()]
        return np.array([max(-(1 << 63), min((1 << 63) - 1, x)) for x in exact], np.int64)
    return vectors.astype(np.int64) @ query.astype(np.int64)


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple]:
    """The k best of one block for each query: (query_id, vec_id, score), ties to smaller ids."""
    n, width = vectors.shape
    order = np.argsort(vectors, axis=0, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(n)[:, None], order.shape), axis=0)
    listed = np.take_along_axis(vectors, order, axis=0)
    real = vectors.astype(np.float64)
    reach = float(np.abs(real).max(initial=0))
    ends = np.concatenate([listed[0], listed[-1]]).astype(np.float64)
    out = []
    for first in range(0, len(queries), AT_ONCE):
        asked = queries[first : first + AT_ONCE].astype(np.float64)
        up, down = np.maximum(asked, 0), np.minimum(asked, 0)
        alive = np.ones((len(asked), n), bool)
        for depth in DEPTHS:
            read = int(n * depth)
            if n <= 4 * k or read == 0 or alive.mean() < 0.05:
                break
            high, low = place >= n - read, place < read  # read from the upper end, from the lower end
            known = up @ np.where(high, real, 0).T + down @ np.where(low, real, 0).T
            # What is unread lies between the reading point and the other end of its list.
            most = known + up @ np.where(high, 0, listed[n - read].astype(np.float64)).T + down @ np.where(low, 0, listed[read - 1].astype(np.float64)).T
            least = known + up @ np.where(high, 0, ends[:width]).T + down @ np.where(low, 0, ends[width:]).T
            own = ids[None, :] == query_ids[first : first + AT_ONCE, None]
            least[own] = -np.inf
            bar = np.partition(least, n - k, axis=1)[:, n - k]
            slack = width * reach * np.abs(asked).max(axis=1, initial=0) * ROUNDING  # of the sums in most and least
            # Scores end at the range of long, and what is beyond either end is equal there.
            alive &= np.maximum(most, -ENDS) >= (np.minimum(bar, ENDS) - slack)[:, None]
        for i in range(len(asked)):
            left = np.flatnonzero(alive[i])
            scores = products(vectors[left], queries[first + i])
            keep = ids[left] != query_ids[first + i]
            left, scores = left[keep], scores[keep]
            if len(scores) > k:
                bar = np.partition(scores, len(scores) - k)[len(scores) - k]
                chosen = np.flatnonzero(scores >= bar)
                left, scores = left[chosen], scores[chosen]
            best = np.lexsort((ids[left], -scores))[:k]
            out += [(int(query_ids[first + i]), int(ids[left[j]]), int(scores[j])) for j in best]
    return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (side, group, id, vec) of one partition to blocks: ids and components as bytes."""
    kept: dict[tuple[int, int], list] = {}

    def block(side: int, width: int) -> pa.RecordBatch:
        rows = kept.pop((side, width))
        ids, vectors = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
        return pa.RecordBatch.from_pydict(
            {"side": pa.array([side], pa.int32()), "width": pa.array([width], pa.int32()), "ids": [ids.astype("<i8").tobytes()], "vecs": [vectors.astype("<i8").tobytes()]}
        )

    for batch in batches:
        side, ids = batch.column("side").to_numpy(), batch.column("vec_id").to_numpy()
        lists = batch.column("vec")
        widths = np.diff(lists.offsets.to_numpy())
        flat, starts = lists.values.to_numpy(), lists.offsets.to_numpy()[:-1]
        for s, w in {*zip(side.tolist(), widths.tolist(), strict=True)}:
            rows = np.flatnonzero((side == s) & (widths == w))
            most = QUERY_BLOCK if s else BLOCK
            vectors = flat[starts[rows][:, None] + np.arange(w)]
            for first in range(0, len(rows), most):
                own = kept.setdefault((s, w), [])
                own.append((ids[rows[first : first + most]], vectors[first : first + most]))
                if sum(len(r[0]) for r in own) >= most:
                    yield block(s, w)
    for s, w in list(kept):
        yield block(s, w)


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for width, ids, vecs, q_ids, qs in zip(
                *(batch.column(c).to_pylist() for c in ("width", "ids", "vecs", "query_ids", "queries")), strict=True
            ):
                if width:
                    out += search_block(
                        np.frombuffer(ids, "<i8"), np.frombuffer(vecs, "<i8").reshape(-1, width), np.frombuffer(q_ids, "<i8"), np.frombuffer(qs, "<i8").reshape(-1, width), k
                    )
                else:
                    ids, q_ids = np.sort(np.frombuffer(ids, "<i8")), np.frombuffer(q_ids, "<i8")
                    out += [(int(q), int(i), 0) for q in q_ids for i in ids[ids != q][:k]]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64()) for c in range(3)], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query, ties to the smaller id.

    Both tables have ``vec_id`` and ``vec``, an array of long. Rows with a null id or
    vector take no part; vectors are compared with those of equal length; a query
    meets every vector but those of its own id. Of rows repeated in ``queries`` one
    counts; candidates are rows, and a repeated row is listed again. Other columns are
    ignored, and an empty table gives no rows.
    """
    spark = vectors.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)

    def blocks(df: DataFrame, side: int) -> DataFrame:
        rows = df.select(F.lit(side).alias("side"), F.col("vec_id").cast("long"), F.col("vec").cast("array<bigint>"))
        return rows.mapInArrow(_pack, "side int, width int, ids binary, vecs binary")

    known = "vec_id is not null and vec is not null"
    asked = blocks(queries.filter(known).dropDuplicates(["vec_id"]).repartition(1 if parts < 8 else parts // 8), 1)
    cells = F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int")
    left = blocks(vectors.filter(known), 0).withColumn("cell", cells)
    # Every block of queries goes to every cell of vectors: a grid, each cell a task's work.
    right = asked.select("width", F.col("ids").alias("query_ids"), F.col("vecs").alias("queries"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("cell"))
    # A merge join, as blocks of queries grow with the table and may have to spill.
    found = left.join(right.hint("merge"), ["cell", "width"]).select("width", "ids", "vecs", "query_ids", "queries").mapInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
