"""Product codes of vectors, assigned through memoised grid cells.

A vector is cut into parts, and each part is replaced by its nearest codebook entry.
Parts lie in coarse cells of a grid. For a cell's box every entry has a least and a
greatest distance; an entry whose least distance is above the smallest greatest one is
dominated all over the box and can be nearest to no part in it. A task hashes each
part's cell and keeps the entries that are not dominated, so a cell is worked out once,
and a part is compared with those entries alone. The step of the grid is the cheapest on
a sample; it decides the cost, never the result. All arithmetic is on whole numbers:
rounds of assignment add up sums and counts for each entry, and only these reach the
driver, at most as many as the codebooks have components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinis.llm.scratch import Scratch
from affinis.llm.tasks import releasing
from affinis.llm.words import mix
from affinis.operators.joins import weighted_lookup

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
FIT_VECTORS = 8_192  # of the smallest ids, at most, on which the step of the grid is chosen
TRIED = 128  # of these, whose cells are worked out for it
STEPS = [1 << b for b in range(4, 24, 2)]
BOX_COST = 64.0  # remembering a cell, for each entry, against comparing one part with the entry
MEMO_CELLS = 20_000  # cells that a task remembers; beyond them it begins anew
EXACT = 1 << 52  # squared distances up to here are exact as doubles
LARGEST = (1 << 63) - 1
LIMIT = 1 << 62


def scaled(column: str, factor: int = SCALE):
    """floor(factor * x) of each component as long, at most 2**62 either way; null where a component is null or not finite."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(column, lambda x: F.greatest(F.least(F.floor(x.cast("double") * factor), F.lit(LIMIT)), F.lit(-LIMIT)))
    return F.when(F.col(column).isNotNull() & ~bad, whole)


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of equal width from lists that may be shorter: zeros at the end."""
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    sizes = np.diff(offsets)
    place = np.arange(offsets[-1] - offsets[0]) - np.repeat(offsets[:-1] - offsets[0], sizes)
    out[np.repeat(np.arange(len(lists)), sizes), place] = flat[offsets[0] : offsets[-1]]
    return out


def largest_of(values: np.ndarray) -> int:
    return int(max(abs(int(values.max())), abs(int(values.min())))) if values.size else 0


def cells_of(parts: np.ndarray, step: int) -> np.ndarray:
    """Cells of a grid whose middle cell is centred on zero, so that a wide step has few cells."""
    return (parts + step // 2) // step


class Grid:
    """Nearest entries of one part's codebook, by cells of ``step``."""

    def __init__(self, entries: np.ndarray, step: int):
        self.entries, self.step = entries, step
        self.reach = largest_of(entries)
        self.real = entries.astype(np.float64)
        self.squares = (self.real**2).sum(axis=1)
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        rng = np.random.Generator(np.random.PCG64(7))
        self.odd = rng.integers(0, 1 << 63, max(1, entries.shape[1]), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def candidates(self, cells: np.ndarray) -> list[np.ndarray]:
        """For each cell the entries, in order, that are not dominated across its box."""
        out = []
        for first in range(0, len(cells), 128):
            low = (cells[first : first + 128] * self.step - self.step // 2).astype(np.float64)[:, None]
            high = low + (self.step - 1)
            least = (np.maximum(np.maximum(low - self.real, self.real - high), 0) ** 2).sum(axis=2)
            most = (np.maximum(np.abs(self.real - low), np.abs(self.real - high)) ** 2).sum(axis=2)
            alive = least <= most.min(axis=1)[:, None]
            out += [np.flatnonzero(row) for row in alive]
        return out

    def among(self, parts: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest of the ``chosen`` entries and squared distance; ties to the lower index."""
        best, error = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        for first in range(0, len(parts), 4_096):
            some = parts[first : first + 4_096].astype(np.float64)
            far = (some**2).sum(axis=1)[:, None] - 2 * (some @ self.real[chosen].T) + self.squares[chosen]
            at = far.argmin(axis=1)
            best[first : first + 4_096] = chosen[at]
            error[first : first + 4_096] = far[np.arange(len(at)), at]
        return best, error

    def in_integers(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same over all entries in Python's integers, for components beyond exact doubles."""
        entries = [[int(x) for x in e] for e in self.entries]
        best, error = [], []
        for part in parts.tolist():
            far = [sum((x - y) ** 2 for x, y in zip(part, entry, strict=True)) for entry in entries]
            least = min(far)
            best.append(far.index(least))
            error.append(min(least, LARGEST))
        return np.array(best, np.int64), np.array(error, np.int64)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = max(1, parts.shape[1])
        reach = np.abs(parts).max(axis=1, initial=0)
        # The box of a cell reaches a step beyond its part.
        small = width * (reach.astype(np.float64) + self.reach + self.step) ** 2 < EXACT
        best, error = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
        if not small.all():
            best[~small], error[~small] = self.in_integers(parts[~small])
        rows = np.flatnonzero(small)
        if not len(rows):
            return best, error
        cells = cells_of(parts[rows], self.step)
        keys = mix((cells.astype(np.uint64) * self.odd[: parts.shape[1]]).sum(axis=1, dtype=np.uint64))
        names, first, group = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.known) + len(names) > MEMO_CELLS:
            self.known.clear()
        fresh = [i for i, name in enumerate(names.tolist()) if name not in self.known]
        for i, found in zip(fresh, self.candidates(cells[first[fresh]]), strict=True):
            self.known[int(names[i])] = (cells[first[i]], found)
        every = np.arange(len(self.entries))
        order = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group))
        for i, name in enumerate(names.tolist()):
            own = order[ends[i - 1] if i else 0 : ends[i]]
            cell, chosen = self.known[name]
            same = (cells[own] == cell).all(axis=1)
            for rows_of, among in ((own[same], chosen), (own[~same], every)):  # other cells of the same hash meet all entries
                if len(rows_of):
                    best[rows[rows_of]], error[rows[rows_of]] = self.among(parts[rows[rows_of]], among)
        return best, error


def cheapest_step(entries: np.ndarray, sample: np.ndarray) -> int:
    """The step with the least work for each part: entries that its cell leaves, and new cells to work out.

    New cells are what the second half of the sample has and the first lacks.
    """
    if len(sample) < 2 or largest_of(np.concatenate([sample, entries])) >= STEPS[-1]:
        return STEPS[-1]
    half = len(sample) // 2

    def cost(step: int) -> float:
        _, group = np.unique(cells_of(sample, step), axis=0, return_inverse=True)
        fresh = ~np.isin(group[half:], group[:half])
        left = Grid(entries, step).candidates(cells_of(sample[:TRIED], step))
        return float(np.mean([len(c) for c in left])) + BOX_COST * len(entries) * float(fresh.mean())

    return min(STEPS, key=cost)


def _parts(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return matrix(batch.column("vec"), width).reshape(batch.num_rows, PARTS, width // PARTS)


def _sums(codebooks: list[np.ndarray], steps: list[int], width: int) -> Callable:
    """(part, entry, at, total, n): sums of the parts assigned to each entry, component by component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Grid(c, s) for c, s in zip(codebooks, steps, strict=True)]
        totals = np.zeros((PARTS, len(codebooks[0]), width // PARTS), object)
        counts = np.zeros((PARTS, len(codebooks[0])), np.int64)
        for batch in batches:
            parts = _parts(batch, width)
            for p, grid in enumerate(grids):
                best, _ = grid.nearest(parts[:, p])
                if not len(best):
                    continue
                order = np.argsort(best, kind="stable")
                found, starts = np.unique(best[order], return_index=True)
                own = parts[order, p]
                if largest_of(own) > 1 << 40:
                    own = own.astype(object)
                totals[p, found] += np.add.reduceat(own, starts, axis=0).astype(object)
                counts[p] += np.bincount(best, minlength=len(counts[p]))
        part, entry, at = np.nonzero(np.broadcast_to(counts[:, :, None] > 0, totals.shape))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.int32()),
                pa.array(entry, pa.int32()),
                pa.array(at, pa.int32()),
                pa.array([Decimal(int(x)) for x in totals[part, entry, at]], pa.decimal128(38, 0)),
                pa.array(counts[part, entry], pa.int64()),
            ],
            names=["part", "entry", "at", "total", "n"],
        )

    return run


def _codes(codebooks: list[np.ndarray], steps: list[int], width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Grid(c, s) for c, s in zip(codebooks, steps, strict=True)]
        for batch in batches:
            parts = _parts(batch, width)
            found = [grid.nearest(parts[:, p]) for p, grid in enumerate(grids)]
            codes = np.stack([best for best, _ in found], axis=1).astype(np.uint8)
            errors = [min(sum(map(int, e)), LARGEST) for e in zip(*(error.tolist() for _, error in found), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([row.tobytes().hex() for row in codes], pa.string()), pa.array(errors, pa.int64())],
                names=["vec_id", "label", "code", "error"],
            )

    return run


def fit(kept: DataFrame, width: int, rounds: int = ROUNDS) -> tuple[list[np.ndarray], list[int]]:
    """Codebooks of each part after the rounds, and the steps of their grids. ``kept`` has vec_id and vec."""
    lowest = kept.orderBy(F.asc_nulls_last("vec_id"), "vec").select("vec").limit(FIT_VECTORS).collect()
    first = matrix(pa.array([r.vec for r in lowest], pa.list_(pa.int64())), width).reshape(len(lowest), PARTS, width // PARTS)
    codebooks = [first[:ENTRIES, p].copy() for p in range(PARTS)]
    steps = [cheapest_step(c, first[:, p]) for p, c in enumerate(codebooks)]
    for _ in range(rounds):
        sums = kept.select("vec").mapInArrow(releasing(_sums(codebooks, steps, width)), "part int, entry int, at int, total decimal(38,0), n long")
        # As many rows as the codebooks have components.
        for row in sums.groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
            codebooks[row.part][row.entry, row.at] = int(row.total) // row.n
    return codebooks, steps


def digest(codebooks: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for c in codebooks for x in c.ravel().tolist()).encode()).hexdigest()


def coded(vectors: DataFrame, vector: str = "embedding", scratch: Scratch | None = None) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of the rows with a vector of finite components.

    The table's width is that of its longest vector, made a multiple of four; shorter
    vectors have zeros at the end. Codebooks begin as the smallest ``vec_id`` (null ids
    last; of equal ids the smaller vector first), with fewer entries where there are
    fewer vectors. Repeated rows each count. Components beyond 2**62 after scaling
    count as that, an error beyond the range of long is its largest value. Other columns
    are ignored; without vectors there are no rows.
    """
    scratch = scratch or Scratch(vectors.sparkSession, "codes")
    kept = scratch.written(vectors.select("vec_id", "label", scaled(vector).alias("vec")).filter("vec is not null"), "kept")
    types = {f.name: f.dataType for f in kept.schema.fields}
    out = T.StructType([T.StructField("vec_id", types["vec_id"]), T.StructField("label", types["label"]), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    longest = kept.agg(F.max(F.size("vec"))).first()[0]
    if longest is None:
        none = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
        return none.withColumn("label_error", F.col("error")).withColumn("codebooks_sha256", F.lit("")).limit(0)
    width = -(-longest // PARTS) * PARTS
    codebooks, steps = fit(kept, width)
    found = scratch.written(kept.mapInArrow(releasing(_codes(codebooks, steps, width)), out).withColumn("group", F.to_json(F.struct("label"))), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("bigint")
    groups = scratch.written(found.groupBy("group").agg(total.alias("label_error"), F.count(F.lit(1)).alias("n")), "labels")
    joined = weighted_lookup(found, groups, ["group"], "n", "vec_id")
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))
