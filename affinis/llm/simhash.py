"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits are dealt to groups so that bits that go together lie in one group, and
each group gets a threshold of its own. If the thresholds add up to ``distance - groups
+ 1``, two fingerprints within ``distance`` agree in at least one group up to its
threshold (-1: the group is never asked). Number of groups and thresholds are chosen
by dynamic programming on the pairs and probes they are expected to cost, estimated on
a bounded sample of fingerprints. Probes meet in buckets; a bucket yields a forest of
verified links, not all its pairs, and large buckets are met in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinis.llm.scratch import Scratch
from affinis.llm.tasks import releasing
from affinis.operators.joins import weighted_lookup

BITS = 64
DISTANCE = 3
SIZE = 3
SAMPLE = 4_000  # fingerprints the cost estimate is made on; it decides speed, never the result
BLOCK = 1_000  # fingerprints of a bucket in one task row
PROBE_COST = 400.0  # a probe's row, in verified pairs


def fingerprint(text: str | None, size: int = SIZE) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= size:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends[:-1].tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (digest(joined[a:b], 42) for a, b in zip(starts, (ends[size - 1 :] - 1).tolist(), strict=False)),
            np.uint64,
            len(words) - size + 1,
        )
    ones = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), 1 << 16):
        part = hashes[first : first + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), size) for t in batch.column("text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return run


def fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(releasing(_fingerprints(size)), "doc_id long, print long")


def bit_groups(sample: np.ndarray, groups: int) -> list[list[int]]:
    """Deal the bits to groups of about equal size, correlated bits together."""
    bits = np.unpackbits(sample.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    spread = bits.std(0)
    scaled = np.divide(bits - bits.mean(0), spread, out=np.zeros_like(bits), where=spread > 0)
    tied = np.abs(scaled.T @ scaled) / max(1, len(bits))
    free, out = list(range(BITS)), []
    for g in range(groups):
        want = len(free) // (groups - g)
        own = [free.pop(0)]
        while len(own) < want:
            best = max(free, key=lambda b: (tied[b, own].sum(), -b))
            free.remove(best)
            own.append(best)
        out.append(sorted(own))
    return out


def packed(prints: np.ndarray, bits: list[int]) -> np.ndarray:
    out = np.zeros(len(prints), np.uint64)
    for place, bit in enumerate(bits):
        out |= ((prints >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return out


def expected_costs(sample: np.ndarray, groups: list[list[int]], total: int, distance: int) -> np.ndarray:
    """Cost by group and threshold -1 .. distance: pairs to verify and probes, for ``total`` fingerprints."""
    costs = np.zeros((len(groups), distance + 2))
    pairs_seen = max(1.0, len(sample) * (len(sample) - 1) / 2)
    for g, bits in enumerate(groups):
        part = packed(sample, bits)
        near = np.zeros(distance + 1)
        for first in range(0, len(part), 500):
            apart = np.bitwise_count(part[first : first + 500, None] ^ part[None, :])
            ahead = np.arange(first, min(first + 500, len(part)))[:, None] < np.arange(len(part))[None, :]
            near += np.bincount(apart[ahead], minlength=BITS + 1)[: distance + 1]
        for t in range(distance + 1):
            chance = sum(comb(len(bits), r) for r in range(t + 1)) / 2.0 ** len(bits)
            share = near[: t + 1].sum() / pairs_seen + chance
            probes = sum(comb(len(bits), r) for r in range(t + 1))
            costs[g, t + 1] = share * total * total / 2 + probes * total * PROBE_COST
    return costs


def allocate(costs: np.ndarray, distance: int) -> tuple[float, list[int]]:
    """Thresholds of least cost that add up to ``distance - groups + 1``."""
    groups = len(costs)
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for g in range(groups):
        after: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for t in range(-1, distance + 1):
                offer = (cost + costs[g, t + 1], [*chosen, t])
                if used + t not in after or offer < after[used + t]:
                    after[used + t] = offer
        best = after
    return best[distance - groups + 1]


def plan_probes(sample: np.ndarray, total: int, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the groups to probe, of least expected cost."""
    offers = []
    for count in range(2, distance + 3):
        groups = bit_groups(sample, count)
        cost, chosen = allocate(expected_costs(sample, groups, total, distance), distance)
        offers.append((cost, [(g, t) for g, t in zip(groups, chosen, strict=True) if t >= 0]))
    return min(offers)[1]


def flips(bits: list[int], most: int) -> list[int]:
    """Masks of up to ``most`` of the bits, on the whole fingerprint."""
    return [sum(1 << b for b in chosen) for r in range(most + 1) for chosen in combinations(bits, r)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _links(distance: int):
    """Forest of the links within a pair of blocks of one bucket: each row holds both blocks' fingerprints."""

    def forest(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
        nodes = np.unique(np.concatenate([left, right]))
        parent = np.arange(len(nodes))
        a_at, b_at = np.searchsorted(nodes, left), np.searchsorted(nodes, right)

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        out = []
        for i, x in zip(a_at.tolist(), left, strict=True):
            for j in b_at[np.bitwise_count(right ^ x) <= distance].tolist():
                r, s = root(i), root(j)
                if r != s:
                    parent[max(r, s)] = min(r, s)
                    out.append((i, j))
        signed = nodes.view(np.int64)
        return [(int(signed[i]), int(signed[j])) for i, j in out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for left, right in zip(batch.column("own"), batch.column("probing"), strict=True):
                links += forest(*(np.asarray(x.values, np.int64).view(np.uint64) for x in (left, right)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )

    return run


def links(prints: DataFrame, scratch: Scratch, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect all that are within ``distance``.

    ``prints`` has one row for each distinct fingerprint, column ``print``.
    """
    total = prints.count()
    share = min(1.0, 2 * SAMPLE / max(1, total))
    drawn = prints.filter(F.pmod(F.xxhash64("print"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).limit(SAMPLE).collect()
    sample = np.array([r.print for r in drawn] or [0], np.int64).view(np.uint64)
    groups = plan_probes(sample, max(1, total), distance)
    own, probing = [], []
    for g, (bits, most) in enumerate(groups):
        mask = _signed(sum(1 << b for b in bits))
        key = F.col("print").bitwiseAND(F.lit(mask))
        own.append(F.struct(F.lit(g).alias("g"), key.alias("key")))
        probing += [F.struct(F.lit(g).alias("g"), key.bitwiseXOR(F.lit(_signed(m))).alias("key")) for m in flips(bits, most)[1:]]
    if not probing:  # only equal keys: a fingerprint's own bucket holds all its partners
        probing_rows = None
    else:
        probing_rows = prints.select("print", F.explode(F.array(*probing)).alias("at")).select("print", "at.*")
    own_rows = prints.select("print", F.explode(F.array(*own)).alias("at")).select("print", "at.*")
    both = own_rows.withColumn("asks", F.lit(False))
    if probing_rows is not None:
        both = both.unionByName(probing_rows.withColumn("asks", F.lit(True)))
    sizes = both.groupBy("g", "key").agg(
        F.sum(F.lit(1) - F.col("asks").cast("int")).alias("n_own"), F.sum(F.col("asks").cast("int")).alias("n_asks")
    )
    # A bucket without an own fingerprint, or with nothing else, has no pair.
    sizes = sizes.filter((F.col("n_own") > 0) & (F.col("n_own") + F.col("n_asks") > 1)).select(
        "g", "key", (F.col("n_own") + F.col("n_asks")).alias("n"), F.ceil(F.col("n_own") / BLOCK).cast("int").alias("rows"), F.ceil((F.col("n_own") + F.col("n_asks")) / BLOCK).cast("int").alias("cols")
    )
    met = weighted_lookup(both, scratch.written(sizes, "sizes"), ["g", "key"], "n", "print")
    place = F.xxhash64("print", F.lit(7))
    row, col = F.pmod(place, F.col("rows")).cast("int"), F.pmod(F.xxhash64("print", F.lit(11)), F.col("cols")).cast("int")
    as_own = (
        met.filter(~F.col("asks"))
        .withColumn("row", row)
        .withColumn("col", F.explode(F.sequence(F.lit(0), F.col("cols") - 1)))
        .withColumn("side", F.lit(0))
    )
    as_probe = met.withColumn("col", col).withColumn("row", F.explode(F.sequence(F.lit(0), F.col("rows") - 1))).withColumn("side", F.lit(1))
    cells = (
        as_own.unionByName(as_probe)
        .groupBy("g", "key", "row", "col")
        .agg(
            F.collect_list(F.when(F.col("side") == 0, F.col("print"))).alias("own"),
            F.collect_list(F.when(F.col("side") == 1, F.col("print"))).alias("probing"),
        )
        .filter((F.size("own") > 0) & (F.size("probing") > 0))
    )
    return cells.select("own", "probing").mapInArrow(releasing(_links(distance)), "a long, b long").distinct()


def smallest_reachable(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, least): the smallest node reachable from each node of ``edges`` (a, b), itself included.

    Rounds of hooking every neighbour to the least one known, until nothing changes;
    a round groups and joins, and no node's neighbours are ever held together: those of
    a node with very many are spread over tasks.
    """
    now = scratch.written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges-0"
    )
    before, turn = None, 0
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n")), f"least-{turn}")
        # Large star: larger neighbours hook to the least; then small star among what is smaller.
        hooked = weighted_lookup(both.filter("v > u"), least, ["u"], "n", "v")
        large = scratch.written(hooked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), f"large-{turn}")
        low = scratch.written(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), f"low-{turn}")
        small = (
            weighted_lookup(large, low, ["u"], "n", "v")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .filter("u <> v")
            .distinct()
        )
        turn += 1
        after = scratch.written(small, f"edges-{turn}")
        state = after.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        for name in ("edges", "least", "large", "low"):
            scratch.drop(f"{name}-{turn - 1}")
        now = after
        if (state.n, state.s) == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("least"))
        before = (state.n, state.s)


def _rooted(docs: DataFrame, distance: int, size: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of every row, and of every distinct one its root, smallest ``doc_id`` and number of rows."""
    prints = scratch.written(fingerprints(docs, size), "prints")
    distinct = scratch.written(prints.groupBy("print").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_rows")), "distinct")
    found = scratch.written(links(distinct.select("print"), scratch, distance), "links")
    hooked = smallest_reachable(found, scratch)
    named = distinct.join(hooked.withColumnRenamed("node", "print"), "print", "left").withColumn("root", F.coalesce("least", "print")).drop("least")
    return prints, scratch.written(named, "named")


def components(docs: DataFrame, distance: int = DISTANCE, size: int = SIZE, scratch: Scratch | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs`` (doc_id, text).

    A null or empty text has fingerprint zero and is linked like any other. A null
    ``doc_id`` keeps its row; it never becomes a ``component_id`` unless all ids of
    the component are null. Repeated rows each give a row. Other columns are ignored.
    """
    scratch = scratch or Scratch(docs.sparkSession, "simhash")
    prints, named = _rooted(docs, distance, size, scratch)
    lowest = scratch.written(named.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n")), "lowest")
    classes = scratch.written(weighted_lookup(named, lowest, ["root"], "n", "print").select("print", "component_id", "n_rows"), "classes")
    return weighted_lookup(prints, classes, ["print"], "n_rows", "doc_id").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _with_prints(size: int):
    """(row, print): the rows as they are, and the fingerprints of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), size) for t in batch.column("text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(prints.view(np.int64))], names=["row", "print"])

    return run


def one_of_each(docs: DataFrame, distance: int = DISTANCE, size: int = SIZE) -> DataFrame:
    """One document of each component, all columns: that with the smallest ``doc_id``.

    Where several rows have that id, the one with the smallest fingerprint stays for the
    component, and rows of one id in several components stay once for each. Rows
    without ``doc_id`` stay: nothing tells which of them to prefer.
    """
    scratch = Scratch(docs.sparkSession, "one")
    prints, named = _rooted(docs.select("doc_id", "text"), distance, size, scratch)
    least = named.filter("first_id is not null").groupBy("root").agg(F.min(F.struct("first_id", "print")).alias("at"))
    kept = scratch.written(least.select(F.col("at.first_id").alias("doc_id"), "at.print"), "kept")
    again = scratch.written(prints.filter("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("doc_id"), "again")
    single = docs.join(kept.select("doc_id").distinct(), "doc_id", "left_semi").join(again, "doc_id", "left_anti").select(*docs.columns)
    # Only rows whose id is on others as well are told apart by their fingerprints.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    shared = docs.join(again, "doc_id", "left_semi").select(whole, "text")
    row_type = T.StructType([T.StructField("row", shared.schema["row"].dataType), T.StructField("print", T.LongType())])
    told = shared.mapInArrow(releasing(_with_prints(size)), row_type).withColumn("doc_id", F.col("row.doc_id").cast("long"))
    first = told.join(kept, ["doc_id", "print"], "left_semi").dropDuplicates(["doc_id", "print"]).select("row.*")
    return single.unionByName(first).unionByName(docs.filter("doc_id is null"))
