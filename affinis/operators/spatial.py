"""Spatial statistics over tables of points, edges and values.

Edges are rows (i, j, w): j is a neighbour of i with weight w. Values are rows (id, value);
ids are unique. Rows with a null id or a null or non-finite number take no part, nor do edges
from or to them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinis.functions.vectors import cosine, norm_l2
from affinis.operators.joins import attached, salted_lookup, weighted_lookup
from affinis.operators.ordering import RANGE, in_ranges, positions, positions_in_ranges, running_total, split_points
from affinis.session import written

CELL_PLACES = 2_048  # places in a cell of the finest grid, unless places are too close for a finer one
BLOCK = 1_024  # places of a cell that one join key holds
PERMUTATIONS = 99
SEED = 42
DIGITS = 9  # of statistics that are compared with permuted ones
RANGE_NODES = 20_000  # nodes of a permutation that are put in order together
TASK_DRAWS = 1_000_000  # draws, a node's in one permutation, that one task hashes or puts in order
CONTINUE = 4  # by how much a round's cells are wider than those before


def finite(*columns: str) -> Column:
    tests = [F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & (F.abs(F.col(c).cast("double")) < float("inf")) for c in columns]
    return reduce(lambda a, b: a & b, tests)


# -- neighbours ---------------------------------------------------------------


def _places(points: DataFrame, k: int) -> DataFrame:
    """(px, py, ids, n_members): distinct places; of the points at one place only the k + 1 smallest ids can be a neighbour."""
    at = Window.partitionBy("px", "py").orderBy("id")
    few = points.withColumn("r", F.row_number().over(at)).filter(F.col("r") <= k + 1)
    ids = few.groupBy("px", "py").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return ids.join(points.groupBy("px", "py").agg(F.count(F.lit(1)).alias("n_members")), ["px", "py"])


def _in_cells(df: DataFrame, size: float) -> DataFrame:
    """Add cell numbers; ``size`` is a power of two, so the division is exact."""
    return df.withColumn("cx", F.floor(F.col("px") / size)).withColumn("cy", F.floor(F.col("py") / size))


def _finest(places: DataFrame, n: int, span: float, reach: float) -> float:
    """A size of cells that hold a few places on average, and CELL_PLACES at most if numbers are fine enough."""
    least = 2.0 ** (math.frexp(reach or 1.0)[1] - 48)
    size = max(least, 2.0 ** (math.frexp(span / max(1.0, math.sqrt(n / 4)))[1] - 1)) if span else 1.0
    while size > least and span:
        fullest = _in_cells(places, size).groupBy("cx", "cy").count().agg(F.max("count")).first()[0]
        if fullest <= CELL_PLACES:
            break
        size = max(least, size / 4)
    return size


def _best(asked: DataFrame, places: DataFrame, size: float, k: int) -> DataFrame:
    """(px, py, found): the k + 1 nearest ids, as (d2, id), among the places in the three by three cells about each place asked."""
    cells = _in_cells(places, size)
    sizes = written(cells.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n")), "cells")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    held = weighted_lookup(cells.select("px", "py", "ids", "cx", "cy"), sizes, ["cx", "cy"], "n", "px").select(
        F.col("px").alias("hx"), F.col("py").alias("hy"), "ids", "cx", "cy", F.pmod(F.xxhash64("px", "py"), blocks).cast("int").alias("block")
    )
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    about = _in_cells(asked.select("px", "py"), size).withColumn("step", F.explode(steps))
    about = about.select("px", "py", (F.col("cx") + F.col("step.a")).alias("cx"), (F.col("cy") + F.col("step.b")).alias("cy"))
    wanted = salted_lookup(about, sizes, ["cx", "cy"], "px").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("n")
    dx, dy = F.col("px") - F.col("hx"), F.col("py") - F.col("hy")
    pairs = wanted.join(held, ["cx", "cy", "block"]).select("px", "py", (dx * dx + dy * dy).alias("d2"), F.explode("ids").alias("id"))
    order = Window.partitionBy("px", "py").orderBy("d2", "id")
    first = pairs.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
    return first.groupBy("px", "py").agg(F.sort_array(F.collect_list(F.struct("d2", "id"))).alias("found"))


def nearest_neighbours(points: DataFrame, k: int, entity: str = "id", x: str = "x", y: str = "y") -> DataFrame:
    """Edges (i, j, rank, distance, w) to the k nearest other points, ties to the smaller id; w is one over their number.

    Places are put into a grid. A place looks at the cells about its own; it is done
    when its last neighbour is nearer than anything outside them can be, and the others go on
    with wider cells. A place with few others in reach has few like it about, so wide
    cells full of places are only met by few. Points at one place are one
    place with the ids that can be neighbours, and a full cell is cut into blocks.
    """
    if k <= 0:
        raise ValueError(f"k must be positive, got {k}")
    plain = points.select(F.col(entity).alias("id"), (F.col(x).cast("double") + 0.0).alias("px"), (F.col(y).cast("double") + 0.0).alias("py"))
    plain = written(plain.filter(F.col("id").isNotNull() & finite("px", "py")), "points")
    places = written(_places(plain, k), "places")
    box = places.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{name}_{c}") for c in ("px", "py") for name, f in (("low", F.min), ("high", F.max))]).first()
    span = max(box.high_px - box.low_px, box.high_py - box.low_py) if box.n else 0.0
    reach = max(abs(v) for v in (box.low_px, box.high_px, box.low_py, box.high_py)) if box.n else 0.0
    size, asked, done = _finest(places, box.n, span, reach), places, []
    while True:
        last = size >= span
        found = written(_best(asked, places, size, k), "nearest")

        def room(c: str, size: float = size) -> Column:
            inside = F.col(c) - F.floor(F.col(c) / size) * size
            return size + F.least(inside, size - inside)

        safe = F.least(room("px"), room("py"))
        proved = (F.size("found") == k + 1) & (F.col("found")[k]["d2"] < safe * safe * (1 - 1e-12))
        done.append(found if last else found.filter(proved))
        if last:
            break
        asked = written(found.filter(~proved).select("px", "py"), "open")
        if asked.isEmpty():
            break
        size *= CONTINUE
    every = reduce(DataFrame.unionAll, done)
    lists = every.join(places.select("px", "py", "n_members"), ["px", "py"])
    members = weighted_lookup(plain, lists, ["px", "py"], "n_members", "id")
    own = members.select("id", F.slice(F.filter("found", lambda f: f["id"] != F.col("id")), 1, k).alias("others"))
    edges = own.select(F.col("id").alias("i"), F.size("others").alias("m"), F.posexplode("others").alias("at", "f"))
    return edges.select("i", F.col("f.id").alias("j"), (F.col("at") + 1).alias("rank"), F.sqrt("f.d2").alias("distance"), (1.0 / F.col("m")).alias("w"))


# -- autocorrelation ----------------------------------------------------------


def row_standardised(edges: DataFrame) -> DataFrame:
    """Edges with weights that sum to one for each i; nodes without weight lose their edges."""
    sums = edges.groupBy("i").agg(F.sum("w").alias("__sum"), F.count(F.lit(1)).alias("__rows")).filter(F.col("__sum") != 0)
    return weighted_lookup(edges, written(sums, "degrees"), ["i"], "__rows", "j").select("i", "j", (F.col("w") / F.col("__sum")).alias("w"))


def _nodes(values: DataFrame, entity: str, value: str) -> DataFrame:
    """(id, position, z): deviations from the mean, numbered in the order of ids."""
    own = values.select(F.col(entity).alias("id"), F.col(value).cast("double").alias("v")).filter(F.col("id").isNotNull() & finite("v"))
    own = written(own, "values")
    mean = own.agg(F.avg("v").alias("mean"))
    return written(positions(own, ["id"]).join(F.broadcast(mean)).select("id", "position", (F.col("v") - F.col("mean")).alias("z")), "nodes")  # one row


def shuffled(nodes: DataFrame, permutations: int, seed: int) -> DataFrame:
    """(id, z, drawn): for each permutation which node's value the id gets, as (source, z); the first is its own.

    A permutation is the order of hashes of (seed, permutation, id): no state, and the
    same on every run. Hashes are even, so their leading digits are ranges of about
    equal size, and as many of them as the counted nodes need.
    """
    n = nodes.count()
    tasks, ranges = max(1, -(-n * permutations // TASK_DRAWS)), max(1, -(-n // RANGE_NODES))
    keyed = nodes.select("id").repartition(tasks, "id").select("id", F.explode(F.sequence(F.lit(1), F.lit(permutations))).alias("perm"))
    digits = F.md5(F.concat_ws(":", F.lit(seed), "perm", "id"))
    leading = F.conv(F.substring(digits, 1, 8), 16, 10).cast("bigint")
    hashed = keyed.select("id", "perm", F.unhex(digits).alias("h"), F.floor(leading * ranges / (1 << 32)).alias(RANGE))
    placed = positions_in_ranges(hashed.repartition(tasks, "perm", RANGE), ["h", "id"], ["perm"]).select("id", "perm", "position")
    got = placed.join(nodes.select("position", F.col("id").alias("source"), "z"), "position").select("id", "perm", "source", "z")
    every = got.unionByName(nodes.select("id", F.lit(0).alias("perm"), F.col("id").alias("source"), "z"))
    lists = every.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("perm", "source", "z"))).alias("drawn"))
    return written(nodes.select("id", "z").join(lists, "id"), "shuffled")


def _both_ends(edges: DataFrame, drawn: DataFrame) -> DataFrame:
    """Edges with what is drawn for both nodes; a node of very many edges is spread over salts."""
    left = drawn.select(F.col("id").alias("i"), F.col("z").alias("z_i"), F.col("drawn").alias("drawn_i"))
    right = drawn.select(F.col("id").alias("j"), F.col("drawn").alias("drawn_j"))
    return attached(written(attached(edges, left, "i", "j"), "left"), right, "j", "i")


def _p_value(at_least: Column, permutations: int) -> Column:
    """Share of permutations as far out as the observed value, on its side, the observed one included."""
    return (F.least(at_least, permutations - at_least) + 1) / F.lit(float(permutations + 1))


def global_moran(edges: DataFrame, values: DataFrame, entity: str = "id", value: str = "value", permutations: int = PERMUTATIONS, seed: int = SEED) -> DataFrame:
    """One row (n, moran_i, expected, p_value): Moran's index of the values over the edges as they are weighted.

    NULL where it is undefined: without edges or without variance.
    """
    nodes = _nodes(values, entity, value)
    totals = nodes.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("z") * F.col("z")).alias("ss"))
    ends = _both_ends(edges.filter(finite("w")), shuffled(nodes, permutations, seed))
    product = F.zip_with("drawn_i", "drawn_j", lambda a, b: F.struct(a["perm"].alias("perm"), (F.col("w") * a["z"] * b["z"]).alias("c")))
    sums = ends.select("w", F.explode(product).alias("p")).groupBy("p.perm").agg(F.sum("p.c").alias("c"), F.sum("w").alias("s0"))
    index = F.round(F.try_divide(F.col("n") * F.col("c"), F.col("s0") * F.col("ss")), DIGITS)
    each = written(sums.join(F.broadcast(totals)).select("perm", "n", index.alias("index")), "indexes")  # one row for each permutation
    seen = each.filter("perm = 0").select(F.col("index").alias("moran_i"))
    counted = each.filter("perm > 0").join(F.broadcast(seen)).agg(F.first("moran_i").alias("moran_i"), F.count_if(F.col("index") >= F.col("moran_i")).alias("above"))
    return totals.join(F.broadcast(counted)).select(
        "n", "moran_i", F.try_divide(F.lit(-1.0), F.col("n") - 1).alias("expected"), F.when(F.col("moran_i").isNotNull(), _p_value(F.col("above"), permutations)).alias("p_value")
    )


def benjamini_hochberg(df: DataFrame, p: str, spread: str, name: str = "p_adjusted") -> DataFrame:
    """Add adjusted p-values of the step-up rule: the least of p * n / rank over this and all larger p.

    Equal values are counted together; the running minimum from the upper end is made in
    ranges, whose minima alone are put together. A NULL p is left out and stays NULL.
    """
    counted = written(df.filter(F.col(p).isNotNull()).groupBy(p).agg(F.count(F.lit(1)).alias("__m")), "p-values")
    total = counted.agg(F.coalesce(F.sum("__m"), F.lit(0))).first()[0]
    raw = F.col(p) * total / (F.col("__below") + F.col("__m"))
    ranked = written(running_total(counted, [p], "__m", "__below").select(p, "__m", raw.alias("__raw")), "ranked")
    ranged = in_ranges(ranked, [p], split_points(ranked, [p], [p]))
    after = Window.orderBy(F.desc(RANGE)).rowsBetween(Window.unboundedPreceding, -1)
    later = ranged.groupBy(RANGE).agg(F.min("__raw").alias("__least")).select(RANGE, F.min("__least").over(after).alias("__later"))  # one row for each range
    local = Window.partitionBy(RANGE).orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    adjusted = ranged.withColumn("__own", F.min("__raw").over(local)).join(F.broadcast(later), RANGE)
    table = written(adjusted.select(p, "__m", F.least("__own", "__later", F.lit(1.0)).alias(name)), "adjusted")
    known = weighted_lookup(df.filter(F.col(p).isNotNull()), table, [p], "__m", spread).select(*df.columns, name)
    return known.unionByName(df.filter(F.col(p).isNull()).withColumn(name, F.lit(None).cast("double")))


def _lags(edges: DataFrame, drawn: DataFrame, permutations: int) -> DataFrame:
    """(id, lags): the weighted sums of what the neighbours have drawn, by permutation.

    An edge stays one row: its share of each permutation's sum is a column of its own, and so is
    the weight of neighbours that have drawn the node's value and get what the node has drawn.
    """
    of_j = drawn.select(F.col("id").alias("j"), F.col("drawn.source").alias("sources"), F.col("drawn.z").alias("values"))
    each = range(permutations + 1)
    back = [(F.col("sources")[p] == F.col("i")) & F.lit(p > 0) for p in each]
    sums = attached(edges, of_j, "j", "i").groupBy(F.col("i").alias("id")).agg(
        *[F.sum(F.when(back[p], 0.0).otherwise(F.col("w") * F.col("values")[p])).alias(f"s{p}") for p in each],
        *[F.sum(F.when(back[p], F.col("w")).otherwise(0.0)).alias(f"b{p}") for p in each],
    )
    lags = F.array(*[F.col(f"s{p}") + F.col(f"b{p}") * F.col("values")[p] for p in each])
    return sums.join(drawn.select("id", F.col("drawn.z").alias("values")), "id").select("id", lags.alias("lags"))


def _lags_of_repeats(edges: DataFrame, drawn: DataFrame) -> DataFrame:
    """:func:`_lags` where ids repeat, so that lists of draws differ in length and are met place by place."""
    part = F.zip_with(
        "drawn_i",
        "drawn_j",
        lambda a, b: F.struct(a["perm"].alias("perm"), (F.col("w") * F.when((b["source"] == F.col("i")) & (b["perm"] > 0), a["z"]).otherwise(b["z"])).alias("c")),
    )
    sums = _both_ends(edges, drawn).select("i", F.explode(part).alias("p")).groupBy("i", "p.perm").agg(F.sum("p.c").alias("lag"))
    each = F.sort_array(F.collect_list(F.struct("perm", "lag")))
    return sums.groupBy(F.col("i").alias("id")).agg(F.transform(each, lambda x: x["lag"]).alias("lags"))


def local_moran(edges: DataFrame, values: DataFrame, entity: str = "id", value: str = "value", permutations: int = PERMUTATIONS, seed: int = SEED) -> DataFrame:
    """(id, z, lag, local_i, quadrant, p_value, p_adjusted) of every node with a value.

    Quadrants: 1 high among high, 2 low among high, 3 low among low, 4 high among low. A
    permutation shuffles the values of all nodes but the one in question: where a neighbour
    has drawn its value, the neighbour gets what it would have drawn itself. Nodes without
    a neighbour have NULL in lag and all that follows.
    """
    nodes = _nodes(values, entity, value)
    variance = nodes.agg(F.avg(F.col("z") * F.col("z")).alias("m2"))
    drawn, weighted = shuffled(nodes, permutations, seed), written(row_standardised(edges.filter(finite("w"))), "weighted")
    unique = nodes.select("id").distinct().count() == nodes.count()
    lags = _lags(weighted, drawn, permutations) if unique else _lags_of_repeats(weighted, drawn)
    score = nodes.join(lags, "id", "left").join(F.broadcast(variance)).withColumn("lag", F.col("lags")[0])  # one row
    scores = F.transform("lags", lambda x: F.round(F.try_divide(F.col("z") * x, F.col("m2")), DIGITS))
    above = F.size(F.filter("scores", lambda s: s >= F.col("scores")[0])) - 1
    high, around = F.col("z") > 0, F.col("lag") > 0
    quadrant = F.when(F.col("lag").isNotNull(), F.when(high & around, 1).when(~high & around, 2).when(~high, 3).otherwise(4))
    tested = score.withColumn("scores", scores).select(
        "id", "z", "lag", F.col("scores")[0].alias("local_i"), quadrant.alias("quadrant"), F.when(F.col("scores")[0].isNotNull(), _p_value(above, permutations)).alias("p_value")
    )
    return benjamini_hochberg(written(tested, "local"), "p_value", "id")


# -- similarity of neighbours -------------------------------------------------


def neighbour_similarity(edges: DataFrame, vectors: DataFrame, entity: str = "id", vector: str = "vector") -> DataFrame:
    """One row (n_edges, neighbour_mean, n_pairs, global_mean): cosine over the edges, and over all pairs of two different rows.

    The mean over all pairs comes from the sum of the unit vectors, whose squared length counts every
    pair twice and every vector once. A zero vector is similar to nothing (0).
    """
    known = vectors.filter(F.col(entity).isNotNull() & F.col(vector).isNotNull()).select(F.col(entity).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    left, right = known.select(F.col("id").alias("i"), F.col("v").alias("u")), known.select(F.col("id").alias("j"), "v")
    pairs = attached(written(attached(edges.select("i", "j"), left, "i", "j"), "pairs"), right, "j", "i")
    near = pairs.agg(F.count(F.lit(1)).alias("n_edges"), F.avg(F.coalesce(cosine(F.col("u"), F.col("v")), F.lit(0.0))).alias("neighbour_mean"))
    unit = known.withColumn("norm", norm_l2(F.col("v"))).filter("norm > 0").select("norm", F.posexplode("v").alias("at", "x"))
    length = unit.groupBy("at").agg(F.sum(F.col("x") / F.col("norm")).alias("s")).agg(F.sum(F.col("s") * F.col("s")).alias("length"))
    count = known.agg(F.count(F.lit(1)).alias("n"), F.count_if(norm_l2(F.col("v")) > 0).alias("ones"))
    n = F.col("n").cast("double")
    overall = count.join(F.broadcast(length)).select(  # one row
        (F.col("n") * (F.col("n") - 1) / 2).cast("bigint").alias("n_pairs"), F.try_divide(F.coalesce("length", F.lit(0.0)) - F.col("ones"), n * (n - 1)).alias("global_mean")
    )
    return near.join(F.broadcast(overall))  # one row
