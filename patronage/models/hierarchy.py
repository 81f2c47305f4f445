"""Density hierarchy: HDBSCAN (Campello, Moulavi, Sander 2013; McInnes, Healy 2017) by joins.

1. Core distances: the distance to the ``min_samples``-th other point, from pairs of balls.
2. The minimum spanning tree of mutual reachability (the largest of both core distances and the
   distance): pairs of balls are taken up by growing reach, each one once, and give the spanning
   tree of their own points; pairs whose points are all connected already are left out. Union of
   these trees, then rounds of Borůvka.
3. Birth of every point: the distance from which on its component has ``min_cluster_size`` points.
   Small components meet along their lightest edges, in rounds. Points that are born together are
   a seed; all others join the component that their chain of lightest edges leads to.
4. Only the edges between seeds are left. The condensed tree over the seeds, excess of mass and
   the epsilon floor are worked out on them; there is at most one seed for ``min_cluster_size``
   points, and more than MAX_SEEDS are an error. Its tree is small enough for every task.

Merges at one distance are one merge of many, so results do not depend on the order of ties.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.models import ball_cover
from patronage.models.density import connected_components, scaled_axes
from patronage.models.spanning_tree import both_ways, follow, relabelled, spanning_forest
from patronage.operators.ranking import global_row_number
from patronage.session import stored

MAX_SEEDS = 1_000_000
#: Distances count as at least this when they are turned into densities.
LEAST_DISTANCE = 1e-9
#: The reach grows by this factor from stage to stage.
GROWTH = 3.0
#: Rows of a block whose distances are worked out at a time.
STRIP = 64
#: Blocks that a task holds at a time, at most: each of the others moves once for all of them.
HELD = 32
#: Squared distances by a product of matrices are this much of the largest squares off, at most.
ROUNDING = 1e-12


def _matrix(column: pa.Array) -> np.ndarray:
    """A list of coordinate lists as rows."""
    return np.array(column.flatten().to_numpy(zero_copy_only=False), "float64").reshape(len(column), -1)


def _blocks(points: DataFrame, *columns: str) -> DataFrame:
    """One row per leaf with its points, at most as many as a leaf has."""
    packed = points.groupBy("leaf").agg(F.sort_array(F.collect_list(F.struct("id", *columns))).alias("block"))
    return packed.select("leaf", *[F.col(f"block.{c}").alias(c) for c in ("id", *columns)])


def _groups(cover: ball_cover.BallCover) -> DataFrame:
    """(leaf, held): leaves that a task holds together, up to HELD that lie near each other; fewer where
    there would not be four groups for every core."""
    leaves = cover.nodes.where("is_leaf").select("parent", F.col("node").alias("leaf"))
    size = max(1, min(HELD, leaves.count() // (4 * leaves.sparkSession.sparkContext.defaultParallelism)))
    numbered = global_row_number(leaves, [F.asc_nulls_first("parent"), F.asc("leaf")], "place")
    return stored(numbered.select("leaf", F.floor((F.col("place") - 1) / size).alias("held")))


def _streamed(pairs: DataFrame, blocks: DataFrame, groups: DataFrame, either: bool = False) -> DataFrame:
    """Rows (held, near, meets, leaf, other columns of a block) for the pairs (a, b, gap) of different
    leaves: of every group its own blocks first (near -1), then each block that some of them are paired
    with, once, near ones first. ``meets`` lists these (gap, a). With ``either`` any side of a pair may
    be held: one for all pairs of two groups, so that no group has all its pairs to itself."""
    met = pairs.where("a <> b").select("a", "b", "gap")
    for side in ("a", "b"):
        met = met.join(groups.select(F.col("leaf").alias(side), F.col("held").alias(f"{side}_held")), side)
    turned = F.lit(False)
    if either:
        one, other = F.col("a_held"), F.col("b_held")
        turned = (one <= other) != (F.xxhash64(F.least(one, other), F.greatest(one, other)) % 2 == 0)
    met = met.select(
        F.when(turned, F.col("b_held")).otherwise(F.col("a_held")).alias("held"),
        F.struct("gap", F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a")).alias("meet"),
        F.when(turned, F.col("a")).otherwise(F.col("b")).alias("leaf"),
    )
    met = met.groupBy("held", "leaf").agg(F.min("meet.gap").alias("near"), F.collect_list("meet").alias("meets"))
    columns = ["held", "near", "meets", *blocks.columns]
    nothing = F.array().cast("array<struct<gap:double,a:string>>")
    own = blocks.join(groups, "leaf").withColumns({"near": F.lit(-1.0), "meets": nothing})
    both = own.select(columns).unionByName(met.join(blocks, "leaf").select(columns))
    return both.repartition("held").sortWithinPartitions("held", "near", "leaf")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict] | None, dict]]:
    """(held, meets, columns) of the rows of a stream; of a group's own blocks no meets."""
    for batch in batches:
        for row in range(batch.num_rows):
            values = {name: column[row] for name, column in zip(batch.schema.names, batch.columns, strict=True)}
            yield values["held"].as_py(), None if values["near"].as_py() < 0 else values["meets"].as_py(), values


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Every row of ``a`` with every row of ``b``; squares are added axis by axis, as in _apart."""
    found, right = np.empty((len(a), len(b))), np.ascontiguousarray(b.T)
    for start in range(0, len(a), STRIP):
        part = a[start : start + STRIP]
        total = found[start : start + STRIP]
        total[:] = 0
        for axis, other in enumerate(right):
            step = part[:, axis, None] - other
            step *= step
            total += step
    return np.sqrt(found, out=found)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row; the same digits as _distances."""
    total = np.zeros(len(a))
    for axis in range(a.shape[1]):
        step = a[:, axis] - b[:, axis]
        total += step * step
    return np.sqrt(total)


def _meet(away: np.ndarray, weights: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray) -> None:
    """Puts points ``y`` that stand for ``n`` each among the nearest of the points ``x``: rows of
    ``away`` rise, and hold infinity (with weight 0) where less is known.

    A product of matrices tells who may be nearer, loosely enough for its rounding; the distances
    themselves are differences.
    """
    most = away.shape[1]
    one, other = (x * x).sum(axis=1), (y * y).sum(axis=1)
    squares = one[:, None] + other - 2 * (x @ y.T)
    bound = away[:, -1] ** 2
    if len(y) > most and np.isinf(bound).any():
        bound = np.minimum(bound, np.partition(squares, most - 1, axis=1)[:, most - 1])
    loose = ROUNDING * (one.max() + other.max())
    i, j = np.nonzero(squares <= bound[:, None] + loose)
    if not len(i):
        return
    touched, row = np.unique(i, return_inverse=True)
    rows = np.concatenate([np.repeat(np.arange(len(touched)), most), row])
    far = np.concatenate([away[touched].ravel(), _apart(x[i], y[j])])
    order = np.lexsort((far, rows))
    rows = rows[order]
    order = order[np.arange(len(rows)) - np.searchsorted(rows, rows) < most]
    away[touched] = far[order].reshape(-1, most)
    weights[touched] = np.concatenate([weights[touched].ravel(), n[j]])[order].reshape(-1, most)


def _needed(cover: ball_cover.BallCover, count: int) -> DataFrame:
    """Nodes with ``need``: within this distance each of their points has ``count`` points.

    For a leaf with so many of its own, the largest distance that its points need among
    themselves; for a smaller one, two radii of the smallest ball around it that has enough. A ball
    needs what its leaves need.
    """

    def among(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            needs = []
            for x, n in zip(batch.column("x"), batch.column("n"), strict=True):
                weights, away = np.array(n.values), _distances(_matrix(x.values), _matrix(x.values))
                order = np.argsort(away, axis=1, kind="stable")
                reached = np.cumsum(weights[order], axis=1) >= count
                place = np.where(reached.any(axis=1), reached.argmax(axis=1), 0)
                found = np.take_along_axis(away, np.take_along_axis(order, place[:, None], 1), 1).ravel()
                needs.append(float(np.where(reached.any(axis=1), found, np.inf).max()))
            yield pa.RecordBatch.from_arrays([batch.column("leaf"), pa.array(needs, pa.float64())], ["node", "among"])

    own = F.when(F.col("total") >= count, 2 * F.col("radius")).otherwise(F.lit(float("inf")))
    nodes = cover.nodes.withColumn("own", own)
    local = _blocks(cover.points, "n", "x").mapInArrow(among, "node string, among double")
    above, leaves = nodes.where("parent is null").withColumn("need", F.col("own")), None
    for level in range(cover.depth + 1):
        if level:
            known = above.select(F.col("node").alias("parent"), F.col("need").alias("above"))
            above = nodes.where(F.col("level") == level).join(known, "parent").withColumn("need", F.least("own", "above")).select(*nodes.columns, "need")
        part = above.where("is_leaf")
        leaves = part if leaves is None else leaves.unionByName(part)
    every = leaves.join(local, "node").withColumn("need", F.least("need", "among")).select(*nodes.columns, "need")
    every = stored(every)
    for level in range(cover.depth - 1, -1, -1):
        below = every.where(F.col("level") == level + 1).groupBy("parent").agg(F.max("need").alias("need"))
        inner = nodes.where((F.col("level") == level) & ~F.col("is_leaf"))
        every = every.unionByName(inner.join(below.withColumnRenamed("parent", "inner"), F.col("node") == F.col("inner")).select(every.columns))
    return stored(every.drop("own"))


def core_distances(cover: ball_cover.BallCover, min_samples: int) -> DataFrame:
    """(id, core): distance to the ``min_samples``-th point other than the point itself; with fewer
    points, to the last one. Copies at one position count."""
    total = cover.points.agg(F.sum("n")).first()[0] or 0
    wanted = min(min_samples, max(int(total) - 1, 0)) + 1
    bounded = ball_cover.BallCover(cover.points, _needed(cover, wanted), cover.depth)
    pairs = ball_cover.close_leaves(
        bounded, lambda gap, a, b: gap <= F.col(f"{a}need") * (1 + ball_cover.SLACK), ("need",), ordered=True
    )

    id_type = cover.points.schema["id"].dataType.simpleString()

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, {}

        def found() -> Iterator[pa.RecordBatch]:
            for ids, _, away, weights in own.values():
                reached = np.cumsum(weights, axis=1) >= wanted
                core = np.take_along_axis(away, reached.argmax(axis=1)[:, None], 1).ravel()
                full = np.flatnonzero(reached[:, -1])
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(full)), pa.array(core[full])], ["id", "core"])

        for held, meets, block in _rows(batches):
            if held != group:
                yield from found()
                group, own = held, {}
            points, n = _matrix(block["x"].values), np.array(block["n"].values)
            if meets is None:
                away, weights = np.full((len(points), wanted), np.inf), np.zeros((len(points), wanted), "int64")
                _meet(away, weights, points, points, n)
                own[block["leaf"].as_py()] = block["id"].values, points, away, weights
                continue
            for pair in meets:
                _, x, away, weights = own[pair["a"]]
                if pair["gap"] <= away[:, -1].max():
                    _meet(away, weights, x, points, n)
        yield from found()

    return _streamed(pairs, _blocks(cover.points, "n", "x"), _groups(cover)).mapInArrow(nearest, f"id {id_type}, core double")


def _prim(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A minimum spanning tree of a full graph: for every node but the first, the one it hangs on."""
    n = len(weights)
    best, hang, left = weights[0].copy(), np.zeros(n, "int64"), np.ones(n, bool)
    left[0] = False
    for _ in range(n - 1):
        at = int(np.where(left, best, np.inf).argmin())
        if not left[at]:
            at = int(np.flatnonzero(left)[0])
        left[at] = False
        closer = left & (weights[at] < best)
        best[closer], hang[closer] = weights[at][closer], at
    return np.arange(1, n), hang[1:]


def _joined(weights: np.ndarray, trees: tuple[tuple, tuple]) -> tuple[np.ndarray, np.ndarray]:
    """The edges between two sides in a minimum spanning tree of both: ``weights`` of all pairs, and a
    minimum spanning tree (one, other, weight) of each side, which holds all its edges that can matter."""
    sizes = weights.shape
    beside = [[[] for _ in range(size)] for size in sizes]
    for near, tree in zip(beside, trees, strict=True):
        for one, other, weight in zip(*(t.tolist() for t in tree), strict=True):
            near[one].append((other, weight))
            near[other].append((one, weight))
    lines = weights, np.ascontiguousarray(weights.T)
    best = [np.full(size, np.inf) for size in sizes]
    hang = [np.full(size, -1) for size in sizes]  # on the other side, or -1
    left = [np.ones(size, bool) for size in sizes]
    side, at, found = 0, 0, []
    for _ in range(sum(sizes)):
        if left[side][at] and hang[side][at] >= 0:
            found.append((at, hang[side][at]) if side == 0 else (hang[side][at], at))
        left[side][at], best[side][at] = False, np.inf
        line, across = lines[side][at], 1 - side
        closer = np.flatnonzero(left[across] & (line < best[across]))
        best[across][closer], hang[across][closer] = line[closer], at
        for other, weight in beside[side][at]:
            if left[side][other] and weight < best[side][other]:
                best[side][other], hang[side][other] = weight, -1
        ends = [int(b.argmin()) for b in best]
        side = 0 if best[0][ends[0]] <= best[1][ends[1]] else 1
        at = ends[side]
    one, other = np.array(found, "int64").reshape(-1, 2).T
    return one, other


def _with_trees(points: DataFrame) -> DataFrame:
    """One row per leaf: its points and a minimum spanning tree of them (places of both ends, weight)."""
    id_type = points.schema["id"].dataType.simpleString()

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends: list[list[np.ndarray]] = [[], [], []]
            for x, core in zip(batch.column("x"), batch.column("core"), strict=True):
                core = np.array(core.values)
                weights = _distances(_matrix(x.values), _matrix(x.values))
                weights = np.maximum(weights, np.maximum(core[:, None], core[None, :]), out=weights)
                one, other = _prim(weights)
                for held, column in zip(ends, (one, other, weights[one, other]), strict=True):
                    held.append(column)
            kinds = (pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c, pa.list_(k)) for c, k in zip(ends, kinds, strict=True)]],
                [*batch.schema.names, "one", "other", "w"],
            )

    schema = f"leaf string, id array<{id_type}>, x array<array<double>>, core array<double>, one array<long>, other array<long>, w array<double>"
    return _blocks(points, "x", "core").repartition("leaf").mapInArrow(trees, schema)


def _crossing(pairs: DataFrame, blocks: DataFrame, groups: DataFrame) -> DataFrame:
    """(u, v, w) for pairs of leaves: the edges of their common spanning tree that lead from one to the
    other."""
    id_type = blocks.schema["id"].dataType.elementType.simpleString()

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, own = None, {}
        for held, meets, block in _rows(batches):
            if held != group:
                group, own = held, {}
            x, core, ids = _matrix(block["x"].values), np.array(block["core"].values), block["id"].values
            tree = tuple(np.array(block[c].values) for c in ("one", "other", "w"))
            if meets is None:
                own[block["leaf"].as_py()] = ids, x, core, tree
                continue
            for pair in meets:
                near_ids, near_x, near_core, near_tree = own[pair["a"]]
                weights = _distances(near_x, x)
                np.maximum(weights, np.maximum(near_core[:, None], core[None, :]), out=weights)
                one, other = _joined(weights, (near_tree, tree))
                yield pa.RecordBatch.from_arrays(
                    [near_ids.take(pa.array(one)), ids.take(pa.array(other)), pa.array(weights[one, other])], ["u", "v", "w"]
                )

    return _streamed(pairs, blocks, groups, either=True).mapInArrow(trees, f"u {id_type}, v {id_type}, w double")


def reachability_tree(cover: ball_cover.BallCover, core: DataFrame) -> DataFrame:
    """(u, v, w): a minimum spanning tree of mutual reachability over the points of the cover."""
    points = stored(cover.points.join(core, "id"))
    least = points.groupBy("leaf").agg(F.min("core").alias("least"))
    radii = cover.nodes.where("is_leaf").agg(F.expr("percentile_approx(radius, 0.5)"), F.max("radius")).first()
    widest = cover.nodes.where("parent is null").first()["radius"]
    most = points.agg(F.max("core")).first()[0] or 0.0
    reach, before = max(2 * (radii[0] or 0.0), widest / 64), -1.0
    blocks, groups, names = stored(_with_trees(points)), _groups(cover), None
    inner = blocks.select("id", F.inline(F.arrays_zip("one", "other", "w")))
    edges = stored(inner.select(F.col("id")[F.col("one")].alias("u"), F.col("id")[F.col("other")].alias("v"), "w"))
    while True:
        last = reach >= max(2 * widest, most)
        limit = float("inf") if last else reach
        pairs = ball_cover.close_leaves(cover, lambda gap, a, b, limit=limit: gap <= limit).where("a <> b")
        for side in ("a", "b"):
            pairs = pairs.join(least.select(F.col("leaf").alias(side), F.col("least").alias(f"{side}_least")), side)
        weight = F.greatest("gap", "a_least", "b_least")
        pairs = pairs.where((weight <= limit) & (weight > before))
        if names is not None:  # both leaves in one component: no edge of theirs can be in the tree
            ends = points.join(names, points["id"] == names["node"]).groupBy("leaf").agg(F.min("root").alias("low"), F.max("root").alias("high"))
            for side in ("a", "b"):
                pairs = pairs.join(ends.select(F.col("leaf").alias(side), F.col("low").alias(f"{side}_low"), F.col("high").alias(f"{side}_high")), side)
            pairs = pairs.where(~((F.col("a_low") == F.col("a_high")) & (F.col("a_low") == F.col("b_low")) & (F.col("b_low") == F.col("b_high"))))
        edges = stored(edges.unionByName(_crossing(pairs, blocks, groups)))
        if last:
            break
        names = stored(connected_components(points.select(F.col("id").alias("node")), edges.where(F.col("w") <= reach).select("u", "v")))
        if names.agg(F.countDistinct("root")).first()[0] <= 1:
            break
        before, reach = reach, reach * GROWTH
    return spanning_forest(edges)


@dataclass
class Births:
    #: id, n, birth and seed; the last two are null for points that never reach the size.
    points: DataFrame
    #: seed and the distance at which it is born.
    seeds: DataFrame


def births(points: DataFrame, tree: DataFrame, size: int) -> Births:
    """When each of ``points`` (id, n, core) first lies in a component of ``size`` points, and with
    which seed, over the edges (u, v, w) of a spanning tree.

    A component below the size goes with its lightest edge. If the chain of lightest edges ends in
    one that is large, all of the chain join it, each at its own edge's weight, as weights fall
    along the chain. Else the chain ends in two that point at each other: these grow by the others
    of their chain in order of weight until a lighter edge leads elsewhere, or they are large.
    """
    place = F.col("id")
    large = F.col("n") >= size
    state = stored(
        points.select(
            "id", "n", place.alias("c"), F.when(large, F.col("core")).alias("birth"), F.when(large, place).alias("seed")
        )
    )
    live = tree.select(F.col("u").alias("cu"), F.col("v").alias("cv"), "w", F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    while True:
        comps = stored(
            state.groupBy("c").agg(F.sum("n").alias("size"), F.first("seed").alias("seed"))
        )
        open_comps = comps.where("seed is null").select("c", "size")
        live = stored(live.where("cu <> cv"))
        out = both_ways(live, "w", "u", "v").join(open_comps, "c")
        lightest = out.groupBy("c", "size").agg(F.min(F.struct("w", "u", "v", "o")).alias("best")).select("c", "size", "best.*")
        lightest = stored(lightest)
        if lightest.isEmpty():
            break
        roots = follow(lightest.select("c", F.col("o").alias("next")))
        named = lightest.join(roots, "c")
        known = comps.where("seed is not null").select(F.col("c").alias("root"), F.col("seed").alias("root_seed"))
        named = stored(named.join(known, "root", "left"))
        joining = named.where("root_seed is not null").select("c", F.col("w").alias("birth"), F.col("root_seed").alias("seed"))
        growing = named.where("root_seed is null")
        # edges that leave the chain: the other end has another root, or none
        ends = growing.select("c", "root")
        other = ends.select(F.col("c").alias("o"), F.col("root").alias("o_root"))
        leaving = out.select("c", "o", "w").join(ends, "c").join(other, "o", "left")
        leaving = leaving.where(F.col("o_root").isNull() | (F.col("o_root") != F.col("root"))).groupBy("c").agg(F.min("w").alias("leaving"))
        order = Window.partitionBy("root").orderBy("w", "u", "v", "c")
        # the first `size` members decide: each one has a point at least
        first = growing.withColumn("place", F.row_number().over(order)).where(F.col("place") <= max(size, 2)).join(leaving, "c", "left")
        upto = order.rowsBetween(Window.unboundedPreceding, 0)
        earlier = order.rowsBetween(Window.unboundedPreceding, -1)
        first = first.withColumns({"held": F.sum("size").over(upto), "lighter": F.min("leaving").over(earlier)})
        fits = (F.col("place") <= 2) | F.col("lighter").isNull() | (F.col("w") <= F.col("lighter"))
        first = first.withColumn("fits", fits).withColumn("all_fit", F.min("fits").over(upto)).where("all_fit")
        taken = stored(first.select("c", "root", "w", "held"))
        enough = taken.where(F.col("held") >= size).groupBy("root").agg(F.min(F.struct("held", "w")).alias("at"))
        enough = enough.select("root", F.col("at.held").alias("enough"), F.col("at.w").alias("born"))
        ripe = growing.join(enough, "root").join(taken.select("c", "held"), "c", "left")
        born = F.when(F.col("held") <= F.col("enough"), F.col("born")).otherwise(F.col("w"))
        seeded = ripe.select("c", born.alias("birth"), F.col("root").alias("seed"))
        decided = stored(joining.unionByName(seeded))
        merged = taken.join(enough, "root", "left_anti").select("c", F.col("root"))
        merged = stored(merged)
        new = decided.select("c", F.col("birth").alias("new_birth"), F.col("seed").alias("new_seed"))
        state = stored(
            state.join(new, "c", "left").join(merged, "c", "left").select(
                "id",
                "n",
                F.coalesce("root", "c").alias("c"),
                F.coalesce("birth", "new_birth").alias("birth"),
                F.coalesce("seed", "new_seed").alias("seed"),
            )
        )
        live = relabelled(live, merged)
    placed = state.select("id", "n", "birth", "seed")
    return Births(placed, placed.where("seed is not null").groupBy("seed").agg(F.min("birth").alias("born")))


@dataclass
class CondensedTree:
    """Clusters by number: children before parents, the last one is the root."""

    born: list[float] = field(default_factory=list)
    ends: list[float] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    #: seed to its cluster
    cluster_of: dict = field(default_factory=dict)


def condensed_tree(seeds: dict, edges: Sequence[tuple]) -> CondensedTree:
    """The tree over ``seeds`` (name to birth) from the spanning edges (u, v, w) between them. All
    that meets at one distance is one merge; what is born there as well is no cluster of its own."""
    tree, up = CondensedTree(), {s: s for s in seeds}
    cluster: dict = {}
    alias: dict[int, int] = {}

    def find(s):
        while up[s] != s:
            up[s] = up[up[s]]
            s = up[s]
        return s

    def add(born: float) -> int:
        tree.born.append(born)
        tree.ends.append(float("inf"))
        tree.parent.append(-1)
        return len(tree.born) - 1

    for s in sorted(seeds):
        cluster[s] = tree.cluster_of[s] = add(seeds[s])
    by_distance = defaultdict(list)
    for u, v, w in edges:
        by_distance[w].append((u, v))
    for w in sorted(by_distance):
        touched = {find(s) for pair in by_distance[w] for s in pair}
        for u, v in by_distance[w]:
            up[max(find(u), find(v))] = min(find(u), find(v))
        met = defaultdict(list)
        for s in touched:
            met[find(s)].append(cluster[s])
        for s, parts in met.items():
            older = sorted(c for c in parts if tree.born[c] < w)
            younger = sorted(c for c in parts if tree.born[c] >= w)
            if len(older) == 1:
                whole = older[0]
            elif older:
                whole = add(w)
                for c in older:
                    tree.ends[c], tree.parent[c] = w, whole
            else:
                whole = younger.pop(0)
            for c in younger:
                alias[c] = whole
            cluster[s] = whole

    def final(c: int) -> int:
        while c in alias:
            c = alias[c]
        return c

    tree.cluster_of = {s: final(c) for s, c in tree.cluster_of.items()}
    return tree


def chosen_clusters(tree: CondensedTree, counts: dict[int, int], masses: dict[int, float], epsilon: float) -> dict[int, int]:
    """Cluster to the selected cluster it belongs to, by excess of mass and the epsilon floor.

    ``counts`` and ``masses`` hold, for the points that join a cluster while it lasts, their number
    and the sum of their densities (one over birth).
    """
    alive = sorted(set(tree.cluster_of.values()) | set(tree.parent) - {-1})
    parents = {c: tree.parent[c] for c in alive}
    order = sorted(alive, key=lambda c: (tree.ends[c], tree.born[c]))
    kids = defaultdict(list)
    for c in order:
        if parents[c] >= 0:
            kids[parents[c]].append(c)

    def density(d: float) -> float:
        return 0.0 if d == float("inf") else 1 / max(d, LEAST_DISTANCE)

    total, best, taken = {}, {}, {}
    for c in order:
        below = sum(total[k] for k in kids[c])
        total[c] = below + counts.get(c, 0)
        mass = masses.get(c, 0.0) + below * density(tree.born[c]) - total[c] * density(tree.ends[c])
        inner = sum(best[k] for k in kids[c])
        root = parents[c] < 0
        taken[c] = not root and mass >= inner
        best[c] = max(mass, inner)
    selected, todo = set(), [c for c in order if parents[c] < 0]
    while todo:
        c = todo.pop()
        if taken[c]:
            selected.add(c)
        else:
            todo.extend(kids[c])
    if epsilon > 0:
        raised = set()
        for c in selected:
            low = tree.ends[c] < epsilon
            while low and parents[parents[c]] >= 0:
                c = parents[c]
                low = tree.ends[c] <= epsilon
            raised.add(c)
        selected = raised
    label = {}
    for c in reversed(order):
        label[c] = c if c in selected else label.get(parents[c], -1)
    return label


def _clusters_of(births_: Births, tree: CondensedTree) -> DataFrame:
    """Points with ``cluster``: the one that exists around their seed when they are born."""
    spark = births_.points.sparkSession
    shared = spark.sparkContext.broadcast((tree.cluster_of, np.array(tree.ends), np.array(tree.parent)))
    seed_type = births_.points.schema["seed"].dataType.simpleString()

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cluster_of, ends, parent = shared.value
        for batch in batches:
            at = np.array([cluster_of[s] for s in batch.column("seed").to_pylist()], "int64")
            born = np.array(batch.column("birth"), "float64")
            while len(at):
                over = born >= ends[at]
                if not over.any():
                    break
                at[over] = parent[at[over]]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], [*batch.schema.names, "cluster"])

    seeded = births_.points.where("seed is not null").select("id", "n", "birth", "seed")
    return seeded.mapInArrow(climb, f"id {seed_type}, n long, birth double, seed {seed_type}, cluster long")


def hierarchy_clusters(
    points: DataFrame, key: str, dims: int, min_samples: int = 10, min_cluster_size: int = 50, epsilon: float = 0.0
) -> DataFrame:
    """(key, segment) for points with ``dims`` coordinates x0, x1, ...; -1 is noise, clusters are
    numbered from 0 in the order of their smallest key. A single cluster is never selected."""
    axes = [f"x{i}" for i in range(dims)]
    # a position is named by the smallest key there
    placed = points.groupBy(*axes).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("id"))
    positions = stored(placed.select("id", "n", F.array(*axes).alias("x")))
    nothing = points.select(key, F.lit(-1).alias("segment"))
    if positions.isEmpty():
        return nothing
    cover = ball_cover.build(positions)
    core = stored(core_distances(cover, min_samples))
    tree = stored(reachability_tree(cover, core))
    found = births(positions.select("id", "n").join(core, "id"), tree, min_cluster_size)
    seeds = {r["seed"]: r["born"] for r in found.seeds.limit(MAX_SEEDS + 1).collect()}
    if len(seeds) > MAX_SEEDS:
        raise ValueError(f"more than {MAX_SEEDS} dense places: raise min_cluster_size")
    if not seeds:
        return nothing
    of = found.points.select("id", "seed")
    between = tree.join(of.select(F.col("id").alias("u"), F.col("seed").alias("one")), "u").join(
        of.select(F.col("id").alias("v"), F.col("seed").alias("other")), "v"
    )
    edges = [tuple(r) for r in between.where("one <> other").select("one", "other", "w").collect()]
    condensed = condensed_tree(seeds, edges)
    clustered = stored(_clusters_of(found, condensed))
    dense = F.sum(F.col("n") / F.greatest("birth", F.lit(LEAST_DISTANCE)))
    sums = clustered.groupBy("cluster").agg(F.sum("n").alias("n"), dense.alias("mass")).collect()
    label = chosen_clusters(condensed, {r["cluster"]: r["n"] for r in sums}, {r["cluster"]: r["mass"] for r in sums}, epsilon)
    pairs = [(c, s) for c, s in label.items() if s >= 0]
    if not pairs:
        return nothing
    labels = points.sparkSession.createDataFrame(pairs, "cluster long, selected long")
    member = clustered.join(labels, "cluster").select("id", "selected")
    firsts = member.groupBy("selected").agg(F.min("id").alias("first_id"))
    numbered = global_row_number(firsts, [F.asc("first_id")], "number").select(
        "selected", (F.col("number") - 1).cast("int").alias("segment")
    )
    labelled = placed.join(member.join(numbered, "selected").select("id", "segment"), "id").select(*axes, "segment")
    return points.select(key, *axes).join(labelled, axes, "left").select(key, F.coalesce("segment", F.lit(-1)).alias("segment"))


def point_core_distances(
    df: DataFrame, features: Sequence[str], min_samples: int = 10, key: str = "customer_id"
) -> DataFrame:
    """(key, core) of standardised features, for every row."""
    axes = [f"x{i}" for i in range(len(features))]
    points = scaled_axes(df, features, key)
    placed = points.groupBy(*axes).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("id"))
    cover = ball_cover.build(stored(placed.select("id", "n", F.array(*axes).alias("x"))))
    core = placed.join(core_distances(cover, min_samples), "id").select(*axes, "core")
    return points.join(core, axes).select(key, "core")


def component_counts(
    df: DataFrame, features: Sequence[str], limits: Sequence[float], min_samples: int = 10, key: str = "customer_id"
) -> DataFrame:
    """Per distance ``within``: how many positions are core at it, and how many components they
    have, both read off the tree of mutual reachability."""
    axes = [f"x{i}" for i in range(len(features))]
    placed = scaled_axes(df, features, key).groupBy(*axes).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("id"))
    cover = ball_cover.build(stored(placed.select("id", "n", F.array(*axes).alias("x"))))
    core = stored(core_distances(cover, min_samples))
    tree = reachability_tree(cover, core)
    at = F.explode(F.array(*[F.lit(float(d)) for d in limits])).alias("within")
    cores = core.select("core", at).groupBy("within").agg(F.count_if(F.col("core") <= F.col("within")).alias("core_positions"))
    merges = tree.select("w", at).groupBy("within").agg(F.count_if(F.col("w") <= F.col("within")).alias("merges"))
    joined = cores.join(merges, "within", "left")
    return joined.select("within", "core_positions", (F.col("core_positions") - F.coalesce("merges", F.lit(0))).alias("components"))


def hierarchy_segments(
    df: DataFrame,
    features: Sequence[str],
    min_samples: int = 10,
    min_cluster_size: int = 50,
    epsilon: float = 0.1,
    key: str = "customer_id",
) -> DataFrame:
    """Segments of standardised features by excess of mass, none of which is finer than ``epsilon``."""
    return hierarchy_clusters(scaled_axes(df, features, key), key, len(features), min_samples, min_cluster_size, epsilon)
