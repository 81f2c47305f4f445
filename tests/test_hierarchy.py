"""The density hierarchy against a plain quadratic version, one point at a time."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.models import ball_cover, hierarchy
from patronage.models.spanning_tree import follow, spanning_forest

LEAST = hierarchy.LEAST_DISTANCE


def plain_tree(x, samples):
    """Core distances and a spanning tree of mutual reachability."""
    away = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2))
    k = min(samples, len(x) - 1)
    core = np.sort(away, axis=1)[:, k]
    weight = np.maximum(away, np.maximum(core[:, None], core[None, :]))
    inside, edges = [0], []
    best, hang = weight[0].copy(), np.zeros(len(x), int)
    left = set(range(1, len(x)))
    while left:
        at = min(left, key=lambda i: (best[i], i))
        edges.append((at, hang[at], best[at]))
        left.discard(at)
        inside.append(at)
        for i in left:
            if weight[at, i] < best[i]:
                best[i], hang[i] = weight[at, i], at
    return core, edges


def parts_of(members, edges):
    near = {i: [] for i in members}
    for u, v, _ in edges:
        near[u].append(v)
        near[v].append(u)
    parts, seen = [], set()
    for i in members:
        if i not in seen:
            part, todo = [], [i]
            seen.add(i)
            while todo:
                j = todo.pop()
                part.append(j)
                for o in near[j]:
                    if o not in seen:
                        seen.add(o)
                        todo.append(o)
            parts.append(part)
    return parts


def plain_hdbscan(x, samples, size, epsilon):
    """From the whole down: take away the longest edges; clusters split when two parts are large."""
    n = len(x)
    if n == 0:
        return []
    _, edges = plain_tree(x, samples)
    density = lambda d: 1 / max(d, LEAST)
    clusters = []  # parent, distance of the split, leaving densities, children, members

    def grow(members, edges, parent, ends):
        me = len(clusters)
        clusters.append({"parent": parent, "ends": ends, "leave": [], "kids": [], "members": list(members)})
        while True:
            if not edges:
                clusters[me]["leave"] += [density(0.0)] * len(members)
                return me
            w = max(e[2] for e in edges)
            rest = [e for e in edges if e[2] < w]
            parts = parts_of(members, rest)
            large = [p for p in parts if len(p) >= size]
            small = sum(len(p) for p in parts if len(p) < size)
            clusters[me]["leave"] += [density(w)] * small
            if not large:
                return me
            inner = [(p, [e for e in rest if e[0] in set(p)]) for p in large]
            if len(large) > 1:
                for p, own in inner:
                    clusters[me]["leave"] += [density(w)] * len(p)
                    clusters[me]["kids"].append(grow(p, own, me, w))
                return me
            members, edges = inner[0]

    if n < size:
        return [-1] * n
    grow(list(range(n)), edges, -1, float("inf"))
    best, taken = {}, {}
    for c in reversed(range(len(clusters))):
        born = 0.0 if c == 0 else density(clusters[c]["ends"])
        own = sum(d - born for d in clusters[c]["leave"])
        inner = sum(best[k] for k in clusters[c]["kids"])
        taken[c], best[c] = c > 0 and own >= inner, max(own, inner)
    selected, todo = set(), [0]
    while todo:
        c = todo.pop()
        if taken[c]:
            selected.add(c)
        else:
            todo += clusters[c]["kids"]
    if epsilon:
        raised = set()
        for c in selected:
            if clusters[c]["ends"] < epsilon:
                while clusters[c]["parent"] != 0:
                    c = clusters[c]["parent"]
                    if clusters[c]["ends"] > epsilon:
                        break
            raised.add(c)
        selected = raised
    label = [-1] * n
    for c in range(len(clusters)):
        if c in selected:
            for i in clusters[c]["members"]:
                label[i] = c
    order = list(dict.fromkeys(c for c in label if c >= 0))
    return [order.index(c) if c >= 0 else -1 for c in label]


def clouds(name):
    rng = np.random.default_rng(7)
    if name == "nested":
        return np.concatenate([rng.normal(0, 0.05, (90, 2)), rng.normal(0.6, 0.06, (80, 2)), rng.normal(5, 0.8, (120, 2)), rng.uniform(-4, 9, (60, 2))])
    if name == "ties":  # a grid has hardly anything but ties
        a, b = np.meshgrid(np.arange(9.0), np.arange(9.0))
        grid = np.c_[a.ravel(), b.ravel()]
        return np.concatenate([grid, grid + 20, grid * 2 + 60])
    if name == "copies":
        return np.concatenate([np.zeros((70, 3)), np.full((40, 3), 1.0), rng.normal(0.5, 0.3, (120, 3)), np.repeat(rng.normal(4, 1, (25, 3)), 3, axis=0)])
    if name == "one":
        return rng.normal(0, 1, (150, 2))
    if name == "none":
        return rng.uniform(0, 1, (30, 2))
    return np.concatenate([rng.normal(c, 0.4, (60, 8)) for c in (0, 2, 2.8)] + [rng.uniform(-2, 5, (60, 8))])


def frame(spark, x):
    axes = ", ".join(f"x{i} double" for i in range(x.shape[1]))
    return spark.createDataFrame([(f"p{i:04d}", *map(float, r)) for i, r in enumerate(x)], f"k string, {axes}")


@pytest.mark.parametrize(
    "name, samples, size, epsilon",
    [("nested", 5, 20, 0.0), ("nested", 5, 20, 0.9), ("ties", 4, 15, 0.0), ("copies", 6, 20, 0.3), ("one", 5, 40, 0.0), ("none", 5, 50, 0.1), ("many axes", 5, 25, 0.0)],
)
def test_hierarchy_equals_plain_version(spark, monkeypatch, name, samples, size, epsilon):
    monkeypatch.setattr(ball_cover, "LEAF", 40)
    monkeypatch.setattr(ball_cover.build, "__defaults__", (40, 4))
    x = clouds(name)
    found = hierarchy.hierarchy_clusters(frame(spark, x), "k", x.shape[1], samples, size, epsilon)
    got = [r["segment"] for r in found.orderBy("k").collect()]
    wanted = plain_hdbscan(x, samples, size, epsilon)
    assert got == wanted
    assert name not in ("nested", "many axes") or max(got) >= 1


def positions(spark, x):
    rows = [(f"p{i:04d}", 1, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id string, n long, x array<double>")


def test_core_distances_and_tree_weight(spark):
    x = clouds("many axes")
    cover = ball_cover.build(positions(spark, x), 30, 5)
    core = hierarchy.core_distances(cover, 7)
    plain_core, edges = plain_tree(x, 7)
    got = {r["id"]: r["core"] for r in core.collect()}
    assert np.allclose([got[f"p{i:04d}"] for i in range(len(x))], plain_core, atol=1e-12)
    tree = hierarchy.reachability_tree(cover, core).collect()
    assert len(tree) == len(x) - 1
    assert np.allclose(sorted(r["w"] for r in tree), sorted(e[2] for e in edges), atol=1e-12)


def test_blocks_meet_exactly(spark):
    """Nearest points and the edges between two blocks, by brute force; and core distances make one row
    for a point, however many blocks it meets."""
    r = np.random.default_rng(5)
    for n, m, dims, round_to in ((40, 60, 33, 9), (50, 20, 3, 0), (1, 7, 2, 1)):
        a, b = np.round(r.normal(size=(n, dims)), round_to), np.round(r.normal(size=(m, dims)), round_to)
        away, weights = np.full((n, 8), np.inf), np.zeros((n, 8), "int64")
        for other in (a, b):
            hierarchy._meet(away, weights, a, other, np.ones(len(other), "int64"))
        both = np.concatenate([a, b])
        every = hierarchy._distances(both, both)
        assert np.array_equal(away, np.sort(every[:n], axis=1)[:, :8])
        inner = [hierarchy._prim(w) for w in (every[:n, :n], every[n:, n:])]
        trees = [(i, j, w[i, j]) for (i, j), w in zip(inner, (every[:n, :n], every[n:, n:]), strict=True)]
        one, other = hierarchy._joined(every[:n, n:], trees)
        edges = [*zip(*inner[0]), *((i + n, j + n) for i, j in zip(*inner[1])), *zip(one, other + n)]
        rows = [(int(i), int(j), float(every[i, j])) for i, j in edges]
        forest = spanning_forest(spark.createDataFrame(rows, "u long, v long, w double")).collect()
        assert np.allclose(sorted(e["w"] for e in forest), sorted(every[hierarchy._prim(every)]), rtol=0, atol=0)
    cover = ball_cover.build(positions(spark, clouds("many axes")), 30, 5)
    core = hierarchy.core_distances(cover, 7)
    plan = core._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("MapInArrow") and core.count() == len(clouds("many axes"))


def test_a_block_moves_once_for_a_group_of_blocks(spark):
    x = clouds("many axes")
    cover = ball_cover.build(positions(spark, x), 4, 8)
    groups = hierarchy._groups(cover)
    leaves, held = groups.count(), groups.select("held").distinct().count()
    assert held < leaves
    pairs = ball_cover.close_leaves(cover, lambda gap, a, b: gap >= 0).where("a <> b")
    streamed = hierarchy._streamed(pairs, hierarchy._blocks(cover.points, "n", "x"), groups, either=True)
    sizes = streamed.selectExpr("near < 0 as own", "size(meets) as met").groupBy("own").agg({"met": "sum", "*": "count"}).collect()
    found = {r["own"]: (r["count(1)"], r["sum(met)"]) for r in sizes}
    assert found[True] == (leaves, 0) and found[False][1] == leaves * (leaves - 1) // 2
    assert found[False][0] <= held * leaves < found[False][1] * 2
    got = {r["id"]: r["core"] for r in hierarchy.core_distances(cover, 7).collect()}
    assert np.allclose([got[f"p{i:04d}"] for i in range(len(x))], plain_tree(x, 7)[0], atol=1e-12)


def test_leaves_hold_every_point_within_their_radius(spark):
    x = clouds("nested")
    cover = ball_cover.build(positions(spark, x), 20, 3)
    leaves = {r["node"]: r for r in cover.nodes.where("is_leaf").collect()}
    held = cover.points.collect()
    assert len(held) == len(x) and {r["leaf"] for r in held} == set(leaves)
    for r in held:
        leaf = leaves[r["leaf"]]
        assert np.linalg.norm(np.array(r["x"]) - np.array(leaf["centre"])) <= leaf["radius"] + 1e-12
    assert all(sum(r["leaf"] == name for r in held) <= 20 for name in leaves)


def compared(spark, x):
    """Pairs of points that meet while core distances are found."""
    cover = ball_cover.build(positions(spark, x), 32, 4)
    needed = hierarchy._needed(cover, 6)
    bounded = ball_cover.BallCover(cover.points, needed, cover.depth)
    pairs = ball_cover.close_leaves(bounded, lambda gap, a, b: gap <= F.col(f"{a}need"), ("need",), ordered=True)
    sizes = cover.points.groupBy("leaf").count()
    met = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    return met.agg(F.sum(F.col("na") * F.col("nb"))).first()[0]


def test_compared_pairs_grow_with_the_data(spark):
    """Twice the cloud at another place is twice the work, in ten axes as well."""
    cloud = np.random.default_rng(3).normal(0, 1, (400, 10)) * np.r_[np.ones(2), np.full(8, 0.05)]
    once = compared(spark, cloud)
    twice = compared(spark, np.concatenate([cloud, cloud + 1000]))
    assert twice < 2.4 * once < 800 * 800 * 0.6


def test_spanning_forest_and_pointers(spark):
    edges = [("a", "b", 1.0), ("b", "c", 1.0), ("a", "c", 1.0), ("c", "d", 3.0), ("b", "d", 2.0), ("x", "y", 5.0), ("y", "x", 4.0), ("z", "z", 0.1)]
    forest = spanning_forest(spark.createDataFrame(edges, "u string, v string, w double")).collect()
    assert sorted(tuple(r) for r in forest) == [("a", "b", 1.0), ("a", "c", 1.0), ("b", "d", 2.0), ("x", "y", 4.0)]
    none = spanning_forest(spark.createDataFrame([], "u string, v string, w double"))
    assert none.count() == 0
    chain = [(i, i - 1) for i in range(2, 60)] + [(0, 1), (1, 0), (70, 71)]
    roots = {r["c"]: r["root"] for r in follow(spark.createDataFrame(chain, "c long, next long")).collect()}
    assert all(roots[i] == 0 for i in range(60)) and roots[70] == 71


def test_no_points(spark):
    assert hierarchy.hierarchy_clusters(frame(spark, np.zeros((0, 2))), "k", 2).count() == 0
