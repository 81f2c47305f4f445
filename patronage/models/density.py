"""Density clustering: connected groups of points that have enough neighbours within a radius.

The result is the DBSCAN* partition (Campello, Moulavi, Sander 2013): a point with at
least ``min_samples`` points within ``eps``, itself included, is a core point; core points
within ``eps`` of each other share a cluster; all other points, and clusters below
``min_cluster_size``, are noise (-1). It is the cut of the HDBSCAN hierarchy at a fixed
``eps``; HDBSCAN's stability selection is not done.

Points at one position are one weighted position from the start, however many they are.
Positions are put into blocks of near ones (``models/blocks.py``). Neighbours are counted in the
own block first; only points that lack some meet the other blocks in their reach. Core points are
linked inside their block, then the largest group of each block through one point to each block
around it. Of what the links leave apart, all points outside of the largest group meet every block
in their reach that is not all of their own group: of two groups that touch, one is such a group.
Nothing is sampled, cut or projected away.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.models import blocks
from patronage.operators.ranking import global_row_number
from patronage.session import cut_lineage, stored

#: Blocks that the largest group of a block looks for links in, the nearest ones.
AROUND = 32


def _cols(prefix: str, dims: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(dims)]


def scaled_axes(df: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    """key and coordinates x0, x1, ... of the standardised features; absent values count as 0."""
    filled = df.select(key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features])
    raw = VectorAssembler(inputCols=list(features), outputCol="raw").transform(filled)
    scaled = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True).fit(raw).transform(raw)
    values = vector_to_array("scaled")
    return scaled.select(key, *[values[i].alias(f"x{i}") for i in range(len(features))])


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of its component, for nodes(node), edges(u, v).

    Alternating large-star and small-star steps (Kiveris et al. 2014), which need about
    log(n) rounds whatever the shape of the component. Each round's edges are checkpointed.
    """
    current = cut_lineage(edges.filter(F.col("u") != F.col("v")).distinct())
    previous = None
    while True:
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").filter(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        downward = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v")
        low = downward.groupBy("u").agg(F.min("v").alias("m"))
        linked = downward.join(low, "u")
        small = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v"))
        )
        current = cut_lineage(small.filter("u != v").distinct())
        mark = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(mark) == previous:
            break
        previous = tuple(mark)
    roots = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _counted(index: blocks.BlockIndex, dims: int, eps: float, min_samples: int) -> DataFrame:
    """The core points (id, n, x, block) of ``index``."""
    boxes = index.boxes

    def own(block: int, columns: dict[str, np.ndarray], x: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, n = columns["id"], columns["n"].astype("int64")
        counts = np.concatenate([
            blocks.near(x[start : start + blocks.STRIP], x, eps).astype("float64") @ n
            for start in range(0, len(x), blocks.STRIP)
        ]).astype("int64")
        yield _asked(np.full(len(ids), -1), ids, counts, np.empty((0, dims)))
        few = np.flatnonzero(counts < min_samples)
        for start in range(0, len(few), blocks.STRIP):
            lacking = few[start : start + blocks.STRIP]
            row, to = boxes.reached(x[lacking], eps)
            row, to = row[to != block], to[to != block]
            yield _asked(to, ids[lacking[row]], np.zeros(len(to), "int64"), x[lacking[row]])

    found = stored(blocks.per_block(index.points, dims, own, _ASKED))
    counts = found.where("block < 0").select(F.col("v").alias("id"), "own")

    def weigh(near: np.ndarray, asked: np.ndarray, n: np.ndarray) -> tuple[list[pa.Array], list[str]]:
        return [pa.array(asked), pa.array((near.astype("float64") @ n).astype("int64"))], ["id", "own"]

    points = index.points.select("block", F.col("n").alias("v"), "x")
    others = blocks.ask(points, found.where("block >= 0"), dims, eps, weigh, "id long, own long")
    enough = counts.unionAll(others).groupBy("id").agg(F.sum("own").alias("own")).where(F.col("own") >= min_samples)
    return stored(index.points.join(enough.select("id"), "id", "left_semi").select("id", "n", "x", "block"))


_ASKED = "block long, v long, own long, x array<double>"


def _asked(to: np.ndarray, v: np.ndarray, own: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    """Rows that ask block ``to``, or (-1) that carry a value without a place."""
    places = blocks.lists(x) if len(x) else pa.array([[]] * len(to), pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(to), pa.array(v), pa.array(own), places], ["block", "v", "own", "x"])


def _met(near: np.ndarray, asked: np.ndarray, group: np.ndarray) -> tuple[list[pa.Array], list[str]]:
    """The pairs of different groups that are near, each once."""
    i, j = np.nonzero(near & (asked[:, None] != group[None, :]))
    pairs = np.unique(np.stack([asked[i], group[j]], axis=1), axis=0)
    return [pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["u", "v"]


def _linked(core: DataFrame, boxes: blocks.Boxes, dims: int, eps: float) -> DataFrame:
    """(id, root) of the core points (id, n, x, block): the same root for those that links connect."""

    def inside(block: int, columns: dict[str, np.ndarray], x: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids = columns["id"]
        label = blocks.components(blocks.near(x, x, eps))
        least = np.full(label.max() + 1, np.iinfo("int64").max)
        np.minimum.at(least, label, ids)
        yield _asked(np.full(len(ids), -1), ids, least[label], np.empty((0, dims)))
        main = np.flatnonzero(label == np.bincount(label).argmax())
        row, to = boxes.closest(x[main], eps, block, AROUND)
        name = np.full(len(to), least[label[main[0]]])
        yield _asked(to, name, name, x[main[row]])

    local = stored(blocks.per_block(core.select("id", "x", "block"), dims, inside, _ASKED))
    groups = local.where("block < 0").select(F.col("v").alias("id"), F.col("own").alias("v"))
    placed = stored(core.select("id", "x", "block").join(groups, "id"))
    names = groups.select(F.col("v").alias("node")).distinct()
    edges = blocks.ask(placed, local.where("block >= 0"), dims, eps, _met, "u long, v long")
    roots = stored(connected_components(names, edges))

    grouped = placed.withColumnRenamed("v", "node").join(roots, "node").select("id", "x", "block", F.col("root").alias("v"))
    grouped = stored(grouped)
    largest = grouped.groupBy("v").count().orderBy(F.desc("count"), "v").first()["v"]
    whole = np.full(len(boxes.low), -1)
    for r in grouped.groupBy("block").agg(F.min("v").alias("low"), F.max("v").alias("high")).where("low = high").collect():
        whole[r["block"]] = r["low"]

    def outside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, blocks.STRIP):
                part = batch.slice(start, blocks.STRIP)
                x, v, own = blocks.matrix(part.column("x"), dims), np.asarray(part.column("v")), np.asarray(part.column("block"))
                row, to = boxes.reached(x, eps)
                kept = (to != own[row]) & (whole[to] != v[row])
                row, to = row[kept], to[kept]
                yield _asked(to, v[row], v[row], x[row])

    apart = grouped.where(F.col("v") != F.lit(largest)).repartition("block").sortWithinPartitions("block")
    more = blocks.ask(grouped, apart.select("block", "v", "x").mapInArrow(outside, _ASKED), dims, eps, _met, "u long, v long")
    final = connected_components(roots.select(F.col("root").alias("node")).distinct(), more)
    return grouped.join(final, F.col("v") == F.col("node")).select("id", "root")


def density_clusters(
    points: DataFrame, key: str, dims: int, eps: float, min_samples: int, min_cluster_size: int
) -> DataFrame:
    """(key, segment) for points with ``dims`` coordinates x0, x1, ... Clusters are numbered
    from 0 in the order of their smallest key."""
    axes = _cols("x", dims)
    # a position is named by the smallest key there
    placed = points.groupBy(*axes).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"))
    placed = stored(placed.withColumn("id", F.monotonically_increasing_id()))
    nothing = points.select(key, F.lit(-1).alias("segment"))
    if placed.isEmpty():
        return nothing
    index = blocks.build(placed.select("id", "n", F.array(*axes).alias("x")), dims)
    core = _counted(index, dims, eps, min_samples)
    if core.isEmpty():
        return nothing
    member = core.select("id", "n").join(_linked(core, index.boxes, dims, eps), "id")
    member = stored(member.join(placed.select("id", "first_key"), "id"))
    clusters = (
        member.groupBy("root")
        .agg(F.sum("n").alias("size"), F.min("first_key").alias("first_key"))
        .filter(F.col("size") >= min_cluster_size)
    )
    numbered = global_row_number(clusters, [F.asc("first_key")], "number").select(
        "root", (F.col("number") - 1).cast("int").alias("segment")
    )
    labelled = placed.select("id", *axes).join(member.join(numbered, "root").select("id", "segment"), "id")
    return points.select(key, *axes).join(labelled.drop("id"), axes, "left").select(
        key, F.coalesce("segment", F.lit(-1)).alias("segment")
    )


def density_segments(
    df: DataFrame,
    features: Sequence[str],
    eps: float = 0.1,
    min_samples: int = 10,
    min_cluster_size: int = 50,
    key: str = "customer_id",
) -> DataFrame:
    """Density segments of standardised features, all of which count."""
    return density_clusters(
        scaled_axes(df, features, key), key, len(features), eps, min_samples, min_cluster_size
    )
