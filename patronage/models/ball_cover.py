"""A metric partition of points into small balls, and the pairs of balls that can matter.

Points are dealt to the nearest of a few of their own number; a ball with too many points is dealt
again, so every leaf is bounded and the tree is as deep as the logarithm of the data. Two balls
whose centres are farther apart than a reach plus both radii hold no pair of points within that
reach, whatever the number of axes; pairs are found from the root down, so that balls far apart
are never unfolded.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.session import stored

#: Positions in a leaf at most, and balls that an overfull one is dealt into.
LEAF, PIVOTS = 2048, 16
#: Bounds are this much looser than computed, against rounding.
SLACK = 1e-9


def distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda p, q: (p - q) * (p - q))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, part: total + part))


@dataclass
class BallCover:
    #: id, n, x (array of coordinates) and leaf.
    points: DataFrame
    #: node, parent, level, centre, radius, total (sum of n) and is_leaf. The root has no parent.
    nodes: DataFrame
    depth: int

    def children(self, *more: str) -> DataFrame:
        """(parent, node, centre, radius, more ...); a leaf is its own child."""
        columns = ["node", "centre", "radius", *more]
        below = self.nodes.where("parent is not null").select("parent", *columns)
        return below.unionByName(self.nodes.where("is_leaf").select(F.col("node").alias("parent"), *columns))


def build(points: DataFrame, leaf: int = LEAF, pivots: int = PIVOTS) -> BallCover:
    """Cover ``points`` (id, n, x), at least one, with distinct ids and distinct x. Centres are points of the ball
    in hash order of their ids; equal distances go to the smaller id."""
    first = points.agg(F.min(F.struct(F.xxhash64("id"), "id", "x")).alias("one")).first()["one"]["x"]
    centre = F.array(*map(F.lit, first)).alias("centre")
    placed = points.select("id", "n", "x", F.lit("0").alias("node"), F.lit(None).cast("string").alias("parent"), centre)
    levels: list[DataFrame] = []
    level = 0
    while True:
        placed = stored(placed)
        away = distance(F.col("x"), F.col("centre"))
        nodes = stored(
            placed.groupBy("node").agg(
                F.first("parent").alias("parent"), F.first("centre").alias("centre"), F.max(away).alias("radius"),
                F.sum("n").alias("total"), F.count(F.lit(1)).alias("size"),
            )
        )
        fresh = nodes if level == 0 else nodes.where(F.col("parent").isNotNull())
        levels.append(fresh.select("node", "parent", F.lit(level).alias("level"), "centre", "radius", "total", (F.col("size") <= leaf).alias("is_leaf")))
        overfull = nodes.where(F.col("size") > leaf).select("node")
        if overfull.isEmpty():
            break
        level += 1
        place = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("id"), "id"))
        chosen = placed.join(overfull, "node", "left_semi").withColumn("place", place).where(F.col("place") <= pivots)
        offered = chosen.groupBy("node").agg(F.collect_list(F.struct("id", "x")).alias("offered"))
        nearest = F.array_min(
            F.transform("offered", lambda p: F.struct(distance(p["x"], F.col("x")).alias("away"), p["id"].alias("id"), p["x"].alias("x")))
        )
        dealt = placed.join(offered, "node", "left").withColumn("nearest", nearest)
        again = F.col("offered").isNotNull()
        # who stays in a leaf is not counted as a child again
        placed = dealt.select(
            "id",
            "n",
            "x",
            F.when(again, F.concat(F.lit(f"{level}:"), F.col("nearest.id").cast("string"))).otherwise(F.col("node")).alias("node"),
            F.when(again, F.col("node")).alias("parent"),
            F.when(again, F.col("nearest.x")).otherwise(F.col("centre")).alias("centre"),
        )
    every = levels[0]
    for part in levels[1:]:
        every = every.unionByName(part)
    return BallCover(placed.select("id", "n", "x", F.col("node").alias("leaf")), stored(every), level)


Bound = Callable[[Column, str, str], Column]


def close_leaves(cover: BallCover, within: Bound, columns: tuple[str, ...] = (), ordered: bool = False) -> DataFrame:
    """(a, b, gap) of leaves, where gap is a lower bound of the distance between their points.

    ``within(gap, "a_", "b_")`` says whether two nodes are to be unfolded, by the gap and the
    ``columns`` of both; it must hold for nodes if it holds for any leaves below them. Each
    unordered pair comes once, a leaf with itself too, and with ``ordered`` also the other way.
    """
    kids = cover.children(*columns)

    def side(prefix: str) -> DataFrame:
        return kids.select(F.col("parent").alias(f"{prefix}parent"), *[F.col(c).alias(f"{prefix}{c}") for c in kids.columns[1:]])

    root = cover.nodes.where("parent is null").select(F.col("node").alias("a_node"))
    pairs = root.select("a_node", F.col("a_node").alias("b_node"), F.lit(0.0).alias("gap"))
    for _ in range(cover.depth):
        held = pairs.select(F.col("a_node").alias("a_parent"), F.col("b_node").alias("b_parent"))
        met = held.join(side("a_"), "a_parent").join(side("b_"), "b_parent")
        if not ordered:  # below two different nodes all pairs count, below one only half
            met = met.where((F.col("a_parent") != F.col("b_parent")) | (F.col("a_node") <= F.col("b_node")))
        apart = distance(F.col("a_centre"), F.col("b_centre"))
        gap = apart - F.col("a_radius") - F.col("b_radius") - SLACK * (apart + F.col("a_radius") + F.col("b_radius"))
        gap = F.when(F.col("a_node") == F.col("b_node"), 0.0).otherwise(F.greatest(gap, F.lit(0.0)))
        pairs = met.withColumn("gap", gap).where(within(F.col("gap"), "a_", "b_")).select("a_node", "b_node", "gap")
    return pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b"), "gap")
