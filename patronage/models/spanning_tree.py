"""Minimum spanning forests and pointer chasing by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.session import stored


def follow(pointers: DataFrame) -> DataFrame:
    """(c, root): where ``pointers`` (c, next) lead. Of two that point at each other the smaller
    is the root; whoever has no pointer is one as well. Steps double in every round."""
    back = pointers.select(F.col("c").alias("next"), F.col("next").alias("back"))
    mutual = (F.col("back") == F.col("c")) & (F.col("c") < F.col("next"))
    current = stored(
        pointers.join(back, "next", "left").select("c", F.when(mutual, F.col("c")).otherwise(F.col("next")).alias("root"))
    )
    while True:
        ahead = current.select(F.col("c").alias("root"), F.col("root").alias("further"))
        moved = current.join(ahead, "root", "left").select(
            "c", F.coalesce("further", "root").alias("root"), (F.coalesce("further", "root") != F.col("root")).alias("moved")
        )
        current = stored(moved)
        if current.where("moved").isEmpty():
            return current.select("c", "root")
        current = current.select("c", "root")


def both_ways(edges: DataFrame, *more: str) -> DataFrame:
    """(c, o, ...) for edges (cu, cv, ...) in both directions."""
    return edges.select(F.col("cu").alias("c"), F.col("cv").alias("o"), *more).unionByName(
        edges.select(F.col("cv").alias("c"), F.col("cu").alias("o"), *more)
    )


def relabelled(edges: DataFrame, names: DataFrame) -> DataFrame:
    """Edges whose ends cu, cv are renamed by ``names`` (c, root) where they have a new name."""
    for end in ("cu", "cv"):
        new = names.select(F.col("c").alias(end), F.col("root").alias("renamed"))
        edges = edges.join(new, end, "left").withColumn(end, F.coalesce("renamed", end)).drop("renamed")
    return edges


def spanning_forest(edges: DataFrame) -> DataFrame:
    """The edges (u, v, w) of a minimum spanning forest, by Borůvka's rounds: every component takes
    its lightest edge, ties by (u, v), so that no round closes a circle."""
    live = stored(
        edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "w").where("u <> v").groupBy("u", "v")
        .agg(F.min("w").alias("w")).select(F.col("u").alias("cu"), F.col("v").alias("cv"), "w", "u", "v")
    )
    forest = None
    while not live.isEmpty():
        lightest = both_ways(live, "w", "u", "v").groupBy("c").agg(F.min(F.struct("w", "u", "v", "o")).alias("best"))
        lightest = stored(lightest.select("c", "best.*"))
        taken = lightest.select("u", "v", "w").distinct()
        forest = stored(taken if forest is None else forest.unionByName(taken))
        roots = follow(lightest.select("c", F.col("o").alias("next")))
        live = stored(relabelled(live, roots).where("cu <> cv").select("cu", "cv", "w", "u", "v"))
    return live.select("u", "v", "w") if forest is None else forest
