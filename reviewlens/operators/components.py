"""Connected components of many small or large graphs at once, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlens.operators.scale import cut_lineage


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest node of the component of every node: (user_id, node, label).

    ``nodes`` is (user_id, node), ``edges`` is (user_id, node, other) in both directions. Each
    round hooks a node and its parent to the smallest grandparent among the neighbours and then
    shortens paths, so rounds grow with the logarithm of a component's diameter. A round moves
    one row per node and edge and takes plain minima, which combine before the shuffle.
    """
    nearest = edges.groupBy("user_id", "node").agg(F.min("other").alias("nearest"))
    state = cut_lineage(
        nodes.join(nearest, ["user_id", "node"], "left").select(
            "user_id", "node", F.least("node", "nearest").alias("label")
        )
    )
    while True:
        parents = state.select(
            "user_id", F.col("node").alias("label"), F.col("label").alias("grand")
        )
        above = state.join(parents, ["user_id", "label"])
        reach = above.select("user_id", F.col("node").alias("other"), "grand")
        lowest = (
            edges.join(reach, ["user_id", "other"])
            .groupBy("user_id", "node")
            .agg(F.min("grand").alias("lowest"))
        )
        known = above.join(lowest, ["user_id", "node"], "left")
        offers = known.select(
            "user_id",
            F.explode(
                F.array(
                    F.struct(
                        F.col("node").alias("node"),
                        F.least("label", "grand", "lowest").alias("offer"),
                        F.col("label").alias("before"),
                    ),
                    F.struct(
                        F.col("label").alias("node"),
                        F.col("lowest").alias("offer"),
                        F.lit(None).alias("before"),
                    ),
                )
            ).alias("o"),
        )
        merged = (
            offers.select("user_id", "o.*")
            .groupBy("user_id", "node")
            .agg(F.min("offer").alias("label"), F.max("before").alias("before"))
        )
        marked = cut_lineage(merged.withColumn("moved", F.col("label") != F.col("before")))
        state = marked.select("user_id", "node", "label")
        if marked.where("moved").isEmpty():
            return state
