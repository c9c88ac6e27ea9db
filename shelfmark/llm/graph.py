"""Connected components of a link table by repeated contraction.

Each round every node looks at its neighbours' places in a random order and takes the first of them as parent if it comes before the node
itself; parents' parents are taken once; links between different parents go on to the next round. Rounds number about the logarithm of the
nodes. Hot nodes are only ever aggregated (with map-side sums) or joined against one row; tables between rounds are written to the shared
folder and dropped as soon as they are not needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, in_scratch


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``edges (a bigint, b bigint)``; the component is one of its nodes.

    Links may repeat, have either direction, or join a node with itself; nodes without another one are left out.
    """
    spark = edges.sparkSession

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        path = in_scratch(spark, "components")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    apart = edges.where("a <> b")
    links, links_at = written(apart.unionByName(apart.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels, labels_at, turn = links.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0), None, 0
    while not links.isEmpty():
        rank = lambda c, t=turn: F.struct(F.xxhash64(c, F.lit(t)).alias("place"), F.col(c).alias("node"))
        best = links.groupBy("a").agg(F.min(rank("b")).alias("best"))
        first = best.select(F.col("a").alias("node"), F.least("best", rank("a")).getField("node").alias("parent"))
        first, first_at = written(first)
        up = first.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        parents, parents_at = written(first.join(up, "parent").select("node", F.col("above").alias("parent")))
        drop_scratch(spark, first_at)
        if labels_at is None:
            new = parents.select("node", F.col("parent").alias("component"))
        else:
            moved = parents.select(F.col("node").alias("component"), "parent")
            new = labels.join(moved, "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
        new, new_at = written(new)
        left = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        rest = links.join(left, "a").join(right, "b").where("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct()
        rest, rest_at = written(rest)
        for path in (links_at, parents_at, labels_at):
            if path is not None:
                drop_scratch(spark, path)
        links, links_at, labels, labels_at, turn = rest, rest_at, new, new_at, turn + 1
    return labels


def smallest(labels: DataFrame, ids: DataFrame) -> DataFrame:
    """``node, component_id``: smallest ``id`` of the component, for all nodes of ``ids (node, id)``; a node may be alone."""
    joined = ids.join(labels, "node", "left").select("node", "id", F.coalesce("component", "node").alias("component"))
    least = joined.groupBy("component").agg(F.min("id").alias("component_id"))
    return joined.join(least, "component").select("node", "component_id")
