"""Connected components of a link table, as joins and grouped minima (large-star and
small-star steps). Every step is written to the session's checkpoint folder, so
nothing is collected and a lost executor costs one step."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def staged(df: DataFrame, path: str, tasks: int | None = None) -> DataFrame:
    """Write once, read back: the lineage ends in shared files. ``tasks``: as many are enough for
    the rows; small tables are then a few files instead of one per shuffle partition."""
    (df.coalesce(tasks) if tasks else df).write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Links that one task is to hold; fewer tasks than partitions, if that is enough.
LINKS_PER_TASK = 20_000


def connected_components(links: DataFrame, path: str, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    Nulls and self-links say nothing. A node's neighbours are never gathered, only
    their minimum is: a hub costs what its links cost. It ends when every node has either larger
    neighbours only or a single, smaller one, which the first step of a round tells.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = staged(edges, os.path.join(path, "0"))
    step = 0
    while True:
        step += 1
        tasks = 1 + edges.count() // LINKS_PER_TASK
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c"))
        low = staged(low.coalesce(tasks), os.path.join(path, f"{step}l"))
        if low.where("m < u AND c > 1").isEmpty():
            break
        # large star: every larger neighbour of a node is linked to the smallest of the node and its neighbours
        large = both.join(low.select("u", F.least("m", "u").alias("m")), "u").where("v > u")
        large = staged(large.select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks), os.path.join(path, f"{step}a"))
        # small star: a node and its smaller neighbours are linked to the smallest of them
        small = large.join(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks), "u") \
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = staged(small.coalesce(tasks).distinct().coalesce(tasks), os.path.join(path, str(step)))
    return low.select(F.col("u").alias("node"), F.least("m", "u").alias("component"))
