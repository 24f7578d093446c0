"""Graphs as link tables: connected components, and the street network of each area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoodcast.operators import geo
from hoodcast.session import cut_lineage


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)``: the smallest node that each linked node reaches.

    Classes of nodes with one label merge: a class takes the smallest label that a neighbour
    of any member has, then every node its label's label, so chains of classes halve. Joins and grouped
    minima over written tables; no node's neighbours are gathered. Links to null say nothing, a
    link of a node to itself makes it a component.
    """
    links = links.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    e = cut_lineage(links.select(F.inline(F.array(F.struct(F.col(a).alias("u"), F.col(b).alias("v")),
                                                  F.struct(F.col(b).alias("u"), F.col(a).alias("v"))))).distinct())
    label = cut_lineage(e.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("c")))
    while True:
        theirs = label.select(F.col("u").alias("v"), F.col("c").alias("seen"))
        seen = e.join(theirs, "v").groupBy("u").agg(F.min("seen").alias("seen"))
        best = cut_lineage(label.join(seen, "u").groupBy("c").agg(F.min("seen").alias("m")))
        if best.where("m < c").isEmpty():
            return label.select(F.col("u").alias("node"), F.col("c").alias("component"))
        taken = label.join(best, "c").select("u", F.least("c", "m").alias("c"))
        label = cut_lineage(taken.join(taken.select(F.col("u").alias("c"), F.col("c").alias("further")), "c")
                            .select("u", F.col("further").alias("c")))


def street_network(nodes: DataFrame, segments: DataFrame, polys: DataFrame, x: str = "x", y: str = "y",
                   cell: float | None = None) -> DataFrame:
    """``nbhd_id, intersection_count, street_segment_count, arterial_length_km, streets_per_node_avg`` of
    every area's street graph.

    ``nodes``: (node, x, y); ``segments``: (u, v, length_m), one row per street. An area's graph has the nodes
    inside it and the segments whose both ends are (a segment across the border is in none), and of
    these the largest connected component: the one of most nodes, then of the smallest node. A node's
    street count is its degree in the whole graph, segments across the border included; more than one makes an
    intersection. Lengths in km and the mean street count to 4 places. An area without such a graph has zeros.
    """
    at = geo.spatial_join(nodes, polys, x, y, "within", single=True, cell=cell).select("node", "nbhd_id")
    at = cut_lineage(at)
    degree = segments.select(F.explode(F.array("u", "v")).alias("node")).groupBy("node").agg(F.count("*").alias("streets"))
    ends = [at.select(F.col("node").alias(k), F.col("nbhd_id").alias(f"{k}_area")) for k in "uv"]
    inner = segments.join(ends[0], "u").join(ends[1], "v").where("u_area = v_area")
    inner = cut_lineage(inner.select(F.col("u_area").alias("nbhd_id"), "u", "v", "length_m"))
    of = components(inner, "u", "v")
    own = at.join(of, "node").join(degree, "node")
    sized = own.groupBy("nbhd_id", "component").agg(
        F.count("*").alias("nodes"), F.count_if(F.col("streets") > 1).alias("intersection_count"), F.avg("streets").alias("spn"))
    largest = sized.groupBy("nbhd_id").agg(F.max_by(
        F.struct("component", "intersection_count", "spn"), F.struct("nodes", -F.col("component"))).alias("g")).select("nbhd_id", "g.*")
    length = inner.join(of.withColumnRenamed("node", "u"), "u").groupBy("nbhd_id", "component").agg(
        F.count("*").alias("street_segment_count"), F.sum("length_m").alias("len_m"))
    g = largest.join(length, ["nbhd_id", "component"])
    count = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return polys.select("nbhd_id").join(g, "nbhd_id", "left").select(
        "nbhd_id", count("intersection_count"), count("street_segment_count"),
        F.coalesce(F.bround(F.col("len_m") / 1000.0, 4), F.lit(0.0)).alias("arterial_length_km"),
        F.coalesce(F.bround("spn", 4), F.lit(0.0)).alias("streets_per_node_avg"))
