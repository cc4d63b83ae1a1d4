"""Connected components of an edge table, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node can reach; nodes without edges are absent.

    ``edges`` has two columns of one orderable type. Every round hangs each
    node's larger neighbours, then its smaller ones, on its smallest neighbour,
    until nothing changes. A round is two joins on node; minima are combined
    before the shuffle, and no neighbourhood is gathered in one place.
    """
    a, b = edges.columns
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges = staged(edges, "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Written first: a join with a stored table can be split where a node has very many neighbours.
        least = staged(least, "least-neighbours")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "larger-neighbours")
        least = staged(large.groupBy("u").agg(F.min("v").alias("m")), "least-neighbours")
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = staged(small.where("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
