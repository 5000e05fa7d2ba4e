"""Connected components of an edge table, by alternating star contractions.

Each round is a few joins and partial aggregates over the edges; nothing is
collected. A node with very many edges is reduced by a partial minimum and its
join is a plain shuffle join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _seal(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    return (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    near = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges``: columns u and v of one orderable type. Returns ``node`` and
    ``root`` (the smallest node of its component), for nodes that have an
    edge, each once. Loops and repeated edges are ignored; an empty table
    gives an empty table."""
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                         F.least("u", "v").alias("v")).distinct()
    edges = materialize(edges, "edges")
    seal = _seal(edges)
    while seal[0]:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        seal, last = _seal(edges), seal
        if seal == last:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
