"""Connected components of an undirected graph, by contraction.

Each round every vertex joins its neighbour, or itself, of the smallest random rank;
edges are redrawn between the vertices that were joined to, without loops or repeats,
until none is left. Random ranks, new ones each round, make the number of vertices
with edges fall by a constant factor in each, whatever the shape of the graph. The
smallest neighbour is an aggregate and repeats are dropped before they are shuffled,
so a vertex with a third of all edges is no hot spot. Every round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_scratch


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` for each vertex of ``edges`` (two columns of one type, no nulls).

    ``root`` is one vertex of the component, the same for all of it. Loops and repeated
    edges are allowed; a vertex of which only a loop is known has no row, as it is its
    own root.
    """
    spark = edges.sparkSession
    base = shared_scratch(spark, "components")
    left, right = edges.columns
    edges = edges.where(F.col(left) != F.col(right)).select(F.col(left).alias("u"), F.col(right).alias("v"))
    maps: list[DataFrame] = []
    while True:
        step = len(maps)
        path = f"{base}/edges_{step}"
        edges.distinct().write.parquet(path)
        edges = spark.read.parquet(path)
        if edges.isEmpty():
            break
        both = edges.union(edges.select("v", "u"))
        rank = F.xxhash64("v", F.lit(step))
        own = F.xxhash64("u", F.lit(step))
        smallest = both.groupBy("u").agg(F.min(F.struct(rank.alias("rank"), F.col("v"))).alias("m"))
        to = F.when(F.struct(own.alias("rank"), F.col("u").alias("v")) < F.col("m"), F.col("u"))
        joined = smallest.select("u", to.otherwise(F.col("m.v")).alias("root"))
        joined.write.parquet(f"{base}/map_{step}")
        joined = spark.read.parquet(f"{base}/map_{step}")
        maps.append(joined)
        edges = (
            edges.join(joined.withColumnRenamed("root", "a"), "u")
            .join(joined.select(F.col("u").alias("v"), F.col("root").alias("b")), "v")
            .where(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
        )
    if not maps:
        return edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    # From the last round back: where a vertex of one round ended in the rounds after it.
    ends = maps[-1]
    for joined in reversed(maps[:-1]):
        later = ends.select(F.col("u").alias("root"), F.col("root").alias("end"))
        ends = joined.join(later, "root", "left").select("u", F.coalesce("end", "root").alias("root"))
    return ends.select(F.col("u").alias("id"), "root")
