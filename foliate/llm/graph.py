"""Connected components over a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliate.llm.frames import remove, store


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node around it."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(u, v)``; the root is the smallest node of the component.

    Alternates large-star and small-star steps (Kiveris et al. 2014, "Connected
    Components in MapReduce and Beyond") until the edges are stars, which takes a number
    of rounds that grows with the logarithm of the edges. Every step is a minimum with a
    map-side half and a join; the driver gets one count per round. Each round is stored in
    the shared folder and takes the place of the one before.
    """
    spark = edges.sparkSession
    oriented = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    path, seen, mark = store(oriented, "edges"), None, ()
    while mark != seen:
        seen, last = mark, path
        path = store(_small_star(_large_star(spark.read.parquet(last))), "edges")
        mark = spark.read.parquet(path).agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        remove(spark, last)
    stars = spark.read.parquet(path)
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(stars.select("v", "v").distinct())
