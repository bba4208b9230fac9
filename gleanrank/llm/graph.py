"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleanrank.session import drop_scratch, new_scratch


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): every edge seen from u, with the least of u and all its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(least, "u")


def _star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.filter("u <> v").distinct()
    small = _with_least(large)
    return (
        small.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(small.select("u", F.col("m").alias("v")))
        .filter("u <> v")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (its first two columns); component = least node reachable.

    Edges point from the larger to the smaller node. Each round is written to the scratch folder and read
    back, so that a lost executor costs a re-read, and the folder of the round before is deleted. Loops and
    rows with a null end are ignored; an empty table gives an empty result. A hub's rows meet in a join
    with one row for each node, which adaptive execution splits.
    """
    spark = links.sparkSession
    a, b = links.columns[:2]
    edges = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )
    path, state = None, None
    while True:
        at = new_scratch(spark, "components")
        edges.write.parquet(at)
        edges = spark.read.schema(edges.schema).parquet(at)
        if path:
            drop_scratch(spark, path)
        path = at
        now = edges.agg(
            F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))), F.sum(F.pmod(F.hash("u", "v"), F.lit(1 << 30)))
        ).first()
        if now == state:
            break
        state = now
        edges = _star(edges)
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
