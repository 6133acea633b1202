"""Connected components of an edge table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.session import scratch_dir, written


def _lowest(edges: DataFrame) -> DataFrame:
    """Each node's smallest neighbour."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours hang on the smallest node around."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.join(_lowest(both), "u")
    return low.filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours hang on the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.join(_lowest(down), "u")
    return low.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        low.select("u", F.col("m").alias("v"))
    )


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, label)`` for every node of an edge; the label is the component's
    smallest node.

    Alternates two star steps until no edge changes. A hub is one row of an
    aggregate and one side of a join; no neighbour list is ever gathered. Each round
    is written, so lineage does not grow and a lost executor costs one round.
    """
    spark = edges.sparkSession
    now = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v").distinct()
    now = written(now, scratch_dir(spark, "edges"))
    before = None
    while True:
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state[0] == 0 or state == before:
            break
        before = state
        step = _small_star(_large_star(now).distinct()).filter("u != v").distinct()
        now = written(step, scratch_dir(spark, "edges"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots).distinct()
