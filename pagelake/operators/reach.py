"""What a crawl covers: everything that can be reached from the seeds.

Next-page chains are contracted first, by pointer doubling: a node with one way in and
one way out, other than a seed, is reached if and only if the node its chain starts from
is, so many steps later. What is left is searched breadth first, with the contracted
edges' lengths. Edges and the reached set are stored in buckets of their nodes, once; a
round joins its frontier with both where they lie and shuffles nothing but the frontier.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.session import scratch_dir, written


class _Bucketed:
    """A table stored in buckets of its first column, that rows are added to, those of
    each round in a partition of their own.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.name = f"reach_{uuid.uuid4().hex}"
        self.key = schema.split(" ", 1)[0]
        spark.sql(
            f"CREATE TABLE {self.name} ({schema}, number int) USING parquet PARTITIONED BY (number) "
            f"CLUSTERED BY ({self.key}) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )

    def add(self, rows: DataFrame, number: int) -> DataFrame:
        # Dealt by the buckets' own hash: a task writes one bucket.
        dealt = rows.repartition(self.buckets, self.key)
        dealt.withColumn("number", F.lit(number)).write.insertInto(self.name)
        return self.rows().filter(F.col("number") == number)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def contract_chains(
    seeds: DataFrame, edges: DataFrame, folder: str
) -> tuple[DataFrame, DataFrame | None]:
    """``(src, dst, steps)``: the edges between nodes that are no inner nodes of a chain,
    and ``(node, head, steps)``: for each inner node the node its chain starts from; None
    if there are none.

    ``edges`` must be distinct. Each of the rounds doubles how far an inner node looks
    back, so a chain of n nodes takes about log2(n) of them. A ring of inner nodes has no
    head; nothing outside leads to it, so it is left out.
    """
    ways_in = edges.groupBy(F.col("dst").alias("node")).agg(
        F.count("*").alias("n"), F.min("src").alias("up")
    )
    ways_out = edges.groupBy(F.col("src").alias("node")).agg(F.count("*").alias("n"))
    inner = (
        ways_in.filter("n = 1 AND up != node").select("node", "up")
        .join(ways_out.filter("n = 1").select("node"), "node")
        .join(seeds, "node", "left_anti")
    )
    now = written(inner.select("node", "up", F.lit(1).cast("bigint").alias("steps")), f"{folder}/back=0")
    left, k = now.count(), 0
    if not left:
        return edges.withColumn("steps", F.lit(1).cast("bigint")), None
    while (1 << k) <= left:  # beyond that, only rings look back at inner nodes
        back = now.select(F.col("node").alias("up"), F.col("up").alias("far"), F.col("steps").alias("more"))
        if now.join(back, "up", "left_semi").isEmpty():
            break
        k += 1
        now = written(
            now.join(back, "up", "left").select(
                "node", F.coalesce("far", "up").alias("up"),
                (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            ),
            f"{folder}/back={k}",
        )
    done = now
    ring = done.join(done.select(F.col("node").alias("up")), "up", "left_semi").select("node")
    chain = done.join(ring, "node", "left_anti").select("node", F.col("up").alias("head"), "steps")
    chain = written(chain, f"{folder}/chains")
    outer = edges.join(done.select(F.col("node").alias("dst")), "dst", "left_anti")
    from_chain = chain.select(F.col("node").alias("src"), "head", "steps")
    joined = outer.join(done.select(F.col("node").alias("src")), "src", "left_anti").select(
        "src", "dst", F.lit(1).cast("bigint").alias("steps")
    )
    short = outer.join(from_chain, "src").select(F.col("head").alias("src"), "dst", F.col("steps") + 1)
    both = joined.union(short).groupBy("src", "dst").agg(F.min("steps").alias("steps"))
    return both, chain


def reachable(
    seeds: DataFrame,
    edges: DataFrame,
    max_rounds: int | None = None,
    work_dir: str | None = None,
) -> DataFrame:
    """``seeds(node)`` and ``edges(src, dst)`` to ``(node, round)``.

    ``round`` is how many edges the nearest seed is away; nodes farther than
    ``max_rounds`` are left out. Null nodes are no nodes. Cycles end, as a node enters a
    frontier only with a smaller distance than it had. Every round is written, so a lost
    executor costs at most the round at hand, and each round's plan is the same size.
    """
    spark = seeds.sparkSession
    # A folder of its own for each run: an earlier run's rounds never count.
    folder = f"{work_dir}/{uuid.uuid4().hex}" if work_dir else scratch_dir(spark, "reachable")
    kind = seeds.schema["node"].dataType.simpleString()
    start = written(seeds.select("node").filter("node IS NOT NULL").distinct(), f"{folder}/seeds")
    # Written once: every round reads narrow columns, not what made them.
    known = edges.select(F.col("src").cast(kind).alias("src"), F.col("dst").cast(kind).alias("dst"))
    known = written(known.filter("src IS NOT NULL AND dst IS NOT NULL").distinct(), f"{folder}/edges")
    short, chain = contract_chains(start, known, folder)

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    links = _Bucketed(spark, f"{folder}/links", f"src {kind}, dst {kind}, steps bigint", buckets)
    reached = _Bucketed(spark, f"{folder}/reached", f"node {kind}, round bigint", buckets)
    try:
        links.add(short, 0)
        frontier = reached.add(start.withColumn("round", F.lit(0).cast("bigint")), 0)
        number = 0
        while not frontier.isEmpty():
            step = frontier.join(links.rows(), F.col("node") == F.col("src")).select(
                F.col("dst").alias("node"), (F.col("round") + F.col("steps")).alias("round")
            )
            if max_rounds is not None:
                step = step.filter(F.col("round") <= max_rounds)
            nearest = step.groupBy("node").agg(F.min("round").alias("round"))
            before = reached.rows().groupBy("node").agg(F.min("round").alias("before"))
            better = F.col("before").isNull() | (F.col("round") < F.col("before"))
            number += 1
            new = nearest.join(before, "node", "left").filter(better).select("node", "round")
            frontier = reached.add(new, number)
        every = reached.rows().groupBy("node").agg(F.min("round").alias("round"))
        if chain is not None:
            heads = every.withColumnRenamed("node", "head")
            every = every.union(
                chain.join(heads, "head").select("node", F.col("round") + F.col("steps"))
            )
        if max_rounds is not None:
            every = every.filter(F.col("round") <= max_rounds)
        return written(every.select("node", F.col("round").cast("int").alias("round")), f"{folder}/found")
    finally:
        links.drop()
        reached.drop()
