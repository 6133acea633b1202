"""The persistent set of seen fingerprints, kept ready for joins."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Lets a scan report the order of buckets that are one sorted file each.
ORDERED_SCAN = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def _layout(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """Buckets and latest generation of the set at ``path``, if there is one."""
    try:
        rows = spark.read.schema("buckets int, generation int").parquet(f"{path}/_layout")
        last = rows.agg(F.max("buckets"), F.max("generation")).first()
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    return None if last[0] is None else (last[0], last[1] or 0)


def _save_layout(spark: SparkSession, path: str, buckets: int, generation: int) -> None:
    row = spark.createDataFrame([(buckets, generation)], "buckets int, generation int")
    row.coalesce(1).write.mode("append").parquet(f"{path}/_layout")


def _folder(path: str, generation: int) -> str:
    return f"{path}/generation={generation}"


def _create(spark: SparkSession, name: str, buckets: int, folder: str) -> None:
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (fp STRING) USING parquet "
        f"CLUSTERED BY (fp) SORTED BY (fp) INTO {int(buckets)} BUCKETS "
        f"LOCATION '{folder}'"
    )


def seen_table(spark: SparkSession, name: str, path: str, buckets: int) -> DataFrame:
    """Open, or start, the seen set stored at ``path`` as table ``name``.

    It is bucketed by fingerprint. A join against it shuffles the new requests
    to its buckets and leaves the set itself, which only ever grows, where it
    is. ``buckets`` is part of the stored layout and kept with it: another number
    raises ``ValueError``. It should keep a bucket within a task's reach.

    The set is the latest generation that :func:`compact_seen` finished; a table that
    was opened before is moved to it.
    """
    spark.conf.set(ORDERED_SCAN, "true")
    stored = _layout(spark, path)
    if stored is None:
        _save_layout(spark, path, int(buckets), 0)
        stored = int(buckets), 0
    if stored[0] != buckets:
        raise ValueError(f"the set at {path} has {stored[0]} buckets, not {buckets}")
    folder = _folder(path, stored[1])
    _create(spark, name, buckets, folder)
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def add_seen(requests: DataFrame, name: str) -> int:
    """Remember the fingerprints of ``requests(fp)``; a repeated insert adds nothing.

    What the set has already is left out by a join on its buckets, which reads but does
    not shuffle it. Every insert adds one file to each bucket it touches; after some
    of them :func:`compact_seen` makes that one file again. Returns how many buckets the
    set has.
    """
    spark = requests.sparkSession
    buckets = _buckets(spark, name)
    # Dealt by the buckets' own hash: a task writes one bucket.
    new = requests.select("fp").filter("fp IS NOT NULL").distinct()
    new = new.repartition(buckets, "fp").join(spark.table(name), "fp", "left_anti")
    new.write.insertInto(name)
    return buckets


def _buckets(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Num Buckets'")
    return int(rows.first()["data_type"])


def compact_seen(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Rewrite the set at ``path`` as one sorted file for each bucket.

    After that a join neither shuffles nor sorts it. Buckets are read and written where
    they are, without a shuffle. The new generation is a folder of its own and counts
    from the moment its number is in the layout, so a job that dies on the way leaves
    the set as it was; older folders are the owner's to delete. Repeated fingerprints, as
    two writers at once may leave them, become one.
    """
    buckets, generation = _layout(spark, path)
    after = f"{name}_generation_{generation + 1}"
    folder = _folder(path, generation + 1)
    spark.sql(f"DROP TABLE IF EXISTS {after}")
    _create(spark, after, buckets, folder)
    # Overwrites what a job that died may have left there.
    spark.table(name).distinct().write.insertInto(after, overwrite=True)
    _save_layout(spark, path, buckets, generation + 1)
    spark.sql(f"DROP TABLE {after}")
    return seen_table(spark, name, path, buckets)
