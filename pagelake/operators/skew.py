"""Keep hot keys from landing on one task.

Spark combines before the shuffle in every plain aggregate, so those need no
help. What is left are *ordered* per-key computations (a running count), where a
key with a third of all rows would be one window partition. Here all rows are cut
into ranges of (key, order), whatever the keys' shares; each range is counted on its
own, and the counts of a key's earlier ranges are added.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagelake.session import scratch_dir, written


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order`` (which should be a total order).

    An aggregate, not a window: copies are combined before the shuffle, so a key
    with any number of copies costs one row per map task.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return picked.select(
        *(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns)
    )


# Bits of the types whose values a decimal of 38 digits can hold several of.
_BITS = {
    "boolean": 1, "tinyint": 8, "smallint": 16, "int": 32, "bigint": 64, "date": 32,
    "timestamp": 64, "timestamp_ntz": 64,
}


def packed_order(df: DataFrame, order: list[str]) -> tuple[Column, list[str]]:
    """The first columns of ``order`` as one number that sorts as they do, nulls first,
    and the columns that did not go in (texts, or more than 120 bits).
    """
    wide = "decimal(38,0)"

    def whole(n: int) -> Column:
        return F.lit(str(n)).cast(wide)

    number, used, rest = whole(0), 0, list(order)
    while rest:
        kind = df.schema[rest[0]].dataType.simpleString()
        bits = _BITS.get(kind, 999)
        if used + bits + 1 > 120:
            break
        value = F.col(rest.pop(0))
        if kind == "date":
            value = F.unix_date(value)
        elif kind.startswith("timestamp"):
            value = F.unix_micros(value.cast("timestamp"))
        value = value.cast("bigint").cast(wide) + whole(1 + (1 << (bits - 1)))
        number = (number * whole(2 << bits) + F.coalesce(value, whole(0))).cast(wide)
        used += bits + 1
    return number, rest


def first_per_key_late(
    df: DataFrame, key: str, order: list[str], unless: DataFrame | None = None
) -> DataFrame:
    """The first row of each key by ``order``, but for the keys in ``unless``.

    For wide rows of which few are left: ``df`` is written once, when this is declared;
    then only key and order are aggregated (by hash, the order packed into one number) and
    held against ``unless``, and the rows of the keys that remain are fetched last.
    ``order`` must tell the rows of a key apart. Order columns that cannot be packed are
    compared among the fetched rows only; where none can be, :func:`first_per_key` runs.
    """
    at = "_at"
    if at in df.columns:
        raise ValueError(f"column {at} exists")
    number, rest = packed_order(df, order)
    if len(rest) == len(order):
        first = first_per_key(df, [key], order)
        return first if unless is None else first.join(unless, key, "left_anti")
    rows = written(df.withColumn(at, number), scratch_dir(df.sparkSession, "rows"))
    first = rows.groupBy(key).agg(F.min(at).alias(at))
    if unless is not None:
        first = first.join(unless, key, "left_anti")
    # Null keys are keys too, so the join is null-safe.
    first = first.select(F.col(key).alias("_first_key"), F.col(at).alias("_first_at"))
    same = rows[key].eqNullSafe(F.col("_first_key")) & (rows[at] == F.col("_first_at"))
    found = rows.join(first, same, "left_semi").select(*df.columns)
    return first_per_key(found, [key], rest) if rest else found


def running_count(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    flag: Column,
    out: str,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``out``: how many rows of the key up to this one satisfy ``flag``.

    ``order`` must be a total order within the key. Keys may be null, and both may be
    of any type that Spark can sort: ranges are cut by the columns' own order. There
    are ``ranges`` of them, or as many as shuffle partitions.

    The rows are written with the number of their range when this is declared, as
    the two steps below must see the same ranges, also after a lost executor. No
    other job runs then. All columns of ``df`` are written, so select those needed first.
    """
    spark = df.sparkSession
    taken = {"_one", "_range", "_before"} & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} exist")
    by = [*keys, *order]
    cut = df.repartitionByRange(*([ranges] if ranges else []), *by)
    marked = cut.withColumn("_one", F.coalesce(flag, F.lit(False)).cast("bigint"))
    marked = marked.withColumn("_range", F.spark_partition_id())
    rows = written(marked, scratch_dir(spark, "ranges"))

    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    counted = rows.withColumn(
        out, F.sum("_one").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    # One row for each key and range it is in; a key has no more than there are ranges.
    earlier = Window.partitionBy(*keys).orderBy("_range")
    offsets = (
        rows.groupBy(*keys, "_range")
        .agg(F.sum("_one").alias("_n"))
        .withColumn(
            "_before",
            F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)),
        )
        .filter("_before > 0")
    )
    same = reduce(
        lambda x, y: x & y,
        (F.col(f"c.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*keys, "_range"]),
    )
    return (
        counted.alias("c")
        .join(offsets.alias("o"), same, "left")
        .select(
            *(F.col(f"c.{x}") for x in df.columns),
            (F.col(f"c.{out}") + F.coalesce("o._before", F.lit(0))).alias(out),
        )
    )
