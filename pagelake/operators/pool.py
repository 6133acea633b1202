"""Health of an endpoint pool, read off the attempt log.

The pool is a table ``generation, ip, port, endpoint, failures``; a new
generation starts with each pool load and all its tallies at 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelake.functions.outcomes import (
    EVICT_AT,
    PAUSE_BELOW_FAILURE,
    PAUSE_BELOW_REQUEST,
    REFILL_BELOW,
    is_ok,
)
from pagelake.operators.attempts import ORDER

KEY = ("generation", "endpoint")


def attach_pool(attempts: DataFrame, pool: DataFrame, key: Sequence[str] = ("endpoint",)) -> DataFrame:
    """Attempts with the row of the pool their endpoint has.

    No broadcast hint: Spark broadcasts a pool below its size threshold, and
    splits the attempts of a hot endpoint at run time if it must shuffle.
    """
    return attempts.join(pool, list(key), "inner")


def endpoint_failures(attempts: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Failures per endpoint within a pool generation.

    Attempts that used no endpoint are left out.
    """
    return (
        attempts.filter(F.col(key[-1]).isNotNull())
        .groupBy(*key)
        .agg(F.count_if("failed").alias("failures"))
    )


def endpoints_to_evict(failures: DataFrame, threshold: int = EVICT_AT) -> DataFrame:
    """Endpoints whose tally has reached the threshold."""
    return failures.filter(F.col("failures") >= threshold)


def evict_immediate(attempts: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Endpoints with a response other than 200: one is enough."""
    bad = ~is_ok(F.col("status")) & F.col("status").isNotNull()
    return (
        attempts.filter(bad & F.col(key[-1]).isNotNull()).select(*key).distinct()
    )


def evicted_at(
    attempts: DataFrame,
    threshold: int = EVICT_AT,
    key: Sequence[str] = KEY,
    order: Sequence[str] = ORDER,
) -> DataFrame:
    """The failed attempt that brings its endpoint to the threshold.

    The rank limit is applied before the shuffle too, so even an endpoint with a
    third of all rows sends no more than ``threshold`` rows per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    failed = attempts.filter(F.col("failed") & F.col(key[-1]).isNotNull())
    return (
        failed.withColumn("failures", rank)
        .filter(F.col("failures") <= threshold)
        .filter(F.col("failures") == threshold)
    )


def evict(pool: DataFrame, bad: DataFrame, key: Sequence[str] = ("endpoint",)) -> DataFrame:
    """The pool without the ``bad`` endpoints."""
    return pool.join(bad.select(*key), list(key), "left_anti")


def pool_status(
    pool: DataFrame,
    refill: int = REFILL_BELOW,
    pause_request: int = PAUSE_BELOW_REQUEST,
    pause_failure: int = PAUSE_BELOW_FAILURE,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Size of each generation's pool, whether it wants a refill, and whether a pool
    this size right after a refill would pause the request side or the failure side.

    A generation without endpoints has no row. A pool without that column is one.
    """
    by = [c for c in ("generation",) if c in pool.columns] if by is None else by
    size = F.col("pool_size")
    return pool.groupBy(*by).agg(F.count("*").alias("pool_size")).select(
        *by,
        size,
        (size < refill).alias("needs_refill"),
        (size < pause_request).alias("pause_request"),
        (size < pause_failure).alias("pause_failure"),
    )


def pool_limit(pool: DataFrame, n: int, order: Sequence[str] = ("endpoint",)) -> DataFrame:
    """The first ``n`` endpoints by ``order``: the size of one pool load."""
    return pool.orderBy(*order).limit(n)
