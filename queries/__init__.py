"""Every operator as a query over the given tables, with its SQL twin.

``@query(sql)`` registers a function ``(spark, sf_dir) -> DataFrame`` under its
own name. Names start with the operator's id in the survey.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def load_all() -> None:
    from queries import attempts, links, pools, records, streams  # noqa: F401
