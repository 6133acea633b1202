"""Users' own code: per-page callbacks and record stages."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Callback = Callable[[str, str], Iterable[dict]]
Stage = Callable[[DataFrame], DataFrame]


def extract_with(pages: DataFrame, callback: Callback, schema: T.StructType) -> DataFrame:
    """Call ``callback(url, html)`` per page; it yields 0..n rows as dicts.

    Filter ``pages`` first: no filter on the result moves below this node.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, html in zip(batch.column(0), batch.column(1)):
                rows.extend(callback(url.as_py(), html.as_py()))
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return pages.select("url", "html").mapInArrow(run, schema)


def apply_stages(records: DataFrame, *stages: Stage) -> DataFrame:
    """Records through each stage in turn. No stage leaves them as they are."""
    return reduce(lambda df, stage: df.transform(stage), stages, records)
