"""Streams with state: deduplication, endpoint tallies, retry counters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pagelake.functions.outcomes import RETRY_CAP
from pagelake.session import use_rocksdb


def merge_copies(stream: DataFrame, key: str) -> DataFrame:
    """Drop the repeats of a key within each Arrow batch, before any shuffle.

    A key with a third of all rows then sends one row per batch of thousands.
    """

    def first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = batch.column(batch.schema.get_field_index(key)).to_pandas()
            yield batch.filter(pa.array(~seen.duplicated()))

    return stream.mapInArrow(first_of_each, stream.schema)


def dedup_stream(
    stream: DataFrame,
    key: str,
    within: str | None = None,
    event_time: str = "ts",
    merge: bool = True,
) -> DataFrame:
    """First row of each key, across batches and restarts.

    The state holds every key ever seen, as a seen set must. ``within`` bounds
    it to keys seen lately, for streams whose repeats come soon. Any of several
    equal-key rows of one batch may be the first. ``merge`` takes repeats out
    before the shuffle; turn it off for streams of wide rows without hot keys.
    """
    use_rocksdb(stream.sparkSession)
    merged = merge_copies(stream, key) if merge else stream
    if within is None:
        return merged.dropDuplicates([key])
    return merged.withWatermark(event_time, within).dropDuplicatesWithinWatermark([key])


def endpoint_tally(
    attempts: DataFrame, key: tuple[str, ...] = ("generation", "endpoint")
) -> DataFrame:
    """Failures per endpoint so far; run it in update (or complete) mode.

    Counts are combined before the shuffle, so a hot endpoint is no burden.
    """
    return (
        attempts.filter(F.col("failed") & F.col(key[-1]).isNotNull())
        .groupBy(*key)
        .agg(F.count("*").alias("failures"))
    )


def _rank_in_batch(attempts: DataFrame) -> DataFrame:
    """Add ``_rank``: the how-manieth failure of its request in its Arrow batch,
    by (ts, attempt_id); 0 for attempts that did not fail.
    """

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["request", "ts", "attempt_id", "failed"]).to_pandas()
            bad = rows[rows["failed"].eq(True)].sort_values(
                ["ts", "attempt_id"], na_position="first"
            )
            ranks = bad.groupby("request", sort=False, dropna=False).cumcount() + 1
            ranks = ranks.reindex(rows.index, fill_value=0).astype("int32")
            yield batch.append_column("_rank", pa.array(ranks, pa.int32()))

    schema = T.StructType([*attempts.schema.fields, T.StructField("_rank", T.IntegerType())])
    return attempts.mapInArrow(rank, schema)


def _count_on(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Number a request's failures of one batch after those of the batches before.

    All rows are numbered and judged at once; only the count is kept.
    """
    (before,) = state.get if state.exists else (0,)
    rows = pd.concat(list(frames), ignore_index=True)
    rows = rows.sort_values(["ts", "attempt_id"], na_position="first", ignore_index=True)
    number = before + 1 + np.arange(len(rows), dtype=np.int64)
    limit = rows["_limit"].to_numpy(np.int64)
    again = (number <= limit) & ~rows["_never"].to_numpy(bool)
    rows["retries"] = np.minimum(number, limit + 1)
    rows["decision"] = np.where(again, "retry", "gave_up")
    state.update((before + len(rows),))
    yield rows.drop(columns=["_limit", "_never"])


def retry_counter(
    attempts: DataFrame,
    cap: int = RETRY_CAP,
    cap_col: str | None = None,
    flag: str | None = None,
    largest: int | None = None,
) -> DataFrame:
    """Add ``retries`` and ``decision`` to a stream of attempts.

    The twin of the batch ``retry_decision``, with the count carried from batch to batch:
    a row's own cap in ``cap_col`` wins over ``cap``, and a true ``flag`` column gives up
    at once, though such a failure counts. ``retries`` stops at one beyond the row's cap
    and is null for attempts that did not fail. Batches must come in the order of time.

    Attempts that did not fail need no state. Nor do failures that come after as many
    others of the same request in the same Arrow batch as any cap allows: they are given
    up whatever the count was, so a hot request sends few rows per Arrow batch to its
    task. Without ``cap_col`` that many is ``cap``; with it, it is ``largest``, and caps
    beyond that count as ``largest``. Without either all failures go to their count.
    """
    use_rocksdb(attempts.sparkSession)
    taken = {"_rank", "_limit", "_never", "retries", "decision"} & set(attempts.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} exist")
    limit = F.lit(cap).cast("bigint")
    if cap_col is not None:
        limit = F.coalesce(F.col(cap_col).cast("bigint"), limit)
        if largest is not None:
            limit = F.least(limit, F.lit(largest))
    most = cap if cap_col is None else largest
    ready = attempts if most is None else _rank_in_batch(attempts)
    bad = F.coalesce(F.col("failed"), F.lit(False))
    late = F.lit(False) if most is None else bad & (F.col("_rank") > most)
    direct = ready.filter(~bad | late).select(
        *attempts.columns,
        F.when(late, limit + 1).cast("bigint").alias("retries"),
        F.when(late, "gave_up").otherwise("ok").alias("decision"),
    )
    never = F.lit(False) if flag is None else F.coalesce(F.col(flag), F.lit(False))
    open_rows = ready.filter(bad & ~late).select(
        *attempts.columns, limit.alias("_limit"), never.alias("_never")
    )
    schema = T.StructType([
        *attempts.schema.fields,
        T.StructField("retries", T.LongType()),
        T.StructField("decision", T.StringType()),
    ])
    counted = open_rows.groupBy("request").applyInPandasWithState(
        _count_on, schema, "n long", "append", GroupStateTimeout.NoTimeout
    )
    return direct.unionByName(counted)
