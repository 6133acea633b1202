"""Retry decisions over a log of fetch attempts.

The log has one row per attempt: ``request``, a timestamp ``ts``, an
``attempt_id`` that breaks ties, and what the outcome columns of each function
name. ``failed`` is a boolean column made by the caller, usually
``~is_ok(status)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagelake.functions.outcomes import PRIORITY_STEP, RETRY_CAP, is_ok, retryable
from pagelake.operators.skew import running_count

ORDER = ("ts", "attempt_id")


def ok_only(pages: DataFrame, status: str = "status") -> DataFrame:
    """Rows with status 200; everything else is a failure."""
    return pages.filter(is_ok(F.col(status)))


def skip_flagged(attempts: DataFrame, flag: str = "dont_retry") -> DataFrame:
    """Rows that may be retried at all."""
    return attempts.filter(retryable(F.col(flag)))


def attempt_number(
    attempts: DataFrame,
    key: Sequence[str] = ("request",),
    order: Sequence[str] = ORDER,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``retries``: failures of the request up to and with this attempt."""
    return running_count(
        attempts, list(key), list(order), F.col("failed"), "retries", ranges
    )


def retry_decision(
    attempts: DataFrame,
    cap: int | None = RETRY_CAP,
    cap_col: str | None = None,
    inclusive: bool = True,
    flag: str | None = None,
    key: Sequence[str] = ("request",),
    order: Sequence[str] = ORDER,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``retries`` and ``decision``: ``ok``, ``retry`` or ``gave_up``.

    A request's own cap in ``cap_col`` wins over ``cap``. ``inclusive=False``
    retries only below the cap; ``cap=None`` always retries. A true ``flag``
    column gives up at once. The cap is final: nothing is requested again
    behind its back.
    """
    numbered = attempt_number(attempts, key, order, ranges)
    limit = F.lit(cap).cast("int")
    if cap_col is not None:
        limit = F.coalesce(F.col(cap_col), limit)
    within = F.col("retries") <= limit if inclusive else F.col("retries") < limit
    within = F.coalesce(within, F.lit(cap is None))
    if flag is not None:
        within = within & retryable(F.col(flag))
    return numbered.withColumn(
        "decision",
        F.when(~F.col("failed"), "ok").when(within, "retry").otherwise("gave_up"),
    )


def retry_stats(decisions: DataFrame, reason: str = "reason") -> DataFrame:
    """Retries per reason, and on the row with a null reason all retries and
    all requests given up. Only a few rows per task are shuffled.
    """
    failures = decisions.filter(F.col("decision") != "ok")
    return (
        failures.rollup(reason)
        .agg(
            F.count_if(F.col("decision") == "retry").alias("retry_count"),
            F.count_if(F.col("decision") == "gave_up").alias("max_reached"),
            F.grouping(reason).alias("is_total"),
        )
        .select(reason, F.col("is_total").cast("int"), "retry_count", "max_reached")
    )


def retry_totals(
    attempts: DataFrame,
    cap: int = RETRY_CAP,
    key: Sequence[str] = ("request",),
) -> DataFrame:
    """How often each decision is taken, without ordering the log.

    The order decides *which* attempt is retried but not how many are, so counts
    per request are enough: two combining aggregates and no window.
    """
    per_request = attempts.groupBy(*key).agg(
        F.count_if(~F.col("failed")).alias("ok"),
        F.count_if("failed").alias("n"),
    )
    return per_request.agg(
        F.sum("ok").alias("ok"),
        F.sum(F.least("n", F.lit(cap))).alias("retry"),
        F.sum(F.greatest(F.col("n") - cap, F.lit(0))).alias("gave_up"),
    )


def retry_priority(decisions: DataFrame, adjust: int = PRIORITY_STEP) -> DataFrame:
    """Lower ``priority`` by one step per retry so far."""
    return decisions.withColumn(
        "priority", F.col("priority") + F.lit(adjust) * F.col("retries")
    )


def retries_as_requests(
    decisions: DataFrame, url: str = "request", first_seen: str | None = None
) -> DataFrame:
    """The retried attempts as new requests that skip the seen test. ``first_seen``
    names the column that orders them in a frontier, if they are to enter one.
    """
    return decisions.filter(F.col("decision") == "retry").select(
        F.col(url).alias("link"),
        F.col("priority"),
        F.col("retries").alias("retry_times"),
        F.lit(True).alias("dont_filter"),
        *([F.col(first_seen).alias("first_seen")] if first_seen else []),
    )


def queue_order(records: DataFrame, seq: str, lifo: bool = False) -> DataFrame:
    """First in, first out; or last in, first out."""
    return records.orderBy(F.desc(seq) if lifo else F.asc(seq))


def queue_position(
    records: DataFrame, seq: str, lifo: bool = False, out: str = "position"
) -> DataFrame:
    """Add each record's place in the queue, from 1. ``seq`` is a column of any type that
    sorts and tells records apart. Counted range by range, never in one task.
    """
    if out in records.columns:
        raise ValueError(f"column {out} exists")
    if not lifo:
        return running_count(records, [], [seq], F.lit(True), out)
    # Last in, first out: how many come after, and this one.
    first = running_count(records, [], [seq], F.lit(True), out)
    total = records.agg(F.count("*")).first()[0]
    return first.withColumn(out, F.lit(total) + 1 - F.col(out))


def assign_worker(df: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """Add ``worker`` in 0..n-1, the same on every run.

    Name columns that tell rows apart (an id, not a host): rows with equal
    values go to one worker.
    """
    text = F.concat_ws("\x1f", *(F.col(k).cast("string") for k in key))
    digest = F.sha1(text.cast("binary"))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return df.withColumn("worker", F.pmod(number, F.lit(n)).cast("int"))


def spread(df: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """Rows shuffled so that worker ``i``'s share is partition ``i``, and no other's."""
    return assign_worker(df, key, n).repartitionById(n, "worker")
