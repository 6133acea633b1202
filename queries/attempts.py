"""Attempt log: outcomes, retry numbers, decisions, counters."""

from pyspark.sql import functions as F

from pagelake.functions.outcomes import RETRY_CODES, is_retryable
from pagelake.operators.attempts import (
    attempt_number,
    ok_only,
    queue_position,
    retries_as_requests,
    retry_decision,
    retry_priority,
    retry_stats,
    retry_totals,
    skip_flagged,
)
from queries import query
from queries.inputs import ATTEMPTS_SQL, REASON_SQL, attempts, table, with_reason

_NUMBERED = f"""WITH {ATTEMPTS_SQL},
    numbered AS (
        SELECT *, {REASON_SQL} AS reason,
               CAST(sum(CAST(failed AS INTEGER)) OVER (
                   PARTITION BY request ORDER BY ts, attempt_id
                   ROWS UNBOUNDED PRECEDING) AS BIGINT) AS retries
        FROM attempts
    )"""


def _decided(within: str) -> str:
    return f"""{_NUMBERED},
    decided AS (
        SELECT *, CASE WHEN NOT failed THEN 'ok' WHEN {within} THEN 'retry'
                  ELSE 'gave_up' END AS decision
        FROM numbered
    )"""


@query(f"WITH {ATTEMPTS_SQL} SELECT attempt_id, request FROM attempts WHERE status = 200")
def b1_ok_only(spark, sf):
    return ok_only(attempts(spark, sf)).select("attempt_id", "request")


@query(f"WITH {ATTEMPTS_SQL} SELECT attempt_id FROM attempts WHERE NOT dont_retry")
def b6_skip_flagged(spark, sf):
    return skip_flagged(attempts(spark, sf)).select("attempt_id")


@query(f"""WITH {ATTEMPTS_SQL}
    SELECT attempt_id, coalesce(status IN {RETRY_CODES}, false)
        OR coalesce(exception = 'net.TimeoutError', false) AS retryable
    FROM attempts""")
def b7_retry_status(spark, sf):
    test = is_retryable(
        F.col("status"), F.col("exception"), classes=["net.TimeoutError"]
    )
    return attempts(spark, sf).select("attempt_id", test.alias("retryable"))


@query(f"WITH {ATTEMPTS_SQL} SELECT attempt_id, {REASON_SQL} AS reason FROM attempts")
def c18_normalise_reason(spark, sf):
    return with_reason(attempts(spark, sf)).select("attempt_id", "reason")


def _log(spark, sf, *more):
    """What a count per request needs: its rows are written, so no more than that."""
    return attempts(spark, sf).select("attempt_id", "ts", "request", "failed", *more)


@query(f"{_NUMBERED} SELECT attempt_id, request, retries FROM numbered")
def g1_attempt_number(spark, sf):
    return attempt_number(_log(spark, sf)).select("attempt_id", "request", "retries")


@query(f"{_NUMBERED} SELECT attempt_id, request, retries FROM numbered")
def g1_attempt_number_sliced(spark, sf):
    # More ranges than tasks, so that most requests lie in several.
    return attempt_number(_log(spark, sf), ranges=64).select(
        "attempt_id", "request", "retries"
    )


@query(f"{_decided('retries <= 2')} SELECT attempt_id, retries, decision FROM decided")
def g2_retry_decision(spark, sf):
    return retry_decision(_log(spark, sf)).select("attempt_id", "retries", "decision")


@query(f"""{_decided('retries <= coalesce(max_retry_times, 2) AND NOT dont_retry')}
    SELECT attempt_id, retries, decision FROM decided""")
def g2_retry_decision_own_cap(spark, sf):
    decided = retry_decision(
        _log(spark, sf, "max_retry_times", "dont_retry"), cap_col="max_retry_times", flag="dont_retry"
    )
    return decided.select("attempt_id", "retries", "decision")


@query(f"{_decided('retries < 3')} SELECT attempt_id, decision FROM decided")
def g3_retry_strict_cap(spark, sf):
    return retry_decision(_log(spark, sf), cap=3, inclusive=False).select(
        "attempt_id", "decision"
    )


@query(f"{_decided('true')} SELECT attempt_id, decision FROM decided")
def g3_retry_without_cap(spark, sf):
    return retry_decision(_log(spark, sf), cap=None).select("attempt_id", "decision")


@query(f"""{_decided('retries <= 2')}
    SELECT attempt_id, CAST(priority - retries AS BIGINT) AS priority FROM decided""")
def g5_retry_priority(spark, sf):
    return retry_priority(retry_decision(_log(spark, sf, "priority"))).select(
        "attempt_id", "priority"
    )


@query(f"""{_decided('retries <= 2')}
    SELECT request AS link, CAST(priority - retries AS BIGINT) AS priority,
           retries AS retry_times, true AS dont_filter
    FROM decided WHERE decision = 'retry'""")
def g5_retries_as_requests(spark, sf):
    return retries_as_requests(retry_priority(retry_decision(_log(spark, sf, "priority"))))


@query(f"""{_decided('retries <= 2')}
    SELECT reason, CAST(grouping(reason) AS INTEGER) AS is_total,
           count(*) FILTER (decision = 'retry') AS retry_count,
           count(*) FILTER (decision = 'gave_up') AS max_reached
    FROM decided WHERE decision <> 'ok' GROUP BY ROLLUP (reason)""")
def f4_retry_stats(spark, sf):
    log = with_reason(attempts(spark, sf)).select("attempt_id", "ts", "request", "failed", "reason")
    return retry_stats(retry_decision(log))


@query(f"""{_decided('retries <= 2')}
    SELECT count(*) FILTER (decision = 'ok') AS ok,
           count(*) FILTER (decision = 'retry') AS retry,
           count(*) FILTER (decision = 'gave_up') AS gave_up
    FROM decided""")
def f4_retry_totals(spark, sf):
    return retry_totals(attempts(spark, sf))


@query("""
    SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) AS position
    FROM documents""")
def g7_queue_order(spark, sf):
    return queue_position(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")


@query("""
    SELECT doc_id, source, row_number() OVER (ORDER BY doc_id DESC) AS position
    FROM documents""")
def g7_queue_order_lifo(spark, sf):
    return queue_position(
        table(spark, sf, "documents").select("doc_id", "source"), "doc_id", lifo=True
    )
