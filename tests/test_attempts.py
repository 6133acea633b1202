import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pagelake.functions.outcomes import is_ok, is_retryable, reason_of
from pagelake.operators.attempts import (
    assign_worker,
    attempt_number,
    queue_position,
    retry_decision,
    retry_priority,
    retry_stats,
    retry_totals,
    spread,
)
from pagelake.operators.pool import (
    endpoint_failures,
    endpoints_to_evict,
    evict,
    evict_immediate,
    evicted_at,
    pool_status,
)
from pagelake.operators.skew import first_per_key, running_count
from pagelake.plans.crawl import retry_report

T0 = datetime(2024, 1, 1)
SCHEMA = """attempt_id long, ts timestamp, request string, endpoint string,
    status int, reason string, dont_retry boolean, max_retry_times int,
    generation int, failed boolean, priority int"""


def log(spark, rows):
    """rows: (request, endpoint, status, extra)."""
    out = []
    for i, (request, endpoint, status, *extra) in enumerate(rows):
        e = extra[0] if extra else {}
        out.append((i, T0 + timedelta(seconds=i), request, endpoint, status,
                    e.get("reason"), e.get("flag"), e.get("cap"),
                    e.get("generation", 1), status != 200, 0))
    return spark.createDataFrame(out, SCHEMA)


def decisions(df, **kw):
    got = retry_decision(df, **kw).orderBy("attempt_id").collect()
    return [(r["retries"], r["decision"]) for r in got]


FOUR = [("r", "e", 500)] * 3 + [("r", "e", 200)]


def test_below_at_and_over_the_cap(spark):
    want = [(1, "retry"), (2, "retry"), (3, "gave_up"), (3, "ok")]
    assert decisions(log(spark, FOUR)) == want
    strict = decisions(log(spark, FOUR), inclusive=False)
    assert [d for _, d in strict] == ["retry", "gave_up", "gave_up", "ok"]
    free = decisions(log(spark, FOUR), cap=None)
    assert [d for _, d in free] == ["retry", "retry", "retry", "ok"]


def test_own_cap_wins(spark):
    df = log(spark, [("r", "e", 500, {"cap": 1})] * 2 + [("s", "e", 500, {"cap": 9})] * 4)
    got = [d for _, d in decisions(df, cap_col="max_retry_times")]
    assert got == ["retry", "gave_up"] + ["retry"] * 4


def test_flagged_gives_up(spark):
    df = log(spark, [("r", "e", 500, {"flag": True}), ("r", "e", 500)])
    assert [d for _, d in decisions(df, flag="dont_retry")] == ["gave_up", "retry"]


def test_stats_and_totals_agree(spark):
    rows = [(f"r{i % 3}", "e", 500 if i % 2 else 200, {"reason": f"c{i % 4}"})
            for i in range(40)]
    df = log(spark, rows)
    decided, stats = retry_report(df)
    by_reason = {r["reason"]: r for r in stats.collect() if not r["is_total"]}
    total = next(r for r in stats.collect() if r["is_total"])
    n = Counter(r["decision"] for r in decided.collect())
    assert (total["retry_count"], total["max_reached"]) == (n["retry"], n["gave_up"])
    assert sum(r["retry_count"] for r in by_reason.values()) == n["retry"]
    assert retry_totals(df).first().asDict() == dict(n)
    assert sum(n.values()) == 40


def test_priority_falls_with_each_retry(spark):
    got = retry_priority(retry_decision(log(spark, FOUR)), -2).orderBy("attempt_id")
    assert [r["priority"] for r in got.collect()] == [-2, -4, -6, -6]


def test_outcome_columns(spark):
    df = spark.createDataFrame(
        [(200, None), (301, None), (None, "x.Timeout"), (503, None), (799, None)],
        "status int, exception string",
    )
    s, e = F.col("status"), F.col("exception")
    got = df.select(is_ok(s), is_retryable(s, e, classes=["x.Timeout"]), reason_of(s, e))
    assert [tuple(r) for r in got.collect()] == [
        (True, False, "200 OK"),
        (False, False, "301 Moved Permanently"),
        (False, True, "x.Timeout"),
        (False, True, "503 Service Unavailable"),
        (False, False, "799 Unknown Status"),
    ]


def test_tallies_restart_with_each_generation(spark):
    rows = [("r", "bad", 500)] * 8 + [("r", "ok", 500)] * 7 + [("r", None, 500)] * 9
    rows += [("r", "split", 500, {"generation": g}) for g in (1, 2) for _ in range(5)]
    df = log(spark, rows)
    tally = endpoint_failures(df)
    assert {(r["generation"], r["endpoint"]): r["failures"] for r in tally.collect()} == {
        (1, "bad"): 8, (1, "ok"): 7, (1, "split"): 5, (2, "split"): 5}
    assert [r["endpoint"] for r in endpoints_to_evict(tally).collect()] == ["bad"]
    assert [r["attempt_id"] for r in evicted_at(df).collect()] == [7]
    assert {r["endpoint"] for r in evict_immediate(df).collect()} == {"bad", "ok", "split"}


def test_evict_and_pool_status(spark):
    pool = spark.createDataFrame([(f"e{i}",) for i in range(32)], "endpoint string")
    for bad, want in [(0, (32, False, False, False)), (3, (29, True, False, True)),
                      (13, (19, True, True, True))]:
        gone = spark.createDataFrame([(f"e{i}",) for i in range(bad)], "endpoint string")
        assert tuple(pool_status(evict(pool, gone)).first()) == want


def test_assign_worker(spark):
    df = assign_worker(spark.range(1000), ["id"], 4)
    n = Counter(r["worker"] for r in df.collect())
    assert set(n) == {0, 1, 2, 3} and min(n.values()) > 200
    again = assign_worker(spark.range(1000).repartition(7), ["id"], 4)
    assert sorted(again.collect()) == sorted(df.collect())


def brute(rows):
    """(key, ts, id, flag) to running counts by plain loop."""
    count, out = Counter(), {}
    for key, _, i, flag in sorted(rows, key=lambda r: (r[1], r[2])):
        count[key] += flag
        out[i] = count[key]
    return out


def skewed(kind):
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(400)}"
        at = rng.randrange(1000)
        if kind == "tied" and key == "hot" and rng.random() < 0.8:
            at = 500  # most of the hot key's rows share one instant
        if kind == "same":
            at = 500
        rows.append((key, at, i, rng.random() < 0.4))
    rng.shuffle(rows)
    return rows


CASTS = {
    "long": "at",
    "string": "cast(at as string)",
    "decimal": "cast(at as decimal(20,3))",
    "date": "date_add(date'2024-01-01', cast(at as int))",
    "timestamp": "timestamp_seconds(at * 10)",
    "timestamp_ntz": "cast(timestamp_seconds(at * 10) as timestamp_ntz)",
}


@pytest.mark.parametrize("kind", ["spread", "tied", "same"])
@pytest.mark.parametrize("type_", CASTS)
@pytest.mark.parametrize("ranges", [None, 40])
def test_running_count_of_a_hot_key(spark, kind, type_, ranges):
    rows = skewed(kind)
    if type_ == "string":  # in the order of the text
        rows = [(k, int(f"{at + 1000}"), i, f) for k, at, i, f in rows]
    df = spark.createDataFrame(rows, "k string, at long, id long, flag boolean")
    df = df.withColumn("at", F.expr(CASTS[type_]))
    out = running_count(df, ["k"], ["at", "id"], F.col("flag"), "n", ranges)
    assert out.columns == [*df.columns, "n"]
    assert {r["id"]: r["n"] for r in out.collect()} == brute(rows)


def test_running_count_of_null_keys_flags_and_times(spark):
    rows = [(None, None if i % 7 == 0 else i // 3, i, [True, False, None][i % 3]) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, at long, id long, flag boolean")
    out = running_count(df, ["k"], ["at", "id"], F.col("flag"), "n", 16).collect()
    at = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    want, n = {}, 0
    for _, _, i, flag in at:
        n += bool(flag)
        want[i] = n
    assert {r["id"]: r["n"] for r in out} == want


def test_queue_positions(spark):
    df = spark.range(500).select((F.col("id") * 7 % 501).alias("seq"))
    seqs = sorted(r["seq"] for r in df.collect())
    for lifo in (False, True):
        got = {r["seq"]: r["position"] for r in queue_position(df, "seq", lifo).collect()}
        assert got == {s: i for i, s in enumerate(seqs[::-1] if lifo else seqs, 1)}


def test_spread_gives_each_worker_a_partition(spark):
    got = spread(spark.range(1000), ["id"], 9).withColumn("p", F.spark_partition_id()).collect()
    assert all(r["p"] == r["worker"] for r in got) and len({r["p"] for r in got}) == 9


def test_attempt_number_with_and_without_slices(spark):
    rows = [("hot" if i % 3 else f"r{i}", "e", 500 if i % 5 else 200) for i in range(900)]
    df = log(spark, rows)
    a = attempt_number(df).select("attempt_id", "retries").collect()
    b = attempt_number(df, ranges=50).select("attempt_id", "retries").collect()
    assert sorted(a) == sorted(b)


def test_first_per_key(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), ("b", 1, None)], "k string, o int, v string"
    )
    assert sorted(map(tuple, first_per_key(df, ["k"], ["o"]).collect())) == [
        ("a", 1, "y"), ("b", 1, None)]
