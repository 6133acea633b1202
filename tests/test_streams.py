import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pagelake.operators.attempts import retry_decision
from pagelake.operators.records import BOOK_SCHEMA, extract_records
from pagelake.sources.tables import (
    load_endpoints,
    read_seeds,
    write_records,
    write_records_json,
)
from pagelake.streaming.drain import drain_records, drained, progress
from pagelake.streaming.state import dedup_stream, endpoint_tally, retry_counter

GOOD = {"book_name": "A", "book_info": ["x", "y"], "book_type": []}
QUEUE = [
    json.dumps(GOOD),
    "{not json",
    json.dumps({"book_name": "B"}),
    json.dumps({"book_name": "C", "extra": 1, "more": [1, 2]}),
    json.dumps(GOOD),
]


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def drain(spark, tmp):
    q = drain_records(
        spark, str(tmp / "in"), str(tmp / "out"), str(tmp / "ckpt"), BOOK_SCHEMA
    )
    q.awaitTermination()
    return drained(spark, str(tmp / "out"))


def test_drain(spark, tmp_path):
    put(tmp_path / "in", "1.json", QUEUE)
    rows = drain(spark, tmp_path).collect()
    assert sorted(r["book_name"] or "" for r in rows) == ["", "A", "A", "B", "C"]
    bad = next(r for r in rows if r["book_name"] is None)
    assert bad["_corrupt"] == "{not json" and bad["_rest"] is None
    extra = next(r for r in rows if r["book_name"] == "C")
    assert json.loads(extra["_rest"]) == {"extra": "1", "more": "[1,2]"}
    assert all(r["book_info"] == ["x", "y"] for r in rows if r["book_name"] == "A")


def test_drain_twice_is_drain_once_and_new_files_are_added(spark, tmp_path):
    put(tmp_path / "in", "1.json", QUEUE)
    assert drain(spark, tmp_path).count() == 5
    assert drain(spark, tmp_path).count() == 5
    put(tmp_path / "in", "2.json", QUEUE[:2])
    store = drain(spark, tmp_path)
    assert [tuple(r)[1:] for r in progress(store).orderBy("batch_id").collect()] == [
        (0, 5, 5), (1, 2, 7)]


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    put(tmp_path / "in", "1.json", QUEUE)
    drain(spark, tmp_path)
    # As after a crash between the write and the commit of batch 0.
    commits = tmp_path / "ckpt" / "commits"
    for f in [*commits.glob("0"), *commits.glob(".0.crc")]:
        f.unlink()
    assert drain(spark, tmp_path).count() == 5


def run(stream, tmp, mode="append"):
    out = str(tmp / "result")
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", str(tmp / "ck"))

    def save(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer.foreachBatch(save).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(out)


def source(spark, df, folder, per_batch=1):
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(str(folder))


def test_dedup_stream_over_restarts(spark, tmp_path):
    src = tmp_path / "src"
    first = spark.createDataFrame([(i % 7, i) for i in range(500)], "fp int, n int")
    first.coalesce(1).write.parquet(str(src))
    got = run(dedup_stream(source(spark, first, src), "fp"), tmp_path)
    assert sorted(r["fp"] for r in got.collect()) == list(range(7))
    more = spark.createDataFrame([(i % 9, i) for i in range(500)], "fp int, n int")
    more.coalesce(1).write.mode("append").parquet(str(src))
    got = run(dedup_stream(source(spark, first, src), "fp"), tmp_path)
    assert sorted(r["fp"] for r in got.collect()) == list(range(9))


T0 = datetime(2024, 1, 1)


def attempts(spark, lo, hi):
    # A third of the rows belong to one request.
    rows = [
        (i, T0 + timedelta(seconds=i), "hot" if i % 3 == 0 else f"r{i % 40}", i % 4 != 0)
        for i in range(lo, hi)
    ]
    return spark.createDataFrame(
        rows, "attempt_id long, ts timestamp, request string, failed boolean"
    )


@pytest.mark.parametrize("cap", [1, 2, 5])
def test_retry_counter_is_the_twin_of_the_batch_decision(spark, tmp_path, cap):
    src = tmp_path / "src"
    for lo in range(0, 900, 300):  # three batches, with the count carried over
        part = attempts(spark, lo, lo + 300).repartition(3)
        part.write.parquet(str(src / f"b={lo}"))
    df = attempts(spark, 0, 900)
    stream = (
        spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 3)
        .parquet(str(src / "b=*"))
    )
    got = run(retry_counter(stream, cap), tmp_path)
    assert got.select("batch_id").distinct().count() == 3
    want = retry_decision(df, cap).withColumn(
        "retries", F.when(F.col("failed"), F.least("retries", F.lit(cap + 1)))
    )
    cols = ["attempt_id", "decision", "retries"]
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(
        map(tuple, want.select(cols).collect()), key=str
    )


@pytest.mark.parametrize("largest", [None, 7])
def test_retry_counter_with_own_caps_and_flags(spark, tmp_path, largest):
    """Rows of one request may differ in their caps; a flagged failure counts too."""
    df = attempts(spark, 0, 900).withColumns({
        "most": F.when(F.col("attempt_id") % 5 == 0, F.col("attempt_id") % 8),
        "stop": F.when(F.col("attempt_id") % 7 > 0, F.col("attempt_id") % 7 == 1),
    })
    src = tmp_path / "src"
    for lo in range(0, 900, 300):
        part = df.filter(f"attempt_id >= {lo} AND attempt_id < {lo + 300}")
        part.repartition(3).write.parquet(str(src / f"b={lo}"))
    stream = (
        spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 3)
        .parquet(str(src / "b=*"))
    )
    got = run(retry_counter(stream, 2, cap_col="most", flag="stop", largest=largest), tmp_path)
    assert got.select("batch_id").distinct().count() == 3
    limit = F.coalesce("most", F.lit(2))
    want = retry_decision(df, 2, cap_col="most", flag="stop").withColumn(
        "retries", F.when(F.col("failed"), F.least("retries", limit + 1))
    )
    cols = ["attempt_id", "decision", "retries"]
    assert sorted(map(tuple, got.select(cols).collect()), key=str) == sorted(
        map(tuple, want.select(cols).collect()), key=str
    )


def test_retry_counter_refuses_taken_names(spark):
    with pytest.raises(ValueError):
        retry_counter(attempts(spark, 0, 3).withColumn("decision", F.lit("x")))


def test_endpoint_tally_updates(spark, tmp_path):
    src = tmp_path / "src"
    df = spark.createDataFrame(
        [(1, "e" if i % 2 else None, i % 3 > 0) for i in range(60)],
        "generation int, endpoint string, failed boolean",
    )
    for _ in range(2):
        df.coalesce(1).write.mode("append").parquet(str(src))
    got = run(endpoint_tally(source(spark, df, src)), tmp_path, "update")
    assert [r["failures"] for r in got.orderBy("batch_id").collect()] == [20, 40]


def test_streaming_extraction_equals_batch(spark, tmp_path):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    pages.repartition(4).write.parquet(str(tmp_path / "src"))
    got = run(extract_records(source(spark, pages, tmp_path / "src")), tmp_path)
    want = extract_records(pages)
    assert sorted(got.drop("batch_id").collect(), key=str) == sorted(want.collect(), key=str)


def test_load_endpoints(spark):
    rows = [(1, '[["10.0.0.1", 80, 5], ["10.0.0.2", "81"]]'), (2, "[]"), (3, "{bad"),
            (4, '[["10.0.0.3", 82]]'), (5, '[["x"], ["y", "z"]]'), (6, None)]
    df = spark.createDataFrame(rows, "generation int, payload string")
    got = load_endpoints(df).orderBy("generation", "ip").collect()
    assert [(r.generation, r.endpoint, r.failures) for r in got] == [
        (1, "10.0.0.1:80", 0), (1, "10.0.0.2:81", 0), (4, "10.0.0.3:82", 0)]


def test_read_seeds(spark, tmp_path):
    (tmp_path / "s.txt").write_text(" http://a/ \n\nhttp://b/\nhttp://a/\n")
    got = [r["link"] for r in read_seeds(spark, str(tmp_path / "s.txt")).collect()]
    assert got == ["http://a/", "http://b/", "http://a/"]


def test_write_records(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    plain, keyed = str(tmp_path / "p"), str(tmp_path / "k")
    for _ in range(2):
        write_records(df, plain)
        write_records(df, keyed, key=["k"])
    assert spark.read.parquet(plain).count() == 6
    assert sorted(map(tuple, spark.read.parquet(keyed).collect())) == [(1, "a"), (2, "c")]


def test_json_round_trip_keeps_null_fields(spark, tmp_path):
    df = spark.createDataFrame([(None, [])], "a string, b array<string>")
    write_records_json(df, str(tmp_path / "j"))
    assert spark.read.text(str(tmp_path / "j")).first()[0] == '{"a":null,"b":[]}'


def test_two_queues_and_a_new_checkpoint_add_to_one_store(spark, tmp_path):
    for i, (queue, ckpt) in enumerate([("a", "c1"), ("b", "c2"), ("a", "c3")]):
        put(tmp_path / queue, f"{i}.json", QUEUE)
        q = drain_records(
            spark, str(tmp_path / queue), str(tmp_path / "out"), str(tmp_path / ckpt), BOOK_SCHEMA
        )
        q.awaitTermination()
    assert drained(spark, str(tmp_path / "out")).count() == 5 + 5 + 10
