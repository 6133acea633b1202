"""Streams, run over what is there and then stopped; the result is their table."""

from pyspark.sql import functions as F

from pagelake.operators.records import extract_records
from pagelake.session import scratch_dir
from pagelake.sources.tables import write_records_json
from pagelake.streaming.drain import drain_records, drained, progress
from pagelake.streaming.state import dedup_stream, endpoint_tally, retry_counter
from queries import query
from queries.inputs import ATTEMPTS_SQL, attempts, pages, table
from queries.records import _RECORD_SQL, PAGE_PICKS, _flat


def _stream(spark, df, label, files=4):
    """The rows of ``df`` as a stream of files."""
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def _run(spark, stream, label):
    """Run an append-only stream to its end and read what it wrote."""
    out = scratch_dir(spark, label)
    (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_dir(spark, f"{label}-checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(out)


def _drained(spark, sf):
    docs = table(spark, sf, "documents")
    queue, out, ckpt = (scratch_dir(spark, n) for n in ("queue", "drained", "ckpt"))
    write_records_json(docs, queue)
    for _ in range(2):  # the second run finds nothing left to do
        drain_records(spark, queue, out, ckpt, docs.schema).awaitTermination()
    return drained(spark, out)


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def a3_drain_records(spark, sf):
    return _drained(spark, sf).select("doc_id", "text", "lang", "source", "n_chars")


@query("SELECT doc_id, lang FROM documents")
def a3_drain_two_queues(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    out, english = scratch_dir(spark, "drained"), F.col("lang") == "en"
    for part in (docs.filter(english), docs.filter(~english)):
        queue, ckpt = (scratch_dir(spark, n) for n in ("queue", "ckpt"))
        write_records_json(part, queue)
        drain_records(spark, queue, out, ckpt, docs.schema).awaitTermination()
    return drained(spark, out).select("doc_id", "lang")


@query("SELECT doc_id, lang FROM documents")
def t1_queue_drain_in_batches(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    queue, out, ckpt = (scratch_dir(spark, n) for n in ("queue", "drained", "ckpt"))
    write_records_json(docs.repartition(6, "doc_id"), queue)
    drain_records(spark, queue, out, ckpt, docs.schema, files_per_batch=2).awaitTermination()
    return drained(spark, out).select("doc_id", "lang")


@query("SELECT count(*) AS saved FROM documents")
def f6_progress(spark, sf):
    return progress(_drained(spark, sf)).agg(F.max("saved").alias("saved"))


@query("SELECT DISTINCT sha1(text) AS fp FROM documents")
def d5_dedup_stream(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.sha1(F.col("text").cast("binary")).alias("fp"), "doc_id"
    )
    stream = dedup_stream(_stream(spark, docs, "documents"), "fp")
    return _run(spark, stream, "dedup").select("fp")


@query("SELECT DISTINCT sha1(text) AS fp FROM documents")
def t2_persistent_dedup(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.sha1(F.col("text").cast("binary")).alias("fp"), "lang"
    )
    source, out, ckpt = (scratch_dir(spark, n) for n in ("source", "once", "ckpt"))
    # The queue grows in two steps, and the stream is started anew for each.
    english = F.col("lang") == "en"
    for part in (docs.filter(english), docs.filter(~english)):
        part.write.mode("append").parquet(source)
        stream = dedup_stream(spark.readStream.schema(docs.schema).parquet(source), "fp")
        (
            stream.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start().awaitTermination()
        )
    return spark.read.schema(docs.schema).parquet(out).select("fp")


@query(f"WITH {_RECORD_SQL} SELECT * FROM records")
def t3_streaming_extraction(spark, sf):
    stream = _stream(spark, pages(spark, sf), "pages")
    return _flat(_run(spark, extract_records(stream, PAGE_PICKS), "records"))


def _in_time_order(spark, log, counter, label, parts=3):
    """Run a stream of attempts that arrive part by part, the earlier ones first; it is
    started anew for each part and goes on from its checkpoint.
    """
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    share = F.lit([(i + 1) / parts for i in range(parts - 1)])
    cuts = log.agg(F.percentile_approx(at, share)).first()[0] or []
    part = sum((F.coalesce(at > c, F.lit(False)).cast("int") for c in cuts), F.lit(0))
    source, out, ckpt = (scratch_dir(spark, f"{label}-{n}") for n in ("log", "out", "ckpt"))
    for i in range(parts):
        log.filter(part == i).write.mode("append").parquet(source)
        stream = counter(spark.readStream.schema(log.schema).parquet(source))
        (
            stream.writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start().awaitTermination()
        )
    return spark.read.schema(stream.schema).parquet(out)


def _counted_sql(limit: str, never: str) -> str:
    return f"""WITH {ATTEMPTS_SQL}
    SELECT attempt_id, request,
           CASE WHEN failed THEN CAST(least(n, {limit} + 1) AS BIGINT) END AS retries,
           CASE WHEN NOT failed THEN 'ok' WHEN n <= {limit} AND NOT {never} THEN 'retry'
                ELSE 'gave_up' END AS decision
    FROM (SELECT *, CASE WHEN failed THEN row_number() OVER (
              PARTITION BY request, failed ORDER BY ts, attempt_id) END AS n
          FROM attempts)"""


@query(_counted_sql("2", "false"))
def t4_stateful_retry_counter(spark, sf):
    log = attempts(spark, sf).select("attempt_id", "ts", "request", "failed")
    return _in_time_order(spark, log, retry_counter, "counter").drop("ts", "failed")


@query(_counted_sql("coalesce(max_retry_times, 2)", "dont_retry"))
def t4_stateful_retry_counter_own_cap(spark, sf):
    log = attempts(spark, sf).select(
        "attempt_id", "ts", "request", "failed", "max_retry_times", "dont_retry"
    )

    def counter(stream):
        return retry_counter(stream, cap_col="max_retry_times", flag="dont_retry")

    return _in_time_order(spark, log, counter, "own-cap").select(
        "attempt_id", "request", "retries", "decision"
    )


@query(f"""WITH {ATTEMPTS_SQL}
    SELECT generation, endpoint, count(*) AS failures FROM attempts
    WHERE failed AND endpoint IS NOT NULL GROUP BY ALL""")
def t5_stateful_endpoint_tally(spark, sf):
    log = attempts(spark, sf).select("generation", "endpoint", "failed")
    tally = endpoint_tally(_stream(spark, log, "attempts"))
    out = scratch_dir(spark, "tally")

    def save(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    (
        tally.writeStream.outputMode("update")
        .foreachBatch(save)
        .option("checkpointLocation", scratch_dir(spark, "tally-checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    # Tallies only grow, so the latest of each endpoint is the greatest.
    return spark.read.parquet(out).groupBy("generation", "endpoint").agg(
        F.max("failures").alias("failures")
    )
