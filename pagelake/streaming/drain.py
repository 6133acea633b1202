"""Drain a queue of JSON records into a table, restart-safe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pagelake.sources.tables import parse_json

CORRUPT, REST = "_corrupt", "_rest"


def parse_records(
    lines: DataFrame, schema: T.StructType, keep_rest: bool = True
) -> DataFrame:
    """JSON lines in ``value`` to the schema's columns plus ``_corrupt``.

    Keys the schema does not know are kept together as JSON in ``_rest``, null
    if there are none.
    """
    parsed = parse_json(F.col("value"), schema, CORRUPT)
    columns = [parsed.alias("_r")]
    if keep_rest:
        known = list(schema.fieldNames())
        rest = F.map_filter(
            F.from_json("value", "map<string,string>"), lambda k, v: ~k.isin(known)
        )
        columns.append(F.when(F.cardinality(rest) > 0, F.to_json(rest)).alias(REST))
    return lines.select(*columns).select("_r.*", *([REST] if keep_rest else []))


def read_queue(
    spark: SparkSession, in_dir: str, files_per_batch: int = 1000
) -> DataFrame:
    """The queue's JSON lines as a stream, oldest files first."""
    return (
        spark.readStream.schema("value string")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(in_dir)
    )


def drain_records(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    ckpt: str,
    schema: T.StructType,
    files_per_batch: int = 1000,
    keep_rest: bool = True,
) -> StreamingQuery:
    """Move what the queue holds now into ``out_dir``; start it again for more.

    Each batch overwrites the folder of its own id, below that of the query's id,
    which the checkpoint keeps. A batch that is replayed after a failure therefore
    stores its records once, while other queues and new checkpoints add to the
    store. Repeated records are kept, as the store has no key.
    """
    records = parse_records(
        read_queue(spark, in_dir, files_per_batch), schema, keep_rest
    )

    def save(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession.read.json(f"{ckpt}/metadata").first()["id"]
        folder = f"{out_dir}/drain={own}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(folder)

    return (
        records.writeStream.queryName("drain")
        .foreachBatch(save)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )


def drained(spark: SparkSession, out_dir: str) -> DataFrame:
    """The store that :func:`drain_records` fills."""
    return spark.read.parquet(out_dir)


def progress(store: DataFrame) -> DataFrame:
    """Records that each drain has saved so far, after each of its batches."""
    # The window runs over one row per batch, whatever the number of records.
    so_far = Window.partitionBy("drain").orderBy("batch_id")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, 0)
    return (
        store.groupBy("drain", "batch_id")
        .agg(F.count("*").alias("records"))
        .withColumn("saved", F.sum("records").over(so_far))
    )
