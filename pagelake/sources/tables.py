"""Pages, seeds, endpoint payloads and record stores."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.functions.text import strip_text
from pagelake.functions.urls import host_key, join_endpoint, key_in_domains
from pagelake.operators.skew import first_per_key
from pagelake.session import scratch_dir, written

PAGE_COLUMNS = ("page_id", "url", "html")


def read_pages(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    domains: list[str] | None = None,
) -> DataFrame:
    """Captured pages: :data:`PAGE_COLUMNS`, and the ``status`` they were answered with if
    it is stored. Columns a job does not use are not read from disk.

    ``domains`` needs pages stored by :func:`store_pages` and skips the row
    groups of other domains.
    """
    pages = spark.read.parquet(path)
    if columns is None:
        columns = [*PAGE_COLUMNS, *(c for c in ("status",) if c in pages.columns)]
    if domains is not None:
        pages = pages.filter(key_in_domains(F.col("host_key"), domains))
    return pages.select(*columns)


def _not_stored(rows: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Rows whose key the store does not have. A null key is a key as well."""
    try:
        stored = rows.sparkSession.read.parquet(path).select(*keys)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return rows
    same = reduce(
        lambda a, b: a & b, (rows[k].eqNullSafe(F.col(f"_stored_{k}")) for k in keys)
    )
    return rows.join(stored.toDF(*(f"_stored_{k}" for k in keys)), same, "left_anti")


def store_pages(
    pages: DataFrame,
    path: str,
    key: Sequence[str] = ("page_id",),
    file_bytes: int = 128 << 20,
) -> None:
    """Pages with a ``host_key``, those of a domain side by side.

    Ranges run over host and url and are as many as the text's size asks for, so a
    host with a third of all pages is spread over its share of files. Pages whose
    ``key`` is stored already are not stored again.
    """
    new = _not_stored(pages, path, list(key))
    keyed = new.withColumn("host_key", host_key(F.col("url")))
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    ranged = keyed.repartitionByRange(1 + size // file_bytes, "host_key", "url")
    ranged.sortWithinPartitions("host_key", "url").write.mode("append").parquet(path)


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Start urls, one per line; blank lines are skipped, repeats are kept."""
    lines = spark.read.text(path).select(strip_text(F.col("value")).alias("link"))
    return lines.filter(F.col("link") != "")


def load_endpoints(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """JSON arrays of ``[ip, port, ...]`` to ``ip, port, endpoint, failures``.

    Other columns (such as a generation) are kept. Payloads that are no such
    array, and entries without ip or port, give no row.
    """
    others = [c for c in payloads.columns if c != col]
    entry = F.from_json(F.col(col), "array<array<string>>")
    rows = payloads.select(*others, F.explode_outer(entry).alias("_e"))
    ip, port = F.get("_e", F.lit(0)), F.get("_e", F.lit(1)).try_cast("int")
    return (
        rows.select(*others, ip.alias("ip"), port.alias("port"))
        .filter(F.col("ip").isNotNull() & F.col("port").isNotNull())
        .withColumn("endpoint", join_endpoint(F.col("ip"), F.col("port")))
        .withColumn("failures", F.lit(0))
    )


def unusable_payloads(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """Payloads that :func:`load_endpoints` takes no or not every entry from."""
    entry = F.from_json(F.col(col), "array<array<string>>")
    bad = F.exists(
        entry, lambda e: F.get(e, F.lit(0)).isNull() | F.get(e, F.lit(1)).try_cast("int").isNull()
    )
    return payloads.filter(F.coalesce(bad, F.lit(True)))


def parse_json(col: Column, schema: T.StructType, corrupt: str = "_corrupt") -> Column:
    """Text to a struct. What is not JSON goes to the ``corrupt`` field whole;
    missing fields are null.
    """
    full = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    return F.from_json(
        col,
        full,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt},
    )


def json_lines(records: DataFrame) -> DataFrame:
    """Each record as one JSON string, null fields written out as such."""
    packed = F.struct(*records.columns)
    return records.select(
        F.to_json(packed, {"ignoreNullFields": "false"}).alias("value")
    )


def write_records_json(records: DataFrame, path: str) -> None:
    """Records as JSON lines."""
    json_lines(records).write.mode("append").text(path)


KEY_BUCKETS = 16  # folders of a key index, unless a store asks for more


def _read_or_none(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _key_bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _index_keys(rows: DataFrame, keys: list[str], path: str, mode: str, buckets: int) -> None:
    """Add the rows' keys to the index, a folder for each bucket. A key's bucket is its
    hash, so keys of any skew are spread evenly, and one task writes one folder.
    """
    bucket = _key_bucket(keys, buckets).alias("key_bucket")
    dealt = rows.select(*keys, bucket).repartition(buckets, "key_bucket")
    dealt.write.mode(mode).partitionBy("key_bucket").parquet(path)


_EVENTS = T.StructType([T.StructField("event", T.StringType())])


def _log_index(spark: SparkSession, path: str, *events: str) -> None:
    rows = spark.range(1).select(F.explode(F.array(*map(F.lit, events))).alias("event"))
    rows.coalesce(1).write.mode("append").parquet(path)


def _index_of(path: str, keys: list[str], buckets: int) -> tuple[str, str]:
    """The index's name and folder."""
    name = "-".join([*keys, str(buckets)])
    return name, f"{path}/_keys/{name}"


def indexed_keys(
    spark: SparkSession, path: str, schema: T.StructType, buckets: int = KEY_BUCKETS
) -> DataFrame | None:
    """The keys (columns of ``schema``) of the store at ``path`` and their ``key_bucket``,
    from its index; None if there is no store yet.

    An index that is not known to be complete is made anew from the store: as the append
    that should have filled it did not end, as records were appended without a key or by
    another, or as the store is older than its index. The index and the log that tells lie in folders
    whose names begin with ``_``, which readers of the store pass over.
    """
    keys = schema.fieldNames()
    name, index = _index_of(path, keys, buckets)
    log, event = f"{path}/_keys_log", F.col("event")
    events = _read_or_none(spark, log, _EVENTS)
    begun = ended = other = 0
    made = None
    if events is not None:
        # "made n": from the store as it was after n appends that passed this index by.
        after = F.when(event.startswith(f"{name} made "), F.substring_index(event, " ", -1))
        passed = (event == "plain") | (event.endswith(" begun") & (event != f"{name} begun"))
        begun, ended, other, made = events.agg(
            *(F.count_if(event == f"{name} {e}") for e in ("begun", "ended")),
            F.count_if(passed),
            F.max(after.cast("bigint")),
        ).first()
    if made != other or begun != ended:
        stored = _read_or_none(spark, path)
        if stored is not None:
            _index_keys(stored, keys, index, "overwrite", buckets)
        _log_index(spark, log, f"{name} made {other}", *[f"{name} ended"] * (begun - ended))
    # By its schema, so that no file of it is opened here.
    full = T.StructType([*schema.fields, T.StructField("key_bucket", T.IntegerType())])
    return _read_or_none(spark, index, full)


def _append_by_key(records: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Append the records whose key the index does not have, and their keys to it."""
    spark = records.sparkSession
    name, index = _index_of(path, keys, buckets)
    log = f"{path}/_keys_log"
    rows = records.withColumn("_key_bucket", _key_bucket(keys, buckets))
    rows = written(rows, scratch_dir(spark, "append"))
    known = indexed_keys(spark, path, T.StructType([records.schema[k] for k in keys]), buckets)
    if known is not None:
        # At most so many numbers: files of other buckets are not opened.
        touched = [r[0] for r in rows.select("_key_bucket").distinct().collect()]
        known = known.filter(F.col("key_bucket").isin(touched) if touched else F.lit(False))
        known = known.select("key_bucket", *keys).toDF("_b", *(f"_stored_{k}" for k in keys))
        same = reduce(
            lambda a, b: a & b, (rows[k].eqNullSafe(F.col(f"_stored_{k}")) for k in keys)
        )
        same = same & (rows["_key_bucket"] == F.col("_b"))
        rows = written(rows.join(known, same, "left_anti"), scratch_dir(spark, "fresh"))
    fresh = rows.drop("_key_bucket")
    _log_index(spark, log, f"{name} begun")
    fresh.write.mode("append").parquet(path)
    _index_keys(fresh, keys, index, "append", buckets)
    _log_index(spark, log, f"{name} ended")


def write_records(
    records: DataFrame,
    path: str,
    mode: str = "append",
    key: Sequence[str] | None = None,
    order: Sequence[str] | None = None,
    key_buckets: int = KEY_BUCKETS,
) -> None:
    """Append records to a parquet store.

    Without a key repeats are kept. With one, a key is stored once: the first
    record by ``order`` (by default all other columns), and none for a key the
    store already has. An append looks these up in a key index beside the store
    (:func:`indexed_keys`), of which it reads the buckets its own keys fall into, and
    never in the store itself. ``key_buckets`` should keep a bucket within a task's reach;
    another number starts another index. One writer at a time, and none that writes to the
    store past this function.
    """
    if key is None:
        spark = records.sparkSession
        if mode == "append" and _read_or_none(spark, f"{path}/_keys_log", _EVENTS) is not None:
            _log_index(spark, f"{path}/_keys_log", "plain")
        records.write.mode(mode).parquet(path)
        return
    keys = list(key)
    rest = [c for c in records.columns if c not in keys]
    records = first_per_key(records, keys, list(order) if order else rest)
    if mode == "append":
        _append_by_key(records, path, keys, key_buckets)
    else:
        records.write.mode(mode).parquet(path)
