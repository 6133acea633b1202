"""Stored sets and records: null keys, layouts, unusable input."""

import pytest
from pyspark.sql import functions as F

from pagelake.functions.urls import decoded_url
from pagelake.operators.pool import pool_status
from pagelake.sources.seen import seen_table
from pagelake.sources import tables
from pagelake.sources.tables import load_endpoints, store_pages, unusable_payloads, write_records


def test_another_bucket_count_raises(spark, tmp_path):
    path = str(tmp_path / "seen")
    seen_table(spark, "seen_a", path, 8)
    seen_table(spark, "seen_b", path, 8)
    with pytest.raises(ValueError):
        seen_table(spark, "seen_c", path, 4)
    for name in ("seen_a", "seen_b"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_null_key_is_stored_once(spark, tmp_path):
    path = str(tmp_path / "records")
    rows = spark.createDataFrame([(None, 1), ("a", 2), (None, 3)], "k string, v int")
    for _ in range(3):
        write_records(rows, path, key=["k"])
    assert sorted(map(str, (tuple(r) for r in spark.read.parquet(path).collect()))) == [
        "('a', 2)", "(None, 1)"]


def test_unusable_payloads_are_not_lost(spark):
    texts = ['[["1.2.3.4", "80"]]', "{bad", None, '[["1.2.3.4"]]', "[]"]
    table = spark.createDataFrame([(t,) for t in texts], "payload string")
    assert load_endpoints(table).count() == 1
    assert {r["payload"] for r in unusable_payloads(table).collect()} == set(texts[1:4])


def test_pool_status_of_each_generation(spark):
    pool = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "generation int, endpoint string")
    assert {r["generation"]: r["pool_size"] for r in pool_status(pool).collect()} == {1: 2, 2: 1}
    assert pool_status(pool.select("endpoint")).first()["pool_size"] == 3


def test_one_bad_escape_leaves_the_others_decoded(spark):
    urls = ["/tag/%E5%B0%8F%zz", "/a%20b+c", "/%FF", "plain", "100%"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in df.select(decoded_url(F.col("u"))).collect()]
    assert got[0] == "/tag/小%zz" and got[1] == "/a b+c" and got[3:] == ["plain", "100%"]


def test_pages_are_stored_once_in_files_by_size(spark, tmp_path):
    path = str(tmp_path / "pages")
    rows = [(i, f"http://h{i % 3}.org/{i}", "x" * 100) for i in range(50)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    store_pages(pages, path, file_bytes=1000)
    assert len(list((tmp_path / "pages").glob("*.parquet"))) == 6
    store_pages(pages, path)
    assert spark.read.parquet(path).count() == 50


def values(spark, path):
    return sorted(r["k"] for r in spark.read.parquet(path).collect())


def test_an_append_reads_the_buckets_of_its_keys_only(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    write_records(rows, path, key=["k"])
    # Without its files the store cannot have been read by the next appends.
    for f in (tmp_path / "store").glob("*.parquet"):
        f.rename(f.with_name("_" + f.name))
    one = rows.filter("k = 7").union(spark.createDataFrame([(1000, "new")], "k long, v string"))
    buckets = {r[0] for r in one.select(F.pmod(F.xxhash64("k"), F.lit(tables.KEY_BUCKETS))).collect()}
    for b in (tmp_path / "store" / "_keys" / "k-16").iterdir():
        if b.name.startswith("key_bucket=") and int(b.name.split("=")[1]) not in buckets:
            for f in b.glob("*.parquet"):
                f.write_bytes(b"unreadable")
    write_records(one, path, key=["k"])
    assert values(spark, path) == [1000]


def test_an_index_that_was_not_finished_is_made_anew(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    first.write.parquet(path)  # a store older than its index
    write_records(spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), path, key=["k"])
    assert values(spark, path) == [1, 2, 3]

    def dies(*a):
        raise RuntimeError

    usual = tables._index_keys
    monkeypatch.setattr(tables, "_index_keys", dies)
    with pytest.raises(RuntimeError):
        write_records(spark.createDataFrame([(4, "e")], "k int, v string"), path, key=["k"])
    monkeypatch.setattr(tables, "_index_keys", usual)
    for _ in range(2):
        write_records(spark.createDataFrame([(4, "f"), (5, "g")], "k int, v string"), path, key=["k"])
        assert values(spark, path) == [1, 2, 3, 4, 5]
    # Records without a key make the index look at the store again.
    write_records(spark.createDataFrame([(6, "p")], "k int, v string"), path)
    write_records(spark.createDataFrame([(6, "q")], "k int, v string"), path, key=["k"])
    assert values(spark, path) == [1, 2, 3, 4, 5, 6]
    # Another key of the same store has an index of its own.
    write_records(spark.createDataFrame([(9, "a"), (8, "z")], "k int, v string"), path, key=["v"])
    assert values(spark, path) == [1, 2, 3, 4, 5, 6, 8]
    write_records(spark.createDataFrame([(8, "y"), (7, "x")], "k int, v string"), path, key=["k"])
    assert values(spark, path) == [1, 2, 3, 4, 5, 6, 7, 8]
