"""Key-value upsert tables: create, merge, replay, count."""

import os

from cartwheel.sinks.kvstore import KeyValueStore


def cells(spark, rows):
    return spark.createDataFrame(rows, "row_key string, column string, value string")


def table(kv, name):
    return sorted(tuple(r)[1:] for r in kv.read(name).collect())


def test_create_is_idempotent(spark, tmp_path):
    kv = KeyValueStore(spark, str(tmp_path))
    assert kv.create_table("t") is True
    assert kv.create_table("t") is False
    assert kv.count_rows("t") == 0 and table(kv, "t") == []
    assert kv.count_rows("other") == 0 and table(kv, "other") == []
    kv.put(cells(spark, [("k", "cf:a", "1")]), "t")
    assert kv.create_table("t") is False and kv.count_rows("t") == 1


def test_put_replaces_named_cells_and_keeps_others(spark, tmp_path):
    kv = KeyValueStore(spark, str(tmp_path))
    kv.put(cells(spark, [("k1", "cf:a", "1"), ("k1", "cf:b", "2"), ("k2", "cf:a", "3")]), "t")
    kv.put(cells(spark, [("k1", "cf:a", "10"), ("k3", "cf:a", "4")]), "t")
    assert table(kv, "t") == [
        ("k1", "cf:a", "10"),
        ("k1", "cf:b", "2"),
        ("k2", "cf:a", "3"),
        ("k3", "cf:a", "4"),
    ]
    assert kv.count_rows("t") == 3
    assert kv.read("t").columns == ["table", "row_key", "column", "value"]


def test_a_named_put_replaces_itself_only(spark, tmp_path):
    kv = KeyValueStore(spark, str(tmp_path))
    for _ in range(2):  # a replayed micro-batch
        kv.put(cells(spark, [("k", "cf:a", "1")]), "t", "q-7")
    assert sorted(os.listdir(tmp_path / "t")) == ["put=q-7"]
    kv.put(cells(spark, [("k", "cf:a", "2")]), "t", "q-8")
    # another stream may use the same batch numbers, also smaller ones
    kv.put(cells(spark, [("k2", "cf:a", "3")]), "t", "other-0")
    assert table(kv, "t") == [("k", "cf:a", "2"), ("k2", "cf:a", "3")]


def test_a_put_writes_only_its_own_cells(spark, tmp_path):
    kv = KeyValueStore(spark, str(tmp_path))
    for i in range(5):
        kv.put(cells(spark, [("k", "cf:a", str(i)), (f"k{i}", "cf:b", "x")]), "t")
    assert len(os.listdir(tmp_path / "t")) == 5
    for put in os.listdir(tmp_path / "t"):
        assert spark.read.parquet(str(tmp_path / "t" / put)).count() == 2
    assert table(kv, "t") == [("k", "cf:a", "4")] + [(f"k{i}", "cf:b", "x") for i in range(5)]


def test_empty_puts(spark, tmp_path):
    kv = KeyValueStore(spark, str(tmp_path))
    kv.put(cells(spark, []), "t")
    assert table(kv, "t") == [] and kv.count_rows("t") == 0
    kv.put(cells(spark, [("k", "cf:a", "1")]), "t")
    kv.put(cells(spark, []), "t")
    assert table(kv, "t") == [("k", "cf:a", "1")]


def test_bucketed_store_equals_the_plain_one(spark, tmp_path):
    from cartwheel.sinks.kvstore import BucketedStore

    spark.sql(f"CREATE DATABASE IF NOT EXISTS kvb LOCATION '{tmp_path}/db'")
    plain, bucketed = KeyValueStore(spark, str(tmp_path / "a")), BucketedStore(spark, str(tmp_path / "b"), "kvb", buckets=4)
    puts = [
        ("1", [("k1", "cf:a", "1"), ("k2", "cf:a", "2"), (None, "cf:a", "3")]),
        ("2", [("k1", "cf:a", "9"), ("k3", "cf:b", None)]),
        ("2", [("k1", "cf:a", "7")]),  # replaces the put of that name
        ("3", []),
    ]
    for store in (plain, bucketed):
        assert store.read("t-x").count() == 0 and store.count_rows("t-x") == 0
        for name, rows in puts:
            store.put(spark.createDataFrame(rows, "row_key string, column string, value string"), "t-x", name)
    rows = lambda store: sorted((tuple(r) for r in store.read("t-x").collect()), key=str)
    assert rows(bucketed) == rows(plain) and bucketed.count_rows("t-x") == plain.count_rows("t-x") == 2
    assert plain.create_table("t-x") is bucketed.create_table("t-x") is False and bucketed.create_table("new")
    read = bucketed.read("t-x")
    read.collect()
    assert "Exchange" not in read._jdf.queryExecution().executedPlan().toString()
    # another session's catalog does not know the table, the folder does
    spark.sql(f"DROP TABLE {bucketed._name('t-x')}")
    assert rows(bucketed) == rows(plain)
