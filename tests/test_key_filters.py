"""Filters of keys beside a table: fewer partitions read, and the rows of the exact join whatever the filters say."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources import key_filters, tables

DAY = dt.date(2024, 1, 1)


def rows(spark, numbers, value=0, day=lambda i: DAY + dt.timedelta(days=i // 100)):
    return spark.createDataFrame([(f"key{i}", value, day(i)) for i in numbers], "k string, v int, d date")


def merge(spark, path, df):
    tables.merge_insert_only(spark, path, df, ["k"], ["d"], filters=True)




def test_only_partitions_that_may_match_are_read(spark, folder):
    path = f"{folder}/t"
    merge(spark, path, rows(spark, range(3000)))  # 30 days
    again, new = [5, 7, 1203], list(range(50_000, 50_020))
    source = rows(spark, again + new, 1, lambda i: DAY)
    found = key_filters.perhaps(spark, path, source, ["k"]).collect()
    days = {r.partition for r in found}
    assert {(f"key{i}", DAY + dt.timedelta(days=i // 100)) for i in again} <= {(r.k, r.partition) for r in found} and len(days) < 6
    with key_filters.unseen(tables.read(spark, path), source, path, ["k"], "d") as fresh:
        plan = fresh._jdf.queryExecution().optimizedPlan().toString() + fresh._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.k for r in fresh.collect()) == sorted(f"key{i}" for i in new)
        scans = [line for line in fresh._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters: [" in line and "d#" in line]
        assert scans and all("d#" in s and ("IN" in s or "=" in s) for s in scans), plan
    none = rows(spark, range(90_000, 90_003), 1)
    if not key_filters.perhaps(spark, path, none, ["k"]).count():
        with key_filters.unseen(tables.read(spark, path), none, path, ["k"], "d") as fresh:
            assert "parquet" not in fresh._jdf.queryExecution().optimizedPlan().toString().lower()  # the table is not read at all


@pytest.mark.parametrize(("words", "keys"), [(1, 5000), (16, 64), (16, 1)])
def test_equal_to_the_anti_join_at_any_rate_of_false_answers(spark, folder, monkeypatch, words, keys):
    """From filters that are all ones to filters that are never wrong."""
    monkeypatch.setattr(key_filters, "WORDS", words)
    monkeypatch.setattr(key_filters, "KEYS", keys)
    rng, path, plain = random.Random(keys), f"{folder}/t", f"{folder}/p"
    for n in range(2):
        source = rows(spark, rng.sample(range(800), 300), n, lambda i: None if i % 7 == 0 else DAY + dt.timedelta(days=i % 5))
        merge(spark, path, source)
        tables.merge_insert_only(spark, plain, source, ["k"], ["d"])
    read = lambda p: sorted((r.k, r.v, str(r.d)) for r in tables.read(spark, p).collect())
    assert read(path) == read(plain) and len(read(path)) == len({k for k, _, _ in read(path)})


def test_a_key_in_another_partition_is_found(spark, folder):
    path = f"{folder}/t"
    merge(spark, path, rows(spark, [1, 2]))
    merge(spark, path, rows(spark, [2, 3], 9, lambda i: DAY + dt.timedelta(days=50)))
    assert sorted((r.k, r.v) for r in tables.read(spark, path).collect()) == [("key1", 0), ("key2", 0), ("key3", 9)]


def test_a_table_from_before_is_remembered_once(spark, folder):
    path = f"{folder}/t"
    tables.append(rows(spark, range(300)), path, ["d"])
    merge(spark, path, rows(spark, range(250, 350), 1))
    assert tables.read(spark, path).count() == 350 and tables.read(spark, path).filter("v = 1").count() == 50
    n = tables.read(spark, key_filters.place(path)).count()
    key_filters.rebuild(spark, path, ["k"], "d")
    assert 0 < tables.read(spark, key_filters.place(path)).count() <= n
    merge(spark, path, rows(spark, range(400), 2))
    assert tables.read(spark, path).count() == 400


def test_what_is_derived_comes_first(spark, folder):
    """If what follows from the new rows fails, they are not appended, and a retry finds them new again."""
    path, got = f"{folder}/t", []

    def fails(df):
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        tables.merge_insert_only(spark, path, rows(spark, [1]), ["k"], ["d"], filters=True, first=fails)
    tables.merge_insert_only(spark, path, rows(spark, [1, 2]), ["k"], ["d"], filters=True, first=lambda df: got.extend(r.k for r in df.collect()))
    tables.merge_insert_only(spark, path, rows(spark, [2, 3]), ["k"], ["d"], filters=True, first=lambda df: got.extend(r.k for r in df.collect()))
    assert sorted(got) == ["key1", "key2", "key3"]


def test_keys_of_several_columns_and_nulls(spark, folder):
    path = f"{folder}/t"
    df = spark.createDataFrame([("a", "b", 1), ("ab", "", 1), ("a", None, None)], "x string, y string, d int")
    key_filters.remember(df, path, ["x", "y"], "d", 0)
    found = {(r.x, r.y, r.partition) for r in key_filters.perhaps(spark, path, df, ["x", "y"]).collect()}
    assert {("a", "b", 1), ("ab", "", 1), ("a", None, None)} <= found and len(found) < 6


def test_no_filters_of_no_rows(spark, folder):
    path = f"{folder}/t"
    merge(spark, path, rows(spark, [1]).limit(0))
    merge(spark, path, rows(spark, [1]))
    merge(spark, path, rows(spark, []))
    assert tables.read(spark, path).select(F.count("*")).first()[0] == 1
