import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidemark.schemas import QUARANTINE
from tidemark.sources import tables


def day(spark, rows):
    return spark.createDataFrame([(k, v, dt.date(2024, 1, d)) for k, v, d in rows], "k string, v int, d date")


def content(spark, path):
    return sorted(tuple(r) for r in tables.read(spark, path).select("k", "v").collect())


def test_upsert(spark, folder):
    path = f"{folder}/t"
    tables.merge_upsert(spark, path, day(spark, [("a", 1, 1), ("b", 2, 1), ("c", 3, 2)]), ["k"], "d")
    new = day(spark, [("b", 9, 1), ("e", 5, 3)])
    for _ in range(2):
        tables.merge_upsert(spark, path, new, ["k"], "d")
        assert content(spark, path) == [("a", 1), ("b", 9), ("c", 3), ("e", 5)]


def test_insert_only(spark, folder):
    path = f"{folder}/t"
    tables.merge_insert_only(spark, path, day(spark, [("a", 1, 1)]), ["k"], ["d"])
    tables.merge_insert_only(spark, path, day(spark, [("a", 7, 1), ("b", 2, 2)]), ["k"], ["d"])
    assert content(spark, path) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("rows", [[(None, 1, 1)], [("a", 1, 1), ("a", 2, 1)]])
def test_bad_keys_are_refused(spark, folder, rows):
    with pytest.raises(ValueError):
        tables.merge_upsert(spark, f"{folder}/t", day(spark, rows), ["k"], "d")


def test_a_merge_computes_its_source_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(k):
        seen.add(1)
        return k

    source = day(spark, [("a", 1, 1), ("b", 2, 2)]).withColumn("k", counted("k"))
    tables.merge_upsert(spark, f"{folder}/u", source, ["k"], "d")
    tables.merge_insert_only(spark, f"{folder}/i", source, ["k"], ["d"])
    assert seen.value == 4 and content(spark, f"{folder}/u") == content(spark, f"{folder}/i") == [("a", 1), ("b", 2)]
    assert sorted(os.listdir(folder)) == ["i", "u"]  # nothing is left beside the tables


def test_insert_only_within_a_range(spark, folder):
    path = f"{folder}/t"
    tables.merge_insert_only(spark, path, day(spark, [("a", 1, 1), ("b", 1, 2)]), ["k"], ["d"])
    tables.merge_insert_only(spark, path, day(spark, [("b", 7, 2), ("c", 2, 2)]), ["k"], ["d"], within="d >= '2024-01-02'")
    assert content(spark, path) == [("a", 1), ("b", 1), ("c", 2)]


def test_merge_statements():
    assert tables.merge_sql("/x", "v", ["a", "b"], True) == "MERGE INTO delta.`/x` t USING v s ON t.a = s.a AND t.b = s.b WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    assert "UPDATE" not in tables.merge_sql("/x", "v", ["a"], False)


def test_missing_table(spark, folder):
    assert not tables.exists(spark, f"{folder}/none")
    df = tables.read_or_empty(spark, f"{folder}/none", QUARANTINE)
    assert df.count() == 0 and df.schema == QUARANTINE
    tables.ensure(spark, f"{folder}/made", QUARANTINE)
    assert tables.exists(spark, f"{folder}/made") and tables.read(spark, f"{folder}/made").count() == 0


def test_versions(spark, folder):
    for n, part in enumerate(([(1, "a"), (2, "b"), (3, "c")], [(4, "d"), (5, "e")])):
        for _ in range(2):  # a commit that is written again replaces itself
            tables.commit(spark, spark.createDataFrame(part, ["k", "v"]), folder, n, F.lit("2024-02-01").cast("timestamp"))
    table = tables.read(spark, folder)
    assert [tables.version_as_of(table, v).count() for v in (0, 1)] == [3, 5]
    assert sorted((r.version, r.rows_added) for r in tables.history(table).collect()) == [(0, 3), (1, 2)]


def test_paths_and_external_tables(spark, folder):
    day(spark, [("a", 1, 1)]).write.parquet(f"{folder}/p")
    assert tables.query_path(spark, f"{folder}/p", "k").collect()[0].k == "a"
    tables.external_table(spark, "outside", f"{folder}/p")
    assert spark.table("outside").count() == 1
    spark.sql("DROP TABLE outside")


def test_json_log(spark, folder):
    from tidemark.operators.events import tail

    with open(f"{folder}/log.jsonl", "w") as f:
        f.write('{"event_id":"1"}\n\n   \n{broken\n{"event_id":"2"}\n')
    got = tail(tables.json_lines(spark, f"{folder}/log.jsonl"), 20).collect()
    assert [r.value for r in got] == ['{"event_id":"2"}', '{"event_id":"1"}'] and got[0].malformed_lines == 1
    tables.append_json(spark.createDataFrame([(1,)], "x int"), f"{folder}/out")
    assert spark.read.json(f"{folder}/out").first().x == 1


def test_formats(spark):
    assert tables.has_format(spark, "parquet") and not tables.has_format(spark, "no_such_format")


def test_an_upsert_keeps_the_rows_of_the_null_partition(spark, folder):
    path, schema = f"{folder}/t", "k int, v string, by string"
    put = lambda *rows: tables.merge_upsert(spark, path, spark.createDataFrame(list(rows), schema), ["k"], "by")
    put((1, "a", None), (2, "b", "x"))
    put((3, "c", None))
    put((1, "d", None), (4, "e", "x"))
    assert sorted(tuple(r) for r in tables.read(spark, path).select("k", "v", "by").collect()) == [(1, "d", None), (2, "b", "x"), (3, "c", None), (4, "e", "x")]
