import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.schemas import AUDIT, declare
from tidemark.sources import compaction, tables
from tidemark.streaming import streams

ROW = declare("n:long event_date:date")


def write(spark, path, batch, items, by=("event_date",), files=1):
    day = lambda d: None if d is None else dt.date(2024, 1, d)
    df = spark.createDataFrame([(n, day(d)) for n, d in items], ROW).repartition(files)
    streams.write_batch(df, path, list(by), batch)


def seen(spark, path):
    return sorted((r.n, r.batch_id) for r in compaction.rows(spark, path, ROW).collect())


def table(spark, path, batches=6):
    """Batches with two rows of the 1st, one of the 2nd, and one without a date."""
    for b in range(batches):
        write(spark, path, b, [(10 * b, 1), (10 * b + 1, 1), (10 * b + 2, 2), (10 * b + 3, None)])
    return sorted((10 * b + i, b) for b in range(batches) for i in range(4))


def names(spark, path):
    return [r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path").collect()]


def test_closed_dates_become_one_file_and_rows_stay(spark, folder):
    path = f"{folder}/t"
    rows = table(spark, path)
    assert compaction.pack(spark, path, ROW, 4, "event_date", "2024-01-02") == 2  # the first day, and rows without a date
    assert seen(spark, path) == rows
    assert len(names(spark, path)) == 18 and len(names(spark, f"{path}.packed")) == 2
    assert compaction.clean(spark, path) == 10 and seen(spark, path) == rows
    # the 2nd of all batches, and what the last batch has
    assert len(names(spark, path)) == 8
    assert compaction.clean(spark, path) == 0
    # late rows of a day that was packed are packed by a later call; a day with one file is left
    write(spark, path, 6, [(60, 1)])
    rows.append((60, 6))
    assert compaction.pack(spark, path, ROW, 6, "event_date") == 2
    compaction.clean(spark, path)
    assert seen(spark, path) == rows and [n.split("batch_id=")[1].split("/")[:2] for n in names(spark, path)] == [["5", "event_date=__HIVE_DEFAULT_PARTITION__"]]


def test_rows_are_pruned_by_date_in_both_parts(spark, folder):
    path = f"{folder}/t"
    table(spark, path)
    compaction.pack(spark, path, ROW, 4, "event_date", "2024-01-02")
    some = compaction.rows(spark, path, ROW).filter("event_date = date '2024-01-01' and batch_id <= 5")
    assert some.count() == 12
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert plan.count("(event_date#") >= 2 and plan.count("PartitionFilters: []") == 0


def test_a_table_without_dates_is_packed_whole_by_sizes(spark, folder):
    path = f"{folder}/t"
    for b in range(12):
        write(spark, path, b, [(100 * b + i, 1) for i in range(50)], by=())
    size = sum(r.length for r in spark.read.format("binaryFile").load(f"{path}/batch_id=0").select("length").collect())
    before = seen(spark, path)
    conf = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert compaction.pack(spark, path, ROW, 11, target=4 * size + size // 2) == 1
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == conf
    compaction.clean(spark, path)
    assert len(names(spark, f"{path}.packed")) == 3 and not tables.exists(spark, path) and seen(spark, path) == before


@pytest.mark.parametrize("dies", ["append", "_note", "remove"])
def test_a_crash_at_any_step_is_harmless(spark, folder, monkeypatch, dies):
    path = f"{folder}/t"
    rows = table(spark, path)

    def run():
        compaction.pack(spark, path, ROW, 5, "event_date")
        compaction.clean(spark, path)

    real, calls = getattr(compaction if dies == "_note" else tables, dies), []

    def die(*args):
        calls.append(args)
        # the first call to remove makes room for the pack
        if len(calls) == {"append": 2, "_note": 1, "remove": 4}[dies]:
            raise RuntimeError("killed")
        return real(*args)

    monkeypatch.setattr(compaction if dies == "_note" else tables, dies, die)
    with pytest.raises(RuntimeError):
        run()
    monkeypatch.undo()
    assert seen(spark, path) == rows
    # the next call closes fewer dates than the one that died: what that one left behind must not show
    compaction.pack(spark, path, ROW, 5, "event_date", "2024-01-02")
    assert seen(spark, path) == rows
    run()
    assert seen(spark, path) == rows and not tables.exists(spark, path)
    assert len(names(spark, f"{path}.packed")) == 3


def test_packed_again_before_it_is_cleaned(spark, folder):
    path = f"{folder}/t"
    rows = table(spark, path, 4)
    assert compaction.pack(spark, path, ROW, 1, "event_date") == 3 and compaction.pack(spark, path, ROW, 1, "event_date") == 0
    assert compaction.pack(spark, path, ROW, 3, "event_date") == 3
    assert seen(spark, path) == rows
    compaction.clean(spark, path)
    assert seen(spark, path) == rows and not tables.exists(spark, path)


def test_only_whole_batches_are_packed_and_readers_of_the_stream_see_them(spark, folder):
    path, audit = f"{folder}/t", f"{folder}/audit"
    assert streams.pack_closed(spark, path, ROW, audit) == 0
    rows = table(spark, path, 3)
    for b in range(2):
        streams.record(spark, audit, "events_silver", b, (4, 4, 0))
    assert tables.read_or_empty(spark, audit, AUDIT).count() == 2
    assert streams.pack_closed(spark, path, ROW, audit) == 3
    compaction.clean(spark, path)
    got = sorted(r.n for r in streams.visible(spark, path, ROW, audit).collect())
    assert got == [n for n, b in rows if b < 2] and streams.visible(spark, path, ROW, audit).columns == ["n", "event_date"]
    assert tables.read(spark, path).agg(F.min("batch_id")).first()[0] == 2


def test_nothing_there(spark, folder):
    path = f"{folder}/none"
    assert compaction.pack(spark, path, ROW, 5, "event_date") == compaction.clean(spark, path) == 0
    assert compaction.rows(spark, path, ROW).collect() == [] and compaction.rows(spark, path, ROW).columns == ["n", "event_date", "batch_id"]
