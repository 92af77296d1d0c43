import io
import json
import os
import random

import pytest

from tidemark.operators.events import tail
from tidemark.sources import log_files, tables
from tidemark.sources.log_files import Range, cut, lines, log_lines


def plain(data: bytes) -> list[tuple[int, bytes]]:
    out, at = [], 0
    for line in data.splitlines(keepends=True) if b"\r" not in data else [x + b"\n" for x in data.split(b"\n")[:-1]] + [data.split(b"\n")[-1]]:
        if line:
            out.append((at, line.rstrip(b"\n").removesuffix(b"\r")))
        at += len(line)
    return out


@pytest.mark.parametrize("look", [1, 3, 1 << 20])
def test_each_line_lies_in_one_range_wherever_they_are_cut(monkeypatch, look):
    monkeypatch.setattr(log_files, "LOOK", look)
    rng = random.Random(3)
    for _ in range(150):
        data = bytes(rng.choice(b"ab\n\n\r") for _ in range(rng.randint(0, 40)))
        for most in (1, 2, 5, 100):
            got = [x for r in cut("f", 0, len(data), most, rest=True) for x in lines(io.BytesIO(data), r)]
            assert got == plain(data), (data, most)
        # as a stream: an unfinished line comes with the range that ends it
        a = rng.randint(0, len(data))
        whole = [x for r in (Range("f", 0, a), Range("f", a, len(data))) for x in lines(io.BytesIO(data), r)]
        assert whole == [x for x in plain(data) if data.find(b"\n", x[0]) >= 0]


def logs(folder):
    path = f"{folder}/log"
    os.makedirs(f"{path}/2024")
    made = {"a.jsonl": "", "2024/b.jsonl": "", "_skipped": "x\n", ".hidden": "x\n"}
    for n in range(300):
        line = "   " if n % 7 == 0 else "{broken" if n % 11 == 0 else json.dumps({"event_id": f"e{n}", "event_type": "ü" * (n % 40)}, ensure_ascii=False)
        made["a.jsonl" if n < 200 else "2024/b.jsonl"] += line + "\n"
    for name, text in made.items():
        with open(f"{path}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    return path, [x for name in ("2024/b.jsonl", "a.jsonl") for x in made[name].splitlines()]


def test_whole_logs_in_ranges_as_the_text_source_reads_them(spark, folder):
    path, want = logs(folder)
    rows = log_lines(spark, path, range_bytes=1000)
    assert rows.rdd.getNumPartitions() > 10
    assert [r.value for r in rows.orderBy("position").collect()] == want
    one = f"{path}/a.jsonl"
    last = lambda df: [(r.value, r.malformed_lines) for r in tail(df, 5).collect()]
    assert last(log_lines(spark, one, range_bytes=500)) == last(tables.json_lines(spark, one))


def test_a_stream_reads_each_line_once(spark, folder):
    path, want = logs(folder)

    def run():
        q = log_lines(spark, path, stream=True, range_bytes=2000).writeStream.format("parquet").option("checkpointLocation", f"{folder}/c")
        q = q.trigger(availableNow=True).start(f"{folder}/out")
        q.awaitTermination(120)
        assert q.exception() is None
        return sorted(r.value for r in spark.read.parquet(f"{folder}/out").collect())

    assert run() == sorted(want) and run() == sorted(want)
    with open(f"{path}/a.jsonl", "ab") as f:
        f.write("one\nhalf of ü".encode()[:-1])
    assert run() == sorted([*want, "one"])
    with open(f"{path}/a.jsonl", "ab") as f:
        f.write("ü".encode()[1:] + b" line\r\n\xff\n")
    with open(f"{path}/c.jsonl", "w") as f:
        f.write("new\n")
    assert run() == sorted([*want, "one", "half of ü line", "�", "new"])


def test_nothing_there(spark, folder):
    os.makedirs(f"{folder}/empty")
    assert log_lines(spark, f"{folder}/empty").collect() == []
    with pytest.raises(Exception, match="FileNotFound|none"):
        log_lines(spark, f"{folder}/none").collect()
