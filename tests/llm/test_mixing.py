import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import ODD, frame, words
from tidemark.llm import mixing
from tidemark.llm.registry import QUERIES


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Reshare what is above a cap until nothing is. sizes: by source, in order."""
    w = {s: weights[i % len(weights)] for i, s in enumerate(sizes)}
    left, out, open_ = share * sum(sizes.values()), {}, dict(sizes)
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > most * open_[s]]
        if not over:
            return out | {s: left * w[s] / total for s in open_}
        for s in over:
            out[s] = most * open_.pop(s)
        left = share * sum(sizes.values()) - sum(out.values())
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(0, 1), max_size=30), st.integers(0, 2**32))
def test_pivot(p, seed):
    p = np.array(p)
    out = mixing.pivot(p, np.random.default_rng(seed).random(len(p)))
    assert ((out > 0) & (out < 1)).sum() <= 1 and abs(out.sum() - p.sum()) < 1e-6
    assert all(a == b for a, b in zip(p, out) if a in (0.0, 1.0))


def test_pivot_keeps_expectations():
    p, rng = np.array([0.3, 0.6, 0.5, 0.9, 0.1]), np.random.default_rng(3)
    mean = np.mean([mixing.pivot(p, rng.random(5)) for _ in range(20000)], axis=0)
    assert np.abs(mean - p).max() < 0.02


def by_source(rows):
    out = {}
    for r in rows:
        out.setdefault(r.source, []).append(r)
    return out


def check(got, slack):
    sources = by_source(got)
    order = sorted(sources, key=lambda s: (s is None, (s or "").encode()))
    want = targets({s: sum(r.size for r in sources[s]) for s in order})
    for s, rows in sources.items():
        assert rows[0].source_size == sum(r.size for r in rows) and rows[0].target == pytest.approx(want[s], rel=1e-9, abs=1e-9)
        assert all(0 <= r.copies <= 2 for r in rows)
        assert abs(sum(r.copies * r.size for r in rows) - rows[0].target) <= slack * max(r.size for r in rows) + 1e-6


@pytest.mark.parametrize("leaf", [4, 1024])
def test_targets_are_met(spark, leaf, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", leaf)
    monkeypatch.setattr(mixing, "FAN", 3)
    rng = np.random.default_rng(1)
    texts = [*ODD, *(" ".join(["w"] * int(n)) for n in rng.integers(1, 60, 400))]
    df = frame(spark, texts)
    first = mixing.mix_sources(df).collect()
    check(first, slack=6)
    again = mixing.mix_sources(df.repartition(5)).collect()
    assert sorted((r.id, r.copies) for r in first) == sorted((r.id, r.copies) for r in again)
    assert {r.id: r.size for r in first} == {i: len(words(t)) for i, t in enumerate(texts)}


def test_edges(spark):
    df = frame(spark, ODD)
    assert mixing.mix_sources(df.limit(0)).count() == 0
    one = mixing.mix_sources(frame(spark, [None, ""])).collect()
    assert [(r.size, r.target) for r in one] == [(0, 0.0), (0, 0.0)]
    rows = [(None, "a b c", "s")] * 3 + [(1, "a b", "s")] * 2
    assert mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).count() == 5


def test_query_on_all_documents(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op3_mixing"](spark, sf).collect()
    sizes, taken, target = {}, {}, {}
    for r in got:
        s = docs[r.doc_id].source
        assert r.size == len(words(docs[r.doc_id].text)) and r.taken in (0, r.size, 2 * r.size)
        sizes[s], taken[s] = sizes.get(s, 0) + r.size, taken.get(s, 0) + r.taken
        target[s] = r.target
    want = targets({s: sizes[s] for s in sorted(sizes)})
    assert len(got) == len(docs) and all(target[s] == pytest.approx(want[s]) for s in sizes)
    assert abs(sum(taken.values()) / sum(target.values()) - 1) < 0.05


def test_a_very_long_text_keeps_its_chance(spark):
    rng = np.random.default_rng(5)
    texts = [" ".join(["w"] * 20000), *(" ".join(["w"] * int(n)) for n in rng.integers(20, 200, 60))]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string").cache()
    copies = []
    for seed in range(40):
        (row,) = mixing.mix_sources(df, share=0.35, seed=seed).filter("id = 0").collect()
        copies.append(row.copies)
    assert set(copies) == {0, 1} and abs(np.mean(copies) - 0.35) < 0.25


def test_null_and_repeated_ids_are_dealt_to_many_lots(spark, monkeypatch):
    monkeypatch.setattr(mixing, "LEAF", 64)
    rounded, most = mixing._rounded, 3 * 64

    def held(seed, level):
        run = rounded(seed, level)

        def checked(key, rows):
            if len(rows) > most:
                raise ValueError(f"{len(rows)} rows in a lot")
            return run(key, rows)

        return checked

    monkeypatch.setattr(mixing, "_rounded", held)
    rows = [(None if i % 2 else 7, "a b c", "s") for i in range(3000)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string"), share=0.5).collect()
    assert len(got) == 3000 and sum(r.id is None for r in got) == 1500 and abs(sum(r.copies for r in got) - 1500) < 1
