import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import ODD, components, frame, shingles
from tidemark.llm import near_dedup
from tidemark.llm.components import connected_components
from tidemark.llm.registry import QUERIES


def family(rng, base, n, rate):
    out = []
    for _ in range(n):
        w = base.split()
        for i in range(len(w)):
            if rng.random() < rate * rng.random():
                w[i] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    made = list(ODD)
    for f in range(4):
        base = " ".join(f"w{f}x{rng.randrange(500)}" for _ in range(120))
        made += family(rng, base, 12, 0.08) + [base] * 5 + [base.upper()]
    return made


@pytest.mark.parametrize(("k", "percent"), [(3, 85), (5, 80)])
def test_against_all_pairs(spark, texts, k, percent):
    got = near_dedup.near_duplicates(frame(spark, texts).repartition(3), k=k, percent=percent).collect()
    want = components(dict(enumerate(texts)), k, percent)
    assert {r.id: r.component for r in got} == want
    assert {r.id: r.n_shingles for r in got} == {i: len(shingles(t, k)) for i, t in enumerate(texts)}


def test_blocks_of_a_large_bucket(spark, texts, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 3)
    got = near_dedup.near_duplicates(frame(spark, texts), k=3, percent=85).collect()
    assert {r.id: r.component for r in got} == components(dict(enumerate(texts)), 3, 85)


def test_query_on_all_documents(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op4_minhash"](spark, sf).collect()
    want = components(texts, 3, 85)
    assert {r.doc_id: r.component_id for r in got} == want and all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_null_and_repeated_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    df = spark.createDataFrame([(None, a), (None, a), (5, a), (5, b), (7, b), (8, a), (9, None)], "doc_id long, text string")
    got = sorted(((r.id, r.component) for r in near_dedup.near_duplicates(df).collect()), key=str)
    assert got == [(5, 5), (5, 5), (7, 5), (8, 5), (9, 9), (None, None), (None, None)]
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    for n, share in ((2000, 0.9), (300, 0.6), (3, 1 / 3)):
        pool = rng.integers(0, 2**63, 3 * n).astype(np.uint64)
        both = round(n * 2 * share / (1 + share))
        x, y = np.sort(pool[:n]), np.sort(np.concatenate([pool[:both], pool[n : 2 * n - both]]))
        rows = near_dedup.sketch(np.concatenate([x, y]), np.array([0, n, 2 * n]), 256)
        assert (rows != near_dedup._TOP).all()
        jaccard = both / (2 * n - both)
        assert abs((rows[0] == rows[1]).mean() - jaccard) < 5 * (jaccard * (1 - jaccard) / 256) ** 0.5 + 0.01


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    from helpers import Groups

    groups = Groups({x for e in edges[:-1] for x in e})
    for a, b in edges[:-1]:
        groups.join(a, b)
    assert got == {x: groups.find(x) for x in groups.up}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_link_within_compares_all():
    sets = [np.arange(i, i + 100).astype(np.uint64) for i in range(0, 40, 5)]
    assert near_dedup.link_within(sets, list(range(8)), 85) == [(i, i + 1) for i in range(7)]
    assert near_dedup.link_within([], [], 85) == [] and pa


def test_ids_that_are_text(spark, texts):
    df = frame(spark, texts).select("text", F.concat(F.lit("d"), F.format_string("%04d", "doc_id")).alias("doc_id"))
    got = {int(r.id[1:]): int(r.component[1:]) for r in near_dedup.near_duplicates(df, k=3, percent=85).collect()}
    assert got == components(dict(enumerate(texts)), 3, 85)


def test_leaders_of_large_buckets(spark, texts, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 1)
    got = near_dedup.near_duplicates(frame(spark, texts), k=5, percent=80, bands=4, rows=1).collect()
    want = components(dict(enumerate(texts)), 5, 80)
    assert all(want[r.component] == want[r.id] for r in got)


def test_texts_meet_ids_in_a_shuffle_if_those_are_many(spark, texts, monkeypatch):
    from tidemark.llm import runtime

    monkeypatch.setattr(runtime, "SENT", -1)
    got = near_dedup.near_duplicates(frame(spark, texts), k=3, percent=85).collect()
    assert {r.id: r.component for r in got} == components(dict(enumerate(texts)), 3, 85)
