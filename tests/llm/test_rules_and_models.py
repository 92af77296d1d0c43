import zlib

import numpy as np
import pyarrow as pa
import pytest

from helpers import ODD, frame, rule_counts
from tidemark.llm import quality_classifier as qc
from tidemark.llm import quality_rules as qr
from tidemark.llm import toxicity as tox
from tidemark.llm.registry import QUERIES
from tidemark.llm.sparse import Sparse

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}


def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def test_rules_on_all_documents(spark, labels):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op5_quality_rules"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        n, *rest = rule_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
        assert r.base_failed == (n < 10 or 100 * rest[3] > 20 * n) and not (r.base_failed and r.kept)
    told = [(labels[r.doc_id].quality, r.kept) for r in got if r.doc_id in labels and not r.base_failed]
    good, bad = [k for q, k in told if q == 1], [k for q, k in told if q == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.25


def test_rules_at_the_edges(spark):
    df = frame(spark, ODD)
    got = {r.id: r for r in qr.judge_texts(df, no_labels(spark)).collect()}
    assert all(got[i].base_failed == (rule_counts(t)[0] < 10 or 100 * rule_counts(t)[4] > 20 * rule_counts(t)[0]) and got[i].kept != got[i].base_failed for i, t in enumerate(ODD))
    odd = spark.createDataFrame([(None, 1, 0), (3, None, 0), (999, 1, 0), (8, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int")
    assert qr.judge_texts(df, odd).count() == len(ODD) and qr.judge_texts(df.limit(0), odd).count() == 0
    kept = qr.keep_sound(df, odd)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {r.id for r in qr.judge_texts(df, odd).collect() if r.kept}


def test_forest_isolates_what_lies_apart():
    rng = np.random.default_rng(0)
    good = rng.normal(0.2, 0.02, (500, 4))
    odd = np.full((5, 4), 0.2)
    odd[np.arange(5), np.arange(5) % 4] = 0.9
    forest = qr.Forest(good, np.zeros(4), np.ones(4), 100, 256, 1)
    assert forest.score(odd).min() > forest.score(good).max()


def test_sound_rows_are_the_same_if_labels_are_many(spark, monkeypatch):
    from tidemark.llm import runtime

    docs, told = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    kept = sorted(r.doc_id for r in qr.keep_sound(docs, told).collect())
    assert kept == sorted(r.id for r in qr.judge_texts(docs, told).collect() if r.kept)
    monkeypatch.setattr(runtime, "SENT", -1)
    assert kept == sorted(r.doc_id for r in qr.keep_sound(docs, told).collect())


def test_path_lengths_against_a_plain_walk():
    rng = np.random.default_rng(4)
    rows = rng.random((300, 3))
    forest = qr.Forest(rows, np.zeros(3), np.ones(3), 20, 64, 2)

    def walk(x, tree, node=0, depth=0):
        feature, split, left, length = tree
        if feature[node] < 0:
            return depth, length[node]
        return walk(x, tree, left[node] + int(x[feature[node]] >= split[node]), depth + 1)

    def rest(n):  # the mean depth of a search that fails, in a random search tree of n keys
        return 2 * sum(1 / i for i in range(1, n)) - 2 * (n - 1) / n if n > 1 else 0

    for x in rng.random((20, 3)):
        ends = [walk(x, tree) for tree in forest.trees]
        # a leaf's length is its depth and the mean depth of what it still holds
        assert all(length >= depth and depth <= forest.depth for depth, length in ends)
        want = 2 ** (-np.mean([length for _, length in ends]) / rest(64))
        assert forest.score(x[None, :])[0] == pytest.approx(want, rel=2e-2)


def test_cut_has_the_least_loss(spark):
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["red", "blue", "green", "tall", "small", "runs", "walks"], 40)) for _ in range(60)]
    texts += [" ".join(rng.choice(["##", "$$%", "|||", "red", "<><>"], 40)) for _ in range(30)]
    df = frame(spark, texts)
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(90)], "doc_id long, quality int, toxic int")
    rows = [r for r in qr.judge_texts(df, labels).collect() if not r.base_failed]
    good, bad = (np.array([np.ceil(r.score * qr.STEPS) for r in rows if (r.id < 60) == kind]) for kind in (True, False))
    loss = lambda cut: 20 * (good > cut).mean() + (bad <= cut).mean()
    kept = [np.ceil(r.score * qr.STEPS) for r in rows if r.kept]
    assert loss(max(kept)) <= min(map(loss, {*good, *bad})) + 1e-9


def test_factorisation_gradient():
    rng = np.random.default_rng(7)
    x = Sparse(np.array([0, 2, 1, 2, 3, 0, 3]), rng.normal(size=7).astype(np.float32), np.array([0, 2, 5, 7]))
    y = np.array([1.0, 0.0, 1.0], np.float32)

    def loss(w, v, b):
        out = 0.0
        for i in range(3):
            c, z = x.columns[x.at[i] : x.at[i + 1]], x.values[x.at[i] : x.at[i + 1]].astype(float)
            m = b + w[c] @ z + sum(v[c[a]] @ v[c[d]] * z[a] * z[d] for a in range(len(c)) for d in range(a + 1, len(c)))
            out += np.log1p(np.exp(-m if y[i] else m))
        return out / 3

    m = qc.Machine(4, 2, 3)
    m.weights, m.vectors = rng.normal(size=4).astype(np.float32), rng.normal(size=(4, 2)).astype(np.float32)
    w, v = m.weights.astype(float).copy(), m.vectors.astype(float).copy()
    m.fit(x, y, 1, 3, 1.0, 0.0, 0)
    # a first step is -rate * g / sqrt(g * g + 1e-4), which gives g back
    back = lambda step: step * 1e-2 / np.sqrt(np.maximum(1 - step**2, 1e-12))
    h = 1e-5
    for i in range(4):
        e = np.zeros(4)
        e[i] = h
        assert back(w[i] - m.weights[i]) == pytest.approx((loss(w + e, v, 0) - loss(w - e, v, 0)) / (2 * h), rel=0.02, abs=2e-4)
        for j in range(2):
            e = np.zeros((4, 2))
            e[i, j] = h
            assert back((v[i, j] - m.vectors[i, j]) / 0.3) == pytest.approx((loss(w, v + e, 0) - loss(w, v - e, 0)) / (2 * h), rel=0.02, abs=2e-4)


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    m = qc.Machine(20, 3, 1)
    m.vectors, m.weights, m.bias = rng.normal(size=(20, 3)).astype(np.float32), rng.normal(size=20).astype(np.float32), np.float32(0.3)
    columns = np.array([1, 5, 7, 2, 9])
    values = rng.normal(size=5).astype(np.float32)
    x = Sparse(columns, values, np.array([0, 3, 3, 5]))
    want = []
    for a, b in ((0, 3), (3, 3), (3, 5)):
        c, v = columns[a:b], values[a:b]
        pairs = sum(m.vectors[c[i]] @ m.vectors[c[j]] * v[i] * v[j] for i in range(len(c)) for j in range(i + 1, len(c)))
        want.append(0.3 + m.weights[c] @ v + pairs)
    assert m.margin(x)[0] == pytest.approx(want, abs=1e-4)


def test_classifier_on_held_out_rows(spark, labels):
    got = QUERIES["op6_quality_classifier"](spark, SF).collect()
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    rows = [(labels[r.doc_id].quality, r.score, r.predicted) for r in got if r.held_out and r.doc_id in labels]
    y, s = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert (s[y == 1][:, None] > s[y == 0][None, :]).mean() > 0.97 and np.mean([r[2] == r[0] for r in rows]) > 0.93
    again = {r.doc_id: r.score for r in QUERIES["op6_quality_classifier"](spark, SF).collect()}
    assert all(abs(again[r.doc_id] - r.score) < 1e-9 for r in got)


def test_models_at_the_edges(spark):
    df = frame(spark, ODD)
    assert [r.score for r in qc.score_quality(df, no_labels(spark)).collect()] == [0.5] * len(ODD)
    assert all(r.severity == 0 and not r.toxic for r in tox.score_toxicity(df, no_labels(spark)).collect())
    odd = spark.createDataFrame([(None, 1, 0), (3, None, None), (8, 1, 1), (8, 0, 0), (4, 0, 0), (11, 1, 1)], "doc_id long, quality int, toxic int")
    assert all(0 <= r.score <= 1 for r in qc.score_quality(df, odd).collect())
    assert all(0 <= r.severity <= 3 for r in tox.score_toxicity(df, odd).collect())
    assert qc.score_quality(df.limit(0), odd).count() == 0 and tox.score_toxicity(df.limit(0), odd).count() == 0


def test_ordinal_regression_follows_grades():
    rng = np.random.default_rng(2)
    n = 1500
    level = rng.integers(0, 4, n)
    columns = np.concatenate([np.array([10] * int(g > 0) + [11] * int(g > 0)) for g in level] or [[]]).astype(np.int64)
    at = np.concatenate([[0], np.cumsum(2 * (level > 0))])
    values = np.repeat(level, 2 * (level > 0)).astype(float) / 2 + rng.normal(0, 0.05, len(columns))
    m = tox.Ordinal(20, 4).fit(Sparse(columns, values, at), level, 40, 64, 0.2, 1e-5, 0)
    above = m.above(Sparse(columns, values, at))
    assert (np.diff(m.thresholds()) > 0).all() and ((above >= 0.5).sum(axis=1) == level).mean() > 0.9
    assert (np.diff(above, axis=1) <= 1e-12).all()


def test_ordinal_likelihood_and_gradient():
    """Probabilities and one step of the fit against the plain formula."""
    rng = np.random.default_rng(8)
    x = Sparse(np.array([0, 1, 2, 0, 2, 1]), rng.normal(size=6), np.array([0, 2, 3, 5, 6]))
    y = np.array([0, 1, 3, 2])

    def loss(w, steps):
        t = np.array([steps[0], steps[0] + np.exp(steps[1]), steps[0] + np.exp(steps[1]) + np.exp(steps[2])])
        out = 0.0
        for i in range(4):
            z = sum(w[c] * v for c, v in zip(x.columns[x.at[i] : x.at[i + 1]], x.values[x.at[i] : x.at[i + 1]]))
            below = [0.0, *(1 / (1 + np.exp(-(t - z)))), 1.0]
            out -= np.log(below[y[i] + 1] - below[y[i]])
        return out / 4

    m = tox.Ordinal(3, 4)
    m.weights, m.steps = rng.normal(size=3), np.array([0.3, -0.2, 0.1])
    w, steps = m.weights.copy(), m.steps.copy()
    for i in range(4):
        z = sum(w[c] * v for c, v in zip(x.columns[x.at[i] : x.at[i + 1]], x.values[x.at[i] : x.at[i + 1]]))
        assert m.above(x)[i] == pytest.approx([1 / (1 + np.exp(t - z)) for t in m.thresholds()])
    m.fit(x, y, 1, 4, 0.5, 0.0, 0)
    # a first step is -rate * g / sqrt(g * g + past)
    back = lambda step, past: step * np.sqrt(past) / np.sqrt(np.maximum(1 - step**2, 1e-12))
    h = 1e-6
    for i in range(3):
        e = np.zeros(3)
        e[i] = h
        assert back((w[i] - m.weights[i]) / 0.5, 1e-4) == pytest.approx((loss(w + e, steps) - loss(w - e, steps)) / (2 * h), rel=1e-3, abs=1e-6)
        assert back((steps[i] - m.steps[i]) / 0.25, 1e-2) == pytest.approx((loss(w, steps + e) - loss(w, steps - e)) / (2 * h), rel=1e-3, abs=1e-6)


def test_toxicity_on_all_documents(spark, labels):
    got = {r.doc_id: r for r in QUERIES["op9_toxicity"](spark, SF).collect()}
    assert len(got) == 1000 and all(0 <= r.severity <= 3 and r.toxic == (r.grade > 0) for r in got.values())
    told = [(labels[i].toxic, got[i].toxic) for i in labels]
    assert np.mean([t for y, t in told if y == 1]) > 0.9 and np.mean([t for y, t in told if y == 0]) < 0.01


def test_toxicity_on_rows_it_was_not_fitted_on(spark):
    """A third of the labelled rows, by the checksum of their ids, is kept from the fit on 2636. (At sf0.01 the fit has 286 rows, and finds 15 of 18.)"""
    folder = SF.replace("0.01", "0.1")
    told = spark.read.parquet(f"{folder}/labels.parquet").filter("toxic is not null")
    held = {r.doc_id: r.toxic for r in told.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    given = told.filter("crc32(cast(cast(doc_id as string) as binary)) % 3 <> 1")
    got = {r.id: r for r in tox.score_toxicity(spark.read.parquet(f"{folder}/documents.parquet"), given).collect() if r.id in held}
    assert len(got) == len(held) > 1000
    bad, fine = ([got[i] for i in held if held[i] == y] for y in (1, 0))
    a, b = (np.array([r.severity for r in rows]) for rows in (bad, fine))
    auc = np.mean((a[:, None] > b) + 0.5 * (a[:, None] == b))
    figures = {"found": np.mean([r.toxic for r in bad]), "wrong": np.mean([r.toxic for r in fine]), "auc": auc}
    assert figures["found"] > 0.9 and figures["wrong"] < 0.02 and figures["auc"] > 0.97, figures


def test_words_of_toxicity_split_at_marks():
    a, b = tox.inputs(pa.array(["Bad!!word bad-WORD", "bad word bad word"])), None
    b = a.take(np.array([1]))
    assert a.take(np.array([0])).columns.tolist() == b.columns.tolist()
