import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from helpers import components, frame, rule_counts, words
from test_packing import check as check_packing
from test_secrets import base

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage got and gave."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name.replace(" ", "_"))
        stage(spark, found[-1], SF).write.parquet(path)
        found.append(spark.read.parquet(path))
    return found


def test_columns_stay(stages):
    assert all(df.columns == stages[0].columns for df in stages[1:-1]) and [n for n, _ in cp.STAGES] == ["quality rules", "near dedup", "secrets", "mixing", "packing"]


def test_rules_reject_and_keep(spark, stages):
    given, kept = ({r.doc_id: r.text for r in df.collect()} for df in stages[:2])
    assert kept.items() <= given.items()
    for i, t in given.items():
        n, *rest = rule_counts(t)
        if n < 10 or 100 * rest[3] > 20 * n:
            assert i not in kept
    sound = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    passed = [i for i in sound & set(given) if rule_counts(given[i])[0] >= 10 and 5 * rule_counts(given[i])[4] <= rule_counts(given[i])[0]]
    assert sum(i in kept for i in passed) >= 0.97 * len(passed)


def test_one_of_each_group_stays(stages):
    given, kept = ({r.doc_id: r.text for r in df.collect()} for df in stages[1:3])
    want = components(given, 5, 80)
    assert set(kept) == {i for i in given if want[i] == i}


def test_secrets_are_gone(stages):
    given, kept = ({r.doc_id: r for r in df.collect()} for df in stages[2:4])
    assert set(given) == set(kept)
    for i, r in kept.items():
        assert not base(r.text) and r.n_chars == len(r.text)
        if not base(given[i].text):
            assert r.text == given[i].text or "%" in given[i].text or "\\" in given[i].text


def test_mix_repeats_rows(stages):
    given, kept = stages[3:5]
    copies = {r.doc_id: r.n for r in kept.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    rows = {r.doc_id: r for r in given.collect()}
    assert set(copies) <= set(rows) and set(copies.values()) <= {1, 2}
    total = sum(len(words(r.text)) for r in rows.values())
    assert abs(sum(n * len(words(rows[i].text)) for i, n in copies.items()) - 1.5 * total) < 0.1 * total


def test_packing_takes_all(stages):
    docs, packed = stages[4].collect(), stages[5].collect()
    once = {}
    for r in docs:
        once[r.doc_id] = r.text
    assert packed and {r.doc_id for r in packed} == set(once)
    ends, seen = {}, set()
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
        seen.add((r.sequence_id, r.offset))
    assert len(seen) == len(packed) and max(ends.values()) <= 1024
    assert check_packing


def test_run_gives_what_the_stages_give(spark, stages):
    got = cp.run(spark, SF)
    assert sorted(tuple(r)[:5] for r in got.collect()) == sorted(tuple(r)[:5] for r in stages[-1].collect())


def test_edges(spark):
    texts = [None, "", "a b", "the same text " + "with words that differ " * 1 + " ".join(f"w{i}" for i in range(40))]
    odd = frame(spark, [*texts, texts[-1]]).select("doc_id", "text", "lang", "source", "n_chars")
    nameless = odd.withColumn("doc_id", F.when(F.col("doc_id") < 4, F.col("doc_id"))).union(odd.filter("doc_id = 3"))
    for docs in (nameless, odd.limit(0)):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, SF)
            rows = out.collect()
            assert name == "packing" or out.columns == docs.columns
            assert rows or docs.isEmpty() or name == "mixing"
    twice = {(r.doc_id, r.text) for r in cp.near_dedup(spark, nameless, SF).collect()}
    assert (None, texts[-1]) in twice and sum(r.doc_id == 3 for r in cp.near_dedup(spark, nameless, SF).collect()) == 1


def test_bands_reach_the_similarity_of_the_stage(spark, monkeypatch):
    asked = {}
    plain = cp.near_duplicates
    # as called, over the operator's own defaults
    monkeypatch.setattr(cp, "near_duplicates", lambda docs, percent=80, bands=32, rows=8: asked.update(percent=percent, bands=bands, rows=rows) or plain(docs, percent=percent, bands=bands, rows=rows))
    cp.near_dedup(spark, frame(spark, ["a b c d e f", "g"]), "")
    assert (1 - (asked["percent"] / 100) ** asked["rows"]) ** asked["bands"] <= 1e-4


def test_rows_of_one_id_and_clashing_columns(spark):
    """Different texts under one id all stay; of near-duplicates under one id one stays; columns with names of our own stay."""
    long_ = lambda a: " ".join(f"{a}{i}" for i in range(60))
    rows = [(1, long_("a"), 0), (1, long_("b"), 1), (1, long_("a") + " end", 2), (2, long_("b") + " end", 3), (2, long_("c"), 4), (2, long_("c"), 4), (None, long_("a"), 5)]
    shape = "doc_id long, text string, size int"
    more = {"lang": "en", "source": "s", "component": "c", "id": "i", "bucket": 1, "rep": "r", "copies": 9, "kept": False, "_row": 1, "__counts": 2}
    docs = spark.createDataFrame(rows, shape).withColumns({k: F.lit(v) for k, v in more.items()}).withColumn("n_chars", F.length("text").cast("long"))
    out = cp.near_dedup(spark, docs, SF)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.size) for r in out.collect()), key=str)
    assert len(got) == 4 and {x for x in got if x[1] in (1, 4, 5)} == {(1, 1), (2, 4), (None, 5)} and ({(1, 0), (1, 2)} & set(got))
    for name, stage in cp.STAGES:
        rows = stage(spark, docs, SF).collect()
        assert rows or name == "mixing"
    # each row is taken 0 to 2 times; the two equal ones together up to 4 times
    taken = cp.mixing(spark, docs, SF)
    assert taken.columns == docs.columns
    assert all(r["n"] <= (4 if r["size"] == 4 else 2) for r in taken.groupBy("size").agg(F.count("*").alias("n")).collect())
    assert abs(taken.count() - 1.5 * 7) <= 1.5



def test_helper_names_that_documents_have(spark):
    """Columns named like those the stages make for themselves: values stay, in whatever case the names are."""
    names = ["__row", "__MIX_key", "__mix_copies", "__mix_copy", "__row_"]
    docs = frame(spark, [f"text number {i} of some words" for i in range(40)] + ["text number 3 of some words", None, ""])
    docs = docs.withColumns({c: F.concat(F.lit(f"own {c} "), F.col("doc_id").cast("string")) for c in names})
    for stage in (cp.near_dedup, cp.mixing):
        for given in (docs, docs.withColumn("doc_id", F.col("doc_id") % 10)):
            out = stage(spark, given, SF)
            assert out.columns == docs.columns
            rows = out.collect()
            assert rows and all(r[c] == f"own {c} {r.id}" for r in rows for c in names)
