import random

from helpers import ODD, frame, words
from tidemark.llm.registry import QUERIES
from tidemark.llm.repeated_runs import repeated_runs


def brute(texts, least=51):
    """{(doc, first word, end, removed)} by looking at every window."""
    holders, lists = {}, {i: words(t) for i, t in texts.items()}
    for i, w in lists.items():
        for a in range(len(w) - least + 1):
            holders.setdefault(tuple(w[a : a + least]), set()).add(i)
    out = set()
    for i, w in lists.items():
        for removed in (True, False):
            cover = set()
            for a in range(len(w) - least + 1):
                having = holders[tuple(w[a : a + least])]
                if len(having) > 1 and (min(having) < i) == removed:
                    cover.update(range(a, a + least))
            for a in sorted(x for x in cover if x - 1 not in cover):
                b = a
                while b in cover:
                    b += 1
                out.add((i, a, b, removed))
    return out


def check(got, texts):
    found = set()
    for r in got:
        before, run = words(texts[r.doc_id][: r.start]), texts[r.doc_id][r.start : r.end]
        assert len(words(run)) == r.n_words and run == run.strip() and (r.first_doc < r.doc_id) == r.removed
        found.add((r.doc_id, len(before), len(before) + r.n_words, r.removed))
    assert found == brute(texts) and len(got) == len(found)


def test_every_repeated_window(spark):
    rng = random.Random(4)
    some = lambda n: [f"wé{rng.randrange(400)}" for _ in range(n)]
    shared = [some(n) for n in (50, 51, 52, 90, 300)]
    texts = list(ODD) + ["wort " * 200]
    for i in range(40):
        w = some(rng.randrange(0, 80))
        for s in rng.sample(shared, rng.randrange(0, 3)):
            a = rng.randrange(0, max(1, len(s) - 60))
            s = s[a:]
            if i % 3 == 0:
                s[rng.randrange(len(s))] = "edited"
            w += s + some(rng.randrange(0, 80))
        # inside one long line, or over short ones
        texts.append(" ".join(w) if i % 2 else "\n".join(" ".join(w[j : j + 7]) for j in range(0, len(w), 7)).upper())
    got = repeated_runs(frame(spark, texts)).collect()
    check(got, dict(enumerate(texts)))
    assert {r.removed for r in got} == {True, False}


def test_edges(spark):
    long_ = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(None, long_), (1, long_), (1, long_ + " x"), (2, None)], "doc_id long, text string")
    assert repeated_runs(df).count() == 0 and repeated_runs(df.limit(0)).count() == 0
    more = df.union(spark.createDataFrame([(3, "before " + long_.replace(" ", "\n") + " after")], df.schema))
    assert sorted((r.doc_id, r.n_words, r.first_doc, r.removed) for r in repeated_runs(more).collect()) == [(1, 60, 1, False), (1, 60, 1, False), (3, 60, 1, True)]


def test_query_on_all_documents(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    check(QUERIES["op10_repeated_runs"](spark, sf).collect(), texts)
