import random

import pyarrow as pa
import pytest

from helpers import ODD, WORD, Groups, frame, words
from tidemark.llm import substring_dedup as sd
from tidemark.llm.registry import QUERIES


def places(text, size=sd.SIZE, reach=sd.REACH):
    """The anchors of a text, by looking at every stretch of places."""
    w = words(text)
    numbers = []
    for i in range(len(w) - size + 1):
        digits = sum(min(len(x), sd.LONGEST) * (sd.LONGEST + 1) ** j for j, x in enumerate(w[i : i + sd.LENGTHS]))
        numbers.append((digits * sd.SCATTER % 2**64 >> 32, -i))
    stretches = [numbers[i : i + reach] for i in range(max(1, len(numbers) - reach + 1))]
    return sorted({-min(s)[1] for s in stretches if s})


def brute(texts, k=5, percent=80, size=sd.SIZE):
    """{(doc, start, end, words, first doc, first start, removed)}, by comparing all paragraphs that share a shingle."""
    found = []
    for i, t in texts.items():
        w, at = words(t), [m.span() for m in WORD.finditer(t or "")]
        for p in places(t):
            s = frozenset(tuple(w[j : j + k]) for j in range(p, p + size - k + 1))
            if found and found[-1][0] == i and found[-1][4] == s:
                found[-1][2:4] = [p + size, at[p + size - 1][1]]
            else:
                found.append([i, p, p + size, at[p + size - 1][1], s, at[p][0]])
    groups, by = Groups({f[4] for f in found}), {}
    for s in {f[4] for f in found}:
        for x in s:
            by.setdefault(x, []).append(s)
    order = {s: n for n, s in enumerate(groups.up)}
    groups = Groups(order.values())
    for s in order:
        for q in {q for x in s for q in by[x]}:
            if 100 * len(s & q) >= percent * len(s | q):
                groups.join(order[s], order[q])
    clusters = {}
    for f in found:
        clusters.setdefault(groups.find(order[f[4]]), []).append(f)
    out = set()
    for c in clusters.values():
        first = min((f[0], f[5]) for f in c)
        if len({f[0] for f in c}) > 1:
            out |= {(f[0], f[5], f[3], f[2] - f[1], *first, f[0] != first[0]) for f in c}
    return out


def check(got, texts):
    rows = [tuple(r) for r in got]
    assert len(rows) == len(set(rows)) and set(rows) == brute(texts)
    for r in got:
        assert len(words(texts[r.doc_id][r.start : r.end])) == r.n_words


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    some = lambda n: [f"w{'é' * rng.randrange(6)}{rng.randrange(300)}" for _ in range(n)]
    shared, out = [some(n) for n in (51, 55, 90, 300)], [*ODD, "wort " * 200, "a b " * 60]
    for i in range(40):
        w = some(rng.randrange(0, 80))
        for s in rng.sample(shared, rng.randrange(0, 3)):
            s = list(s)
            if i % 3 == 0:
                s[rng.randrange(len(s))] = "edited"
            w += s + some(rng.randrange(0, 80))
        # inside one long line, or over short ones
        out.append(" ".join(w) if i % 2 else "\n".join(" ".join(w[j : j + 7]) for j in range(0, len(w), 7)).upper())
    return out


def test_against_all_pairs(spark, texts):
    got = sd.repeated_passages(frame(spark, texts)).collect()
    check(got, dict(enumerate(texts)))
    assert {r.removed for r in got} == {True, False}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_on_all_documents(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op10_substring_dedup"](spark, sf).collect()
    check(got, texts)
    # independent of paragraphs: every document that has 51 words in a row in common with another one is found
    holders, hold = {}, {i: words(t) for i, t in texts.items()}
    for i, w in hold.items():
        for a in range(len(w) - 50):
            holders.setdefault(tuple(w[a : a + 51]), set()).add(i)
    common = {i for h in holders.values() if len(h) > 1 for i in h}
    assert common and common <= {r.doc_id for r in got}


def test_any_51_words_hold_the_same_paragraph():
    rng = random.Random(7)
    for _ in range(300):
        passage = ["x" * rng.randrange(1, 12) for _ in range(51)]
        around = lambda: ["y" * rng.randrange(1, 12) for _ in range(rng.randrange(0, 60))]
        found = []
        for _ in range(2):
            before = around()
            p = sd.Paragraphs(pa.array([" ".join(before + passage + around())]), 5, sd.SIZE, sd.REACH)
            found.append({int(a) - len(before) for a in p.first if 0 <= a - len(before) <= 51 - sd.SIZE})
        assert found[0] & found[1]


def test_edges(spark):
    long_ = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(None, long_), (1, long_), (1, long_ + " x"), (2, None)], "doc_id long, text string")
    assert sd.repeated_passages(df).count() == 0 and sd.repeated_passages(df.limit(0)).count() == 0
    got = sd.repeated_passages(df.union(spark.createDataFrame([(3, "before " + long_.replace(" ", "\n") + " after")], df.schema))).collect()
    assert {r.doc_id for r in got} == {1, 3} and all(r.first_doc == 1 and r.removed == (r.doc_id == 3) for r in got)


def test_bands_follow_the_recall():
    for s, recall, rows in ((0.8, 0.999, 4), (0.85, 0.9, 8)):
        n = sd.tune_bands(s, recall, rows)
        assert (1 - s**rows) ** n <= 1 - recall < (1 - s**rows) ** (n - 1)
