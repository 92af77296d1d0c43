import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from helpers import LOWER, ODD, frame
from tidemark.llm import spelling
from tidemark.llm.spelling import code, crc32_spans, neighbours, op12_spelling, spelling_variants, symbols, vocabulary

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_vocabulary(rows, least=5, occurrences=3, modulus=97):
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall((text or "").translate(LOWER)):
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % modulus == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= occurrences}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w in counts:
        if near[w]:
            best = min(near[w], key=lambda v: (-counts[v], v))
            if counts[best] >= 2 * counts[w]:
                form[w] = best
    out = set()
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), counts[form[w]] if w in form else None))
    return out


def rows_of(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("modulus", [97, 2])
def test_vocabulary_of_odd_texts(spark, modulus):
    rng = random.Random(1)
    made = [" ".join(rng.choice(["Straße", "NAÏVE", "naïve", "words", "Wordy-words", "façade×÷", "xŸzzzzz", "ab1cdefg", "ÀÉÎÕÜ"]) for _ in range(40)) for _ in range(30)]
    texts = [*ODD, *made, *made[:5], "Lettersxyz " * 4000, "w" * 100_000]
    want = plain_vocabulary(list(enumerate(texts)), modulus=modulus)
    got = {r.word: r.n for r in vocabulary(frame(spark, texts), modulus=modulus).collect()}
    assert got == want and len(want) > 5


def test_null_ids_and_empty_tables(spark):
    rows = spark.createDataFrame([(None, "again again again", 1), (None, None, 2), ("k", "again", 3)], "doc_id string, text string, n int")
    assert {r.word: r.n for r in vocabulary(rows).collect()} == plain_vocabulary([(None, "again again again"), (None, None), ("k", "again")])
    assert vocabulary(rows.limit(0)).collect() == [] and rows_of(spelling_variants(vocabulary(rows.limit(0)))) == set()


def test_checksums():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    cuts = np.sort(rng.choice(5000, 200, replace=False))
    starts, ends = np.append(cuts[:-1:2], 4000), np.append(cuts[1::2], 5000)
    before = rng.integers(0, 1 << 32, len(starts), dtype=np.uint32)
    got = crc32_spans(data, starts, ends, before)
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes(), int(c)) for a, b, c in zip(starts, ends, before)]


def test_neighbourhoods_are_full(monkeypatch):
    one = lambda x: int(code(x.reshape(1, -1))[0])
    for word in ("abcde", "zzzzz", "straße", "a"):
        s = symbols(word)
        want = {one(s)}
        for i in range(len(s)):
            want |= {one(np.concatenate([s[:i], [x], s[i + 1 :]])) for x in range(spelling.SYMBOLS)} | ({one(np.delete(s, i))} if len(s) > 1 else set())
        for i in range(len(s) + 1):
            want |= {one(np.insert(s, i, x)) for x in range(spelling.SYMBOLS)}
        for many in (1 << 21, 20):
            monkeypatch.setattr(spelling, "MANY", many)
            got = set(np.concatenate([b.ravel() for b in neighbours(s.reshape(1, -1))]).tolist())
            assert want <= got and len(got - want) <= 1  # a word of one letter loses it


def test_variants_as_by_comparing_all_pairs(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("abcéñz") for _ in range(rng.randint(5, 7))) for _ in range(500)}
    for w in list(words)[:150]:
        i = rng.randrange(len(w))
        words |= {w[:i] + w[i + 1 :], w[:i] + "q" + w[i:], w[:i] + "w" + w[i + 1 :]}
    # chains, ties and powers of two
    counts = {w: rng.choice([3, 3, 4, 6, 8, 12, 16, 64]) for w in words} | {"chainaa": 3, "chainab": 6, "chainbb": 12, "chaibbb": 24, "chabbbb": 48, "tieaa": 9, "tiebb": 9, "tieab": 3}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling_variants(df)) == plain_variants(counts)


def test_very_long_words(spark, monkeypatch):
    monkeypatch.setattr(spelling, "MANY", 1 << 12)
    monkeypatch.setattr(spelling, "WHOLE", 100)
    rng = random.Random(4)
    long = "".join(rng.choice("abcdefé") for _ in range(3000))
    same = "a" * 500
    counts = {long: 40, long[:1500] + long[1501:]: 3, long[:7] + "z" + long[8:]: 5, long + "x": 90, same: 10, same[1:]: 3, same[2:]: 7}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling_variants(df)) == plain_variants(counts)


def test_a_word_of_a_megabyte(spark):
    word = "ab" * 250_000
    df = spark.createDataFrame([(word, 8), (word[:-1], 3)], "word string, n long")
    got = {(len(r.word), len(r.root), r.n_near) for r in spelling_variants(df).collect()}
    assert got == {(500_000, 500_000, 1), (499_999, 500_000, 1)}


def test_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = rows_of(op12_spelling(spark, sf))
    counts = plain_vocabulary(docs)
    assert {(r[0], r[3]) for r in got} == set(counts.items())
    top = dict(sorted(counts.items(), key=lambda x: (len(x[0]), x))[:1500])
    assert rows_of(spelling_variants(spark.createDataFrame(list(top.items()), "word string, n long"))) == plain_variants(top)
