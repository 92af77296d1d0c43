import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from helpers import ODD, frame
from tidemark.llm import byte_pairs
from tidemark.llm.byte_pairs import decode, encode, merge_long, op13_byte_pairs, read_ranks

#: Texts where splitting and merging are delicate.
HARD = [
    "it's they'll I'M 's", "a  b   c\n\n d \t\t", "   ", "x  ", "12345678901234567890", "!!!!!!!!!!!!???", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "<|endoftext|>",
    "Straße, naïve façade — “quoted”", "Привет, мир", "漢字かな交じり文", "🙂🙃👩‍👩‍👧", "é‍﻿", "\x00\x1f\x85  x", "ababababab" * 30, "z" * 300 + " y",
]


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_and_bytes_as_the_library_gives_them(spark, ranks, library, monkeypatch):
    rng = random.Random(5)
    noise = ["".join(rng.choice("etaoin ,.éßжあ\n0") for _ in range(rng.randint(1, 80))) for _ in range(120)]
    texts = [*ODD, *HARD, *noise, *HARD]
    rows = decode(encode(frame(spark, texts), ranks, public_tokenizers.PATTERN), ranks).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.ids == library.encode_ordinary(text) and bytes(r.bytes) == text.encode()


def test_blocks_do_not_matter(spark, ranks, library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "BLOCK", 64)
    texts = ["one two three " * 5, None, "two", "three four " * 9]
    rows = encode(frame(spark, texts).coalesce(1), ranks, public_tokenizers.PATTERN).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: library.encode_ordinary(t or "") for i, t in enumerate(texts)}


def test_long_words_take_n_log_n_steps(ranks, library):
    rng = random.Random(6)
    for word in ["a" * 1001, "".join(rng.choice("abcde") for _ in range(3000)), " " * 500, "ab" * 400, "漢字" * 300]:
        assert merge_long(word.encode(), ranks) == library._encode_single_piece(word)
    assert sum(len(word) for word in ("x" * 400_000,)) > len(merge_long(b"x" * 400_000, ranks)) > 0


def test_very_long_texts_ids_that_repeat_and_nulls(spark, ranks, library):
    blanks, letters = " " * 1_200_000, "q" * 500_000
    rows = spark.createDataFrame([(None, blanks, 1), (7, letters, 2), (7, "again", 3), (None, None, 4)], "doc_id int, text string, ids int")
    out = decode(encode(rows, ranks, public_tokenizers.PATTERN), ranks)
    assert out.schema["doc_id"].dataType.simpleString() == "int"
    got = {(r.doc_id, bytes(r.bytes)) for r in out.collect()}
    assert got == {(None, blanks.encode()), (7, letters.encode()), (7, b"again"), (None, b"")}
    assert encode(rows.limit(0), ranks, public_tokenizers.PATTERN).collect() == []


def test_ids_that_are_none_decode_to_null(spark, ranks):
    rows = spark.createDataFrame([([0, 1],), ([],), (None,), ([len(ranks)],), ([None, 1],), ([-1],)], "ids array<int>")
    got = [r.bytes for r in decode(rows, ranks).collect()]
    back = {v: k for k, v in ranks.items()}
    assert [None if b is None else bytes(b) for b in got] == [back[0] + back[1], b"", None, None, None, None]


def test_a_byte_without_a_rank_is_refused(spark, ranks):
    with pytest.raises(ValueError):
        encode(frame(spark, ["a"]), {b"a": 0}, public_tokenizers.PATTERN)


def test_query(spark, sf, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op13_byte_pairs(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        plain = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), texts[r.doc_id].encode())]
        assert [r.n_tokens, r.ids_sha256, r.decoded_sha256] == [len(ids), *plain]


def test_nothing_is_shuffled(spark, sf):
    plan = op13_byte_pairs(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "aggregate(sequence" in plan


def test_words_of_earlier_blocks_and_known_words_are_not_folded_again(spark, ranks, library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "BLOCK", 64)
    texts = ["zyxqv wvutq " * 5, "zyxqv again wvutq " * 5, "zyxqv new"]
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1, 2], pa.int64()), pa.array(texts)], ["doc_id", "text"])
    slices = [batch.slice(i, 1) for i in range(3)]
    rows = list(byte_pairs._blocks(ranks, public_tokenizers.PATTERN, pa.int64(), byte_pairs.NOTHING)(iter(slices)))
    assert [(r.column("first")[0].as_py(), len(r.column("words")[0])) for r in rows] == [(0, 4), (4, 1), (5, 1)]
    docs = frame(spark, texts)
    known = byte_pairs.sample_words(docs, ranks, public_tokenizers.PATTERN)
    rows = list(byte_pairs._blocks(ranks, public_tokenizers.PATTERN, pa.int64(), known)(iter(slices)))
    assert [len(r.column("words")[0]) for r in rows] == [0, 0, 0]
    got = encode(docs, ranks, public_tokenizers.PATTERN, known=known).collect()
    assert {r.doc_id: r.ids for r in got} == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_words_are_forgotten_and_numbered_anew(spark, ranks, library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "BLOCK", 32)
    monkeypatch.setattr(byte_pairs, "TABLE", 3)
    texts = [f"zyxqv wvutq{'abcdefgh'[i % 8]} qqkj{'xyz'[i % 3]}" for i in range(24)]
    docs = frame(spark, texts).coalesce(1)
    known = byte_pairs.sample_words(frame(spark, texts[:2]), ranks, public_tokenizers.PATTERN)
    for more in (byte_pairs.NOTHING, known):
        got = encode(docs, ranks, public_tokenizers.PATTERN, known=more).collect()
        assert {r.doc_id: r.ids for r in got} == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_ranks_beyond_the_letters_of_three_bytes(spark, ranks, library):
    wide = {token: rank + 20_000 for token, rank in ranks.items()}
    texts = [t for t in HARD if t]
    got = encode(frame(spark, texts), wide, public_tokenizers.PATTERN).collect()
    assert {r.doc_id: r.ids for r in got} == {i: [x + 20_000 for x in library.encode_ordinary(t)] for i, t in enumerate(texts)}
