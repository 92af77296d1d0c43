import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import ODD, rule_counts, shingles, words
from tidemark.llm import textkit
from tidemark.llm.quality_rules import COUNTS, count_texts

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("aAbB é漢\n\t \x0b\x0c\r\x1f |#"), max_size=60), st.text(max_size=20)), min_size=1, max_size=6)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_and_shingles(texts):
    texts = [t.encode("utf-8", "ignore").decode() if t else t for t in texts]
    got = textkit.Words(pa.array(texts, pa.string()), lower=True)
    raw = bytes(got.data)
    for i, t in enumerate(texts):
        assert [raw[got.starts[j] : got.ends[j]].decode() for j in range(got.at[i], got.at[i + 1])] == words(t)
    same = {}
    for h, s, e in zip(got.hash.tolist(), got.starts, got.ends):
        assert same.setdefault(h, raw[s:e]) == raw[s:e]
    for k in (1, 3, 5):
        _, at = textkit.shingles(pa.array(texts, pa.string()), k)
        assert np.diff(at).tolist() == [len(shingles(t, k)) for t in texts]


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_counts(texts):
    texts = [t.encode("utf-8", "ignore").decode() if t else t for t in texts]
    got = count_texts(pa.array(texts, pa.string()))
    assert [tuple(int(got[c][i]) for c in COUNTS[:5]) for i in range(len(texts))] == [rule_counts(t) for t in texts]


def test_odd_texts_slices_and_chunks(monkeypatch):
    array = pa.array(["skipped", *ODD], pa.string()).slice(1)
    whole = textkit.Words(array)
    assert whole.n.tolist() == [len(words(t)) for t in ODD]
    monkeypatch.setattr(textkit, "CHUNK", 64)
    assert (textkit.Words(array.cast(pa.large_string())).hash == whole.hash).all()


def test_hashes_stay_the_same():
    assert textkit.Words(pa.array(["to be or"])).hash.tolist() == textkit.Words(pa.array(["x to", "to be or"])).hash.tolist()[2:]
