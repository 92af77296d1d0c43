"""Texts of several MB, many in one batch: what a worker holds stays small."""

import tracemalloc

import pyarrow as pa
import pytest

from tidemark.llm import quality_classifier, quality_rules, substring_dedup, toxicity
from tidemark.llm.near_dedup import sketch
from tidemark.llm.runtime import SLICE, by_bytes
from tidemark.llm.textkit import shingles

LONG = " ".join(f"word{i % 9973}" for i in range(300_000))  # about 2.6 MB


def batches(n):
    return iter([pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([LONG[i:] for i in range(n)])], ["id", "text"])])


@pytest.mark.parametrize(
    "work",
    [
        quality_rules.count_texts, quality_classifier.inputs, toxicity.inputs, lambda c: sketch(*shingles(c, 3), 256), lambda c: substring_dedup.Paragraphs(c, 5, 21, 31),
    ],
    ids=["rules", "classifier", "toxicity", "sketch", "paragraphs"],
)
def test_memory_does_not_grow_with_the_batch(work):
    peaks = []
    for n in (2, 10):
        given = batches(n)
        tracemalloc.start()
        for batch in by_bytes(given, 1):
            work(batch.column(1))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 2.2 * peaks[0] and peaks[1] < 700 << 20  # a slice has two of the texts at most


def test_slices_keep_all_rows_in_order():
    texts = ["x" * n for n in (0, 10, SLICE, 5, SLICE * 2, 0, 3)] + [None, "end"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    parts = list(by_bytes(iter([batch, batch.slice(0, 0)]), 1))
    assert pa.Table.from_batches(parts).column(0).to_pylist() == list(range(len(texts))) and len(parts) > 2
