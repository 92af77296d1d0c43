"""Best-fit decreasing packing of token sequences.

Pieces of one length are interchangeable, so best-fit decreasing over all pieces depends on the counts of each length alone. The
plan is made from that histogram (never more rows than the capacity) with a segment tree over remaining capacities, and says
for each length which ranks go where. Spark ranks the pieces and looks each one up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.byte_pairs import merge_long, read_ranks
from tidemark.llm.runtime import by_bytes, materialize, prepare, tuned

#: Ranks are counted in lots of about so many pieces of one length.
LOT = 500

#: The code points (up to U+024F, and general punctuation) on which both tokenizer libraries are tested to agree.
PLAIN = re.compile("[^\\x00-ɏ‐-‧‰-⁞]")


#: White space in a row from which on a run is taken out and merged by itself: the libraries' time or stack grows with it.
BLANKS = 1000


def parts(text: str, runs) -> Iterator[tuple[str, bool]]:
    """The text in parts that are tokenized by themselves with the same ids, and whether a part is a long run of white space.

    The pretokenizer makes such a run a word of its own but for its last character, which may go with what follows; no other word holds
    white space after its first character. runs: the pattern of the long runs.
    """
    last = 0
    for m in runs.finditer(text):
        a, b = m.span()
        b -= b < len(text)
        if a > last:
            yield text[last:a], False
        yield text[a:b], True
        last = b
    if last < len(text):
        yield text[last:], False


class TightestFit:
    """A segment tree over capacities 0..n: the least capacity of at least c that has open sequences, in logarithmic time."""

    def __init__(self, n: int):
        self.size = 1 << (n + 1).bit_length()
        self.some = [False] * (2 * self.size)

    def set(self, at: int, some: bool) -> None:
        i = at + self.size
        self.some[i] = some
        while i > 1:
            i //= 2
            self.some[i] = self.some[2 * i] or self.some[2 * i + 1]

    def least(self, c: int) -> int:
        """-1 if none."""
        i = c + self.size
        if self.some[i]:
            return c
        while i > 1:
            if i % 2 == 0 and self.some[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.some[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return -1


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing of histogram[length] pieces: runs (length, first rank, ranks, first sequence, pieces each, offset).

    Piece r of a run, counted from 0, goes to sequence first + r // each, at offset + (r % each) * length. Equal pieces take
    the tightest open sequence one after the other; as that one only gets tighter, it takes as many as it holds, and a whole
    interval of equally full sequences is filled in one step. The result is that of placing piece by piece.
    """
    open_: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # intervals of sequences with that much left
    tree, runs, opened = TightestFit(capacity), [], 0

    def put(c: int, a: int, b: int) -> None:
        if a < b and c > 0:
            open_[c].append((a, b))
            tree.set(c, True)

    for length in sorted((x for x in histogram if histogram[x]), reverse=True):
        left, rank = histogram[length], 0
        while left:
            c = tree.least(length)
            if c < 0:
                c, each = capacity, capacity // length
                n = -(-left // each)
                a, b = opened, opened + n
                opened += n
            else:
                each = c // length
                a, b = open_[c].pop()
                if not open_[c]:
                    tree.set(c, False)
            full = min(b - a, left // each)
            if full:
                runs.append((length, rank, full * each, a, each, capacity - c))
                put(c - each * length, a, a + full)
                rank, left, a = rank + full * each, left - full * each, a + full
            if a < b and left:
                runs.append((length, rank, left, a, left, capacity - c))
                put(c - left * length, a, a + 1)
                rank, left, a = rank + left, 0, a + 1
            put(c, a, b)
    return runs


def place(pieces: DataFrame, capacity: int = 1024, length_col: str = "length", key: str = "_row") -> DataFrame:
    """pieces with sequence_id and offset: best-fit decreasing over all of them.

    pieces is a written table, as it is read twice, with a number of its own for each row in the column `key`. What reaches the driver is
    the histogram of lengths, at most `capacity` rows, and the plan made from it. Ranks within a length are counted in lots dealt by that
    number, so that a length which most pieces have, or a document that repeats, is spread over tasks. Lengths below 1 or above the
    capacity are an error.
    """
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy(length_col).count().collect()}
    if any(x is None or not 0 < x <= capacity for x in histogram):
        raise ValueError(f"lengths must be between 1 and {capacity}")
    # a row for each length
    lots = spark.createDataFrame([(n, m // LOT + 1) for n, m in histogram.items()], "_n long, _lots long")
    runs = sorted(plan(histogram, capacity))
    table = spark.sparkContext.broadcast(np.array(runs, dtype=np.int64).reshape(-1, 6))
    dealt = pieces.join(F.broadcast(lots), F.col(length_col) == F.col("_n")).withColumn("_lot", F.pmod(F.xxhash64(key), "_lots"))
    counts = dealt.groupBy(F.col(length_col).alias("_l"), F.col("_lot").alias("_m")).count()
    before = Window.partitionBy("_l").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_l", "_m", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(length_col, "_lot").orderBy(key)
    ranked = dealt.withColumn("_in", F.row_number().over(within) - 1)
    ranked = ranked.join(counts, (F.col(length_col) == F.col("_l")) & (F.col("_lot") == F.col("_m"))).withColumn("_rank", F.col("_before") + F.col("_in"))

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        t = table.value
        wide = np.int64(1) << 50
        at = np.searchsorted(t[:, 0] * wide + t[:, 1], length.to_numpy(np.int64) * wide + rank.to_numpy(np.int64), "right") - 1
        run = t[at]
        r = rank.to_numpy(np.int64) - run[:, 1]
        return pd.DataFrame({"sequence_id": run[:, 3] + r // run[:, 4], "offset": run[:, 5] + (r % run[:, 4]) * run[:, 0]})

    found = ranked.withColumn("_at", look_up(F.col(length_col).cast("long"), F.col("_rank").cast("long")))
    return found.select(*pieces.columns, "_at.sequence_id", "_at.offset")


def tokenize(docs: DataFrame, tokenizer: str = "byte_bpe_50k", end_id: int = 2, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids): token ids of each text and an end id, cut into pieces of at most `capacity`.

    Texts of up to `capacity` ids are one piece. Of longer ones all pieces are full but the first, which takes the remainder.
    ids are little-endian unsigned 32-bit numbers in one binary value. Null or empty text: the end id alone.

    tokenizer names a vocabulary that public_tokenizers has both for the tokenizers library and as ranks for tiktoken. The ids
    are those of tokenizers; on texts of plain Latin code points, where both agree, the faster one computes them.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import public_tokenizers
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        ranks = read_ranks(public_tokenizers.path(f"{tokenizer}.tiktoken"))
        blanks = regex.compile(rf"\s{{{BLANKS},}}")
        fast = tiktoken.Encoding(tokenizer, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        slow = None
        for batch in by_bytes(batches, 1):
            doc, piece, start, length, data = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                text = text or ""
                found = []
                for part, blank in parts(text, blanks):
                    if blank:
                        found.append(merge_long(part.encode(), ranks))
                    elif "<|" in part or PLAIN.search(part):
                        if slow is None:
                            slow = Tokenizer.from_file(public_tokenizers.path(f"{tokenizer}.json"))
                        found.append(slow.encode(part, add_special_tokens=False).ids)
                    else:
                        found.append(fast.encode_to_numpy(part, disallowed_special=()))
                ids = np.concatenate([*found, [end_id]]).astype("<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    doc.append(i)
                    piece.append(n)
                    start.append(a)
                    length.append(b - a)
                    data.append(ids[a:b].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(data, pa.binary())],
                ["doc_id", "piece", "start", "length", "ids"],
            )

    return docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary")


def packed(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """pieces, written and placed. The numbers of sequences may differ from run to run, how many there are does not."""
    return place(materialize(pieces.withColumn("_row", F.monotonically_increasing_id())), capacity).drop("_row")


def pack(docs: DataFrame, capacity: int = 1024, **how) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset): documents in as few sequences as best-fit decreasing finds.

    Null id: packed like others. Rows that repeat an id are packed one by one. Empty table: empty result. Extra columns are ignored.
    """
    prepare(docs.sparkSession)
    return packed(tokenize(docs, capacity=capacity, **how), capacity)


def op1_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens; a checksum stands for the ids."""
    docs = tuned(spark).read.parquet(f"{sf_dir}/documents.parquet")
    return packed(tokenize(docs).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
