"""Byte-level BPE: ranked merges folded over the bytes of distinct words, and decoding by concatenation.

Texts are taken in blocks. A block is one row: its documents as numbers of words, and the distinct words that are new in it. Spark's
higher-order functions fold the merges over each new word, with the ranks as a literal in the plan; numbers are then replaced by what their
words gave. Words of earlier blocks of a task, and those of a bounded sample that is folded beforehand, are not folded again. Nothing but
the sample is shuffled, and what a task holds is bounded by TABLE words and a block, or one text if that is longer.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import bounded_sample, by_bytes, discard, materialize, prepare, tuned

#: Bytes of text in a block, but for a single text that is longer; and in what is split at a time.
BLOCK = 2 << 20
SMALL = 1 << 20

#: A task forgets the words of its blocks when it has more of them.
TABLE = 300_000

#: Texts in the sample whose words are folded beforehand, the most words that are kept of it, and the tasks that fold them.
SAMPLE = 6000
WORDS = 300_000
SPREAD = 12

#: A fold copies a word at each merge. Words of more bytes than this are merged with a heap instead, in n log n steps.
LONG = 256

#: The rank map is split by a checksum, so that looking a rank up passes over an entry or two; a power of two.
PARTS = 1 << 15


def read_ranks(path: str) -> dict[bytes, int]:
    """{bytes: rank} of a vocabulary file: a line has the bytes in base64, and the rank, which is also the id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _points(ranks: np.ndarray, wide: bool) -> np.ndarray:
    """The code points of the letters that stand for ranks: in order of ranks, none half of another, all of one width in UTF-8."""
    if wide:
        return ranks + 0x10001
    return ranks + np.where(ranks < 0xD800 - 0x801, 0x801, 0x1001)


class Letters:
    """The alphabet of the words of a fold: a letter for each rank, one for the edges of a word, and one, greater than all others, for no rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.wide = max(ranks.values(), default=-1) >= 0xFFFF - 0x1001
        self.width = 4 if self.wide else 3
        self.edge, self.none = (0x10000, 0x10FFFF) if self.wide else (0x800, 0xFFFF)

    def of(self, rank: int) -> str:
        return chr(int(_points(np.int64(rank), self.wide)))

    def ranks(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ranks each word has, and the ranks of all words. Edges are left out."""
        points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4").astype(np.int32)
        points = points[points != self.edge]
        sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) // self.width - 2
        return sizes, points - (0x10001 if self.wide else np.where(points < 0xD800, 0x801, 0x1001).astype(np.int32))

    def array(self, points: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """Texts of the given sizes from the code points of all."""
        data = points.astype("<u4").tobytes().decode("utf-32-le").encode()
        ends = np.concatenate([[0], np.cumsum(sizes * self.width)]).astype(np.int32)
        return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(data))


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The rank map as one literal: an array of PARTS maps from two pieces to what they become, for all pairs that become one."""
    letters = Letters(ranks)
    letter = {rank: letters.of(rank) for rank in ranks.values()}
    parts: list[dict[str, str]] = [{} for _ in range(PARTS)]
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                pair = letter[left] + letter[right]
                parts[zlib.crc32(pair.encode()) % PARTS][pair] = letter[rank]
    return F.from_json(F.lit(json.dumps(parts)), "array<map<string, string>>")


def piece_literal(ranks: dict[bytes, int]) -> Column:
    """The bytes of each id in hexadecimal, as one literal: an array in order of ids, null where there is no such id."""
    pieces: list[str | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token.hex()
    return F.from_json(F.lit(json.dumps(pieces)), "array<string>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def fold(word: Column, merged: Callable[[Column], Column], none: str) -> Column:
    """What is left of a word after all ranked merges, between its edges.

    A word is a struct: s has a letter for each piece, between two edges, and f what each two neighbours in s become, `none` if they do not;
    an empty f says that there is nothing to merge. Each step puts the lowest of f, the leftmost of those, in the place of its two pieces and
    looks up only the two pairs that this makes. merged(pair) is what a pair becomes, or null.
    """

    def step(state: Column, _: Column) -> Column:
        s, f = state["s"], state["f"]

        def replaced(low: Column, i: Column) -> Column:
            pairs = F.array(F.concat(F.substring(s, i - 1, F.lit(1)), low), F.concat(low, F.substring(s, i + 2, F.lit(1))))
            around = F.array_join(F.transform(pairs, merged), "", none)
            return F.struct(F.overlay(s, low, i, F.lit(2)).alias("s"), F.overlay(f, around, i - 1, F.lit(3)).alias("f"))

        def best(low: Column) -> Column:
            return F.when(low == none, state).otherwise(let(F.instr(f, low), lambda i: replaced(low, i)))

        return let(F.array_min(F.split(f, "")), best)

    # n pieces are merged n - 1 times at most, and s has two edges more
    return F.when(word["f"] == "", word["s"]).otherwise(F.aggregate(F.sequence(F.lit(4), F.length(word["s"])), word, step)["s"])


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same ids, by a heap of adjacent pairs: for words that are too long to be copied at each merge."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), bytearray(b"\1") * n
    # (rank, start, end of the first piece, end of the second): out of date if an end has moved
    heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        if not alive[i] or end[i] != a or end[a] != b:
            continue
        alive[a] = 0
        end[i] = b
        if b < n:
            before[b] = i
            if (r := ranks.get(word[i : end[b]])) is not None:
                heapq.heappush(heap, (r, i, b, end[b]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:b])) is not None:
            heapq.heappush(heap, (r, p, i, b))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


@dataclass(frozen=True)
class Known:
    """Words whose ids are known before a text is read: sizes and ids are those of all words, one after the other."""

    words: list[str]
    sizes: np.ndarray
    ids: np.ndarray


NOTHING = Known([], np.empty(0, np.int64), np.empty(0, np.int32))


def _unfolded(ranks: dict[bytes, int]) -> Callable[[list[str]], pa.Array]:
    """Words as a fold takes them: bytes as pieces, but for words that have a rank, or are long and have been merged."""
    letters = Letters(ranks)
    single = [ranks[bytes([b])] for b in range(256)]
    # what two bytes become; the last row and column are the edges
    pairs = np.full((257, 257), letters.none, np.int64)
    for token, rank in ranks.items():
        if len(token) == 2:
            pairs[token[0], token[1]] = _points(np.int64(rank), letters.wide)
    pairs = pairs.ravel()
    first = np.append(_points(np.array(single, np.int64), letters.wide), letters.edge)

    def whole(data: bytes) -> list[int] | None:
        rank = ranks.get(data)
        return [rank] if rank is not None else merge_long(data, ranks) if len(data) > LONG else None

    def array(words: list[str]) -> pa.Array:
        data = [word.encode() for word in words]
        done = [whole(x) for x in data]
        open_ = np.array([x is None for x in done], bool)
        sizes = np.array([len(x) if y is None else len(y) for x, y in zip(data, done)], np.int64) + 2
        at = np.concatenate([[0], np.cumsum(sizes)])
        edges = np.zeros(at[-1], bool)
        edges[at[:-1]] = edges[at[1:] - 1] = True
        folds = np.repeat(open_, sizes)
        points = np.full(at[-1], letters.edge, np.int64)
        ready = np.fromiter((x for y in done if y is not None for x in y), np.int64)
        points[~edges & ~folds] = _points(ready, letters.wide)
        codes = np.full(at[-1], 256, np.int64)
        codes[~edges & folds] = np.frombuffer(b"".join(x for x, y in zip(data, done) if y is None), np.uint8)
        points[folds] = first[codes[folds]]
        # a pair starts at each letter of an open word but its last
        starts = folds.copy()
        starts[at[1:] - 1] = False
        starts = np.flatnonzero(starts)
        found = pairs[codes[starts] * 257 + codes[starts + 1]] if len(starts) else starts
        columns = [letters.array(points, sizes), letters.array(found, np.where(open_, sizes - 1, 0))]
        return pa.StructArray.from_arrays(columns, ["s", "f"])

    return array


def _blocks(ranks: dict[bytes, int], pattern: str, kind: pa.DataType, known: Known) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each block of texts: their ids, their words as numbers, the words that are new, and the number of the first of these.

    Known words have the first numbers. Words of earlier blocks of the task are not new, until there are TABLE of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        words, unfolded = regex.compile(pattern), _unfolded(ranks)

        def anew() -> defaultdict[str, int]:
            return defaultdict(count(len(known.words)).__next__, zip(known.words, count()))

        def row(docs: list[pa.Array], numbers: list[np.ndarray], first: int) -> pa.RecordBatch:
            new = list(islice(reversed(table), len(table) - first))[::-1]
            ends = pa.array(np.cumsum([0, *map(len, numbers)]), pa.int32())
            texts = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(numbers), pa.int32()))
            columns = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in (pa.concat_arrays(docs), texts, unfolded(new))]
            return pa.RecordBatch.from_arrays([*columns, pa.array([first], pa.int32())], ["docs", "texts", "words", "first"])

        table = anew()
        docs, numbers, first, held = [], [], len(table), 0
        for batch in by_bytes(batches, 1, SMALL):
            size = batch.column(1).nbytes
            if docs and held + size > BLOCK:
                yield row(docs, numbers, first)
                if len(table) - len(known.words) > TABLE:
                    table = anew()
                docs, numbers, first, held = [], [], len(table), 0
            docs.append(batch.column(0).cast(kind))
            for text in batch.column(1).to_pylist():
                numbers.append(np.array(list(map(table.__getitem__, words.findall(text))) if text else [], np.int32))
            held += size
        if docs:
            yield row(docs, numbers, first)

    return run


def _assembled(letters: Letters, known_sizes: np.ndarray, known_ids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row for each document of the blocks: the ids of its words, one after the other. Blocks come in the order in which they were made."""

    def lists(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Where each list begins, and what all of them hold."""
        at = array.offsets.to_numpy().astype(np.int64)
        return at - at[0], array.flatten().to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, ids = [known_sizes], [known_ids]
        for batch in batches:
            for i in range(batch.num_rows):
                docs, texts, encoded = (batch.column(c)[i].values for c in range(3))
                first = batch.column(3)[i].as_py()
                if first == len(known_sizes):
                    sizes, ids = [known_sizes], [known_ids]
                if first != sum(map(len, sizes)):
                    raise ValueError("blocks of words are not in the order in which they were made")
                for held, more in zip((sizes, ids), letters.ranks(encoded)):
                    held.append(more)
                sizes, ids = [np.concatenate(sizes)], [np.concatenate(ids)]
                begin = np.cumsum(sizes[0]) - sizes[0]
                text_at, numbers = lists(texts)
                size = sizes[0][numbers]
                at = np.concatenate([[0], np.cumsum(size)])
                # each id's place in ids: its word's beginning, and its place in the word
                source = np.repeat(begin[numbers] - at[:-1], size) + np.arange(at[-1])
                out = pa.ListArray.from_arrays(pa.array(at[text_at], pa.int32()), pa.array(ids[0][source] if len(source) else [], pa.int32()))
                yield from pa.Table.from_arrays([docs, out], ["doc_id", "ids"]).to_batches(max_chunksize=1000)

    return run


def _merged(ranks: dict[bytes, int]) -> Callable[[Column], Column]:
    """What a pair of pieces becomes, or null."""
    parts = rank_literal(ranks)
    return lambda pair: F.get(parts, F.crc32(pair).bitwiseAND(PARTS - 1).cast("int"))[pair]


def _checked(ranks: dict[bytes, int]) -> None:
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("each single byte needs a rank")


def sample_words(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text") -> Known:
    """The words of SAMPLE texts, of the first 16,384 characters of each, with their ids: WORDS at most. Given to encode, they are not folded again.

    They change how long encode takes, not what it gives. The texts are those whose ids hash lowest.
    """
    _checked(ranks)
    letters = Letters(ranks)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        words, unfolded, seen = regex.compile(pattern), _unfolded(ranks), set()
        for batch in by_bytes(batches, 0):
            new = {w for text in batch.column(0).to_pylist() if text for w in words.findall(text) if len(w) <= 64} - seen
            seen |= new
            new = sorted(new)
            for at in range(0, len(new), 1000):
                lot = new[at : at + 1000]
                yield pa.RecordBatch.from_arrays([pa.array(lot, pa.string()), unfolded(lot)], ["word", "open"])

    texts = docs.select(F.col(id_col).alias("id"), F.substring(F.col(text_col).cast("string"), 1, 1 << 14).alias("text"))
    found = bounded_sample(texts, SAMPLE, 13).select("text").repartition(SPREAD).mapInArrow(distinct, "word string, open struct<s: string, f: string>")
    one = materialize(found.groupBy("word").agg(F.first("open").alias("open")).limit(WORDS).repartition(SPREAD, "word"))
    rows = one.select("word", fold(F.col("open"), _merged(ranks), chr(letters.none)).alias("ids")).toArrow()
    discard(one)
    sizes, ids = letters.ranks(rows.column("ids").combine_chunks())
    return Known(rows.column("word").to_pylist(), sizes, ids)


def encode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", known: Known = NOTHING
) -> DataFrame:
    """(doc_id, ids): the ids of each whole text, without special tokens. pattern says what words are; it is matched by `regex`.

    Each single byte must have a rank. Null or empty text: no ids. Each row is encoded by itself, so ids of rows may be null or repeat.
    Empty table: empty result. Extra columns are ignored. known: from sample_words, with the same ranks and pattern.
    """
    prepare(docs.sparkSession)
    _checked(ranks)
    id_type = docs.select(F.col(id_col)).schema[0].dataType
    kind = id_type.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    blocks = rows.mapInArrow(
        _blocks(ranks, pattern, to_arrow_type(id_type), known),
        f"docs array<{kind}>, texts array<array<int>>, words array<struct<s: string, f: string>>, first int",
    )
    letters, merged = Letters(ranks), _merged(ranks)
    folded = F.transform("words", lambda w: fold(w, merged, chr(letters.none)))
    # no shuffle may come between the two steps in Python, as the second counts on from block to block
    return blocks.select("docs", "texts", folded.alias("encoded"), "first").mapInArrow(_assembled(letters, known.sizes, known.ids), f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids") -> DataFrame:
    """encoded with the column `bytes`: the pieces of its ids, concatenated. No ids: no bytes. Null ids, or an id without a piece: null."""
    pieces = piece_literal(ranks)
    # get is null for null, negative and too large ids; unhex is null if there is a mark that is no digit
    joined = let(pieces, lambda all_: F.transform(F.col(ids_col), lambda i: F.get(all_, i)))
    return encoded.withColumn("bytes", F.unhex(F.array_join(joined, "", "--")))


def op13_byte_pairs(spark, sf_dir: str) -> DataFrame:
    """All documents as byte-level BPE ids, and the ids decoded again; checksums stand for both."""
    import public_tokenizers

    ranks = read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = tuned(spark).read.parquet(f"{sf_dir}/documents.parquet")
    known = sample_words(docs, ranks, public_tokenizers.PATTERN)
    rows = decode(encode(docs, ranks, public_tokenizers.PATTERN, known=known), ranks)
    text = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(text.cast("binary"), 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256")
    )
