"""Spelling variants: words of one vocabulary that differ in one letter, found over a reduced alphabet.

Each letter is hashed to one of a few symbols. The full one-edit neighbourhood of every reduced word is generated and joined with the
reduced vocabulary; words whose reduced forms meet are compared as they are. A word and its variant are one edit apart, so their reduced
forms are one edit apart or equal: none is missed. Reduced words stand as 64-bit hashes, whose edits are sums over prefixes and suffixes,
so that a neighbour costs the same whatever the word's length; hashes that collide only bring candidates that comparison drops.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import by_bytes, discard, materialize, prepare, tuned
from tidemark.llm.textkit import BASE, LOWER, UNBASE, U, constants, hash_spans, mix, powers, spans, utf8

#: Symbols of the reduced alphabet: more of them give larger neighbourhoods, fewer give more candidates.
SYMBOLS = 8

#: Numbers of neighbours that are made in one go.
MANY = 1 << 21

#: Words of up to so many code points have their neighbours made together, so that none is given twice.
WHOLE = 4096

LEAD = 0xC3  # first byte of U+00C0 to U+00FF in UTF-8, and of nothing else
ASCII = np.zeros(256, bool)
ASCII[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True

#: Runs of up to so many bytes have their checksums taken together, a byte at a time; words of up to so many letters are compared by levenshtein.
SHORT = 48


def _crc_table() -> np.ndarray:
    """What each byte does to a crc32: eight steps of the reversed polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The crc32 of each span of data, where a text with the crc32 `before` stands in front of it."""
    size = ends - starts
    order = np.argsort(-np.minimum(size, SHORT + 1), kind="stable")
    state = (before ^ np.uint32(0xFFFFFFFF))[order]
    at, size = starts[order], size[order]
    long = int(np.searchsorted(-size, -SHORT))
    for j in range(min(int(size.max(initial=0)), SHORT)):
        k = int(np.searchsorted(-size[long:], -j)) + long
        s = state[long:k]
        state[long:k] = CRC[(s ^ data[at[long:k] + j]) & 255] ^ (s >> 8)
    for i in range(long):
        a = int(at[i])
        state[i] = zlib.crc32(data[a : a + int(size[i])], int(before[order[i]])) ^ 0xFFFFFFFF
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def _counted(texts: pa.Array, ids: list[str | None], least: int, modulus: int) -> dict[str, int]:
    """The words of a slice that have `least` code points, and how often they stand there."""
    raw, at = utf8(texts)
    keep = ASCII[raw] | (raw == LEAD)
    keep[1:] |= raw[:-1] == LEAD
    starts, ends = spans(keep, at)
    data = LOWER[raw]
    prefix = np.array([zlib.crc32(f"{'null' if i is None else i}:".encode()) for i in ids], np.uint32)
    crc = crc32_spans(data, starts, ends, prefix[np.searchsorted(at, starts, "right") - 1])
    counts: dict[str, int] = {}
    hit = crc % modulus == 0
    for a, b, h in zip(starts[hit].tolist(), ends[hit].tolist(), crc[hit].tolist()):
        word = data[a:b].tobytes().decode()
        k = h % len(word)
        word = word[:k] + word[k + 1 :]
        if len(word) >= least:
            counts[word] = counts.get(word, 0) + 1
    leads = np.concatenate([[0], np.cumsum(raw == LEAD)])
    rest = ~hit & (ends - starts - (leads[ends] - leads[starts]) >= least)
    starts, ends = starts[rest], ends[rest]
    _, first, n = np.unique(hash_spans(data, starts, ends), return_index=True, return_counts=True)
    for a, b, m in zip(starts[first].tolist(), ends[first].tolist(), n.tolist()):
        word = data[a:b].tobytes().decode()
        counts[word] = counts.get(word, 0) + m
    return counts


def vocabulary(docs: DataFrame, least: int = 5, occurrences: int = 3, modulus: int = 97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of whole texts with at least that many code points and occurrences.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lower-cased. Let h be the crc32 of `<id>:<run>`; if modulus divides h, the run loses its
    code point h % length. Null text: no words; null id: `null`. Rows that repeat count as often. Empty table: empty result. Extra
    columns are ignored. A frequent word is one row for each slice of text before anything is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 1):
            counts = _counted(batch.column(1), batch.column(0).to_pylist(), least, modulus)
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= occurrences)


def symbols(word: str, k: int = SYMBOLS) -> np.ndarray:
    """The reduced word: a symbol below k for each letter."""
    letters = np.frombuffer(word.encode("latin-1"), np.uint8)
    return (mix(letters.astype(np.uint64) + U(29)) % U(k)).astype(np.uint8)


def code(reduced: np.ndarray, k: int = SYMBOLS) -> np.ndarray:
    """The 64-bit hash of each row of reduced words of one length."""
    return mix((constants(13, k)[reduced] * powers(BASE, reduced.shape[1])).sum(axis=1, dtype=np.uint64))


def neighbours(reduced: np.ndarray, k: int = SYMBOLS) -> Iterator[np.ndarray]:
    """The hashes of all reduced words that are one edit from each row, and of the row itself, in blocks of columns.

    Any of the k symbols in place of each symbol, or before each and at the end; and each symbol left out.
    """
    m, size = reduced.shape
    c, power = constants(13, k), powers(BASE, size + 1)
    own = c[reduced]
    before = np.zeros((m, size + 1), np.uint64)
    np.cumsum(own * power[:size], axis=1, out=before[:, 1:])
    whole = before[:, -1:]
    wide = max(1, MANY // (m * (2 * k + 1)))
    for a in range(0, size + 1, wide):
        b, e = min(a + wide, size), min(a + wide, size + 1)
        replaced = whole[:, :, None] + (c - own[:, a:b, None]) * power[a:b, None]
        left_out = before[:, a:b] + (whole - before[:, a + 1 : b + 1]) * U(UNBASE)
        added = before[:, a:e, None] + c * power[a:e, None] + ((whole - before[:, a:e]) * U(BASE))[:, :, None]
        yield mix(np.concatenate([replaced.reshape(m, -1), left_out, added.reshape(m, -1)], axis=1))


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of words of one length, not too many at once, and their reduced forms."""
    places: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        places.setdefault(len(word), []).append(i)
    for size, found in places.items():
        lot = max(1, MANY // ((2 * SYMBOLS + 1) * (size + 1)))
        for a in range(0, len(found), lot):
            part = found[a : a + lot]
            yield np.array(part), symbols("".join([words[i] for i in part])).reshape(len(part), size)


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, n, and the hash of the reduced word."""
    for batch in batches:
        out = np.empty(batch.num_rows, np.uint64)
        for places, reduced in _by_length(batch.column(0).to_pylist()):
            out[places] = code(reduced)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out.view(np.int64))], ["word", "n", "code"])


def _generated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, near, own) from (id, word): the hashes around each reduced word that are not below its own, and whether it is its own.

    Two reduced words that are one edit apart are in each other's neighbourhood; the one with the lower hash is enough to find both.
    """
    for batch in batches:
        ids = batch.column(0).to_numpy()
        for places, reduced in _by_length(batch.column(1).to_pylist()):
            own = code(reduced)[:, None]
            blocks = neighbours(reduced)
            if reduced.shape[1] <= WHOLE:
                blocks = [np.concatenate(list(blocks), axis=1)]
            for found in blocks:
                found.sort(axis=1)
                keep = found >= own
                keep[:, 1:] &= found[:, 1:] != found[:, :-1]
                row, _ = np.nonzero(keep)
                near = found[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[places[row]]), pa.array(near.view(np.int64)), pa.array(near == own[row, 0])], ["id", "near", "own"]
                )


def _common(a: Column, b: Column) -> Column:
    """How many code points a and b have in common at their beginning, by halving."""
    start = F.struct(F.lit(0).alias("low"), F.least(F.length(a), F.length(b)).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"] + 1) / 2).cast("int")
        same = F.substring(a, F.lit(1), middle) == F.substring(b, F.lit(1), middle)
        return F.struct(F.when(same, middle).otherwise(s["low"]).alias("low"), F.when(same, s["high"]).otherwise(middle - 1).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(32)), start, lambda s, _: F.when(s["low"] < s["high"], halve(s, _)).otherwise(s), lambda s: s["low"])


def one_edit(a: str, b: str) -> Column:
    """Whether the columns differ by exactly one inserted, deleted or replaced code point. levenshtein steps through long words from the
    start for each letter; for those, what follows the first difference is compared instead."""
    a, b = F.col(a), F.col(b)
    more = F.length(a) - F.length(b)
    rest = lambda x, skip: F.substring(x, _common(a, b) + 1 + skip, F.length(x))
    of_long = (a != b) & (rest(a, (more >= 0).cast("int")) == rest(b, (more <= 0).cast("int")))
    return F.when(F.abs(more) > 1, False).when(F.length(a) <= SHORT, F.levenshtein(a, b, 1) == 1).otherwise(of_long)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(id, word, n, other, other_word, other_n): each pair of words that are one edit apart, once. vocabulary: (id, word, n, code), written."""
    around = vocabulary.select("id", "word").mapInArrow(_generated, "id long, near long, own boolean")
    other = vocabulary.select(F.col("code").alias("near"), F.col("id").alias("other"), F.col("word").alias("other_word"), F.col("n").alias("other_n"))
    # both sides grow with the vocabulary: never broadcast
    pairs = around.join(other.hint("merge"), "near").filter((F.col("id") < F.col("other")) | (~F.col("own") & (F.col("id") != F.col("other"))))
    pairs = pairs.select("id", "other", "other_word", "other_n").join(vocabulary.select("id", "word", "n").hint("merge"), "id")
    # a word beyond WHOLE may have met another more than once
    return pairs.filter(one_edit("word", "other_word")).dropDuplicates(["id", "other"])


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root) of (id, up, up_word): the word at the end of the chain. Chains halve in each round, as each row then leads twice as far."""
    at = materialize(forms.select("id", F.col("up").alias("to"), F.col("up_word").alias("root")))
    while True:
        onward = at.select(F.col("id").alias("to"), F.col("to").alias("next"), F.col("root").alias("next_root"))
        if at.join(onward.select("to").hint("merge"), "to", "left_semi").isEmpty():
            return at.select("id", "root")
        far = at.join(onward.hint("merge"), "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.coalesce("next_root", "root").alias("root"))
        old, at = at, materialize(far)
        discard(old)


def spelling_variants(words: DataFrame, times: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a vocabulary (word, n) without repeats, of letters up to U+00FF.

    Two words are near if one inserted, deleted or replaced code point makes one the other; n_near counts the near words. form is the near
    word with the largest n, ties going to the first in order of code points, if it is frequent enough: its n is at least `times` the
    word's. root is the last word that forms lead to, the word itself if it has none. Empty vocabulary: empty result.
    """
    prepare(words.sparkSession)
    coded = words.select("word", "n").mapInArrow(_codes, "word string, n long, code long")
    known = materialize(coded.withColumn("id", F.monotonically_increasing_id()))
    pairs = near_words(known)
    side = lambda a, b: F.struct(F.col(a).alias("id"), *[F.col(f"{b}{c}").alias(c) for c in ("word", "n")], F.col("other" if a == "id" else "id").alias("up"))
    ends = pairs.select(F.explode(F.array(side("id", "other_"), side("other", ""))).alias("e")).select("e.*")
    best = ends.groupBy("id").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("least"), "word", "up")).alias("best"))
    found = known.select("id", "word", "n").join(best.hint("merge"), "id", "left")
    formed = -F.col("best.least") >= times * F.col("n")
    rows = materialize(found.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *[F.when(formed, c).alias(name) for c, name in (
        (F.col("best.word"), "form"), (-F.col("best.least"), "form_n"), (F.col("best.up"), "up"))]))
    discard(known)
    roots = _roots(rows.filter("up is not null").select("id", "up", F.col("form").alias("up_word")))
    out = rows.join(roots.hint("merge"), "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling(spark, sf_dir: str) -> DataFrame:
    """The words of all documents, with the more frequent words that they may be misspellings of."""
    return spelling_variants(vocabulary(tuned(spark).read.parquet(f"{sf_dir}/documents.parquet")))
