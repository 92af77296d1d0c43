"""Secret scans: patterns over whole texts and over every layer that recursive decoding unwraps.

A worklist holds layers. A layer is text, and bytes if it was decoded from some, and knows which stretch of the original text a part of it
comes from. A layer with percent escapes, or with \\u and \\x escapes, gives a layer with all of them decoded and the rest as it is, so that a
key stays beside its value. Runs of base64, compressed data in escapes or anywhere in a layer's bytes, those that were compressed themselves
included, and text of two bytes a letter become layers of their own. Layers are scanned and unwrapped in turn until nothing new appears. A layer that has been seen before is not taken up again, which ends cycles such as
archives that hold themselves. Compressed data is unpacked and scanned a piece at a time, whatever it grows to.
"""

from __future__ import annotations

import base64
import bisect
import bz2
import functools
import itertools
import lzma
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import by_bytes, prepare, tuned

#: In the order in which kinds with the same start are listed; with the group whose length counts, and the least length.
KINDS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
ORDER = {kind: n for n, kind in enumerate(KINDS)}

#: Runs of at least 24 of the letters: where a match of the kind can be long enough, so that short ones aren't looked at.
LONG_HEX = re.compile(r"[0-9a-f]{24,}")

#: What a match of the first kind begins with, in lower case.
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2}|%u[0-9A-Fa-f]{4})+")
ONE_PERCENT = re.compile(r"%u([0-9A-Fa-f]{4})|(?:%[0-9A-Fa-f]{2})+")
ONE_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\u\{0*(10[0-9A-Fa-f]{4}|[0-9A-Fa-f]{1,5})\}|\\U(000[0-9A-Fa-f]{5}|0010[0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})")
ESCAPES = re.compile(f"(?:{ONE_ESCAPE.pattern})+")
#: Runs, and runs that go on over line breaks.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)++={0,2}")
PIECES = re.compile(r"[A-Za-z0-9+]+")
BORDER = re.compile(r"[/_-]")

#: What any find or further layer needs at least.
PROMISING = re.compile(rb"[:=%\\]|AKIA|[A-Za-z0-9+/_-]{16}")

#: First bytes of gzip, zlib, bzip2, xz and zstandard: fixed values.
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]1AY&SY|\xfd7zXZ\x00|\x28\xb5\x2f\xfd", re.S)

#: Eight letters or more of two bytes each, the low byte first or last.
WIDE = re.compile(rb"((?:[\t\n\r\x20-\x7e]\x00){8,})|(?:\x00[\t\n\r\x20-\x7e]){8,}")

#: Compressed data is scanned in pieces of so many bytes. Each begins with the last OVERLAP bytes of the one before, so that what is
#: shorter than that is whole in one of them.
PIECE, OVERLAP = 1 << 22, 1 << 16

#: First bytes of gzip, zlib, bzip2, xz and zstandard, percent-escaped or as in a literal with \\x: fixed values.
PACKED_PERCENT = re.compile(
    r"%1[fF]%8[bB]|(?:%78|x)%(?:01|5[eE]|9[cC]|[dD][aA])|(?:%42|B)(?:%5[aA]|Z)(?:%68|h)|%[fF][dD](?:%37|7)(?:%7[aA]|z)(?:%58|X)|(?:%28|\()%[bB]5(?:%2[fF]|/)%[fF][dD]"
)
#: What every match of PACKED_PERCENT has within its first three characters, or begins with.
FIRST_PERCENT = re.compile(r"BZh|%(?:1[fF]|78|01|5[eEaA]|9[cC]|[dD][aA]|42|68|[fF][dD]|28|[bB]5)")
PACKED_LITERAL = re.compile(
    r"\\x1[fF]\\x8[bB]|(?:\\x78|x)(?:\\x01|\^|\\x5[eE]|\\x9[cC]|\\x[dD][aA])|(?:\\x42|B)(?:\\x5[aA]|Z)(?:\\x68|h)|\\x[fF][dD](?:\\x37|7)(?:\\x7[aA]|z)|(?:\\x28|\()\\x[bB]5(?:\\x2[fF]|/)\\x[fF][dD]"
)
OCTETS_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2}|[A-Za-z0-9_.~/+(-])+")
OCTETS_LITERAL = {
    "'": re.compile(r"(?:\\x[0-9A-Fa-f]{2}|\\[abfnrtv0\\'\"]|[^\\'\n])+"), '"': re.compile(r"(?:\\x[0-9A-Fa-f]{2}|\\[abfnrtv0\\'\"]|[^\\\"\n])+"),
    "": re.compile(r"(?:\\x[0-9A-Fa-f]{2}|\\[abfnrtv0\\'\"]|[^\\'\"\s])+"),
}
SHORT = {"a": 7, "b": 8, "f": 12, "n": 10, "r": 13, "t": 9, "v": 11, "0": 0}


def matches(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of each kind's leftmost, non-overlapping matches that are long enough, in code points."""
    found = []
    low = text.lower()
    if any(word in low for word in WORDS):
        pattern, group, least = KINDS["assign"]
        found += [("assign", m.start(), m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    if "AKIA" in text:
        pattern, group, least = KINDS["access"]
        found += [("access", m.start(), m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    found += [("hex", m.start(), m.end()) for m in LONG_HEX.finditer(text)]
    return found


#: (start, end) of a stretch of a layer, and of the stretch of the original text that it comes from.
Where = Callable[[int, int], tuple[int, int]]

#: Gives the bytes of a layer from the start, a chunk at a time, as often as it is called.
Source = Callable[[], Iterator[bytes]]


class Layer:
    """text, and where: which stretch of the original text the characters from a to b come from, worked out for finds alone.

    A layer that was bytes has them as `data`, with where_data for bytes; rest(i) gives the data from i on if it goes on beyond this layer.
    """

    __slots__ = ("data", "rest", "text", "where", "where_data")

    def __init__(self, text: str, where: Where, data: bytes | None = None, where_data: Where | None = None, rest: Callable[[int], Source] | None = None):
        self.text, self.where, self.data, self.where_data, self.rest = text, where, data, where_data, rest


def _of_bytes(data: bytes, where: Where, rest: Callable[[int], Source] | None = None) -> Layer:
    """The layer whose UTF-8 bytes are data; a byte that is not UTF-8 is a character that matches nothing."""
    text = data.decode("utf-8", "surrogateescape")
    if len(text) == len(data):
        return Layer(text, where, data, where, rest)

    @functools.cache
    def offsets() -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        size = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        size[(points >= 0xDC80) & (points <= 0xDCFF)] = 1
        return np.concatenate([[0], np.cumsum(size)])

    return Layer(text, lambda a, b: where(int(offsets()[a]), int(offsets()[b])), data, where, rest)


def _replaced(layer: Layer, runs: re.Pattern, decode: Callable[[re.Match], tuple[str, list[int], list[int]]]) -> Layer:
    """layer with each of the runs decoded, and all other characters as they are. decode(match): the characters, and begin and end of each."""
    text, begin, old, inner, last, size = [], [], [], [], 0, 0
    for m in [*runs.finditer(layer.text), None]:
        stop = m.start() if m else len(layer.text)
        if stop > last:
            text.append(layer.text[last:stop])
            begin.append(size)
            old.append(last)
            inner.append(None)
            size += stop - last
        if m:
            chars, starts, ends = decode(m)
            text.append(chars)
            begin.append(size)
            old.append(stop)
            inner.append((starts, ends))
            size += len(chars)
            last = m.end()

    def where(a: int, b: int) -> tuple[int, int]:
        i, j = bisect.bisect_right(begin, a) - 1, bisect.bisect_right(begin, b - 1) - 1
        first = old[i] + a - begin[i] if inner[i] is None else inner[i][0][a - begin[i]]
        end = old[j] + b - begin[j] if inner[j] is None else inner[j][1][b - 1 - begin[j]]
        return layer.where(first, end)

    return Layer("".join(text), where)


def _units(run: list[tuple[int, int, int]]) -> tuple[str, list[int], list[int]]:
    """Characters of (code, start, end), halves of one character joined."""
    codes, starts, ends = [], [], []
    for code, a, b in run:
        if codes and 0xD800 <= codes[-1] < 0xDC00 and 0xDC00 <= code < 0xE000:
            codes[-1] = 0x10000 + ((codes[-1] - 0xD800) << 10) + code - 0xDC00
            ends[-1] = b
        else:
            codes.append(code)
            starts.append(a)
            ends.append(b)
    return "".join(map(chr, codes)), starts, ends


def _percent(m: re.Match) -> tuple[str, list[int], list[int]]:
    found = []
    for one in ONE_PERCENT.finditer(m.string, m.start(), m.end()):
        if one[1]:
            found.append((int(one[1], 16), one.start(), one.end()))
        else:
            at = one.start()
            for c in bytes.fromhex(one[0].replace("%", "")).decode("utf-8", "surrogateescape"):
                n = 3 * len(c.encode("utf-8", "surrogateescape"))
                found.append((ord(c), at, at + n))
                at += n
    return _units(found) if "%u" in m[0] else ("".join(chr(c) for c, _, _ in found), [a for _, a, _ in found], [b for _, _, b in found])


def _escaped(m: re.Match) -> tuple[str, list[int], list[int]]:
    return _units([(int(one[one.lastindex], 16), one.start(), one.end()) for one in ONE_ESCAPE.finditer(m.string, m.start(), m.end())])


class _File:
    """Chunks as a file to read from."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.held = chunks, b""

    def read(self, size: int = -1) -> bytes:
        while not self.held:
            self.held = next(self.chunks, None)
            if self.held is None:
                self.held = b""
                return b""
        out, self.held = self.held[:size], self.held[size:]
        return out


def _unpacked(source: Source, used: list[int] | None = None) -> Iterator[bytes]:
    """What all members of packed data unpack to, in order, up to the first that is broken; each chunk has PIECE bytes at most.

    used: its last number becomes how many bytes the members took that were whole.
    """
    chunks, held, given = source(), b"", 0
    while True:
        while len(held) < 6 and (more := next(chunks, None)) is not None:
            held += more
            given += len(more)
        try:
            if held[:4] == b"\x28\xb5\x2f\xfd":
                yield from _frames(lambda: itertools.chain([held], chunks) if given > len(held) or used is None else source())
                return
            if held[:3] == b"BZh":
                tool = bz2.BZ2Decompressor()
            elif held[:6] == b"\xfd7zXZ\x00":
                tool = lzma.LZMADecompressor(memlimit=1 << 27)
            elif held[:2] == b"\x1f\x8b" or held[:1] == b"\x78" and len(held) > 1 and (held[0] * 256 + held[1]) % 31 == 0:
                tool = zlib.decompressobj(47)
            else:
                return
            feed = held
            while not tool.eof:
                part = tool.decompress(feed, PIECE)
                feed = getattr(tool, "unconsumed_tail", b"")
                if part:
                    yield part
                elif not tool.eof:
                    more = next(chunks, None)
                    if more is None:
                        return  # cut short
                    given += len(more)
                    feed = feed + more
            held = tool.unused_data
            if used is not None:
                used[-1] = given - len(held)
        except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError):
            return


def _frames(source: Source) -> Iterator[bytes]:
    """All zstandard frames; the first alone if noise follows it, which may give parts of it again."""
    for every in (True, False):
        with zstandard.ZstdDecompressor(max_window_size=1 << 27).stream_reader(_File(source()), read_across_frames=every) as tool:
            try:
                while part := tool.read(PIECE):
                    yield part
                return
            except zstandard.ZstdError:
                continue


def _skipped(chunks: Iterator[bytes], n: int) -> Iterator[bytes]:
    """The chunks from the n-th byte on."""
    for chunk in chunks:
        if n < len(chunk):
            yield chunk[n:]
        n = max(0, n - len(chunk))


def _packed_layers(source: Source, span: tuple[int, int], used: list[int] | None = None) -> Iterator[Layer]:
    """Packed data unpacked, in pieces that overlap; those in which nothing can be found are left out.

    Packing scatters a byte over the whole, so the whole is what a find maps to. Packed data that begins in one piece and goes on in the
    next is unpacked from the stream once more, so that no more than a piece is ever held.
    """
    where = lambda a, b: span

    def layer(piece: bytes, at: int, whole: bool) -> Iterator[Layer]:
        if PROMISING.search(piece) or MAGIC.search(piece) or WIDE.search(piece):
            yield _of_bytes(piece, where, None if whole else lambda i: lambda: _skipped(_unpacked(source), at + i))

    held, at = b"", 0
    for part in _unpacked(source, used):
        held += part
        while len(held) > PIECE:
            yield from layer(held[:PIECE], at, False)
            held = held[PIECE - OVERLAP :]
            at += PIECE - OVERLAP
    if held:
        yield from layer(held, at, True)


def _inside(layer: Layer) -> Iterator[Layer]:
    """Packed data and text of two bytes a letter that stand anywhere in the bytes of a layer."""
    data, after = layer.data, 0
    for m in MAGIC.finditer(data):
        i = m.start()
        if i >= after:  # not within what has been unpacked
            used = [0]
            source = layer.rest(i) if layer.rest else functools.partial(lambda i: iter([data[i:]]), i)
            yield from _packed_layers(source, layer.where_data(i, len(data)), used)
            after = i + used[-1]
    for m in WIDE.finditer(data):
        a = m.start()
        text = m[0].decode("utf-16-le" if m[1] else "utf-16-be")
        yield Layer(text, functools.partial(lambda first, x, y: layer.where_data(first + 2 * x, first + 2 * y), a))


def _decode64(core: str) -> bytes:
    core = core[: len(core) - (len(core) % 4 == 1)]
    return base64.b64decode(core.translate({45: 43, 95: 47}) + "=" * (-len(core) % 4))


def _base64(layer: Layer, begin: int, end: int) -> Iterator[Layer]:
    """What the run from begin to end holds.

    The base64 may begin after any /, _, - or line break. A start matters only modulo 4, so the run is decoded from the first start of
    each remainder on, and what stands before or after comes out as noise. Pieces whose last letters are
    no whole group are decoded by themselves too, as they may end without padding. Three bytes stand for four letters: where a find comes from follows from that.
    """
    run = layer.text[begin:end]
    if "\n" in run:
        at: list[int] | range = [i for i in range(begin, end) if layer.text[i] not in " \t\r\n="]
        core = "".join([layer.text[i] for i in at])
        breaks = [i for i in range(1, len(core)) if at[i] > at[i - 1] + 1]
    else:
        core = run.rstrip("=")
        at, breaks = range(begin, begin + len(core)), []
    starts: dict[int, int] = {}
    for a in sorted({0, *breaks, *(m.end() for m in BORDER.finditer(core) if m.end() < len(core))}):
        starts.setdefault(a % 4, a)
    spans = [(a, len(core)) for a in starts.values()]
    if len(starts) > 1 or breaks or BORDER.search(core):
        spans += [m.span() for m in PIECES.finditer(core) if m.end() - m.start() >= 16 and m.end() < len(core) and (m.end() - m.start()) % 4 > 1]

    def where(a: int, b: int, x: int, y: int) -> tuple[int, int]:
        j = min(a + 4 * ((y - 1) // 3) + 4, b)
        padded = j == len(core) and (j - a) % 4
        return layer.where(at[a + 4 * (x // 3)], end if padded else at[j - 1] + 1)

    for a, b in spans:
        data = _decode64(core[a:b])
        if PROMISING.search(data) or MAGIC.search(data) or WIDE.search(data):
            yield _of_bytes(data, functools.partial(where, a, b))


def _octet(m: re.Match) -> str:
    """The character of the value that an escape in a literal stands for."""
    return chr(int(m[1], 16)) if m[1] else chr(SHORT[m[2]]) if m[2] in SHORT else m[2]


def _escaped_data(layer: Layer) -> Iterator[Layer]:
    """What compressed data unpacks to whose bytes are escaped one by one, or stand as they are where they are letters."""
    text = layer.text
    if "%" in text:
        near = sorted({i for m in FIRST_PERCENT.finditer(text) for i in range(max(0, m.start() - 2), m.start() + 1)})
        for m in filter(None, map(functools.partial(PACKED_PERCENT.match, text), near)):
            run = OCTETS_PERCENT.match(text, m.start())
            if run and "%" in run[0]:
                data = re.sub(rb"%([0-9A-Fa-f]{2})", lambda x: bytes([int(x[1], 16)]), run[0].replace("+", " ").encode("latin-1"))
                yield from _packed_layers(functools.partial(lambda d: iter([d]), data), layer.where(*run.span()))
    if "\\x" in text:
        for m in PACKED_LITERAL.finditer(text):
            quote = text[m.start() - 1] if m.start() and text[m.start() - 1] in "'\"" else ""
            run = OCTETS_LITERAL[quote].match(text, m.start())
            if run and "\\x" in run[0]:
                data = re.sub(r"\\x([0-9A-Fa-f]{2})|\\(.)", _octet, run[0]).encode("latin-1", "replace")
                yield from _packed_layers(functools.partial(lambda d: iter([d]), data), layer.where(*run.span()))


def unwrap(layer: Layer) -> Iterator[Layer]:
    """The layers right below this one."""
    for mark, runs, decode in (("%", PERCENT, _percent), ("\\", ESCAPES, _escaped)):
        if mark in layer.text and runs.search(layer.text):
            yield _replaced(layer, runs, decode)
    if layer.data is not None:
        yield from _inside(layer)
    yield from _escaped_data(layer)
    for pattern in (BASE64, WRAPPED):
        for m in pattern.finditer(layer.text):
            yield from _base64(layer, m.start(), m.end())


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The spans in the text itself, and all spans: those and the ones of decoded layers, sorted by start, then kind."""
    order = lambda s: (s[1], ORDER[s[0]], s[2])
    base = sorted(matches(text), key=order)
    work, seen, more = [unwrap(Layer(text, lambda a, b: (a, b)))], set(), set()
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
        elif layer.text:
            n, where = (len(layer.text), layer.where) if layer.data is None else (len(layer.data), layer.where_data)
            origin = (hash(layer.text), n, *where(0, 1), where(n - 1, n)[1])
            if origin not in seen:
                seen.add(origin)
                more |= {(kind, *layer.where(a, b)) for kind, a, b in matches(layer.text)}
                work.append(unwrap(layer))
    return base, sorted({*base, *more}, key=order)


def _listed(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in found)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): arrays of (kind, start, end) in code points of the text, end exclusive, sorted by start, then kind.

    base has the matches in the text itself; spans has those and what decoded layers hold, mapped back to the encoded part that
    they come from. Null text counts as empty: both arrays are empty. Each row is scanned by itself, so ids may be null or
    repeat. Empty table: empty result. Extra columns are ignored.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    one = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in by_bytes(batches, 1):
            both = [scan(text or "") for text in batch.column(1).to_pylist()]
            lists = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x[i]] for x in both], one) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], ["id", "base", "spans"])

    span = "array<struct<kind: string, start: long, end: long>>"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, base {span}, spans {span}")


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """docs with each stretch of secret spans in the text replaced by the mask; all rows and columns stay, null texts too."""
    prepare(docs.sparkSession)
    at = docs.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        out, last = [], 0
        for _, a, b in scan(text)[1]:
            if a >= last:
                out += [text[last:a], mask]
            last = max(last, b)
        return "".join([*out, text[last:]]) if out else text

    def run(batches):
        for batch in by_bytes(batches, at):
            texts = pa.array([clean(x) for x in batch.column(at).to_pylist()], pa.string())
            yield batch.set_column(at, batch.schema.names[at], texts)

    return docs.mapInArrow(run, docs.schema)


def op7_secrets(spark, sf_dir: str) -> DataFrame:
    """The secrets in all documents."""
    out = find_secrets(tuned(spark).read.parquet(f"{sf_dir}/documents.parquet"))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select(
        F.col("id").alias("doc_id"), *map(count, KINDS), F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans")
    )
