"""Substring dedup: paragraphs that repeat, exactly or nearly, across documents.

A paragraph is a line. It is also cut into units, sentences of at least five words. Their
five-word shingles are min-hashed, and those whose hashes agree throughout a band share a
key. Keys tie them into loose clusters; within each, exact Jaccard similarities are
computed and only pairs that reach the threshold are linked. Components of these links,
with exact copies counted once, are the classes; of each class the first occurrence
stays. A repeated line of MIN_LINE words or more counts on its own; shorter ones and
units do in a run of repeated ones of MIN_RUN words, be they exact copies or near ones.
A stock phrase on its own is left alone.

Passages keep neither to lines nor to sentences. So every window of PASSAGE words that
occurs twice is found as well, whatever stops are in it: of each window the least hash
of its GRAM-word grams is its anchor, and windows whose anchor occurs twice are
compared by a hash of all their words. A passage is what such windows cover.

Rows are told apart by keys of their own, which sort as doc_ids do: rows that share
a doc_id, or have none, get their text's hash and a number written once after it.
Inside, doc_id is that key.

A large cluster is first compared with its most copied member. What is similar to it
needs no more comparing among itself; the rest is compared with all in blocks.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from .components import connected_components
from .tables import discard, partitions, staged

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.99
ROWS = 4
# Words that are a passage wherever they start and end.
PASSAGE = 50
# Words of an anchor: any two equal windows of PASSAGE words share theirs.
GRAM = 20
# Words of consecutive repeated units.
MIN_RUN = 35
# Words of a repeated line that counts on its own.
MIN_LINE = 15
MIN_UNIT = 5
# A unit of fewer words has no other at the threshold: four of five shingles are eight words.
NEAR_UNIT = 8
# Hashes a band of units: there are many units, so fewer and shorter bands of the same recall.
NEAR_ROWS = 3
BLOCK = 512
SEED = 20240101
# Words hashed together at least; texts are processed whole.
CHUNK_WORDS = 50_000
# Digests of which a worker remembers that it has given their keys.
KNOWN_PIDS = 500_000
# Distinct shingles of a block that are multiplied at a time.
COLUMNS = 4096
# Sets of a block that are compared one by one.
FEW = 8
# Pairs of key and digest that are sorted at a time.
HELD_PAIRS = 1 << 20
# Ranges of keys for each shuffle partition: one range is held in memory.
BUCKETS = 16
# Shares of the ranges that are shuffled one after the other.
TURNS = 2

BLANKS = re.compile(r"\s*")
# White space beyond ASCII, and which bytes of UTF-8 are white space.
WIDE_WHITE = tuple(chr(c) for c in range(0x80, 0x3001) if chr(c).isspace())
WHITE_BYTES = np.array([c < 128 and chr(c).isspace() for c in range(256)])
TOKEN = re.compile(r"\S+")
# Scripts written without spaces, and the stops that end a sentence without one.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9d\U00020000-\U0003ffff"
STOPS = "\u3002\uff01\uff1f"
SENTENCE_END = re.compile(rf"[.!?](?=\s)|[{STOPS}]")
OF_UNSPACED = re.compile(f"[{UNSPACED}{STOPS}]")
PIECE = re.compile(f"[{UNSPACED}{STOPS}]|[^{UNSPACED}{STOPS}]+")
# A string without white space of more code points is as many words as code points.
LONG_TOKEN = 200

# A row per document; units and lines are numbered from 0. Of each unit its number of words, place in words, whether
# it is all of its line, and digest; of each line of several units the first one, how many they are and the line's
# digest; of each stretch of windows with one anchor the anchor, its first window, how many they are, and a hash of
# all their words. Rows between them have no document but band keys of units and lines: a range of keys by number
# (below 0: none) and pairs, the keys and then as many digests, or links (below 0), as many digests and others.
DOCUMENTS = pa.schema(
    {
        "doc_id": pa.binary(),
        **dict.fromkeys(("words", "ats"), pa.list_(pa.int32())),
        "alone": pa.list_(pa.bool_()),
        "uids": pa.list_(pa.int64()),
        **dict.fromkeys(("line_units", "line_counts"), pa.list_(pa.int32())),
        **dict.fromkeys(("line_pids", "anchors", "spans"), pa.list_(pa.int64())),
        **dict.fromkeys(("firsts", "counts"), pa.list_(pa.int32())),
        "bucket": pa.int32(),
        "pairs": pa.binary(),
    }
)


FOUND = pa.schema(
    [
        ("cluster", pa.int64()), ("pid", pa.int64()), ("copies", pa.int64()), ("shingles", pa.binary()),
        ("hash", pa.int64()), ("span", pa.int64()), ("doc_id", pa.binary()), ("pos", pa.int32()), ("k", pa.int32()),
    ]
)
FOUND_DDL = "cluster bigint, pid bigint, copies bigint, shingles binary, hash bigint, span bigint, doc_id binary, pos int, k int"
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
PAIRS = pa.schema([("bucket", pa.int32()), ("pairs", pa.binary())])
PARTS = pa.schema(
    [
        ("doc_id", pa.binary()), *((c, pa.int32()) for c in ("para", "unit", "start", "length", "words")),
        ("kept_doc_id", pa.binary()), ("removed", pa.bool_()),
    ]
)


def tune_bands(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands of ``rows`` hashes after which a pair at the threshold shares a key with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))


@cache
def hash_functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    draw = random.integers(0, 1 << 63, size=(2, count), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def _is_plain(word: str) -> bool:
    return len(word) <= LONG_TOKEN and (word.isascii() or not OF_UNSPACED.search(word))


def is_plain(text: str, words: list[str]) -> bool:
    """Whether each of ``words``, which ``text`` has between white space, is one word indeed."""
    return (text.isascii() or not OF_UNSPACED.search(text)) and max(map(len, words), default=0) <= LONG_TOKEN


def _rotated(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


# The primes of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _xxh64(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """XXH64 of the ``size`` bytes (fewer than 32) from each start; seven more follow the last."""
    eights = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
    out = np.full(len(starts), P5 + np.uint64(size), dtype=np.uint64)
    at = 0
    while at < size:
        lane = eights[starts + at]
        if size - at >= 8:
            out = _rotated(out ^ (_rotated(lane * P2, 31) * P1), 27) * P1 + P4
            at += 8
            continue
        if size - at >= 4:
            out = _rotated(out ^ ((lane & np.uint64(0xFFFFFFFF)) * P1), 23) * P2 + P3
            lane = lane >> np.uint64(32)
            at += 4
        while at < size:
            out = _rotated(out ^ ((lane & np.uint64(0xFF)) * P5), 11) * P1
            lane = lane >> np.uint64(8)
            at += 1
    out = (out ^ (out >> np.uint64(33))) * P2
    out = (out ^ (out >> np.uint64(29))) * P3
    return out ^ (out >> np.uint64(32))


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH64 of the bytes from each start to its end; those of one length are hashed together."""
    import xxhash

    out = np.empty(len(starts), dtype=np.uint64)
    for lo in range(0, len(starts), CHUNK_WORDS):
        some, sizes = starts[lo : lo + CHUNK_WORDS], (ends - starts)[lo : lo + CHUNK_WORDS]
        first = int(some[0])
        part = np.concatenate((data[first : int(ends[lo + len(some) - 1])], np.zeros(7, dtype=np.uint8)))
        order = np.argsort(np.minimum(sizes, 32).astype(np.uint8), kind="stable")
        some, sizes = some[order] - first, sizes[order]
        cuts = np.searchsorted(np.minimum(sizes, 32), np.arange(33))
        found = np.empty(len(some), dtype=np.uint64)
        for size in range(1, 32):
            a, b = cuts[size], cuts[size + 1]
            if a < b:
                found[a:b] = _xxh64(part, some[a:b], size)
        for k in range(int(cuts[32]), len(some)):
            found[k] = xxhash.xxh64_intdigest(part[some[k] : some[k] + sizes[k]].tobytes())
        out[lo + order] = found
    return out


def byte_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words between white space start and end in bytes of ``lowered`` texts."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    np.logical_not(WHITE_BYTES[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def lowered(text: str) -> bytes:
    """The lower-case text in UTF-8, its white space in ASCII; line ends stay."""
    low = text.lower()
    if not low.isascii():
        for c in WIDE_WHITE:
            if c in low:
                low = low.replace(c, " ")
    return low.encode()


def word_hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer("\n".join(words).encode(), dtype=np.uint8)
    return byte_hashes(data, *byte_spans(data))


class Words:
    """The words between white space of some texts: their hashes, and the texts' numbers of words."""

    def __init__(self, texts: list[str | None]) -> None:
        parts = [lowered(t) if t else b"" for t in texts]
        self.data = np.frombuffer(b"\n".join(parts), dtype=np.uint8)
        self.starts, self.ends = byte_spans(self.data)
        stops = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1)
        self.until = np.searchsorted(self.starts, stops)
        self.sizes = np.diff(self.until, prepend=0)

    def long(self) -> np.ndarray:
        """Which texts have a word of more than LONG_TOKEN code points."""
        out = np.zeros(len(self.sizes), dtype=bool)
        for k in np.flatnonzero(self.ends - self.starts > LONG_TOKEN).tolist():
            word = self.data[self.starts[k] : self.ends[k]]
            if np.count_nonzero((word & 0xC0) != 0x80) > LONG_TOKEN:
                out[np.searchsorted(self.until, k, "right")] = True
        return out

    def hashes(self) -> np.ndarray:
        return byte_hashes(self.data, self.starts, self.ends)

    def cuts(self) -> tuple[np.ndarray, np.ndarray]:
        last = self.data[self.ends - 1]
        return cuts_of(self.starts, np.flatnonzero(self.data == 10), (last == 46) | (last == 33) | (last == 63))


def cuts_of(starts: np.ndarray, breaks: np.ndarray, stops: np.ndarray, least: int = MIN_UNIT) -> tuple[np.ndarray, np.ndarray]:
    """The words that lines and units (as ``units_of``) begin with. Words start at ``starts``, lines end at ``breaks``,
    sentences after words that are ``stops``."""
    n = len(starts)
    of_line = np.zeros(n + 1, dtype=bool)
    of_line[np.searchsorted(starts, breaks)] = True
    of_line[0] = True
    begins = of_line.copy()
    begins[1:] |= stops
    begins, of_line = np.flatnonzero(begins[:n]), of_line[:n]
    chosen, held = [], 0
    sizes = np.diff(begins, append=n)
    for at, size, first in zip(begins.tolist(), sizes.tolist(), of_line[begins].tolist(), strict=True):
        if first or held >= least:
            chosen.append(at)
            held = size
        else:
            held += size
    return np.flatnonzero(of_line), np.array(chosen, dtype=np.int64)


def _wide(text: str | None) -> bool:
    """Whether a text has code points of scripts without spaces."""
    return text is not None and not text.isascii() and OF_UNSPACED.search(text) is not None


def plain_and_others(texts: list[str | None]) -> tuple[list[int], Words, list[int]]:
    """Texts (by place) all of whose words are between white space, these words, and the other texts."""
    others = {k for k, text in enumerate(texts) if _wide(text)}
    plain = [k for k in range(len(texts)) if k not in others]
    words = Words([texts[k] for k in plain])
    long = words.long()
    if long.any():
        others |= {plain[k] for k in np.flatnonzero(long).tolist()}
        plain = [k for k in plain if k not in others]
        words = Words([texts[k] for k in plain])
    return plain, words, sorted(others)


def token_spans(text: str) -> list[tuple[int, int]]:
    """Where words are: between white space, but single code points of scripts without it and of endless strings."""
    out = []
    for m in TOKEN.finditer(text):
        if _is_plain(m[0]):
            out.append(m.span())
            continue
        for p in PIECE.finditer(m[0]):
            at, end = m.start() + p.start(), m.start() + p.end()
            out += [(k, k + 1) for k in range(at, end)] if end - at > LONG_TOKEN else [(at, end)]
    return out


@cache
def _white() -> np.ndarray:
    """Which of the code points that hold all white space is."""
    return np.array([chr(c).isspace() for c in range(0x3002)])


def plain_spans(text: str) -> np.ndarray:
    """Where words between white space are."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    white = _white()
    inside = np.concatenate(([False], ~white[np.minimum(codes, len(white) - 1)], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges.reshape(-1, 2)


def split_words(text: str) -> list[str]:
    return text.lower().split()


def cut_words(text: str) -> list[str]:
    return [text[a:b].lower() for a, b in token_spans(text)]


def text_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' words, one text after the other, and the texts' numbers of words."""
    plain, words, others = plain_and_others(texts)
    if not others:
        return words.hashes(), words.sizes
    parts = [np.empty(0, dtype=np.uint64)] * len(texts)
    hashes = words.hashes()
    for k, end, size in zip(plain, words.until.tolist(), words.sizes.tolist(), strict=True):
        parts[k] = hashes[end - size : end]
    for k in others:
        parts[k] = word_hashes(cut_words(texts[k]))
    return np.concatenate(parts), np.array([len(x) for x in parts])


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingle_hashes(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hashes of the windows of ``width`` words; none where there are fewer."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = _mix(out + words[k : k + n])
    return out


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse there."""
    base = 0x9E3779B97F4A7C15
    out = []
    for x in (base, pow(base, -1, 1 << 64)):
        factors = np.full(size, x, dtype=np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors, dtype=np.uint64))
    return out[0], out[1]


def _sums(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of the words times powers, and the inverse powers."""
    powers, inverse = _powers(1 << max(0, len(words) - 1).bit_length())
    return np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_mix(words) * powers[: len(words)], dtype=np.uint64))), inverse


def span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the words from each start to its end, wherever they stand."""
    sums, inverse = _sums(words)
    return _mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """``shingle_hashes`` for wide windows: differences of running sums."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    sums, inverse = _sums(words)
    return _mix((sums[width:] - sums[:n]) * inverse[:n])


def anchors_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a text's grams, and for each window of PASSAGE words the place of its least gram, the first if several."""
    grams = window_hashes(words, GRAM)
    width = PASSAGE - GRAM + 1
    n = len(grams) - width + 1
    if n <= 0:
        return grams, np.empty(0, dtype=np.int64)
    least, at, span = grams, np.arange(len(grams)), 1

    def joined(step: int) -> tuple[np.ndarray, np.ndarray]:
        left = least[:-step] <= least[step:]
        return np.where(left, least[:-step], least[step:]), np.where(left, at[:-step], at[step:])

    while 2 * span <= width:
        least, at = joined(span)
        span *= 2
    if span < width:
        least, at = joined(width - span)
    return grams, at


def lines_of(text: str | None) -> Iterator[tuple[int, int, str]]:
    """(number, start in code points, line) of each line with a word."""
    start = 0
    for k, line in enumerate((text or "").split("\n")):
        if line and not line.isspace():
            yield k, start, line
        start += len(line) + 1


def units_of(line: str, split: Callable[[str], list[str]] = cut_words, least: int = MIN_UNIT) -> list[tuple[int, int, list[str]]]:
    """(start, end, lower-case words) of the units of a line; the last may be short."""
    out, held, first, at = [], [], 0, 0
    ends = [m.end() for m in SENTENCE_END.finditer(line)]
    for end in [*ends, len(line)]:
        part = line[at:end]
        words = split(part)
        if words:
            if not held:
                first = at + len(part) - len(part.lstrip())
            held = held + words if held else words
            if len(held) >= least:
                out.append((first, at + len(part.rstrip()), held))
                held = []
        at = end
    if held:
        out.append((first, len(line.rstrip()), held))
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def digests(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A digest for each of the texts that ``words`` are, one after the other, of ``sizes`` words (one at least)."""
    if not len(sizes):
        return np.empty(0, dtype=np.uint64)
    begins = np.cumsum(sizes) - sizes
    place = (np.arange(len(words)) - np.repeat(begins, sizes)).astype(np.uint64)
    parts = _mix(words + _mix(place * np.uint64(0xD1342543DE82EF95) + np.uint64(1)))
    return _mix(np.add.reduceat(parts, begins) + sizes.astype(np.uint64))


def band_keys(shingles: np.ndarray, cuts: np.ndarray, bands: int, rows: int, salt: int = 0) -> np.ndarray:
    """Keys (text, band) of texts whose shingles begin at ``cuts``."""
    keys = np.zeros((len(cuts), bands), dtype=np.uint64)
    if len(cuts):
        factors, offsets = hash_functions(bands * rows)
        for b in range(bands):
            key = np.full(len(cuts), b + 1 + salt, dtype=np.uint64)
            for k in range(b * rows, (b + 1) * rows):
                key = _mix(key + np.minimum.reduceat((shingles ^ offsets[k]) * factors[k], cuts))
            keys[:, b] = key
    return keys


def _keys_of(shingles: np.ndarray, sizes: np.ndarray, wanted: np.ndarray, bands: int, rows: int, salt: int) -> np.ndarray:
    """Keys of the ``wanted`` (SHINGLE words or more) of texts of ``sizes`` words, one after the other, whose ``shingles`` these are."""
    begins = np.cumsum(sizes) - sizes
    counts = sizes[wanted] - SHINGLE + 1
    starts = np.repeat(begins[wanted] - (np.cumsum(counts) - counts), counts)
    return band_keys(shingles[starts + np.arange(counts.sum())], np.cumsum(counts) - counts, bands, rows, salt)


def _lists(of: np.ndarray, count: int, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list per document of the ``values`` that are ``of`` it (ascending)."""
    offsets = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=count))))
    return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.array(values, type=kind))


def combined(keys: np.ndarray, pids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each key once, with one of its pids; and links (two rows) of the other pids of a key to that one."""
    order = np.argsort(keys)
    keys, pids = keys[order], pids[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    heads = pids[new]
    firsts = heads[np.cumsum(new) - 1]
    other = pids != firsts
    return keys[new], heads, np.stack((pids[other], firsts[other]))


class Pairs:
    """Rows of PAIRS for keys and pids: as they become many, they are sorted and cut into ``buckets`` ranges of keys."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.held, self.size = buckets, [], 0

    def add(self, keys: np.ndarray, pids: np.ndarray) -> None:
        self.held.append((keys, pids))
        self.size += len(keys)

    def rows(self) -> pa.RecordBatch:
        keys, pids, links = combined(*(np.concatenate(x) for x in zip(*self.held, strict=True)))
        self.held, self.size = [], 0
        bucket = ((keys >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)
        cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        ends = [*cuts[1:].tolist(), len(keys)]
        numbers = bucket[cuts].astype(np.int32).tolist()
        blobs = [keys[a:b].tobytes() + pids[a:b].tobytes() for a, b in zip(cuts.tolist(), ends, strict=True)]
        for lo in range(0, links.shape[1], CHUNK_WORDS):
            numbers.append(-1)
            blobs.append(links[:, lo : lo + CHUNK_WORDS].tobytes())
        return pa.record_batch([pa.array(numbers, type=pa.int32()), pa.array(blobs, type=pa.binary())], schema=PAIRS)


class Documents:
    """Rows of DOCUMENTS for (doc_id, text) pairs, hashed together; each worker gives the keys of a digest once or a few times."""

    def __init__(self, bands: int, near_bands: int, rows: int = ROWS, buckets: int = BUCKETS) -> None:
        self.bands, self.near_bands, self.rows = bands, near_bands, rows
        self.given: set[int] = set()
        self.pairs = Pairs(buckets)

    def _fresh(self, pids: np.ndarray) -> np.ndarray:
        if len(self.given) > KNOWN_PIDS:
            self.given.clear()
        given, out = self.given, np.zeros(len(pids), dtype=bool)
        for k, pid in enumerate(pids.tolist()):
            if pid not in given:
                given.add(pid)
                out[k] = True
        return out

    def batch(self, texts: list[tuple[bytes, str | None]]) -> Iterator[pa.RecordBatch]:
        plain, words, others = plain_and_others([text for _, text in texts])
        if plain:
            line_at, unit_at = words.cuts() if len(words.starts) else (np.empty(0, dtype=np.int64),) * 2
            total = len(words.starts)
            units = np.stack((np.searchsorted(words.until, unit_at, "right"), np.diff(unit_at, append=total)))
            first = np.searchsorted(unit_at, line_at)
            of_line = np.searchsorted(words.until, line_at, "right")
            before = np.searchsorted(units[0], np.arange(len(plain)))[of_line]
            lines = np.stack((of_line, first - before, np.diff(first, append=len(unit_at)), np.diff(line_at, append=total)))
            yield self._arrow([texts[k][0] for k in plain], words.hashes(), units, lines)
        if others:
            found, units, lines = self._cut([texts[k][1] for k in others])
            yield self._arrow([texts[k][0] for k in others], word_hashes(found), units, lines)
        if self.pairs.size > HELD_PAIRS:
            yield self.rest()

    def rest(self) -> pa.RecordBatch:
        """Rows without a document: the pairs that are held."""
        rows = self.pairs.rows()
        empty = [pa.nulls(len(rows), f.type) for f in list(DOCUMENTS)[: -len(PAIRS)]]
        return pa.record_batch([*empty, *rows.columns], schema=DOCUMENTS)

    @staticmethod
    def _cut(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """All words; document and words of units; document, first unit, units and words of lines."""
        words, units, lines = [], [], []
        for doc, text in enumerate(texts):
            unit = 0
            for _, _, line in lines_of(text):
                some, size = units_of(line), 0
                for _, _, w in some:
                    units.append((doc, len(w)))
                    words += w
                    size += len(w)
                lines.append((doc, unit, len(some), size))
                unit += len(some)
        return words, *(np.array(x, dtype=np.int64).reshape(-1, n).T for x, n in ((units, 2), (lines, 4)))

    def _arrow(self, doc_ids: list[bytes], hashes: np.ndarray, units: np.ndarray, lines: np.ndarray) -> pa.RecordBatch:
        n, (of_units, sizes), (of_line, first_units, unit_counts, line_sizes) = len(doc_ids), units, lines
        uids, pids = digests(hashes, sizes), digests(hashes, line_sizes)
        # A line of one unit is compared as this unit.
        several = unit_counts > 1
        near = np.flatnonzero(sizes >= NEAR_UNIT)
        near = near[self._fresh(uids[near])]
        long = np.flatnonzero(several & (line_sizes >= SHINGLE))
        long = long[self._fresh(pids[long])]
        shingles = shingle_hashes(hashes)
        unit_keys = _keys_of(shingles, sizes, near, self.near_bands, NEAR_ROWS, 1 << 20)
        line_keys = _keys_of(shingles, line_sizes, long, self.bands, self.rows, 0)
        self.pairs.add(unit_keys.ravel(), np.repeat(uids[near], self.near_bands))
        self.pairs.add(line_keys.ravel(), np.repeat(pids[long], self.bands))
        doc_sizes = np.bincount(of_line, line_sizes, n).astype(np.int64)
        ats = np.cumsum(sizes) - sizes - (np.cumsum(doc_sizes) - doc_sizes)[of_units]
        alone = np.repeat(~several, unit_counts)
        anchors, spans, firsts, counts, anchor_docs = self._anchors(hashes, doc_sizes)
        of_lines = of_line[several]
        i32, i64 = pa.int32(), pa.int64()
        columns = [
            pa.array(doc_ids, type=pa.binary()),
            _lists(of_units, n, sizes, i32),
            _lists(of_units, n, ats, i32),
            _lists(of_units, n, alone, pa.bool_()),
            _lists(of_units, n, _signed(uids), i64),
            _lists(of_lines, n, first_units[several], i32),
            _lists(of_lines, n, unit_counts[several], i32),
            _lists(of_lines, n, _signed(pids[several]), i64),
            _lists(anchor_docs, n, _signed(anchors), i64),
            _lists(anchor_docs, n, _signed(spans), i64),
            _lists(anchor_docs, n, firsts, i32),
            _lists(anchor_docs, n, counts, i32),
            *[pa.nulls(n, f.type) for f in PAIRS],
        ]
        return pa.record_batch(columns, schema=DOCUMENTS)

    @staticmethod
    def _anchors(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each stretch of windows with one anchor its anchor, hash, first place, windows and document."""
        grams, at = anchors_of(hashes)
        begins = np.cumsum(sizes) - sizes
        doc = np.repeat(np.arange(len(sizes)), sizes)
        start = np.arange(len(at))
        start = start[start + PASSAGE <= (begins + sizes)[doc[: len(at)]]]
        at, doc = at[start], doc[start]
        new = np.ones(len(start), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
        heads = np.flatnonzero(new)
        counts = np.diff(np.append(heads, len(start)))
        first, doc = start[heads], doc[heads]
        spans = span_hashes(hashes, first, first + counts - 1 + PASSAGE) if len(first) else np.empty(0, dtype=np.uint64)
        return grams[at[heads]], spans, first - begins[doc], counts, doc


def _structs(column: pa.ListArray) -> tuple[np.ndarray, pa.StructArray]:
    """The structs in all lists, and the lists' numbers."""
    return np.repeat(np.arange(len(column)), column.value_lengths().fill_null(0).to_numpy()), column.flatten()


def _field(values: pa.StructArray, name: str) -> np.ndarray:
    return values.field(name).to_numpy(zero_copy_only=False)


def _chunks(doc_ids: list[bytes], texts: list[str | None]) -> Iterator[list[tuple[bytes, str | None]]]:
    held, size = [], 0
    for doc_id, text in zip(doc_ids, texts, strict=True):
        held.append((doc_id, text))
        size += len(text or "")
        if size > 6 * CHUNK_WORDS:
            yield held
            held, size = [], 0
    if held:
        yield held


def occurrences(docs: DataFrame, bands: int, near_bands: int, rows: int = ROWS) -> DataFrame:
    """Rows of DOCUMENTS for each of ``docs`` (doc_id, text) and for their band keys."""
    buckets = BUCKETS * partitions(docs.sparkSession)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Documents(bands, near_bands, rows, buckets)
        for batch in batches:
            for chunk in _chunks(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from made.batch(chunk)
        if made.pairs.size:
            yield made.rest()

    return docs.select("doc_id", "text").mapInArrow(hashed, from_arrow_schema(DOCUMENTS))


# --- exact similarity -------------------------------------------------------


def _shared(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of each set with each other set (arrays without repeats)."""
    left, right = np.concatenate(sets), np.concatenate(others)
    common = np.intersect1d(left, right)
    out = np.zeros((len(sets), len(others)), dtype=np.float32)

    def places(group: list[np.ndarray], all_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        owner = np.repeat(np.arange(len(group)), [len(s) for s in group])
        at = np.searchsorted(common, all_of)
        at[at == len(common)] = 0
        held = common[at] == all_of if len(common) else np.zeros(len(all_of), dtype=bool)
        return owner[held], at[held]

    (a_row, a_at), (b_row, b_at) = places(sets, left), places(others, right)
    for lo in range(0, len(common), COLUMNS):
        parts = []
        for row, at, n in ((a_row, a_at, len(sets)), (b_row, b_at, len(others))):
            some = (at >= lo) & (at < lo + COLUMNS)
            part = np.zeros((n, min(COLUMNS, len(common) - lo)), dtype=np.float32)
            part[row[some], at[some] - lo] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out


def similar(sets: list[np.ndarray], others: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs have a Jaccard similarity of ``threshold`` or more."""
    both = _shared(sets, others).astype(np.float64)
    sizes, other_sizes = np.array([len(s) for s in sets]), np.array([len(s) for s in others])
    return both >= threshold * (sizes[:, None] + other_sizes[None, :] - both) - 1e-9


def spanning_links(ids: list[int], near: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the symmetric matrix ``near`` connects, one per id at most."""
    left, links = np.ones(len(ids), dtype=bool), []
    for root in range(len(ids)):
        queue = [root] if left[root] else []
        left[root] = False
        while queue:
            at = queue.pop()
            for b in np.flatnonzero(near[at] & left).tolist():
                left[b] = False
                links.append((ids[at], ids[b]))
                queue.append(b)
    return links


def block_links(ids: list[int], sets: list[np.ndarray], first: list[bool], threshold: float) -> list[tuple[int, int]]:
    """Links within a block (all ``first``), or between its first part and the rest."""
    a = [k for k, f in enumerate(first) if f]
    b = [k for k, f in enumerate(first) if not f]
    if not a or len(ids) < 2:
        return []
    near = np.zeros((len(ids), len(ids)), dtype=bool)
    if len(ids) <= FEW:
        few = [set(s.tolist()) for s in sets]
        for x in a:
            for y in b or a:
                both = len(few[x] & few[y])
                near[x, y] = both >= threshold * (len(few[x]) + len(few[y]) - both) - 1e-9
    elif b:
        near[np.ix_(a, b)] = similar([sets[k] for k in a], [sets[k] for k in b], threshold)
    else:
        near[np.ix_(a, a)] = similar([sets[k] for k in a], [sets[k] for k in a], threshold)
    return spanning_links(ids, near | near.T)


def link_rows(links: np.ndarray) -> pa.RecordBatch:
    """Rows of LINKS for links in two rows."""
    return pa.record_batch([pa.array(x, type=pa.int64()) for x in links], schema=LINKS)


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, int, int]]:
    """Whole groups of rows that arrive sorted by ``keys`` (without nulls): a table, and from where to where in it."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = (table if rest is None else pa.concat_tables([rest, table])).combine_chunks()
        new = np.ones(table.num_rows, dtype=bool)
        new[1:] = False
        for c in keys:
            values = table.column(c).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        cuts = np.flatnonzero(new).tolist()
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            yield table, lo, hi
        rest = table.slice(cuts[-1])
    if rest is not None:
        yield rest, 0, rest.num_rows


def _blocks(rows: int | Column) -> Column:
    return F.ceil(rows / F.lit(BLOCK)).cast("int")


def verified_links(members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``members`` (cluster, pid, copies, shingles; written) -> links a, b.

    Within each cluster, all pairs that reach the threshold are connected by links that do.
    """
    sizes = members.groupBy("cluster").agg(F.count("*").alias("n"), F.max(F.struct("copies", "pid")).alias("most"))
    sizes = staged(sizes.select("cluster", "n", F.col("most.pid").alias("lead")), "cluster-sizes")
    small, large = sizes.where(F.col("n") <= BLOCK), sizes.where(F.col("n") > BLOCK)

    lead = large.join(members, (large["cluster"] == members["cluster"]) & (large["lead"] == members["pid"]))
    lead = staged(lead.select(large["cluster"], "lead", F.col("shingles").alias("lead_shingles")), "leads")

    def against_lead(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [np.frombuffer(x, dtype=np.uint64) for x in batch["shingles"]]
            leads = [np.frombuffer(x, dtype=np.uint64) for x in batch["lead_shingles"]]
            near = [bool(similar([a], [b], threshold)[0, 0]) for a, b in zip(sets, leads, strict=True)]
            yield batch[["cluster", "pid", "lead", "shingles"]].assign(near=near)

    compared = members.join(lead, "cluster").select("cluster", "pid", "lead", "shingles", "lead_shingles")
    compared = staged(
        compared.mapInPandas(against_lead, "cluster bigint, pid bigint, lead bigint, shingles binary, near boolean"),
        "compared",
    )
    to_lead = compared.where(F.col("near") & (F.col("pid") != F.col("lead"))).select(
        F.col("lead").alias("a"), F.col("pid").alias("b")
    )

    # Blocks: i of those far from the lead, j of those near it (numbered after the far ones).
    split = compared.groupBy("cluster").agg(
        _blocks(F.count_if(~F.col("near"))).alias("far_blocks"), _blocks(F.count_if("near")).alias("near_blocks")
    )
    split = staged(split.where("far_blocks > 0"), "blocks")
    dealt = compared.join(split, "cluster")
    own = F.when(F.col("near"), F.col("far_blocks") + F.pmod(F.xxhash64("pid"), "near_blocks")).otherwise(
        F.pmod(F.xxhash64("pid"), "far_blocks")
    )
    dealt = dealt.withColumn("own", own.cast("int"))
    # A near member meets each far block; a far one meets all blocks, each pair of blocks once.
    others = F.when(F.col("near"), F.sequence(F.lit(0), F.col("far_blocks") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("far_blocks") + F.col("near_blocks") - 1)
    )
    paired = dealt.withColumn("other", F.explode(others)).select(
        "cluster",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        "pid",
        "shingles",
        (F.col("own") <= F.col("other")).alias("first"),
    )
    whole = members.join(small.select("cluster"), "cluster").select(
        "cluster", F.lit(0).alias("i"), F.lit(0).alias("j"), "pid", "shingles", F.lit(True).alias("first")
    )
    keys = ["cluster", "i", "j"]

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        seen = pids = shingles = first = None
        for table, lo, hi in _grouped(batches, keys):
            if table is not seen:
                seen, (pids, shingles, first) = table, (table.column(c).to_pylist() for c in ("pid", "shingles", "first"))
            sets = [np.frombuffer(x, dtype=np.uint64) for x in shingles[lo:hi]]
            out += block_links(pids[lo:hi], sets, first[lo:hi], threshold)
            if len(out) > 10_000:
                yield link_rows(np.array(out, dtype=np.int64).T)
                out = []
        if out:
            yield link_rows(np.array(out, dtype=np.int64).T)

    groups = whole.unionAll(paired).repartition(*keys).sortWithinPartitions(*keys)
    return groups.mapInArrow(links, "a bigint, b bigint").unionAll(to_lead)


# --- classes ----------------------------------------------------------------


def pieces_of(lines: DataFrame) -> DataFrame:
    """What is compared: units, and lines of several units. ``lines`` (``occurrences``) -> pid, place (doc_id,
    unit, at: in words), words (of its units), whole (whether it is a line)."""
    each = F.arrays_zip("uids", "ats", "words", "alone")
    units = lines.select("doc_id", F.posexplode(each).alias("unit", "x")).select(
        F.col("x.uids").alias("pid"),
        F.struct("doc_id", "unit", F.col("x.ats").alias("at")).alias("place"),
        F.array("x.words").alias("words"),
        F.col("x.alone").alias("whole"),
    )
    each = F.explode(F.arrays_zip("line_pids", "line_units", "line_counts"))
    several = lines.select("doc_id", "ats", "words", each.alias("x")).select(
        F.col("x.line_pids").alias("pid"),
        F.struct("doc_id", F.col("x.line_units").alias("unit"), F.get("ats", F.col("x.line_units")).alias("at")).alias("place"),
        F.slice("words", F.col("x.line_units") + 1, F.col("x.line_counts")).alias("words"),
        F.lit(True).alias("whole"),
    )
    return units.unionAll(several)


def _size(words: str) -> Column:
    return F.aggregate(words, F.lit(0), lambda a, b: a + b)


def packed_links(packed: DataFrame) -> DataFrame:
    """Rows of PAIRS -> links a, b that connect the pids of each key.

    Ranges of keys are dealt to tasks, and a task holds one at a time; of what it holds, each key
    is kept once, so neither many keys nor many pids of one are too much.
    """
    dealt = packed.where("bucket >= 0").repartition("bucket").sortWithinPartitions("bucket")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, size = None, [], 0

        def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            together = np.concatenate(held, axis=1)
            return combined(together[0], together[1])

        for batch in batches:
            for bucket, pairs in zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True):
                both = np.frombuffer(pairs, dtype=np.int64).reshape(2, -1)
                if bucket < 0:
                    yield link_rows(both)
                    continue
                if held and bucket != at:
                    yield link_rows(joined()[2])
                    held, size = [], 0
                elif size > 4 * HELD_PAIRS:
                    keys, pids, links = joined()
                    yield link_rows(links)
                    held, size = [np.stack((keys, pids))], 0
                at = bucket
                held.append(both)
                size += both.shape[1]
        if held:
            yield link_rows(joined()[2])

    return dealt.unionAll(packed.where("bucket < 0")).mapInArrow(linked, "a bigint, b bigint")


def key_links(keyed: DataFrame) -> DataFrame:
    """``keyed`` (key, pid) -> links a, b that connect the pids of each key."""
    buckets = BUCKETS * partitions(keyed.sparkSession)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = Pairs(buckets)
        for batch in batches:
            pairs.add(batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy().view(np.uint64))
            if pairs.size > HELD_PAIRS:
                yield pairs.rows()
        if pairs.size:
            yield pairs.rows()

    return packed_links(keyed.select("key", "pid").mapInArrow(packed, from_arrow_schema(PAIRS)))


def loose_members(lines: DataFrame, places: DataFrame) -> DataFrame:
    """``lines`` (``occurrences``) -> pid, cluster, place, size, copies of what shares a band key with something else.

    A share of the ranges of keys at a time, so the shuffles of all needn't be kept at once.
    """
    packed = lines.where("bucket IS NOT NULL").select("bucket", "pairs")
    turns = [packed.where(F.pmod("bucket", F.lit(TURNS)) == k) for k in range(TURNS)]
    links = [staged(packed_links(turn), "key-links") for turn in turns]
    clusters = staged(connected_components(reduce(DataFrame.unionAll, links)), "clusters")
    discard(*links)
    found = clusters.join(places, clusters["node"] == places["pid"])
    return staged(found.select("pid", F.col("component").alias("cluster"), "place", "size", "copies"), "members")


def paragraph_classes(shingles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``shingles`` (cluster, pid, copies, shingles; written) -> pid, class, of those in a class of two or more."""
    links = verified_links(shingles, threshold)
    return connected_components(links).select(F.col("node").alias("pid"), F.col("component").alias("class"))


# --- texts ------------------------------------------------------------------


def found_in_texts(docs: DataFrame, members: DataFrame, stretches: DataFrame) -> DataFrame:
    """The shingles of ``members`` and the hashes of the windows of ``stretches`` (span, place: doc_id, first, n;
    copies), in one pass over the texts.

    Rows have either cluster, pid, copies and shingles, or hash, span, copies, doc_id, pos and k, the window's
    number in its stretch.
    """
    wanted = members.groupBy(F.col("place.doc_id").alias("doc_id")).agg(
        F.collect_list(F.struct("place.at", "size", "cluster", "pid", "copies")).alias("wanted")
    )
    places = stretches.groupBy(F.col("place.doc_id").alias("doc_id")).agg(
        F.collect_list(F.struct("place.first", "place.n", "span", "copies")).alias("stretches")
    )
    texts = docs.select("doc_id", "text").join(wanted.join(places, "doc_id", "full"), "doc_id")

    def flat(column: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Of the structs in all lists: the lists' numbers, and each field."""
        of, values = _structs(column)
        return of, {f.name: _field(values, f.name) for f in values.type}

    def of_members(shingles: np.ndarray, at: np.ndarray, asked: dict[str, np.ndarray]) -> pa.RecordBatch:
        ends = at + np.maximum(asked["size"] - SHINGLE + 1, 0)
        sets = [np.unique(shingles[a:b]).tobytes() for a, b in zip(at.tolist(), ends.tolist(), strict=True)]
        named = [pa.array(asked[c], type=pa.int64()) for c in ("cluster", "pid", "copies")]
        empty = [pa.nulls(len(sets), FOUND.field(k).type) for k in range(4, len(FOUND))]
        return pa.record_batch([*named, pa.array(sets, type=pa.binary()), *empty], schema=FOUND)

    def of_windows(every: np.ndarray, doc_ids: pa.Array, docs: np.ndarray, begins: np.ndarray, asked: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lo in range(0, len(docs), CHUNK_WORDS):
            doc, first, n, span, copies = (x[lo : lo + CHUNK_WORDS] for x in (docs, *(asked[c] for c in ("first", "n", "span", "copies"))))
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(first, n) + k
            none, ids = pa.nulls(len(at), pa.int64()), doc_ids.take(pa.array(np.repeat(doc, n)))
            found = pa.array(_signed(every[at + np.repeat(begins[doc], n)]))
            named = [pa.array(np.repeat(x, n), type=pa.int64()) for x in (copies, span)]
            places = [pa.array(x, type=pa.int32()) for x in (at, k)]
            yield pa.record_batch([none, none, named[0], pa.nulls(len(at), pa.binary()), found, named[1], ids, *places], schema=FOUND)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = 0
            for chunk in _chunks([b""] * len(batch), batch.column("text").to_pylist()):
                some = batch.slice(lo, len(chunk))
                lo += len(chunk)
                hashes, sizes = text_hashes([text for _, text in chunk])
                begins = np.cumsum(sizes) - sizes
                docs, asked = flat(some.column("wanted"))
                if len(docs):
                    yield of_members(shingle_hashes(hashes), begins[docs] + asked["at"], asked)
                docs, asked = flat(some.column("stretches"))
                if len(docs):
                    yield from of_windows(window_hashes(hashes, PASSAGE), some.column("doc_id"), docs, begins, asked)

    return staged(texts.mapInArrow(found, FOUND_DDL), "found-in-texts")


# --- windows ----------------------------------------------------------------


def repeated_stretches(lines: DataFrame) -> DataFrame:
    """Stretches of windows whose anchor occurs twice or more: doc_id, first (place in words), n (windows), span (hash)."""
    every = lines.select("doc_id", F.explode(F.arrays_zip("anchors", "spans", "firsts", "counts")).alias("x"))
    often = every.groupBy(F.col("x.anchors").alias("anchor")).agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    often = staged(often, "anchors")
    found = every.join(often, F.col("x.anchors") == F.col("anchor"))
    names = [F.col("x.firsts").alias("first"), F.col("x.counts").alias("n"), F.col("x.spans").alias("span")]
    found = staged(found.select("doc_id", *names), "stretches")
    discard(often)
    return found


def repeated_windows(stretches: DataFrame, windows: DataFrame) -> DataFrame:
    """Ranges of places (in words) where windows of PASSAGE words start that occur twice or more.

    ``windows`` (hash, span, copies, doc_id, pos, k) are those of the first of all equal ``stretches``. Returns
    doc_id, first and last place, kept_doc_id and shift: the windows' first occurrence is
    there, ``shift`` words before that place.
    """
    kept = windows.groupBy("hash").agg(F.min(F.struct("doc_id", "pos")).alias("kept"), F.sum("copies").alias("n"))
    kept = windows.join(kept.where("n > 1").select("hash", "kept"), "hash").select(
        "span", "k", F.col("kept.doc_id").alias("kept_doc_id"), (F.col("k") - F.col("kept.pos")).alias("ahead")
    )
    in_span = Window.partitionBy("span").orderBy("kept_doc_id", "ahead", "k")
    of_span = kept.withColumn("run", F.col("k") - F.row_number().over(in_span)).groupBy("span", "kept_doc_id", "ahead", "run")
    of_span = staged(of_span.agg(F.min("k").alias("from"), F.max("k").alias("to")).drop("run"), "span-ranges")
    found = stretches.join(of_span, "span").select(
        "doc_id",
        "kept_doc_id",
        (F.col("first") + F.col("ahead")).alias("shift"),
        (F.col("first") + F.col("from")).alias("first"),
        (F.col("first") + F.col("to")).alias("last"),
    )
    in_text = Window.partitionBy("doc_id", "kept_doc_id", "shift").orderBy("first")
    new = (F.col("first") > F.lag("last").over(in_text) + 1).cast("int")
    runs = found.withColumn("new", F.coalesce(new, F.lit(0))).withColumn("run", F.sum("new").over(in_text))
    return runs.groupBy("doc_id", "kept_doc_id", "shift", "run").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")


def splitter(text: str) -> Callable[[str], list[str]]:
    """``split_words`` where that is right for ``text``, else ``cut_words``."""
    return split_words if is_plain(text, text.split()) else cut_words


def places_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words are; line and number of words of each unit."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    spans = None if _wide(text) else plain_spans(text)
    if spans is not None and len(spans) and int((spans[:, 1] - spans[:, 0]).max()) <= LONG_TOKEN:
        last, breaks = codes[spans[:, 1] - 1], np.flatnonzero(codes == 10)
        _, units = cuts_of(spans[:, 0], breaks, (last == 46) | (last == 33) | (last == 63))
        return spans, np.searchsorted(breaks, spans[units, 0]), np.diff(units, append=len(spans))
    places = [(para, len(w)) for para, _, line in lines_of(text) for _, _, w in units_of(line, splitter(text))]
    paras, sizes = np.array(places, dtype=np.int64).reshape(-1, 2).T
    return np.array(token_spans(text), dtype=np.int64).reshape(-1, 2), paras, sizes


def range_rows(first: np.ndarray, last: np.ndarray, shift: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of ranges of windows start and end, and whether they go; ``own``: the first ones are in the same text."""
    # The words of the first occurrence stay.
    first = first + np.where(own & (shift > 0) & (shift < PASSAGE), PASSAGE - shift, 0)
    return first, last + PASSAGE, ~(own & (shift == 0))


def _cover(places: tuple, units: tuple, ranges: tuple, names: list[bytes]) -> list[list]:
    """Columns of PARTS but doc_id. ``units``: unit, number of the name kept, whether it goes; ``ranges``: of words, and likewise."""
    spans, paras, sizes = places
    ends = np.cumsum(sizes)
    rows = [np.concatenate(x) for x in zip(((ends - sizes)[units[0]], ends[units[0]], *units[1:]), ranges, strict=True)]
    # 1: first of its kind, 2: to be removed; and the number of the row kept.
    state, kept = np.zeros(len(spans), dtype=np.int8), np.full(len(spans), len(names))
    order = np.lexsort((-rows[2], rows[3]))
    for lo, hi, to, gone in zip(*(x[order].tolist() for x in rows), strict=True):
        state[lo:hi] = 1 + gone
        kept[lo:hi] = to
    unit_of = np.repeat(np.arange(len(sizes)), sizes)
    # Those that go come last, of them the least number.
    cuts = np.concatenate(([0], np.flatnonzero((state[1:] != state[:-1]) | (unit_of[1:] != unit_of[:-1])) + 1))
    last = np.append(cuts[1:], len(spans))
    marked = state[cuts] > 0
    least = np.minimum.reduceat(kept, cuts)[marked].tolist()
    cuts, last = cuts[marked], last[marked]
    unit, start = unit_of[cuts], spans[cuts, 0]
    columns = (paras[unit], unit, start, spans[last - 1, 1] - start, last - cuts)
    return [*(x.tolist() for x in columns), [names[k] for k in least], (state[cuts] == 2).tolist()]


def parts_of(doc_id, text: str, units, ranges) -> Iterator[tuple]:
    """Rows of PARTS: what repeated ``units`` and ``ranges`` of windows cover of a text, cut at units."""
    names = sorted({bytes(x["kept_doc_id"]) for x in (*units, *ranges)})
    number = {name: k for k, name in enumerate(names)}

    def column(rows, value, kind=np.int64) -> np.ndarray:
        return np.array([value(x) for x in rows], dtype=kind)

    def kept(rows) -> np.ndarray:
        return column(rows, lambda x: number[bytes(x["kept_doc_id"])])

    own = kept(ranges) == number.get(bytes(doc_id), -1)
    lo, hi, gone = range_rows(*(column(ranges, lambda x, c=c: x[c]) for c in ("first", "last", "shift")), own)
    of_units = (column(units, lambda x: x["unit"]), kept(units), column(units, lambda x: x["removed"], bool))
    columns = _cover(places_of(text), of_units, (lo, hi, kept(ranges), gone), names)
    yield from zip([doc_id] * len(columns[0]), *columns, strict=True)


def chosen_units(docs: np.ndarray, units: np.ndarray, words: np.ndarray, alone: np.ndarray, kept: np.ndarray, removed: np.ndarray, min_run: int) -> tuple:
    """Document, unit, least name kept and whether it goes, of the marked units that count ``alone`` or are in a run of ``min_run`` words."""
    if not len(docs):
        return docs, units, kept, removed
    order = np.lexsort((kept, units, docs))
    docs, units, words, alone, kept, removed = (x[order] for x in (docs, units, words, alone, kept, removed))
    heads = np.flatnonzero(np.concatenate(([True], (docs[1:] != docs[:-1]) | (units[1:] != units[:-1]))))
    alone, removed = np.logical_or.reduceat(alone, heads), np.logical_or.reduceat(removed, heads)
    docs, units, words, kept = docs[heads], units[heads], words[heads], kept[heads]
    new = np.concatenate(([True], (docs[1:] != docs[:-1]) | (units[1:] != units[:-1] + 1)))
    sums = np.add.reduceat(words, np.flatnonzero(new))
    counts = alone | (sums[np.cumsum(new) - 1] >= min_run)
    return docs[counts], units[counts], kept[counts], removed[counts]


def part_rows(parts: list[list[list]]) -> pa.RecordBatch:
    columns = [[x for part in column for x in part] for column in zip(*parts, strict=True)]
    return pa.record_batch([pa.array(x, type=f.type) for x, f in zip(columns, PARTS, strict=True)], schema=PARTS)


def covered(docs: DataFrame, marked: DataFrame, ranges: DataFrame, min_run: int) -> DataFrame:
    """Rows of PARTS for ``marked`` (doc_id, unit: the first, words: of each unit, alone, kept_doc_id, removed) and ``ranges`` of windows."""
    marked = marked.groupBy("doc_id").agg(F.collect_list(F.struct("unit", "words", "alone", "kept_doc_id", "removed")).alias("units"))
    ranges = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("first", "last", "kept_doc_id", "shift")).alias("ranges"))
    found = staged(marked.join(ranges, "doc_id", "full"), "covered")
    texts = docs.select("doc_id", "text").join(found, "doc_id")

    def numbered(columns: list[pa.Array]) -> tuple[list[bytes], list[np.ndarray]]:
        """All names in order, and the columns as numbers of names."""
        every = pa.chunked_array([c.cast(pa.binary()) for c in columns]).combine_chunks().dictionary_encode()
        names = every.dictionary.to_pylist()
        order = sorted(range(len(names)), key=names.__getitem__)
        ranks = np.empty(len(names), dtype=np.int64)
        ranks[order] = np.arange(len(names))
        cuts = np.cumsum([len(c) for c in columns])[:-1]
        return [names[k] for k in order], np.split(ranks[every.indices.to_numpy(zero_copy_only=False)], cuts)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, of_units = _structs(batch.column("units"))
            of_range, windows = _structs(batch.column("ranges"))
            doc_ids = batch.column("doc_id")
            names, (keys, kept, kept_range) = numbered([doc_ids, of_units.field("kept_doc_id"), windows.field("kept_doc_id")])
            own = kept_range == keys[of_range]
            ranges = (*range_rows(*(_field(windows, c).astype(np.int64) for c in ("first", "last", "shift")), own),)
            ranges = (*ranges[:2], kept_range, ranges[2])
            each, words = _structs(of_units.field("words"))
            sizes = np.bincount(each, minlength=len(doc))
            number = _field(of_units, "unit").astype(np.int64)[each] + np.arange(len(each)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            doc, *units = chosen_units(
                doc[each], number, words.to_numpy().astype(np.int64), _field(of_units, "alone")[each], kept[each], _field(of_units, "removed")[each], min_run
            )
            ends, range_ends = (np.searchsorted(x, np.arange(len(batch)), "right") for x in (doc, of_range))
            held, rows, a, c = [], 0, 0, 0
            for doc_id, text, b, d in zip(doc_ids.to_pylist(), batch.column("text").to_pylist(), ends.tolist(), range_ends.tolist(), strict=True):
                if a < b or c < d:
                    columns = _cover(places_of(text), [x[a:b] for x in units], [x[c:d] for x in ranges], names)
                    held.append([[doc_id] * len(columns[0]), *columns])
                    rows += len(columns[0])
                a, c = b, d
                if rows > 10_000:
                    yield part_rows(held)
                    held, rows = [], 0
            if rows:
                yield part_rows(held)

    return texts.mapInArrow(parts, from_arrow_schema(PARTS))


def repeated_paragraphs(docs: DataFrame, threshold: float = THRESHOLD, min_run: int = MIN_RUN, min_line: int = MIN_LINE) -> DataFrame:
    """What repeats in ``docs`` (doc_id, text), exactly or nearly: windows of PASSAGE words, lines of
    ``min_line`` words or more, and runs of repeated units of ``min_run`` words or more.

    Returns a row per unit, or part of one: doc_id, para (line number), unit (number in the
    document), start and length (code points), words, kept_doc_id (where it stays) and
    removed: true for all but the first, by doc_id and place. Copies within a document count. Case
    and white space make no difference. Null and empty texts have no paragraphs. Each row is a
    document: those of one doc_id come in the order of their texts' hashes, those without last.
    Code points of scripts without spaces, and of strings of more than LONG_TOKEN of them without
    white space, are words each. A text is read whole by one task, a line of any length with
    it. Other columns may have any names; an empty table gives no rows.
    """
    found = _repeated(_told_apart(docs.select("doc_id", "text")), threshold, min_run, min_line)
    return found.withColumns({c: _id_of(F.col(c)) for c in ("doc_id", "kept_doc_id")})


def _repeated(docs: DataFrame, threshold: float, min_run: int, min_line: int) -> DataFrame:
    """Rows of PARTS for ``docs`` (doc_id, a key; text)."""
    bands, near_bands = tune_bands(threshold), tune_bands(threshold, rows=NEAR_ROWS)
    lines = staged(occurrences(docs, bands, near_bands), "documents")
    pieces = staged(pieces_of(lines), "pieces")
    places = pieces.groupBy("pid").agg(F.min(F.struct("place", _size("words").alias("size"))).alias("least"), F.count("*").alias("copies"))
    places = staged(places.select("pid", "least.place", "least.size", "copies"), "places")
    members = loose_members(lines, places)
    stretches = repeated_stretches(lines)
    discard(lines)
    distinct = stretches.groupBy("span").agg(F.min(F.struct("doc_id", "first", "n")).alias("place"), F.count("*").alias("copies"))
    found = found_in_texts(docs, members, distinct)
    shingles = found.where(F.col("shingles").isNotNull()).select("cluster", "pid", "copies", "shingles")
    windows = found.where(F.col("hash").isNotNull()).select("hash", "span", "copies", "doc_id", "pos", "k")
    classes = staged(paragraph_classes(shingles, threshold), "classes")
    ranges = staged(repeated_windows(stretches, windows), "ranges")
    discard(found, stretches)

    # Exact copies stay where their first one is, those nearly alike where the first of their class is.
    near = classes.join(members.select("pid", "place"), "pid")
    kept = near.groupBy("class").agg(F.min("place").alias("near_kept"))
    near = staged(classes.join(kept, "class").select(F.col("pid").alias("near_pid"), "near_kept"), "near")
    exact = places.where("copies > 1").select("pid", F.col("place").alias("kept"))
    repeated = exact.join(near, F.col("pid") == F.col("near_pid"), "full").select(
        F.coalesce("near_pid", "pid").alias("pid"), F.coalesce("near_kept", "kept").alias("kept")
    )
    # The k-th unit of a line stands for the k-th of the line that stays.
    marked = pieces.join(staged(repeated, "repeated"), "pid").withColumn("alone", F.col("whole") & (_size("words") >= min_line))
    marked = marked.select(
        "place.doc_id",
        "place.unit",
        "words",
        "alone",
        F.col("kept.doc_id").alias("kept_doc_id"),
        ((F.col("place.doc_id") != F.col("kept.doc_id")) | (F.col("place.unit") != F.col("kept.unit"))).alias("removed"),
    )
    found = covered(docs, marked, ranges, min_run)
    discard(pieces, places, members)
    return found


def _sortable(x: Column) -> Column:
    """The eight bytes of a bigint, which sort as it does."""
    return F.unhex(F.lpad(F.hex(x.cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))


def _key_of(doc_id: Column) -> Column:
    """A zero and the id; for a null a one, which sorts last."""
    return F.when(doc_id.isNull(), F.unhex(F.lit("01"))).otherwise(F.concat(F.unhex(F.lit("00")), _sortable(doc_id)))


def _id_of(key: Column) -> Column:
    value = F.conv(F.hex(F.substring(key, 2, 8)), 16, 10).cast("decimal(20,0)") - F.expr("9223372036854775808BD")
    return F.when(F.hex(F.substring(key, 1, 1)) == "00", value.cast("bigint"))


def _told_apart(docs: DataFrame) -> DataFrame:
    """``docs`` -> row (the whole of it), doc_id (a key no other row has) and text."""
    columns = [F.struct(*[docs[c] for c in docs.columns]).alias("row"), "doc_id", "text"]
    docs = docs.select(*columns)
    shared = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    shared = staged(shared, "shared-ids")
    own = docs.where("doc_id IS NOT NULL").join(shared, "doc_id", "left_anti").withColumn("doc_id", _key_of(F.col("doc_id")))
    others = docs.join(shared, "doc_id", "left_semi").unionByName(docs.where("doc_id IS NULL"))
    key = F.concat(_key_of(F.col("doc_id")), _sortable(F.xxhash64("text")), _sortable(F.monotonically_increasing_id()))
    others = staged(others.withColumn("doc_id", key).select("row", "doc_id", "text"), "shared-rows")
    return own.select("row", "doc_id", "text").unionAll(others)


def cut_text(text: str | None, spans) -> str | None:
    """``text`` without ``spans`` (start, length; apart) and the white space after each."""
    if text is None or spans is None or len(spans) == 0:
        return text
    parts, at = [], 0
    for start, length in sorted((s["start"], s["length"]) for s in spans):
        parts.append(text[at:start])
        end = start + length
        at = BLANKS.match(text, end).end()
        if at < len(text) and start and text[start - 1] != "\n" and "\n" in text[end:at]:
            parts.append("\n")  # a line cut at its end stays a line
    return "".join([*parts, text[at:]])


def without_spans(text: Column, spans: Column) -> Column:
    @F.pandas_udf("string")
    def cut(texts: pd.Series, removed: pd.Series) -> pd.Series:
        return pd.Series([cut_text(x, s) for x, s in zip(texts, removed, strict=True)], dtype="object")

    return cut(text, spans)


def without_repeats(docs: DataFrame, threshold: float = THRESHOLD, min_run: int = MIN_RUN, min_line: int = MIN_LINE) -> DataFrame:
    """``docs`` with what repeats cut from text, and n_chars (if there) counted anew.

    Columns stay as they are. Rows of whose text nothing is left are dropped.
    """
    rows = _told_apart(docs)
    found = _repeated(rows.select("doc_id", "text"), threshold, min_run, min_line).where("removed")
    spans = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "length")).alias("spans"))
    spans = staged(spans.select(F.col("doc_id").alias("id"), "spans"), "spans")
    joined = rows.join(spans, F.col("doc_id") == F.col("id"), "left")
    cut = joined.withColumn("text", without_spans(F.col("text"), F.col("spans")))
    left = cut.where(F.col("spans").isNull() | (F.btrim("text", F.lit(" \t\n\x0b\x0c\r")) != ""))
    changed = F.col("spans").isNotNull()
    values = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        values["n_chars"] = F.when(changed, F.length("text").cast(kind)).otherwise(values["n_chars"])
    return left.select(*[values[c].alias(c) for c in docs.columns])
