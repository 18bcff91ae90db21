"""Periodic runs of words: stretches that repeat with a small period, each extended as far as it goes.

Per document, Ukkonen suffix trees of its words and of their reversal answer how far two
places agree to the right and to the left, by constant-time lowest common ancestors on
the Euler tours. Every run has a Lyndon root, a longest Lyndon word at some place under
one of two opposite orders, so two candidates a place, extended both ways, find all runs.

A run of four periods or more and at least six words holds no window of four words that
doesn't occur again within a quarter of the run. Stretches of other windows are put in
place of a separator before the trees are built; no run touches them (``zones``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 6
MIN_PERIODS = 4
GRAM = 4
# Words handled at a time, unless one document has more.
SLICE_WORDS = 1 << 20

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])
FOUND_DDL = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


class SuffixTree:
    """Ukkonen's suffix tree of whole numbers whose last one occurs nowhere else.

    rank: place of each suffix among the sorted ones. Between neighbours in that order the
    Euler tour turns at their lowest common ancestor, whose depths are kept in tables
    of minima over spans of powers of two: ``common`` looks two of them up.
    """

    def __init__(self, text: list[int]) -> None:
        first, stop, link, kids = [0], [0], [0], [{}]
        suffix_of: dict[int, int] = {}
        n = len(text)
        node = edge = length = rest = 0
        for i, word in enumerate(text):
            rest += 1
            waits = 0  # an inner node without its suffix link yet
            while rest:
                if not length:
                    edge = i
                head = text[edge]
                child = kids[node].get(head)
                if child is None:
                    leaf = len(first)
                    first.append(i)
                    stop.append(n)
                    link.append(0)
                    kids.append(None)
                    suffix_of[leaf] = i - rest + 1
                    kids[node][head] = leaf
                    if waits:
                        link[waits] = node
                        waits = 0
                else:
                    begin = first[child]
                    width = stop[child] - begin
                    if length >= width:
                        edge += width
                        length -= width
                        node = child
                        continue
                    if text[begin + length] == word:
                        length += 1
                        if waits:
                            link[waits] = node
                        break
                    inner = len(first)
                    first += (begin, i)
                    stop += (begin + length, n)
                    link += (0, 0)
                    kids += ({text[begin + length]: child, word: inner + 1}, None)
                    suffix_of[inner + 1] = i - rest + 1
                    kids[node][head] = inner
                    first[child] = begin + length
                    if waits:
                        link[waits] = inner
                    waits = inner
                rest -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - rest + 1
        self._tour(first, stop, kids, suffix_of)

    def _tour(self, first: list, stop: list, kids: list, suffix_of: dict[int, int]) -> None:
        """Visits the children of a node by their first word; -1 - depth marks a turn between two of them."""
        suffixes, turns = [], []
        todo, depths = [0], [0]
        while todo:
            node = todo.pop()
            if node < 0:
                turns.append(-1 - node)
                continue
            depth = depths.pop()
            below = kids[node]
            if below is None:
                suffixes.append(suffix_of[node])
                continue
            mark = -1 - depth
            for head in sorted(below, reverse=True):
                child = below[head]
                todo += (child, mark)
                depths.append(depth + stop[child] - first[child])
            todo.pop()  # a turn lies between two children, not before the first
        order = np.array(suffixes, dtype=np.int64)
        self.rank = np.empty(len(order), dtype=np.int64)
        self.rank[order] = np.arange(len(order))
        self.minima = [np.array(turns, dtype=np.int32)]
        while len(self.minima[-1]) > (span := 1 << (len(self.minima) - 1)):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-span], last[span:]))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of different places, how many numbers from them on agree."""
        a, b = self.rank[a], self.rank[b]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp(high - low)[1] - 1
        out = np.empty(len(low), dtype=np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            table = self.minima[k]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << int(k))])
        return out


def _next_smaller(values: list[int]) -> list[int]:
    """For each place, the next one with a smaller value, or the end."""
    out, open_places = [len(values)] * len(values), []
    for i, value in enumerate(values):
        while open_places and values[open_places[-1]] > value:
            out[open_places.pop()] = i
        open_places.append(i)
    return out


def periodic_runs(
    zones: list[list[int]], min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, length, period) of all runs of at least ``min_periods`` (2 or more) in ``zones``.

    Zones are lists of non-negative numbers; places count through them with a separator
    after each. Runs come by place, then period.
    """
    text: list[int] = []
    for k, zone in enumerate(zones):
        text += zone
        text.append(-1 - k)
    n = len(text)
    tree = SuffixTree(text)
    back = text[n - 2 :: -1] if n > 1 else []
    back_tree = SuffixTree([*back, -1 - len(zones)])
    ends = np.repeat(np.cumsum([len(z) + 1 for z in zones]) - 1, [len(z) + 1 for z in zones])
    rank = tree.rank.tolist()
    places = np.arange(n)
    found = []
    for order in (rank, [-r for r in rank]):
        roots_end = np.array(_next_smaller(order), dtype=np.int64)
        period = roots_end - places
        at = np.flatnonzero((roots_end < ends) & (period * min_periods <= ends))
        found.append(np.stack([at, period[at]]))
    at, period = np.concatenate(found, axis=1)
    right = tree.common(at, at + period)
    left = back_tree.common(n - 1 - at, n - 1 - at - period)
    length = left + period + right
    kept = length >= np.maximum(min_words, min_periods * period)
    runs = np.unique(np.stack([at - left, period, length], axis=1)[kept], axis=0)
    return runs[:, 0], runs[:, 2], runs[:, 1]


def zones(words: np.ndarray, lengths: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> tuple[np.ndarray, np.ndarray]:
    """Stretches (start, end) of ``words``, documents of these lengths in a row, outside which there's no run.

    A window of GRAM words in a run occurs again one period away, which is at most the
    run's length by ``min_periods``. So from the stretches of windows that occur again
    within the bound their stretch allows, others are left out until none is left to.
    """
    n = len(words)
    ends = np.repeat(np.cumsum(lengths), lengths)
    key = np.repeat(np.arange(1, len(lengths) + 1, dtype=np.uint64), lengths)
    padded = np.concatenate([words.astype(np.uint64) + np.uint64(1), np.zeros(GRAM, dtype=np.uint64)])
    for k in range(GRAM):  # equal windows have equal keys; a clash only leaves a stretch in
        key = (key ^ padded[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    places = np.flatnonzero(np.arange(n) + GRAM <= ends)
    order = np.argsort(key[places], kind="stable")
    places = places[order]
    gap = np.where(np.diff(key[places]) == 0, np.diff(places), n + 1)
    nearest = np.full(n, n + 1)
    nearest[places[1:]] = gap
    nearest[places[:-1]] = np.minimum(nearest[places[:-1]], gap)
    bound = np.repeat(lengths, lengths) // min_periods
    while True:
        marked = nearest <= bound
        edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.view(np.int8), [0]])))
        start, end = edges[::2], edges[1::2] + GRAM - 1
        long = end - start >= min_words
        start, end = start[long], end[long]
        steps = np.zeros(n + 1, dtype=np.int64)
        most = (end - start) // min_periods
        steps[start] += most
        steps[end - GRAM + 1] -= most
        tighter = np.cumsum(steps[:n])
        if np.array_equal(nearest <= tighter, marked):
            return start, end
        bound = tighter


def _document_runs(words: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a document within ``spans`` of its words."""
    at, length, period = periodic_runs([words[a:b].tolist() for a, b in spans])
    begins = np.concatenate([[0], np.cumsum([b - a + 1 for a, b in spans])])
    zone = np.searchsorted(begins, at, side="right") - 1
    return at - begins[zone] + np.array([a for a, _ in spans])[zone], length, period


def runs_of_texts(texts: list[bytes | None]) -> Iterator[tuple[list[bytes], tuple[np.ndarray, np.ndarray, np.ndarray] | None]]:
    """Words and runs (start, length, period; None without any) of UTF-8 texts, some at a time."""
    known: dict[bytes, int] = {}
    many: list[list[bytes]] = []
    numbers: list[int] = []

    def handled() -> Iterator:
        lengths = np.array([len(x) for x in many], dtype=np.int64)
        ids = np.array(numbers, dtype=np.int64)
        start, end = zones(ids, lengths)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        cut = np.searchsorted(start, offsets)
        for k, words in enumerate(many):
            if cut[k] == cut[k + 1]:
                yield words, None
                continue
            begin = int(offsets[k])
            spans = [(int(a) - begin, int(b) - begin) for a, b in zip(start[cut[k] : cut[k + 1]], end[cut[k] : cut[k + 1]], strict=True)]
            runs = _document_runs(ids[begin : begin + len(words)], spans)
            yield words, runs if len(runs[0]) else None

    for text in texts:
        words = (text or b"").split()  # bytes are split at ASCII white space only: 20, 09 to 0D
        if many and len(numbers) + len(words) > SLICE_WORDS:
            yield from handled()
            known, many, numbers = {}, [], []
        many.append(words)
        numbers += [known.setdefault(w, len(known)) for w in words]
    if many:
        yield from handled()


def _collapsed(words: list[bytes], runs: tuple | None) -> bytes:
    """Words but those that lie in a run beyond its first period."""
    if runs is None:
        return b" ".join(words)
    start, length, period = runs
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)])


def _batch(doc_ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    n_words, counts, parts, collapsed = [], [], [], []
    for words, runs in runs_of_texts(texts.cast(pa.binary()).to_pylist()):
        n_words.append(len(words))
        counts.append(0 if runs is None else len(runs[0]))
        if runs is not None:
            parts.append(runs)
        collapsed.append(_collapsed(words, runs))
    columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.empty(0, dtype=np.int64)] * 3
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), type=pa.int32())
    flat = pa.StructArray.from_arrays([pa.array(c, type=pa.int64()) for c in columns], fields=list(RUN))
    runs = pa.ListArray.from_arrays(offsets, flat)
    return pa.record_batch(
        [doc_ids, pa.array(n_words, type=pa.int64()), runs, pa.array(collapsed, type=pa.binary()).view(pa.string())], schema=FOUND
    )


def find_runs(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n_words, runs, collapsed; a row for each row.

    Words are what lies between ASCII white space. runs (start, length, period, in words
    from 0) holds every stretch of at least MIN_WORDS words and MIN_PERIODS times its
    smallest period that no neighbour extends, by start, then period; collapsed is the
    text's other words joined by spaces: each run keeps its first period only. Null,
    empty and blank texts have no words, no runs and an empty collapsed text. Rows that
    share an id or a text are rows of their own, a null id stays null, other columns
    have no part and may have any names, an empty table gives no rows.

    Every text is read whole, by one task: words are numbered about a million at a time,
    and the trees of a document take some 500 bytes for each word in its zones.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _batch(batch.column(0), batch.column(1))

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(found, FOUND_DDL)


def strongest(runs: Column) -> Column:
    """The run with the greatest length by period, ties to the first one; null without runs."""

    def better(best: Column, run: Column) -> Column:
        ahead = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | ahead, run).otherwise(best)

    return F.aggregate(runs, F.get(runs, F.lit(0)), better)


def planted_text(doc_id: Column, text: Column) -> Column:
    """``text``, for a tenth of the ids with its tail made of repeats of a part of it.

    With h the CRC-32 of the id's digits and g = h div 10, texts of n words whose h ends
    in 0 repeat, from word g mod n on, the first 1 + (n - g mod n) div (3 + g mod 8) words
    there. A null id changes nothing.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words)

    def tail(words: Column, n: Column) -> Column:
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
        copies = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(copies, F.lit(1), n - a)), " ")

    return F.when((h % 10 == 0) & (n > 0), tail(words, n)).otherwise(text)
