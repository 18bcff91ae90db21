"""Best-fit packing of documents into sequences, planned on counts of lengths.

Documents become token ids, ended by a separator, and are cut only where they are
longer than a sequence. The driver sees how many pieces there are of each length,
at most ``capacity`` numbers, and places lengths from the longest down, each into
the open sequences with the least sufficient room. What it plans are runs: so many
consecutive pieces of a length go to so many consecutive sequences. Pieces then
take their slots by a join on length and rank within it.

Ranks are counted in parts: a length with many pieces is dealt over buckets, the
counts of the buckets are summed up, and rows are numbered within a bucket only.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import partitions, staged

CAPACITY = 4096
SEPARATOR = 1
# Words whose ids a worker keeps at a time.
CACHE_WORDS = 800_000
# Below U+0250, without U+0130, lower-casing a text at once equals the tokenizer's own; without these
# separators white space is the same to both, and without these digits so are letters and numbers.
NOT_PLAIN = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbeİɐ-\U0010ffff]")
# Fixed value: how the tokenizer cuts a word of a plain text.
PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
SPECIAL = "<|endoftext|>"

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"
PLAN = "length bigint, rank_from bigint, n bigint, per_sequence bigint, sequence_from bigint, offset_from bigint"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The character that byte-level vocabularies write for each byte."""
    printed = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printed else chr(next(others)) for b in range(256)]


class Kept(dict):
    """Values by key, worked out when first asked for; about the ``most`` newest and oftenest asked are kept."""

    def __init__(self, learn: Callable[[str], bytes], most: int) -> None:
        self.learn, self.half, self.older = learn, max(1, most // 2), {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.learn(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class WordEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit bytes, equal to the tokenizer's own.

    The tokenizer drops white space and never joins what stands on either side of
    it, so a text's ids are those of its words, one after the other, and a word's those
    of the parts it is cut into. Ids of both are kept, up to a bound. Texts with a special
    token go to the tokenizer whole, words of texts that are not plain one by one.
    """

    def __init__(self, path: str, words: int = CACHE_WORDS) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = byte_letters()
        self.part = Kept(self._part, words // 4).__getitem__
        self.word = Kept(self._word, words // 2).__getitem__
        self.other = Kept(self._ids, words // 4).__getitem__

    def _ids(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _part(self, part: str) -> bytes:
        """Ids of what is one word to the tokenizer, so its model is asked at once."""
        spelled = part if part.isascii() and part.isprintable() else "".join(map(self.letters.__getitem__, part.encode()))
        ids = [t.id for t in self.tokenizer.model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: str) -> bytes:
        return self._part(word) if word.isalpha() else b"".join(map(self.part, PARTS.findall(word)))

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        for text in texts:
            if not text:
                yield b""
            elif "<|" in text:
                yield self._ids(text)
            elif NOT_PLAIN.search(text):
                yield b"".join(map(self.other, text.split(" ")))
            else:
                yield b"".join(map(self.word, text.lower().split()))


@cache
def encoder(path: str, words: int) -> WordEncoder:
    return WordEncoder(path, words)


def cut_pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
    ids: bool = True,
    cache_words: int = CACHE_WORDS,
) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, piece, start, length, ids_crc32, ids (as bytes).

    A null text is empty: its only piece is the separator.
    """
    path, tail = vocabulary or vocabulary_path(), SEPARATOR.to_bytes(4, "little")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path, cache_words).encode
        for batch in batches:
            for at in range(0, len(batch), 256):
                some, rows = batch.iloc[at : at + 256], []
                for doc_id, raw in zip(some["doc_id"].tolist(), encode(some["text"].tolist()), strict=True):
                    raw += tail
                    for k, start in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[start : start + 4 * capacity]
                        rows.append((doc_id, k, start // 4, len(part) // 4, zlib.crc32(part), part if ids else None))
                out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    return docs.select("doc_id", "text").mapInPandas(pieces, PIECES)


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, for ``counts`` of pieces by length.

    Rows (length, rank_from, n, per_sequence, sequence_from, offset_from): the n pieces
    of this length from rank_from on go, per_sequence to each, to the sequences from
    sequence_from on, the first of each at offset_from. The work is in the number of
    runs, not of pieces.
    """
    runs: dict[int, list[tuple[int, int]]] = {}  # by room: (first sequence, how many)
    rooms: list[int] = []  # sorted
    plan, sequences = [], 0

    def add(room: int, first: int, many: int) -> None:
        if many and room:
            if room not in runs:
                bisect.insort(rooms, room)
                runs[room] = []
            runs[room].append((first, many))

    def place(length: int, rank: int, left: int, room: int, first: int, many: int) -> int:
        """Fill sequences of this room with pieces of this length; the number placed."""
        each = room // length
        full, rest = divmod(min(left, many * each), each)
        placed = full * each + rest
        plan.append((length, rank, placed, each, first, capacity - room))
        add(room - each * length, first, full)
        add(room - rest * length, first + full, 1 if rest else 0)
        add(room, first + full + bool(rest), many - full - bool(rest))
        return placed

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left and (at := bisect.bisect_left(rooms, length)) < len(rooms):
            room = rooms[at]
            first, many = runs[room].pop()
            if not runs[room]:
                del runs[room], rooms[at]
            placed = place(length, rank, left, room, first, many)
            rank, left = rank + placed, left - placed
        if left:
            many = -(-left // (capacity // length))
            place(length, rank, left, capacity, sequences, many)
            sequences += many
    return plan


def ranked(pieces: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """``pieces`` with a rank from 0 within their length, and the counts by length."""
    spark = pieces.sparkSession
    sizes = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    most = max(1, sum(sizes.values()) // (4 * partitions(spark)))
    dealt = spark.createDataFrame([(k, -(-n // most)) for k, n in sizes.items()], "length bigint, buckets bigint")
    spread = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("buckets"))
    # One row per length, of which there are at most as many as tokens in a sequence.
    bucketed = pieces.join(F.broadcast(dealt), "length").withColumn("bucket", spread).drop("buckets")
    filled = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n")).collect()
    starts, before = [], {}
    for length, bucket, n in sorted(filled):
        starts.append((length, bucket, before.get(length, 0)))
        before[length] = before.get(length, 0) + n
    # At most one row per length and four per partition.
    origin = spark.createDataFrame(starts, "length bigint, bucket bigint, rank_start bigint")
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    numbered = bucketed.withColumn("k", F.row_number().over(within))
    placed = numbered.join(F.broadcast(origin), ["length", "bucket"])
    return placed.withColumn("rank", F.col("rank_start") + F.col("k") - 1).drop("k", "rank_start", "bucket"), sizes


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (written: read several times) with sequence_id and offset.

    Offsets leave no gaps; no sequence is longer than ``capacity``. Without pieces
    there are no rows.
    """
    spark = pieces.sparkSession
    rows, counts = ranked(pieces)
    plan = spark.createDataFrame(plan_slots(counts, capacity), PLAN)
    slots = plan.groupBy("length").agg(
        F.array_sort(F.collect_list(F.struct("rank_from", "n", "per_sequence", "sequence_from", "offset_from"))).alias("slots")
    )
    # One row per length: the plan's size follows the lengths, not the pieces.
    joined = rows.join(F.broadcast(slots), "length")
    slot = F.filter("slots", lambda s: (s["rank_from"] <= F.col("rank")) & (F.col("rank") < s["rank_from"] + s["n"]))[0]
    ahead = F.col("rank") - F.col("slot.rank_from")
    return (
        joined.withColumn("slot", slot)
        .withColumn("sequence_id", F.col("slot.sequence_from") + F.expr("(rank - slot.rank_from) div slot.per_sequence"))
        .withColumn("offset", F.col("slot.offset_from") + ahead % F.col("slot.per_sequence") * F.col("length"))
        .drop("slot", "slots", "rank")
    )


def pack_documents(
    docs: DataFrame,
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
    ids: bool = True,
    cache_words: int = CACHE_WORDS,
) -> DataFrame:
    """Each piece of ``docs`` (doc_id, text) with its place.

    Returns doc_id, piece, start, length, ids_crc32, ids (with ``ids``), sequence_id and
    offset. Every row gives at least one piece; repeated and null ids are kept as they
    are; other columns are ignored. ``cache_words`` bounds the words whose ids a Python
    worker keeps (about 200 bytes each).
    """
    cut = cut_pieces(docs, capacity, vocabulary, ids, cache_words)
    return pack_pieces(staged(cut if ids else cut.drop("ids"), "pieces"), capacity)
