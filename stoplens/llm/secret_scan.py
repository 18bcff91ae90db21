"""Secret scan: pattern matches, and strings a tokenizer finds hard to spell.

A byte-pair vocabulary spells words in few tokens and random strings in many, so
a long unbroken string with few characters per token is taken for random. Digests
and identifiers, which look random and are no secrets, are excluded first.

Spans are [start, end) in code points of the text.
"""

from __future__ import annotations

import re
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGNED = 8
MIN_ACCESS = 16

# What may be random: unbroken, whatever it is made of.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
# Hexadecimal digests of the usual lengths, with or without a name before them.
DIGEST = re.compile(
    r"(?:md5|sha1|sha224|sha256|sha384|sha512)?[-=_/]?"
    r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128})",
    re.IGNORECASE,
)
# Identifiers: UUIDs, dates and times, numbers with separators, prefixed record ids.
IDENTIFIER = re.compile(
    r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    r"|\d{4}-\d{2}-\d{2}[T_-]?[\dZ_+-]*"
    r"|[\d+/_=-]+"
    r"|(?:[A-Za-z]+[/_=-]+)+\d+"
)
MAX_CHARS_PER_TOKEN = 1.9
# Without digits a string may be a word. Lengths up to these have limits of their own, which of the
# 1,111 distinct words of 16 letters and more in sf0.1/documents one is under.
WORD_LIMITS = ((17, 1.75), (19, 1.85))
PLACEHOLDER = "[SECRET]"

SPANS = "array<struct<kind:string,start:int,end:int>>"


@cache
def encoding(path: str):
    """The byte-pair encoding whose ranks are in the file at ``path``."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def is_random(string: str, tokens: int, limit: float = MAX_CHARS_PER_TOKEN) -> bool:
    if not any(c.isdigit() for c in string):
        limit = min([limit, *(x for most, x in WORD_LIMITS if len(string) <= most)])
    return tokens > 0 and len(string) / tokens <= limit


def _covers(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether ``spans``, by start, have all places from ``start`` to ``end``."""
    for s, e in spans:
        if s > start:
            break
        start = max(start, e)
    return start >= end


def find_spans(text: str | None, encode, limit: float = MAX_CHARS_PER_TOKEN) -> list[tuple[str, int, int]]:
    """Base spans, and spans of random strings that these don't cover, by start and kind."""
    if not text:
        return []
    found = base_spans(text)
    base = sorted((s, e) for _, s, e in found)
    for m in CANDIDATE.finditer(text):
        string, (start, end) = m[0], m.span()
        if DIGEST.fullmatch(string) or IDENTIFIER.fullmatch(string):
            continue
        if _covers(base, start, end):
            continue
        if is_random(string, len(encode(string)), limit):
            found.append(("random", start, end))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def secret_spans(text: Column, vocabulary: str | None = None, limit: float = MAX_CHARS_PER_TOKEN) -> Column:
    """Spans of ``text``, as array<struct<kind, start, end>>; null and empty texts have none.

    ``vocabulary`` is the path of a tiktoken rank file that executors can open.
    """
    path = vocabulary or vocabulary_path()

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        encode = encoding(path).encode_ordinary
        return pd.Series(
            [[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(x, encode, limit)] for x in texts],
            dtype="object",
        )

    return spans(text)


def redact(text: str | None, spans) -> str | None:
    """``text`` with each stretch that spans cover replaced by a placeholder."""
    if text is None or spans is None or len(spans) == 0:
        return text
    parts, at = [], 0
    for span in sorted(spans, key=lambda x: (x["start"], x["end"])):
        if span["start"] >= at:
            parts += [text[at : span["start"]], PLACEHOLDER]
        at = max(at, span["end"])
    return "".join([*parts, text[at:]])


def redacted(text: Column, spans: Column) -> Column:
    @F.pandas_udf("string")
    def cut(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([redact(x, s) for x, s in zip(texts, found, strict=True)], dtype="object")

    return cut(text, spans)


def scan_secrets(docs: DataFrame, vocabulary: str | None = None, limit: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, spans; a row for each row, spans never null."""
    return docs.select("doc_id", secret_spans(F.col("text"), vocabulary, limit).alias("spans"))


def without_secrets(docs: DataFrame, vocabulary: str | None = None, limit: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """``docs`` with a placeholder for each secret in text, and n_chars (if there) counted anew.

    Rows and columns stay as they are.
    """
    text = redacted(F.col("text"), secret_spans(F.col("text"), vocabulary, limit))
    clean = docs.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), "n_chars"))
    return clean.select(*docs.columns)


def of_kinds(spans: Column, kinds: tuple[str, ...]) -> Column:
    return F.filter(spans, lambda x: x["kind"].isin(*kinds))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
