"""Quality rules: a table of thresholds compiled into one projection.

Words are runs of characters other than the six ASCII white-space characters.
Every measure is an array or string expression of the row's own text, so there
is no shuffle and no user function, and a long text costs in proportion to its
length (times the logarithm where five-word windows repeat).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
# A share of stop words says little about fewer words than this.
STOP_WORDS_FROM = 50
SYMBOLS = "[#*$%&|<>]"

# Frequent function words of the corpus's languages.
STOP_WORDS = {
    "en": "the be to of and that have with a in is it for on was as are this by an or at from not",
    "fr": "le la les de des du un une et est en que qui dans pour pas sur au avec ce il elle ne se",
    "de": "der die das und ist in den von zu mit ein eine nicht auf für sich des im dem sie es auch",
    "es": "el la los las de y que en un una es por con para no se del al lo su como más pero",
}


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie between ``low`` and ``high`` (None: no bound)."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


# Wide bounds: each is far from what running prose shows, so a text has to be
# odd in one respect to go, and short or long prose stays.
RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 20.0),
    Rule("symbols", "symbols_per_word", None, 0.1),
    Rule("stop_words", "stop_word_share", 0.02, None),
    Rule("repeated_lines", "dup_line_share", None, 0.5),
    Rule("bullets", "bullet_line_share", None, 0.9),
    Rule("ellipses", "ellipsis_line_share", None, 0.3),
)


def stop_words() -> list[str]:
    """Each stop word as written within and at the start of a sentence."""
    words = {w for text in STOP_WORDS.values() for w in text.split()}
    return sorted(words | {w.capitalize() for w in words})


def _tail(items: Column, start: int, size: Column) -> Column:
    return F.slice(items, F.lit(start), F.greatest(size, F.lit(0)))


def _window_hashes(word_hashes: Column, n: Column) -> Column:
    """Hash of each window of five words, from the words' hashes."""
    both = lambda a, b: F.xxhash64(a, b)
    two = F.zip_with(_tail(word_hashes, 1, n - 1), _tail(word_hashes, 2, n - 1), both)
    four = F.zip_with(_tail(two, 1, n - 3), _tail(two, 3, n - 3), both)
    return F.zip_with(_tail(four, 1, n - 4), _tail(word_hashes, 5, n - 4), both)


def _repeat_positions(windows: Column) -> Column:
    """Positions of windows that occur twice or more, in order, some of them twice."""
    order = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    pairs = F.zip_with(
        order,
        F.slice(order, F.lit(2), F.size(order)),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    return F.sort_array(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))


def _covered(positions: Column) -> Column:
    """Number of words in windows that start at ``positions`` (sorted)."""
    steps = F.zip_with(
        positions,
        F.slice(positions, F.lit(2), F.size(positions)),
        lambda p, q: F.least(F.coalesce(q - p, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)


def measured(docs: DataFrame) -> DataFrame:
    """One row per document: row (all its columns), counts, and the measures the rules bound.

    A null text has no words and no lines. Windows are compared by 64-bit hash:
    two different windows of one text are taken for equal with a probability of
    about the square of its words over 2^65.
    """
    blank = f"[{SPACE}]"
    stops = stop_words()
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    text = docs.select(row, F.coalesce("text", F.lit("")).alias("t"))
    body = F.btrim("t", F.lit(SPACE))
    words = text.select(
        "row",
        "t",
        F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, f"{blank}+")).alias("w"),
        F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "").alias("lines"),
    )
    counts = words.select(
        "row",
        F.size("w").alias("n"),
        F.length(F.translate("t", SPACE, "")).cast("bigint").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        F.size(F.filter("w", lambda x: x.isin(stops))).alias("stops"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: F.btrim(x, F.lit(SPACE)).rlike("^[-*•]"))).alias("bullets"),
        F.size(F.filter("lines", lambda x: F.btrim(x, F.lit(SPACE)).rlike("(\\.\\.\\.|…)$"))).alias("ellipses"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    windows = counts.withColumn("h", _window_hashes(F.col("h"), F.col("n")))
    # Few texts repeat a window; only those are sorted.
    repeats = F.size(F.array_distinct("h")) < F.size("h")
    places = windows.withColumn("h", F.when(repeats, _repeat_positions(F.col("h"))))
    return places.select(
        "row",
        F.col("n").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(_covered(F.col("h")), F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.try_divide("word_chars", "n").alias("mean_word_chars"),
        F.try_divide("n_symbols", "n").alias("symbols_per_word"),
        F.when(F.col("n") >= STOP_WORDS_FROM, F.try_divide("stops", "n")).alias("stop_word_share"),
        F.try_divide("n_dup_lines", "n_lines").alias("dup_line_share"),
        F.try_divide("bullets", "n_lines").alias("bullet_line_share"),
        F.try_divide("ellipses", "n_lines").alias("ellipsis_line_share"),
    )


def passes(rule: Rule) -> Column:
    """Whether a row is within the rule's bounds; a measure without a value passes."""
    measure, held = F.col(rule.measure), F.lit(True)
    if rule.low is not None:
        held = held & (measure >= rule.low)
    if rule.high is not None:
        held = held & (measure <= rule.high)
    return F.coalesce(held, F.lit(True))


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``measured`` with base_failed, failed_rules (names, in the table's order) and kept."""
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    failed = F.filter(
        F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull()
    )
    verdicts = measured(docs).withColumn("base_failed", base_failed).withColumn("failed_rules", failed)
    return verdicts.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts and verdict of each row of ``docs`` (doc_id, text; other columns are ignored).

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept and failed_rules. Every row gives a row, repeated and null ids
    included; a null, empty or blank text has no words, fails the base and is not kept.
    """
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged(docs, rules).select("row.doc_id", *counts, "base_failed", "kept", "failed_rules")


def passing(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    # A filter on measures alone would be pushed below the projections that compute them, each
    # written out wherever it is used. A column without a fixed value keeps it above them.
    judgement = judged(docs, rules).select("row", "kept", F.monotonically_increasing_id().alias("at"))
    return judgement.where(F.col("kept") & (F.col("at") >= 0)).select("row.*")
