"""Mixing sources to target weights: how many words of each document a mix takes.

Documents get hash-random keys and are sorted by range within their source. Distributed
prefix sums of the word counts say where each document lies in its source's random
order; the source's budget is cut there to the word. Sources whose target exceeds what
they have go through whole epochs first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import ordered
from .tables import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def mix_key(doc_id: Column, seed: str = SEED) -> Column:
    """A random order of documents that depends on their id only; a null id has one as well."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("-"))).cast("binary"), 256)


def with_targets(sources: DataFrame, share: float = SHARE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (weight, group_sum) with target: ``share`` of all sums, dealt by weight.

    No target exceeds ``max_epochs`` times its source's sum; what is over is dealt again
    among the others. Each round reads two sums over the sources; a round that stops no
    further source ends them. If all are stopped, every source is taken whole.
    """
    sources = staged(sources.withColumn("most", F.col("group_sum") * F.lit(max_epochs)), "weights")
    total, weights = sources.agg(F.sum("group_sum"), F.sum("weight")).first()
    rest = goal = float(total or 0) * share

    def part() -> Column:
        return F.lit(rest) * F.col("weight") / F.lit(float(weights or 1))

    while weights:
        stopped = F.col("most") < part()
        spent, left = sources.agg(F.sum(F.when(stopped, F.col("most"))), F.sum(F.when(~stopped, F.col("weight")))).first()
        now = (goal - (spent or 0), left)
        if now == (rest, weights):
            break
        rest, weights = now
    target = F.least(F.col("most").cast("double"), part()) if weights else F.col("most").cast("double")
    return sources.withColumn("target", target).drop("most")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text, source): what the mix takes of it.

    Returns doc_id, source, the columns ``keep``, size (words of the text, a null text has
    none), source_size (those of its source), target (its source's, double) and taken:
    words taken, with repeats. The sources, by value with null last, weigh ``weights`` in
    turn. A source's taken words are its target rounded down: each document size times per
    whole epoch, then as far as the budget goes in the random order, the last one in part.
    Texts without words take no words; rows that share an id stand side by side, by size;
    equal rows differ at most in which of them is cut. Other columns may have any names.
    An empty table gives no rows. Only ids, sources, sizes and ``keep`` are shuffled.
    """
    kept = {f"kept_{name}": F.col(name) for name in keep}
    rows = docs.select(
        "doc_id",
        F.struct(F.col("source").isNull().alias("none"), F.col("source").alias("name")).alias("group"),
        word_count(F.col("text")).alias("size"),
        mix_key(F.col("doc_id"), seed).alias("key"),
        *[c.alias(n) for n, c in kept.items()],
    )
    turn = F.array(*[F.lit(w) for w in weights])

    def extend(groups: DataFrame) -> DataFrame:
        weight = F.get(turn, (F.col("group_index") % len(weights)).cast("int")).cast("bigint")
        return with_targets(groups.withColumn("weight", weight), share, max_epochs)

    found, _ = ordered(rows, "group", ["key", "doc_id", "size"], amount="size", extend=extend)
    budget = F.floor("target")
    epochs = F.when(F.col("group_sum") > 0, F.expr("floor(target) div group_sum")).otherwise(0).cast("bigint")
    rest = budget - epochs * F.col("group_sum") - F.col("before")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return found.select(
        "doc_id",
        F.col("group.name").alias("source"),
        *[F.col(n).alias(n.removeprefix("kept_")) for n in kept],
        "size",
        F.col("group_sum").alias("source_size"),
        "target",
        taken.cast("bigint").alias("taken"),
    )


def mixed_texts(mix: DataFrame) -> DataFrame:
    """``mix_sources(docs, keep=["text"])`` -> doc_id, source, epoch (from 0), text: the mix itself.

    Whole texts as they are; one taken in part as its first words, joined by spaces.
    """
    size = F.greatest("size", F.lit(1))
    epochs = F.expr("taken div greatest(size, 1)")
    some = (F.col("taken") - epochs * size).cast("int")
    copies = F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("taken") / size) - 1)
    begun = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), some), " ")
    rows = mix.where("taken > 0").withColumn("epoch", F.explode(copies))
    return rows.select("doc_id", "source", "epoch", F.when(F.col("epoch") < epochs, F.col("text")).otherwise(begun).alias("text"))
