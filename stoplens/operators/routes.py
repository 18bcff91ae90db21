"""Adding route attributes to passages, or to anything with line and direction."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: how many characters of a route name a direction must contain.
NAME_PREFIX = 50

ROUTE_COLUMNS = {
    "code_trace": "route_code",
    "nom_trace": "route_name",
    "nom_origine": "nom_origine",
    "nom_destination": "nom_destination",
    "pmr": "pmr",
}

MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# Characters of a route name that the index of names goes by.
GRAM = 8
# Characters of these that tell where a name can start, unless there are too many such starts.
START, MAX_STARTS = 3, 4096

# Rows of a (line, direction) pair that are no longer left to one task.
BUSY = 100_000


def text_bytes(df: DataFrame) -> int:
    """Size of a table of texts, allowing 16 bytes per field on top of the text."""
    widths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in df.columns]
    return df.agg(F.sum(reduce(add, widths)).alias("bytes")).first()["bytes"] or 0


def _named(routes: DataFrame) -> DataFrame:
    return routes.select(
        F.col("ligne").alias("_line"),
        F.col("nom_trace").substr(1, NAME_PREFIX).alias("_name"),
        *[F.col(name).alias(alias) for name, alias in ROUTE_COLUMNS.items()],
    )


def match_routes(
    df: DataFrame,
    routes: DataFrame,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    salts: int = 32,
) -> DataFrame:
    """Left join to the routes of the same line whose name the direction contains.

    A row matching several routes is repeated, one matching none keeps NULLs.
    ``df`` may be a stream. The routes are measured first and broadcast only
    up to ``max_broadcast_bytes``. Beyond that a batch goes by an index of the
    names (``match_by_index``). A stream's sides are shuffled on (line, salt),
    each route copied once per salt, so that a line with a large share of the
    rows (or rows without a line) is spread over ``salts`` tasks.
    """
    if text_bytes(_named(routes)) > max_broadcast_bytes and not df.isStreaming:
        return match_by_index(df, routes, salts)
    routes = _named(routes)
    rows = df.columns
    match = (F.col("ligne") == F.col("_line")) & F.col("direction").contains(F.col("_name"))
    if df.isStreaming and text_bytes(routes) > max_broadcast_bytes:
        df = df.withColumn("_salt", F.pmod(F.xxhash64(*rows), F.lit(salts)).cast("int"))
        routes = routes.withColumn("_copy", _every(salts)).hint("merge")
        match = match & (F.col("_salt") == F.col("_copy"))
    else:
        routes = F.broadcast(routes)
    return df.join(routes, match, "left").select(*rows, *ROUTE_COLUMNS.values())


def _every(salts: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))


def _busy_pairs(df: DataFrame, busy: int) -> list[int]:
    """Hashes of the (line, direction) pairs of ``busy`` rows or more, the 1,000 most frequent at most."""
    counts = df.groupBy(F.xxhash64("ligne", "direction").alias("pair")).count().where(F.col("count") >= busy)
    return [r["pair"] for r in counts.orderBy(F.desc("count"), "pair").limit(1000).collect()]


def match_by_index(df: DataFrame, routes: DataFrame, salts: int = 32, gram: int = GRAM, busy: int = BUSY) -> DataFrame:
    """``match_routes`` for a batch and any number of routes: equalities only, no line meets all its routes.

    A name is found in a direction where its first ``gram`` characters are. So each distinct
    (line, direction) asks, for every place in it, for names of its line that start like that
    place, and gets the lengths of such names, however many there are: one row. The texts of
    these lengths at that place are then looked up as whole names. So names that start alike
    are not compared one by one, and what is found are matches. They are joined back to the
    rows by pair. A pair of more than ``busy`` rows is not one task: its rows are dealt over
    ``salts``, and so are copies of its matches, which are as many as its routes.
    """
    routes, rows = _named(routes).where("_line is not null and _name is not null"), df.columns
    names = routes.select("_line", "_name", F.left("_name", F.lit(gram)).alias("_gram"))
    starts = names.groupBy("_line", "_gram").agg(F.collect_set(F.length("_name")).alias("_lengths"))
    # Names shorter than the key are asked for by their own lengths, if there are any.
    lengths = sorted(r[0] for r in names.select(F.length("_gram")).distinct().collect())
    # Places where no name can start are left out before the shuffle, if few characters tell them.
    known = names.select(F.length("_gram"), F.left("_gram", F.lit(START))).distinct().limit(MAX_STARTS + 1).collect()
    pairs = df.select("ligne", "direction").where("ligne is not null and direction is not null").distinct()

    def asked(length: int) -> Column:
        last = F.length("direction") - length + 1 if length else F.lit(1)
        places = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(F.lit(1), last))).otherwise(F.array().cast("array<int>"))
        if len(known) <= MAX_STARTS:
            few = [r[1] for r in known if r[0] == length]
            places = F.filter(places, lambda at: F.substring("direction", at, F.lit(min(length, START))).isin(few))
        return F.transform(places, lambda at: F.struct(at.alias("at"), F.substring("direction", at, F.lit(length)).alias("gram")))

    none = F.array().cast("array<struct<at:int,gram:string>>")
    probes = pairs.withColumn("_place", F.explode(F.concat(none, *[asked(n) for n in lengths])))
    probes = probes.select("ligne", "direction", "_place.at", F.col("_place.gram").alias("_asked"))
    # A start that most directions have is not one task.
    probes = probes.withColumn("_salt", F.pmod(F.xxhash64("direction"), F.lit(salts)).cast("int"))
    starts = starts.withColumn("_copy", _every(salts))
    # Neither side is known to be small.
    begun = probes.join(
        starts.hint("merge"),
        (F.col("ligne") == F.col("_line")) & (F.col("_asked") == F.col("_gram")) & (F.col("_salt") == F.col("_copy")),
    )
    texts = begun.select("ligne", "direction", "at", F.explode("_lengths").alias("_length"))
    texts = texts.where(F.col("at") + F.col("_length") - 1 <= F.length("direction"))
    texts = texts.select("ligne", "direction", F.substring("direction", F.col("at"), F.col("_length")).alias("_text")).distinct()
    found = texts.join(routes.hint("merge"), (F.col("ligne") == F.col("_line")) & (F.col("_text") == F.col("_name"))).select(
        F.col("ligne").alias("_line"), F.col("direction").alias("_direction"), *ROUTE_COLUMNS.values()
    )
    often = _busy_pairs(df, busy)
    is_busy = lambda *pair: F.xxhash64(*pair).isin(often) if often else F.lit(False)
    copies = F.when(is_busy("_line", "_direction"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    found = found.withColumn("_copy", F.explode(copies))
    dealt = df.withColumn("_salt", F.when(is_busy("ligne", "direction"), F.pmod(F.xxhash64(*rows), F.lit(salts)).cast("int")).otherwise(F.lit(0)))
    same = (F.col("ligne") == F.col("_line")) & (F.col("direction") == F.col("_direction")) & (F.col("_salt") == F.col("_copy"))
    return dealt.join(found.hint("merge"), same, "left").select(*rows, *ROUTE_COLUMNS.values())
