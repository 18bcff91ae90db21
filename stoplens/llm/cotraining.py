"""Quality classifier by co-training on two views of a document.

One classifier sees what the text says: its words, symbols, shapes of words and how
often words repeat. The other sees the page: language, source, length and layout.
Both start from labelled rows. In each round every unlabelled document is scored,
and all those one view is sure of become training rows of the other, but for those
whose views are sure of opposite labels. They are dealt
into shards, each is fitted with the labelled rows in a task of its own, and the
shards' weights are averaged by their rows. Which coordinates are learned from is
counted over all training rows. At the end each view is calibrated on labelled rows kept apart, and the calibrated views are
combined there into one probability.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import staged
from .toxicity import MIN_ROWS, Model, ftrl

BITS = 18
# Labelled rows used at most (least hash of the id): four fifths train, one calibrates.
LABELLED_ROWS = 5000
ROUNDS = 2
# A view's share of a label beyond which it is sure.
SURE = 0.95
# Unlabelled documents per shard, about. There are as many shards as the documents need.
SHARD = 10_000
# Fixed point of weights that are added up, so that their order makes no difference.
POINT = float(1 << 20)

VIEWS = "doc_id bigint, text_view binary, page_view binary"
WORD = re.compile(r"\w+")
SYMBOLS = re.compile(r"[^\w\s]+")
CACHE_WORDS = 400_000
# Ids whose least row a task remembers while it deals rows out.
KNOWN_IDS = 10_000


def _coordinate(name: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(name) >> (64 - BITS)


@cache
def _seen() -> dict[str, int]:
    """Both coordinates of tokens, their word's and their shape's, in one number; kept up to a bound."""
    return {}


def _token_coordinates(tokens: set[str]) -> np.ndarray:
    seen = _seen()
    if len(seen) > CACHE_WORDS:
        seen.clear()
    for t in tokens.difference(seen):
        seen[t] = _coordinate(t.lower()) << 32 | _shape_coordinate(t)
    both = np.fromiter(map(seen.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    return np.concatenate((both >> 32, both & 0xFFFFFFFF))


def _distinct(found: list) -> np.ndarray:
    return np.unique(np.concatenate(found)).astype(np.int32)


def _bucket(x: float, steps: float = 2.0) -> int:
    """Number of halvings, in steps, between x and 1."""
    return int(np.log2(max(x, 0) + 1) * steps)


class _Kinds(dict):
    """For each character the one that stands for its kind: lower, upper, digit, other letter; or itself."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = kind = "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "w" if c.isalpha() else c
        return kind


KINDS = _Kinds()
RUNS = re.compile(r"(.)\1+")


def _shape(token: str) -> str:
    return RUNS.sub(r"\1+", token[:24].translate(KINDS))


@cache
def _shape_coordinates() -> dict[str, int]:
    return {}


def _shape_coordinate(token: str) -> int:
    shape = ("a+" if len(token) > 1 else "a") if token.isascii() and token.isalpha() and token.islower() else _shape(token)
    known = _shape_coordinates()
    if len(known) > CACHE_WORDS:
        known.clear()
    found = known.get(shape)
    if found is None:
        found = known[shape] = _coordinate(f"shape={shape}")
    return found


def text_view(text: str | None) -> np.ndarray:
    """Coordinates of what a text says; those of having no words for a null or empty one."""
    words, symbols = WORD.findall(text or ""), SYMBOLS.findall(text or "")
    kinds, n = {*words, *symbols}, len(words) + len(symbols)
    share = lambda x: int(10 * x / max(1, n))
    names = (f"symbols={share(len(symbols))}", f"distinct={share(len(kinds))}:{_bucket(n, 1)}")
    return _distinct([_token_coordinates(kinds), np.array([_coordinate(x) for x in names])])


def page_view(lang, source, n_chars, n_lines) -> np.ndarray:
    """Coordinates of a document's page: each null is a value of its own."""
    known = lambda x: None if x is None or pd.isna(x) else x
    chars, lines = known(n_chars), known(n_lines)
    length = None if chars is None else _bucket(chars)
    line = None if chars is None or not lines else _bucket(chars / lines)
    names = {f"lang={known(lang)}", f"source={known(source)}", f"length={length}", f"line={line}"}
    names |= {f"lines={None if lines is None else _bucket(lines)}", f"page={length}:{line}"}
    return _distinct([np.array([_coordinate(x) for x in names])])


def _pages(docs: DataFrame) -> DataFrame:
    lines = F.size(F.split("text", "\n"))
    return docs.select("doc_id", "text", "lang", "source", "n_chars", F.when(F.col("text").isNotNull(), lines).alias("n_lines"))


def _rows(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    columns = (batch[c].tolist() for c in ("text", "lang", "source", "n_chars", "n_lines"))
    for text, *page in zip(*columns, strict=True):
        yield text_view(text), page_view(*page)


def views_of(docs: DataFrame) -> DataFrame:
    """``docs`` -> doc_id, text_view, page_view (coordinates, as bytes)."""

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([(a.tobytes(), b.tobytes()) for a, b in _rows(batch)], columns=["text_view", "page_view"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield out

    return _pages(docs).mapInPandas(found, VIEWS)


@dataclass
class Views:
    text: Model
    page: Model

    def logits(self, views: DataFrame) -> DataFrame:
        """``views`` -> doc_id, text_logit, page_logit."""
        models = (self.text, self.page)

        def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            dense = [m.dense() for m in models]
            for batch in batches:
                out = pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64")})
                for name, m, d in zip(("text", "page"), models, dense, strict=True):
                    at = (np.frombuffer(x, dtype=np.int32) for x in batch[f"{name}_view"])
                    out[f"{name}_logit"] = [m.intercept + d[x].sum(dtype=np.float64) for x in at]
                yield out.astype({"text_logit": "float64", "page_logit": "float64"})

        return views.mapInPandas(scored, "doc_id bigint, text_logit double, page_logit double")


def _rows_of(views: DataFrame, chosen: DataFrame) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """(id, label, text view, page view) of the documents that ``chosen`` (id, label; bounded) has."""
    rows = views.join(F.broadcast(chosen), views["doc_id"] == chosen["id"])
    # A document is a training row once, whatever repeats its id.
    rows = rows.groupBy("id").agg(F.min(F.struct("text_view", "page_view", "label")).alias("r")).select("id", "r.*")
    return [
        (r["id"], r["label"], np.frombuffer(r["text_view"], dtype=np.int32), np.frombuffer(r["page_view"], dtype=np.int32))
        for r in rows.orderBy(F.xxhash64("id"), "id").collect()
    ]


def _labelled_docs(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    return docs.join(F.broadcast(chosen.select("id")), docs["doc_id"] == chosen["id"], "left_semi")


def _fit(rows: list[tuple], held: np.ndarray | None = None) -> Model:
    return ftrl([x for x, _ in rows], [y for _, y in rows], bits=BITS, alpha=0.5, l1=2.0, l2=1.0, passes=4, held=held)


def _calibrated(views: Views, apart: list[tuple]) -> tuple[list[np.ndarray], tuple[np.ndarray, ...]]:
    """The logits of the rows ``apart`` in each view, and each view's calibration there (slope, shift)."""
    y = np.array([r[1] for r in apart], dtype=np.float64)
    raw = [
        np.array([m.intercept + m.dense()[x].sum(dtype=np.float64) for x in rows])
        for m, rows in ((views.text, [r[2] for r in apart]), (views.page, [r[3] for r in apart]))
    ]
    if not len(y):  # nothing to learn from: every score is a half
        return raw, (np.zeros(2), np.zeros(2))
    return raw, tuple(logistic(x[:, None], y) for x in raw)


def _passed_on(views: Views, by: tuple[np.ndarray, ...], batch: pd.DataFrame) -> Iterator[tuple[str, int, int, np.ndarray]]:
    """(view, row, label, coordinates) of the rows of ``batch`` that the other view, calibrated, is sure of.

    Where the views are sure of opposite labels, neither passes the row on.
    """
    sure = np.log(SURE / (1 - SURE))
    logits = []
    for model, name, (slope, shift) in ((views.text, "text_view", by[0]), (views.page, "page_view", by[1])):
        dense = model.dense()
        at = (np.frombuffer(x, dtype=np.int32) for x in batch[name])
        logits.append([slope * (model.intercept + dense[x].sum(dtype=np.float64)) + shift for x in at])
    for k, (text, page) in enumerate(zip(*logits, strict=True)):
        if text * page < 0 and min(abs(text), abs(page)) >= sure:
            continue
        for name, other in (("text", page), ("page", text)):
            if abs(other) >= sure:
                yield name, k, int(other > 0), np.frombuffer(batch[f"{name}_view"].iat[k], dtype=np.int32)


def _learned_from(unlabelled: DataFrame, views: Views, by: tuple[np.ndarray, ...], labelled: dict[str, list[tuple]]) -> dict[str, np.ndarray]:
    """For each view, the coordinates that MIN_ROWS of the labelled rows and those passed on have."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = {name: np.zeros(1 << BITS, dtype=np.int64) for name in labelled}
        for batch in batches:
            for name, _, _, at in _passed_on(views, by, batch):
                counts[name][at] += 1
        for name, n in counts.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"view": name, "at": at.astype(np.int32), "n": n[at]})

    total = {name: np.bincount(np.concatenate([x for x, _ in rows] or [np.empty(0, dtype=np.int32)]), minlength=1 << BITS) for name, rows in labelled.items()}
    found = unlabelled.mapInPandas(counted, "view string, at int, n bigint").groupBy("view", "at").agg(F.sum("n").alias("n"))
    found = found.toPandas()
    for name, n in total.items():
        own = found[found["view"] == name]
        n[own["at"].to_numpy(dtype=np.int64)] += own["n"].to_numpy(dtype=np.int64)
    return {name: n >= MIN_ROWS for name, n in total.items()}


def _refitted(unlabelled: DataFrame, shards: int, views: Views, by: tuple[np.ndarray, ...], labelled: dict[str, list[tuple]]) -> Views | None:
    """Views fitted on ``labelled`` rows and all that ``views`` pass on; none if they pass nothing on."""
    held = _learned_from(unlabelled, views, by, labelled)

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        least: dict[tuple, tuple] = {}
        for batch in batches:
            ids, orders, rows = batch["doc_id"].tolist(), batch["hash"].tolist(), []
            if len(least) > KNOWN_IDS:
                least.clear()
            for name, k, y, x in _passed_on(views, by, batch):
                row = (x[held[name][x]].tobytes(), y)
                # Of rows that share an id the least one trains, so others needn't travel.
                if row < least.get((name, ids[k]), (row[0], y + 1)):
                    least[name, ids[k]] = row
                    rows.append((name, orders[k] % shards, orders[k], ids[k], y, row[0]))
            yield pd.DataFrame(rows, columns=["view", "shard", "hash", "doc_id", "label", "at"])

    def fitted(batch: pd.DataFrame) -> pd.DataFrame:
        name = batch["view"].iat[0]
        # A document is a training row once, whatever repeats its id.
        batch = batch.sort_values(["hash", "doc_id", "at", "label"]).drop_duplicates("doc_id")
        added = [(np.frombuffer(x, dtype=np.int32), y) for x, y in zip(batch["at"], batch["label"].tolist(), strict=True)]
        model = _fit([*labelled[name], *added], held[name])
        at = np.concatenate((model.at, [-1, -2])).astype(np.int32)
        sums = np.concatenate((model.weights, [model.intercept, 1.0])) * len(added) * POINT
        return pd.DataFrame({"view": name, "at": at, "sum": np.rint(sums).astype(np.int64)})

    rows = unlabelled.withColumn("hash", F.xxhash64("doc_id")).mapInPandas(
        dealt, "view string, shard bigint, hash bigint, doc_id bigint, label int, at binary"
    )
    sums = rows.groupBy("view", "shard").applyInPandas(fitted, "view string, at int, sum bigint")
    sums = sums.groupBy("view", "at").agg(F.sum("sum").alias("sum")).toPandas()
    models = {}
    for name, rows_of in labelled.items():
        own = sums[sums["view"] == name]
        at, total = own["at"].to_numpy(dtype=np.int64), own["sum"].to_numpy(dtype=np.float64)
        if not len(own):
            models[name] = None
            continue
        mean = dict(zip(at.tolist(), (total / total[at == -2][0]).tolist(), strict=True))
        some = np.sort(at[at >= 0]).astype(np.int32)
        models[name] = Model(mean[-1], some, np.array([mean[k] for k in some.tolist()], dtype=np.float32), BITS)
    if not any(models.values()):
        return None
    return Views(models["text"] or views.text, models["page"] or views.page)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients (the last is the intercept) of a logistic regression, by Newton's method."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (len(w) - 1) + [1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Quality:
    """Views, the calibration (slope, shift) of each, and the weights that combine them."""

    views: Views
    calibrations: tuple[np.ndarray, np.ndarray]
    combined: np.ndarray


def _is_apart(doc_id: int) -> bool:
    """Labelled rows kept for calibration."""
    import zlib

    return zlib.crc32(f"apart:{doc_id}".encode()) % 5 == 0


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS, rounds: int = ROUNDS) -> tuple[Quality, DataFrame]:
    """The model fitted on at most ``rows`` labelled rows and what all others add to them, and the views of ``docs``.

    Views are worked out once, written, and read in every round. Documents whose labels are beyond
    ``rows`` are unlabelled ones. Without documents or labels every score is a half.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(F.max("quality").alias("label"))
    first = staged(known.orderBy(F.xxhash64("id"), "id").limit(rows), "labelled")
    labelled = _rows_of(views_of(_labelled_docs(docs, first)), first)
    # The sample's ids are bounded, so views, which are long, are marked where they are made.
    found = views_of(docs).join(F.broadcast(first.select("id")), F.col("doc_id") == F.col("id"), "left")
    unknown = F.col("doc_id").isNotNull() & F.col("id").isNull()
    written = staged(found.select("doc_id", "text_view", "page_view", unknown.alias("unlabelled")), "views")
    views_table = written.drop("unlabelled")
    train = [r for r in labelled if not _is_apart(r[0])] or labelled
    apart = [r for r in labelled if _is_apart(r[0])] or labelled
    given = {"text": [(t, y) for _, y, t, _ in train], "page": [(p, y) for _, y, _, p in train]}
    views = Views(_fit(given["text"]), _fit(given["page"]))
    unlabelled = written.where("unlabelled").drop("unlabelled")
    shards = max(1, round(views_table.count() / SHARD))
    for _ in range(rounds):
        better = _refitted(unlabelled, shards, views, _calibrated(views, apart)[1], given)
        if better is None:
            break
        views = better

    y = np.array([r[1] for r in apart], dtype=np.float64)
    raw, calibrations = _calibrated(views, apart)
    if not len(y):
        return Quality(views, calibrations, np.zeros(3)), views_table
    both = np.column_stack([c[0] * x + c[1] for c, x in zip(calibrations, raw, strict=True)])
    weights = logistic(both, y)
    # A view that would count against itself counts for nothing.
    if (weights[:2] < 0).any():
        used = int(weights[1] < 0) ^ 1
        one = logistic(both[:, [used]], y)
        weights = np.array([one[0] if used == 0 else 0.0, one[0] if used == 1 else 0.0, one[1]])
    return Quality(views, calibrations, weights), views_table


def score_quality(views: DataFrame, model: Quality) -> DataFrame:
    """``views`` (of documents' doc_id, text, lang, source, n_chars) -> doc_id, text_score, page_score, score, predicted.

    A row for each row; scores are probabilities of quality 1, predicted is 1 from a half
    on. Nulls are values like others; a null text has no words and no lines.
    """

    def share(x):
        return 1 / (1 + F.exp(-F.greatest(F.lit(-35.0), F.least(F.lit(35.0), x))))

    (a, b), (c, d), w = *model.calibrations, model.combined
    scored = model.views.logits(views).select(
        "doc_id", (F.col("text_logit") * float(a) + float(b)).alias("t"), (F.col("page_logit") * float(c) + float(d)).alias("p")
    )
    score = share(F.col("t") * float(w[0]) + F.col("p") * float(w[1]) + float(w[2]))
    return scored.select("doc_id", share(F.col("t")).alias("text_score"), share(F.col("p")).alias("page_score"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
