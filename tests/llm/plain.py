"""Plain Python versions of the stages, all pairs and no hashing tricks; for small tables."""

from __future__ import annotations

from collections import defaultdict
from itertools import combinations

from stoplens.llm import paragraphs as P


def key_of(doc_id: int) -> bytes:
    """A key that sorts as ids do."""
    return b"\x00" + (doc_id + (1 << 63)).to_bytes(8, "big")


def _shingles(words):
    return {tuple(words[i : i + P.SHINGLE]) for i in range(len(words) - P.SHINGLE + 1)}


def near_classes(texts: list[tuple], threshold: float = P.THRESHOLD) -> dict[tuple, tuple]:
    """Text (a tuple of words) -> name of its class, for those in one of two or more; every pair with a common shingle compared."""
    sets = {t: _shingles(t) for t in set(texts)}
    holders = defaultdict(list)
    for t, s in sets.items():
        for x in s:
            holders[x].append(t)
    parent = {t: t for t in sets}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    seen = set()
    for group in holders.values():
        for a, b in combinations(sorted(group), 2):
            if (a, b) not in seen:
                seen.add((a, b))
                if len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]) - 1e-9:
                    parent[root(b)] = root(a)
    sizes = defaultdict(int)
    for t in sets:
        sizes[root(t)] += 1
    return {t: root(t) for t in sets if sizes[root(t)] > 1}


def repeated_parts(docs: list[tuple[int, str | None]], min_run: int = P.MIN_RUN, min_line: int = P.MIN_LINE) -> list[tuple]:
    """Rows of PARTS for (doc_id, text) pairs with ids of their own, whole rows."""
    docs = sorted((i, t or "") for i, t in docs)
    units, lines, sizes, words_of = [], [], {}, {}
    for i, text in docs:
        split, unit = P.splitter(text), 0
        words_of[i] = [w for _, _, line in P.lines_of(text) for u in P.units_of(line, split) for w in u[2]]
        for _, _, line in P.lines_of(text):
            some = [tuple(u[2]) for u in P.units_of(line, split)]
            for k, w in enumerate(some):
                units.append((i, unit + k, w, len(some) == 1))
                sizes[i, unit + k] = len(w)
            if len(some) > 1:
                lines.append((i, unit, tuple(w for u in some for w in u), len(some)))
            unit += len(some)
    marks = defaultdict(list)

    def mark(pieces, classes):
        """``pieces``: (doc, first unit, words, number of units, whether a line), in order."""
        groups = defaultdict(list)
        for piece in pieces:
            groups[classes.get(piece[2], piece[2])].append(piece)
        for group in groups.values():
            if len(group) > 1:
                kept = group[0]
                for i, unit, words, n, whole in group:
                    for k in range(n):
                        marks[i, unit + k].append((whole and len(words) >= min_line, kept[0], (i, unit) != kept[:2]))

    mark([(i, u, w, 1, whole) for i, u, w, whole in units], near_classes([u[2] for u in units if len(u[2]) >= P.NEAR_UNIT]))
    mark([(i, u, w, n, True) for i, u, w, n in lines], near_classes([x[2] for x in lines if len(x[2]) >= P.SHINGLE]))
    chosen = defaultdict(list)
    places = sorted(marks)
    run: list[tuple] = []
    for at, place in enumerate([*places, None]):
        if run and (place is None or place != (run[-1][0], run[-1][1] + 1)):
            long = sum(sizes[p] for p in run) >= min_run
            for p in run:
                if long or any(m[0] for m in marks[p]):
                    chosen[p[0]].append({"unit": p[1], "kept_doc_id": key_of(min(m[1] for m in marks[p])), "removed": any(m[2] for m in marks[p])})
            run = []
        if place is not None:
            run.append(place)
    first, count = {}, defaultdict(int)
    for i, _ in docs:
        for at in range(len(words_of[i]) - P.PASSAGE + 1):
            window = tuple(words_of[i][at : at + P.PASSAGE])
            first.setdefault(window, (i, at))
            count[window] += 1
    out = []
    for i, text in docs:
        spots = defaultdict(list)
        for at in range(len(words_of[i]) - P.PASSAGE + 1):
            window = tuple(words_of[i][at : at + P.PASSAGE])
            if count[window] > 1:
                spots[first[window][0], at - first[window][1]].append(at)
        ranges = []
        for (kept, shift), ats in spots.items():
            begin = ats[0]
            for a, b in zip(ats, [*ats[1:], None], strict=True):
                if b != a + 1:
                    ranges.append({"first": begin, "last": a, "kept_doc_id": key_of(kept), "shift": shift})
                    begin = b
        if chosen[i] or ranges:
            for row in P.parts_of(key_of(i), text, chosen[i], ranges):
                out.append((i, *row[1:6], int.from_bytes(row[6][1:], "big") - (1 << 63), row[7]))
    return sorted(out)


def without_parts(docs: list[tuple[int, str | None]]) -> dict[int, str | None]:
    """Text by id after repeats are cut; without those of which nothing is left."""
    spans = defaultdict(list)
    for i, _, _, start, length, _, _, removed in repeated_parts(docs):
        if removed:
            spans[i].append({"start": start, "length": length})
    cut = {i: P.cut_text(t, spans.get(i)) for i, t in docs}
    return {i: t for i, t in cut.items() if i not in spans or t.strip(" \t\n\x0b\x0c\r")}


# --- classifiers ------------------------------------------------------------


def coordinates(text: str | None, bits: int) -> set[int]:
    """Hashed words, pairs of neighbours and pairs around one word, one at a time."""
    import re

    import xxhash

    cut, every = (1 << 64) - 1, []
    words = [xxhash.xxh64_intdigest(w) for w in re.findall(r"\w+", (text or "").lower())]

    def pair(a, b, salt):
        x = ((a * 0x9E3779B97F4A7C15) & cut) ^ ((b + salt) & cut)
        return ((x ^ (x >> 29)) * 0xBF58476D1CE4E5B9) & cut

    for k, w in enumerate(words):
        every.append(w)
        if k + 1 < len(words):
            every.append(pair(w, words[k + 1], 1))
        if k + 2 < len(words):
            every.append(pair(w, words[k + 2], 2))
    return {x >> (64 - bits) for x in every}


def sigmoid(x: float) -> float:
    import math

    return 1 / (1 + math.exp(-min(max(x, -35.0), 35.0)))


class PlainFtrl:
    """Per-coordinate FTRL-proximal in dictionaries, as its paper has it; the intercept is not shrunk."""

    def __init__(self, alpha: float, beta: float, l1: float, l2: float) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = defaultdict(float), defaultdict(float)

    def weight(self, at) -> float:
        z, l1 = self.z[at], 0.0 if at is None else self.l1
        if abs(z) <= l1:
            return 0.0
        return -(z - (l1 if z > 0 else -l1)) / ((self.beta + self.n[at] ** 0.5) / self.alpha + self.l2)

    def margin(self, row) -> float:
        return sum(map(self.weight, [*row, None]))

    def learn(self, row, label: int) -> None:
        slope = sigmoid(self.margin(row)) - label
        for at in [*row, None]:
            w, before = self.weight(at), self.n[at]
            self.n[at] = before + slope * slope
            self.z[at] += slope - (self.n[at] ** 0.5 - before**0.5) / self.alpha * w


def plain_ftrl(rows: list[set], labels: list[int], least: int, passes: int, alpha: float, l1: float, l2: float) -> PlainFtrl:
    counts = defaultdict(int)
    for row in rows:
        for at in row:
            counts[at] += 1
    model = PlainFtrl(alpha, 1.0, l1, l2)
    for _ in range(passes):
        for row, label in zip(rows, labels, strict=True):
            model.learn([at for at in row if counts[at] >= least], label)
    return model
