"""Sampled SentencePiece segmentations without replacement, by Gumbel top-k.

A text's segmentations are the paths of a lattice of vocabulary pieces, each with the
probability of its pieces, normalised. Backward sums give every node's share, so the
perturbed score of all paths below a node is one Gumbel value, and the children of a
node divide it: the best keeps it, the others get less. Expanding the best open node
first (A*) emits paths in order of perturbed score: a sample without replacement.
Draws are hashes of the row's key, so a row's samples depend on nothing else.

The model's ranks, which are no probabilities, are taken as Zipf's: a piece has a
probability in proportion to 1 / (rank + OFFSET).

No piece reaches over the start of a word, nor from letters to others, so nodes are those
of single words, whose lattices are kept, and all words of a batch of texts advance together. On paths of more
than SHORT pieces, nodes below a share of e^CUT of their text are not opened: one of
their paths would be among the samples with a probability under a double's resolution.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 2
SEED = 7
OFFSET = 100.0
CUT = -37.0
SPACE = "▁"
# Letters, digits or other characters, with the spaces before them; numbers that are no digits count with the others.
WORD = re.compile(rf"{SPACE}*(?:[^\W\d_\xb2\xb3\xb9\xbc-\xbe]+|\d+|(?:[^\w{SPACE}\n]|[_\xb2\xb3\xb9\xbc-\xbe])+)|{SPACE}+|\n")
# Characters of text worked on together at least; a longer text is worked on whole.
BATCH_CHARS = 1_000_000
# Characters of words laid out together at least.
TABLE = 100_000
# Words whose lattices a worker keeps at a time.
WORDS_KEPT = 400_000
# Words of up to so many characters have their shares computed as plain numbers, each character lifted by e^LIFT.
PLAIN_WIDTH = 16
LIFT = 6.0
# Paths of up to so many pieces are opened at every step.
SHORT = 64

SAMPLES = (
    "doc_id bigint, sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double"
)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# The hash of the empty string; not zero, which a null character would leave as it is.
EMPTY = np.uint64(0x5851F42D4C957F2D)


def _fold(state: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hash of a string one character longer."""
    state = (state ^ codes) * np.uint64(0x9E3779B97F4A7C15)
    return state ^ (state >> np.uint64(31))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(seed: np.ndarray, *counters) -> np.ndarray:
    """Numbers in (0, 1), a hash of the seed and the counters."""
    x = seed.astype(np.uint64)
    for c in counters:
        x = _mixed(x + np.asarray(c).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019))
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def _gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


class Vocabulary:
    """Pieces of a SentencePiece model, their log-probabilities and a table of prefixes."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.pieces = [self.model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))]
        order = sorted(plain, key=lambda i: -self.model.get_score(i))
        if any(len(WORD.findall(self.pieces[i])) != 1 for i in plain):
            raise ValueError("pieces of this model reach over the start of a word")
        weights = 1 / (np.arange(len(order) + 1) + OFFSET)
        log = np.log(weights / weights.sum())
        self.log_prob = np.full(n, -np.inf)
        self.log_prob[order] = log[:-1]
        self.byte_log_prob = float(log[-1])
        self.byte_ids = np.array([self.model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        self.log_prob[self.byte_ids] = self.byte_log_prob
        self.longest = max(len(self.pieces[i]) for i in plain)
        # The pieces' probabilities, lifted by their characters; the last one, which -1 stands for, is no piece.
        lengths = np.ones(n + 1)
        lengths[plain] = [len(self.pieces[i]) for i in plain]
        self.lifted = np.exp(np.append(self.log_prob, -np.inf) + LIFT * lengths)
        self.bytes = [self.pieces[i].encode() for i in range(n)]
        for b, i in enumerate(self.byte_ids.tolist()):
            self.bytes[i] = bytes([b])
        table: dict[int, int] = {}
        with np.errstate(over="ignore"):
            for i in plain:
                state = EMPTY
                for at, c in enumerate(self.pieces[i]):
                    state = _fold(np.array([state]), np.array([ord(c)], dtype=np.uint64))[0]
                    table.setdefault(int(state), -1)
                    if at == len(self.pieces[i]) - 1:
                        table[int(state)] = i
        # A sparse table: slots by the hash's low bits, the next ones where those are taken.
        self.mask = np.uint64((1 << (16 * len(table)).bit_length()) - 1)
        self.keys = np.zeros(int(self.mask) + 1, dtype=np.uint64)
        self.values = np.full(len(self.keys), -1, dtype=np.int32)
        for state, piece in table.items():
            at = state & int(self.mask)
            while self.keys[at]:
                at = (at + 1) & int(self.mask)
            self.keys[at], self.values[at] = state, piece

    def find(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is a prefix of a piece, and the piece that it is, or -1."""
        at = (states & self.mask).astype(np.int64)
        key = self.keys[at]
        lost = np.flatnonzero((key != states) & (key != 0))
        while len(lost):
            at[lost] = (at[lost] + 1) & int(self.mask)
            key[lost] = self.keys[at[lost]]
            lost = lost[(key[lost] != states[lost]) & (key[lost] != 0)]
        known = key == states
        return known, np.where(known, self.values[at], -1)

    def words(self, text: str | None) -> list[str]:
        return WORD.findall(self.model.normalize(text)) if text else []

    def expand(self, edge: int) -> list[int]:
        """Ids of an edge: a piece, or a character (as -2 - its code) in bytes."""
        return [edge] if edge >= 0 else [int(self.byte_ids[b]) for b in chr(-2 - edge).encode()]

    def decode(self, ids) -> str:
        text = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@cache
def known_words(path: str) -> Words:
    return Words(vocabulary(path))


class Words:
    """Lattices of words, kept from text to text up to a bound.

    Word w has the nodes first[w] ... first[w] + its length - 1; node n has the edges
    start[n] ... start[n + 1] - 1, longest first, each with its piece, length, share of
    the node (as a log, and cumulated).
    """

    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.again = np.zeros(0, dtype=bool)
        self.first = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.start = Grown(np.int64, [0])
        self.piece, self.length = Grown(np.int32), Grown(np.int32)
        self.log, self.cumulative = Grown(np.float32), Grown(np.float32)

    def trim(self) -> None:
        """Keep the words met again since the last time, the likeliest to be met again."""
        which = np.flatnonzero(self.again)
        if len(which) > WORDS_KEPT // 2:
            return self.clear()
        words = [w for w, met in zip(self.index, self.again.tolist(), strict=True) if met]  # they are in order of their numbers
        first, sizes, start = self.first[which], self.size[which], self.start.view()
        nodes, _ = _ranges(first, sizes)
        degrees = start[nodes + 1] - start[nodes]
        edges, _ = _ranges(start[nodes], degrees)
        columns = [(c, c.view()[edges]) for c in (self.piece, self.length, self.log, self.cumulative)]
        self.index, self.again = dict(zip(words, range(len(words)), strict=True)), np.zeros(len(words), dtype=bool)
        self.first, self.size = np.cumsum(sizes) - sizes, sizes
        self.start = Grown(np.int64, [0])
        self.start.extend(np.cumsum(degrees))
        for column, values in columns:
            column.used = 0
            column.extend(values)

    def numbers(self, words: list[str]) -> np.ndarray:
        """The numbers of words, which are learned where new."""
        found = np.fromiter(map(self.index.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(found < 0)
        self.again[found[found >= 0]] = True
        if len(missing):
            missed = [words[i] for i in missing.tolist()]
            self.learn(set(missed))
            found[missing] = np.fromiter(map(self.index.__getitem__, missed), dtype=np.int64, count=len(missed))
        return found

    def learn(self, words: set[str]) -> None:
        new = sorted(words.difference(self.index), key=len)
        if not new:
            return
        self.again = np.append(self.again, np.zeros(len(new), dtype=bool))
        sizes = np.array([len(w) for w in new], dtype=np.int64)
        first = len(self.start) - 1 + np.cumsum(sizes) - sizes
        self.first, self.size = np.append(self.first, first), np.append(self.size, sizes)
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        lo = 0
        while lo < len(new):  # words of about one length together, in tables of bounded size
            most = max(1, TABLE // int(sizes[lo]))
            hi = int(np.searchsorted(sizes, max(sizes[lo] + 1, sizes[lo] * 5 // 4), side="right"))
            hi = min(hi, lo + most)
            self._lay(new[lo:hi], sizes[lo:hi])
            lo = hi

    def _lay(self, words: list[str], sizes: np.ndarray) -> None:
        v, n, width = self.v, len(words), int(sizes.max())
        held = np.arange(width)[None, :] < sizes[:, None]
        codes = np.zeros((n, width), dtype=np.uint64)
        codes[held] = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        longest = min(v.longest, width)
        edge = np.full((n, width, longest), -1, dtype=np.int32)
        row, at = np.nonzero(held)
        state = np.full(len(row), EMPTY)
        for k in range(longest):
            state = _fold(state, codes[row, at + k])
            known, piece = v.find(state)
            edge[row, at, k] = piece
            if k == 0:  # a character without a piece is spelled in bytes
                alone = piece < 0
                code = codes[row[alone], at[alone]].astype(np.int32)
                edge[row[alone], at[alone], 0] = np.where(code < 0x80, v.byte_ids[code & 0x7F], -2 - code)
            on = known & (at + k + 1 < sizes[row])
            row, at, state = row[on], at[on], state[on]
            if not len(row):
                longest = k + 1
                break
        edge = edge[:, :, :longest]
        spelled = edge < -1
        in_bytes = 0.0
        if spelled.any():
            code = -2 - edge[spelled]
            in_bytes = v.byte_log_prob * (2 + (code > 0x7FF) + (code > 0xFFFF))
        if width <= PLAIN_WIDTH:
            weights = v.lifted[np.maximum(edge, -1)]
            weights[spelled] = np.exp(in_bytes + LIFT)
            share = self._shares(weights, sizes)[held][:, ::-1]
        else:
            log = np.where(edge >= 0, v.log_prob[np.maximum(edge, 0)], -np.inf)
            log[spelled] = in_bytes
            share = np.exp(self._log_shares(log, sizes))[held][:, ::-1]
        edge = edge[held][:, ::-1]
        real = edge != -1
        total = np.cumsum(share, axis=1)
        last = longest - 1 - real[:, ::-1].argmax(axis=1)
        total[np.arange(len(last)), last] = np.inf  # whatever rounding left
        lengths = np.broadcast_to(np.arange(longest, 0, -1), edge.shape)
        self.start.extend(self.start.view()[-1] + np.cumsum(real.sum(axis=1)))
        self.piece.extend(edge[real])
        self.length.extend(lengths[real])
        self.log.extend(np.log(np.maximum(share[real], 1e-300)))
        self.cumulative.extend(total[real])

    @staticmethod
    def _shares(weights: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Each edge's share of its node. Weights are scaled by LIFT a character, so short words stay in range."""
        n, width, longest = weights.shape
        below = np.zeros((n, width + longest))
        below[np.arange(n), sizes] = 1
        for i in range(width - 1, -1, -1):
            paths = weights[:, i, :]
            paths *= below[:, i + 1 : i + 1 + longest]
            below[:, i] += paths.sum(axis=1)
            paths /= np.where(below[:, i] > 0, below[:, i], 1)[:, None]
        return weights

    @staticmethod
    def _log_shares(log: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The same for words of any length, as logs."""
        n, width, longest = log.shape
        below = np.full((n, width + longest), -np.inf)
        below[np.arange(n), sizes] = 0
        with np.errstate(invalid="ignore", divide="ignore"):
            for i in range(width - 1, -1, -1):
                paths = log[:, i, :] + below[:, i + 1 : i + 1 + longest]
                top = paths.max(axis=1)
                total = top + np.log(np.exp(paths - top[:, None]).sum(axis=1))
                inside = i < sizes
                below[inside, i] = total[inside]
                log[:, i, :] = paths - total[:, None]
        return log


class Grown:
    """An array that is added to at its end."""

    def __init__(self, kind: type, values: list | None = None) -> None:
        self.items, self.used = np.array(values or [], dtype=kind), len(values or [])

    def __len__(self) -> int:
        return self.used

    def view(self) -> np.ndarray:
        return self.items[: self.used]

    def extend(self, values: np.ndarray) -> None:
        need = self.used + len(values)
        if need > len(self.items):
            grown = np.empty(max(need, len(self.items) * 3 // 2), dtype=self.items.dtype)
            grown[: self.used] = self.view()
            self.items = grown
        self.items[self.used : need] = values
        self.used = need


def _ranges(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers start ... start + count - 1 of each, and which each is of."""
    owner = np.repeat(np.arange(len(counts)), counts)
    ahead = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return starts[owner] + ahead, owner


class Sampler:
    """k segmentations each of some texts, worked on together."""

    def __init__(self, texts: list[str | None], seeds: np.ndarray, words: Words, k: int) -> None:
        self.v, self.k, self.seeds, self.words = words.v, k, seeds, words
        if len(words.index) > WORDS_KEPT:
            words.trim()
        per_text = [self.v.words(x) for x in texts]
        counts = np.array([len(w) for w in per_text], dtype=np.int64)
        self.ends = np.cumsum(counts)
        self.begins = self.ends - counts
        word = words.numbers(list(chain.from_iterable(per_text)))
        self.text_of = np.repeat(np.arange(len(texts)), counts)
        # The nodes where words begin and end; one more, so that the last has a next.
        self.node_of = np.append(words.first[word], 0)
        self.end_of = np.append(words.first[word] + words.size[word], 0)

    def samples(self) -> list[list[tuple[np.ndarray, float, float, float]]]:
        """For each text, its samples in order: ids, log-probability, perturbed score, log-inclusion."""
        d, k, w = len(self.begins), self.k, self.words
        every = np.arange(d)
        # The best open nodes of each text: perturbed score, word and node, log-share of the
        # text, and the path there: that of a sample for some steps, then an edge.
        slots = {"g": np.full((d, k), -np.inf), "log": np.zeros((d, k))}
        slots |= {c: np.full((d, k), -1, dtype=np.int64) for c in ("at", "node", "of", "steps", "edge")}
        slots["g"][:, 0] = _gumbel(uniform(self.seeds, 0))
        slots["at"][:, 0], slots["node"][:, 0] = self.begins, self.node_of[self.begins]
        slots["steps"][:, 0] = 0
        paths: list[list[np.ndarray]] = []  # by sample and text: all edges
        out: list[list[tuple]] = [[] for _ in range(d)]
        for s in range(k):
            best = slots["g"].argmax(axis=1)
            g, log, at, node, of, steps, edge = (slots[c][every, best].copy() for c in slots)
            slots["g"][every, best] = -np.inf
            live = np.isfinite(g)
            if not live.any():
                break
            tail, nodes, text, words = self._tails(s, live, at, node)
            cuts = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=d))))
            logs = w.log.view()[tail].astype(np.float64)
            self._open(s, slots, g, log, steps + (edge >= 0), tail, nodes, text, words, logs, cuts)
            total = log + np.bincount(text, weights=logs, minlength=d)
            paths.append([np.empty(0, dtype=np.int64)] * d)
            pieces = w.piece.view()
            for t in np.flatnonzero(live).tolist():
                head = paths[of[t]][t][: steps[t]] if of[t] >= 0 else paths[s][t]
                own = [edge[t]] if edge[t] >= 0 else []
                path = paths[s][t] = np.concatenate((head, np.array(own, dtype=np.int64), tail[cuts[t] : cuts[t + 1]]))
                ids = pieces[path]
                if len(ids) and ids.min() < 0:
                    ids = np.array([x for e in ids.tolist() for x in self.v.expand(e)], dtype=np.int32)
                out[t].append((ids, float(total[t]), float(g[t])))
        rest = slots["g"].max(axis=1)
        return [[(*row, log_inclusion(row[1], rest[t])) for row in rows] for t, rows in enumerate(out)]

    def _tails(self, s: int, live: np.ndarray, at: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, ...]:
        """Edges from each live text's node to its end, drawn by their shares: with the nodes they leave, texts, words."""
        w = self.words
        all_words = np.arange(len(self.text_of))
        words = all_words[live[self.text_of] & (all_words >= at[self.text_of])]
        text, nodes, ends = self.text_of[words], self.node_of[words], self.end_of[words]
        opened = at[text] == words  # may be left in the middle of a word
        nodes[opened] = node[text[opened]]
        seeds = _mixed(self.seeds[text] + (words - self.begins[text]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        start, cumulative, length = w.start.view(), w.cumulative.view(), w.length.view()
        turns, left, chosen, going = [], [], [], np.arange(len(words))
        while len(going):
            here = nodes[going]
            u = uniform(seeds[going], (s + 1 << 40) + len(turns))
            edge = start[here]
            more = np.flatnonzero(u >= cumulative[edge])
            while len(more):
                edge[more] += 1
                more = more[u[more] >= cumulative[edge[more]]]
            turns.append(going)
            left.append(here)
            chosen.append(edge)
            nodes[going] = here = here + length[edge]
            going = going[here < ends[going]]
        counts = np.zeros(len(words), dtype=np.int64)
        for which in turns:
            counts[which] += 1
        offsets = np.cumsum(counts) - counts
        edges, sources = np.zeros((2, int(counts.sum())), dtype=np.int64)
        for k, (which, here, taken) in enumerate(zip(turns, left, chosen, strict=True)):
            edges[offsets[which] + k], sources[offsets[which] + k] = taken, here
        return edges, sources, np.repeat(text, counts), np.repeat(words, counts)

    def _open(self, s, slots, g, log, steps, tail, nodes, text, words, logs, cuts) -> None:
        """Put the siblings of the edges of ``tail`` among the open nodes.

        Which child has the most is independent of how much that is, and the others' scores are
        Gumbel, cut off there: so the path can be drawn first.
        """
        w, k = self.words, self.k
        if not len(tail):
            return
        before = np.cumsum(logs) - logs
        before += (log - before[np.minimum(cuts[:-1], len(tail) - 1)])[text]
        near = (before > CUT) | (np.diff(cuts) <= SHORT)[text]
        at = np.flatnonzero(near)
        starts, lengths = w.start.view(), w.length.view()
        node = nodes[at]
        edge, of = _ranges(starts[node], starts[node + 1] - starts[node])
        other = edge != tail[at[of]]
        edge, of = edge[other], at[of[other]]
        if not len(edge):
            return
        share = before[of] + w.log.view()[edge]
        t = text[of]
        ahead = of - cuts[t] + steps[t]
        u = uniform(self.seeds[t], s + 1, ahead + (1 << 40), lengths[edge])
        with np.errstate(over="ignore"):
            value = share - np.logaddexp(share - g[t], np.log(-np.log(u)))
        # The k best of each text; texts are in order.
        firsts = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
        owner, best, rank, rest = np.cumsum(np.concatenate(([0], t[1:] != t[:-1]))), [], [], value.copy()
        for r in range(k):
            top = np.maximum.reduceat(rest, firsts)
            found = np.flatnonzero((rest == top[owner]) & np.isfinite(rest))
            found = found[np.concatenate(([True], owner[found][1:] != owner[found][:-1]))] if len(found) else found
            rest[found] = -np.inf
            best.append(found)
            rank.append(np.full(len(found), r))
        order, rank = np.concatenate(best), np.concatenate(rank)
        edge, of, t = edge[order], of[order], t[order]
        node = nodes[of] + lengths[edge]
        word = words[of]
        over = node == self.end_of[word]
        word = word + over
        node = np.where(over, self.node_of[word], node)
        d = len(g)
        new = {"g": np.full((d, k), -np.inf), "log": np.zeros((d, k))}
        new |= {c: np.full((d, k), -1, dtype=np.int64) for c in ("at", "node", "of", "steps", "edge")}
        columns = (("g", value[order]), ("log", share[order]), ("at", word), ("node", node), ("of", s), ("steps", ahead[order]), ("edge", edge))
        for c, values in columns:
            new[c][t, rank] = values
        both = {c: np.concatenate((slots[c], new[c]), axis=1) for c in slots}
        keep = np.argsort(-both["g"], axis=1, kind="stable")[:, :k]
        for c in slots:
            slots[c] = np.take_along_axis(both[c], keep, axis=1)


def log_inclusion(log: float, rest: float) -> float:
    """Log of the probability that a path's score is above ``rest``, the best one left out."""
    if not np.isfinite(rest):
        return 0.0
    gap = log - rest
    return float(gap) if gap < -30 else float(np.log(-np.expm1(-np.exp(min(gap, 700.0)))))


def key_seeds(keys: list, seed: int) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest(str(key), seed) for key in keys], dtype=np.uint64)


def sample_texts(keys: list, texts: list[str | None], words: Words, k: int = K, seed: int = SEED) -> list[list[tuple]]:
    with np.errstate(over="ignore"):
        return Sampler(texts, key_seeds(keys, seed), words, k).samples()


def sample_segmentations(
    docs: DataFrame, k: int = K, seed: int = SEED, path: str | None = None, decode: bool = False
) -> DataFrame:
    """Up to ``k`` distinct segmentations of each row of ``docs`` (doc_id, text).

    Returns doc_id, sample (from 1, by perturbed score), ids, log_prob (of the
    segmentation, given the text), perturbed and log_inclusion (log of the probability
    that it is in a sample that ends at the same score); with ``decode`` also text, which
    the ids stand for. Fewer rows for texts with fewer
    segmentations: a null or empty text has one, without ids. Rows with equal keys and
    texts get equal samples. Other columns are ignored, whatever their names; an empty table
    gives no rows. A text is read whole by one task, a word of any length with it: its draws
    have numbers of their own however many pieces it has.
    """
    where = path or model_path()

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = known_words(where)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lo, size = 0, 0
            for hi in range(1, len(ids) + 1):
                size += len(texts[hi - 1] or "")
                if size >= BATCH_CHARS or hi == len(ids):
                    yield _batch(ids[lo:hi], sample_texts(ids[lo:hi], texts[lo:hi], words, k, seed), words.v if decode else None)
                    lo, size = hi, 0

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(sampled, SAMPLES + ", text string" * decode)


def _batch(ids: list, found: list[list[tuple]], v: Vocabulary | None) -> pa.RecordBatch:
    rows = [(doc_id, s + 1, *row) for doc_id, samples in zip(ids, found, strict=True) for s, row in enumerate(samples)]
    offsets = np.concatenate(([0], np.cumsum([len(r[2]) for r in rows]))).astype(np.int32)
    flat = np.concatenate([r[2] for r in rows]) if rows else np.empty(0, dtype=np.int32)
    names = ["doc_id", "sample", "ids", "log_prob", "perturbed", "log_inclusion"]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.int32()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())),
            *(pa.array([r[c] for r in rows], pa.float64()) for c in (3, 4, 5)),
            *([pa.array([v.decode(r[2].tolist()) for r in rows], pa.string())] if v else []),
        ],
        names=[*names, "text"] if v else names,
    )


def decoded(ids: Column, path: str | None = None) -> Column:
    """The text that ``ids`` stand for."""
    where = path or model_path()

    @F.pandas_udf("string")
    def decode(rows: pd.Series) -> pd.Series:
        v = vocabulary(where)
        return pd.Series([None if r is None else v.decode(r.tolist()) for r in rows], dtype="object")

    return decode(ids)
