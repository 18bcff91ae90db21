"""Periodic runs, the Merkle manifest and the source mix: brute force, edge tables and scale-free plans."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stoplens.llm import periodic
from stoplens.llm.merkle import fold, leaf_digest, merkle_manifest, proof_digest, sibling_indices
from stoplens.llm.mixing import mix_key, mix_sources, mixed_texts
from stoplens.llm.ordering import ordered
from stoplens.llm.queries import QUERIES
from stoplens.llm.tables import table

# --- periodic runs ----------------------------------------------------------


def plain_runs(words):
    """All runs by comparing words at every distance."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            start, length = i, j + q - i
            shorter = any(all(words[k] == words[k + d] for k in range(start, start + length - d)) for d in range(1, q))
            if length >= max(6, 4 * q) and not shorter:
                out.append((start, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic_words(pick, letters, n):
    words = [chr(97 + pick.randrange(letters)) for _ in range(n)]
    if n > 3 and pick.random() < 0.6:
        a = pick.randrange(n)
        p = pick.randint(1, max(1, (n - a) // 3))
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        words += ["x", "y"] * pick.randint(0, 6) + words[: pick.randint(0, 9)]
    return words


def as_rows(runs):
    return [] if runs is None else [tuple(map(int, r)) for r in zip(*runs, strict=True)]


def test_runs_equal_brute_force():
    pick = random.Random(11)
    texts = [" ".join(periodic_words(pick, pick.choice([1, 2, 2, 3, 4, 9]), pick.randint(0, 60))).encode() for _ in range(1500)]
    for text, (words, runs) in zip(texts, periodic.runs_of_texts(texts), strict=True):
        expected = plain_runs(text.split())
        assert as_rows(runs) == expected
        known = {}
        whole = [known.setdefault(w, len(known)) for w in words]
        if whole:  # the trees of the whole text, no stretch left out
            place, length, period = periodic.periodic_runs([whole])
            assert as_rows((place, length, period)) == expected


def test_suffix_tree_ranks_and_common_lengths():
    pick = random.Random(5)
    for letters in (1, 2, 5):
        text = [pick.randrange(letters) for _ in range(60)] + [-1]
        tree = periodic.SuffixTree(text)
        order = sorted(range(len(text)), key=lambda i: text[i:])
        assert [int(x) for x in np.argsort(tree.rank)] == order
        a, b = np.array([(i, j) for i in range(61) for j in range(61) if i != j]).T
        for i, j, found in zip(a, b, tree.common(a, b), strict=True):
            x, y = text[i:], text[j:]
            assert found == next((k for k, (u, v) in enumerate(zip(x, y, strict=False)) if u != v), min(len(x), len(y)))


def planted_words(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def plain_op11(doc_id, text):
    words = planted_words(doc_id, text)
    runs = plain_runs(words) if len(words) < 1500 else as_rows(next(iter(periodic.runs_of_texts([b" ".join(words)])))[1])
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()),
        sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_op11_equals_brute_force(spark, sf_dir):
    found = sorted(map(tuple, QUERIES["op11_periodic_runs"](spark, sf_dir).collect()))
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    assert found == sorted(plain_op11(*r) for r in rows)
    assert sum(r[1] for r in found) > 10


def test_runs_of_odd_rows(spark, docs, odd_docs):
    found = periodic.find_runs(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in found}
    assert (by_id[1]["n_words"], by_id[1]["runs"], by_id[1]["collapsed"]) == (0, [], "")
    assert by_id[3]["collapsed"] == "" and by_id[None]["collapsed"] == "no id"
    assert by_id[6]["collapsed"] == "a\x00b 語𝄞 é"
    long = by_id[4]
    assert [tuple(r) for r in long["runs"]] == [(0, 30_000, 977)] and len(long["collapsed"].split()) == 977
    assert periodic.find_runs(docs((1, "a b")).where("doc_id < 0")).count() == 0
    # A no-break space is part of a word.
    words = docs((1, "a\u00a0b " * 6), (2, "a " * 5), (3, "x " + "a " * 6 + "a b " * 4))
    runs = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in periodic.find_runs(words).collect()}
    assert runs == {1: [(0, 6, 1)], 2: [], 3: [(1, 7, 1), (7, 8, 2)]}


def test_strongest_run_ties(spark):
    runs = spark.createDataFrame([([(5, 8, 2), (0, 12, 3), (9, 4, 1)],), ([],)], "runs array<struct<start: bigint, length: bigint, period: bigint>>")
    best = [r[0] and tuple(r[0]) for r in runs.select(periodic.strongest(F.col("runs"))).collect()]
    assert best == [(5, 8, 2), None]


def test_planted_text(spark, docs):
    rows = [(i, f"a b c d e\tf {i}") for i in range(300)] + [(None, "a b"), (7, None)]
    found = docs(*rows).select("doc_id", "text", periodic.planted_text(F.col("doc_id"), F.col("text")).alias("new")).collect()
    for doc_id, text, new in found:
        assert (new or "").encode().split() == planted_words(doc_id, text)
    assert sum(r["text"] != r["new"] for r in found) > 10


# --- Merkle manifest --------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves, fanout):
    """Root, and per leaf the (left, right) steps upward."""
    paths, level, owner = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, at in enumerate(owner):
            run = at - at % fanout
            paths[k].append(("".join(level[run:at]), "".join(level[at + 1 : run + fanout])))
        level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
        owner = [at // fanout for at in owner]
    return level[0], paths


def plain_manifest(rows, fanout):
    """(source, doc_id, leaf, subroot, root, path) of (source, doc_id, leaf) rows."""
    groups = defaultdict(list)
    for source, doc_id, leaf in rows:
        groups[source].append((doc_id is not None, doc_id, leaf))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    low = {s: plain_tree([x[2] for x in sorted(groups[s])], fanout) for s in names}
    root, high = plain_tree([low[s][0] for s in names], fanout)
    return [
        (s, doc_id, leaf, low[s][0], root, low[s][1][i] + high[k])
        for k, s in enumerate(names)
        for i, (_, doc_id, leaf) in enumerate(sorted(groups[s]))
    ]


def key(row):
    return tuple((x is not None, str(x)) for x in row)


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest_equals_plain_trees(spark, fanout):
    pick = random.Random(fanout)
    sources = [None, "", "a", "Z", "é", "𝄞", "b"]
    rows = [(pick.choice(sources[:6]), pick.choice([None, *range(40)]), str(pick.randrange(30)), "x", 1) for _ in range(120)]
    rows.append(("b", 5, "alone", "x", 1))
    df = spark.createDataFrame(rows, "source string, doc_id bigint, text string, node string, tree int")
    found = merkle_manifest(df, leaf_digest([F.col("text")]), fanout=fanout)
    assert found.columns == ["source", "doc_id", "leaf", "subroot", "root", "path"]
    checked = found.withColumns({"folded": fold(F.col("leaf"), F.col("path")), "proof": proof_digest(F.col("path"))}).collect()
    got = [(*r[:5], [tuple(s) for s in r["path"]]) for r in checked]
    expected = plain_manifest([(s, d, sha(f"{len(t)}:{t}")) for s, d, t, *_ in rows], fanout)
    assert sorted(got, key=key) == sorted(expected, key=key)
    assert all(r["folded"] == r["root"] and r["proof"] == sha("".join(a + b for a, b in r["path"])) for r in checked)
    assert merkle_manifest(df.where("false"), leaf_digest([F.col("text")])).count() == 0


def test_lone_leaf_is_the_root(spark):
    one = merkle_manifest(spark.createDataFrame([("s", 1, "t")], "source string, doc_id int, text string"), leaf_digest([F.col("text")])).first()
    assert one["leaf"] == one["subroot"] == one["root"] == sha("1:t") and one["path"] == []


def test_leaf_digest_frames_fields(spark):
    row = spark.createDataFrame([(None, "", "é", -5)], "a string, b string, c string, d bigint")
    assert row.select(leaf_digest([F.col(c) for c in "abcd"])).first()[0] == sha("-0:2:é2:-5")


def test_sibling_indices(spark):
    at = spark.range(6).select("id", F.array(*sibling_indices(F.col("id"), 3)), F.array(*sibling_indices(F.col("id"), 2)))
    for i, three, two in at.collect():
        assert set(three) == {3 * (i // 3) + k for k in range(3)} - {i} and two == [i ^ 1]


def test_every_changed_text_is_found(spark, sf_dir):
    rows = QUERIES["op12_merkle_manifest"](spark, sf_dir).collect()
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    changed = {i for i, t in texts.items() if zlib.crc32(str(i).encode()) % 2 == 0 and "\n" in (t or "")}
    assert {r["doc_id"] for r in rows if not r["verified"]} == changed and changed
    assert all((r["folded_root"] == r["root"]) == r["verified"] for r in rows)


# --- places in a sorted table -----------------------------------------------


def test_ordered_places_and_sums(spark):
    pick = random.Random(3)
    rows = [(pick.choice([None, "hot", "hot", "hot", "a", "b"]), pick.randrange(9), pick.randrange(5)) for _ in range(700)]
    df = spark.createDataFrame(rows, "g string, o int, x bigint").repartition(7)
    found, groups = ordered(df, "g", ["o", "x"], amount="x")
    by_group = defaultdict(list)
    for r in found.collect():
        by_group[r["g"]].append((r["index"], r["o"], r["x"], r["before"], r["group_rows"], r["group_sum"]))
    names = [None, "a", "b", "hot"]
    assert {r["g"]: r["group_index"] for r in groups.collect()} == {s: k for k, s in enumerate(names)}
    for g, got in by_group.items():
        expected = sorted((o, x) for s, o, x in rows if s == g)
        before = 0
        for i, (row, (o, x)) in enumerate(zip(sorted(got), expected, strict=True)):
            assert row == (i, o, x, before, len(expected), sum(y for _, y in expected))
            before += x


# --- source mix -------------------------------------------------------------


def plain_targets(sizes, weights, share, epochs):
    goal, stopped = share * sum(sizes), set()
    while True:
        rest = goal - sum(epochs * sizes[i] for i in stopped)
        left = sum(w for i, w in enumerate(weights) if i not in stopped)
        parts = {i: rest * w / left for i, w in enumerate(weights) if i not in stopped}
        over = {i for i, p in parts.items() if p > epochs * sizes[i]}
        if not over:
            return [parts.get(i, epochs * sizes[i]) for i in range(len(sizes))]
        stopped |= over


def mix_table(spark, n=400, seed=1):
    pick = random.Random(seed)
    words = lambda k: " ".join("w" for _ in range(k))
    rows = [(i % 390, pick.choice(["hot"] * 6 + ["a", "b", "é", "𝄞", "", None]), words(pick.randrange(12)), "x", 2) for i in range(n)]
    rows += [(None, "a", "p q", "x", 2), (None, "a", "p q", "x", 2), (900, "empty", None, "x", 2), (901, "empty", " ", "x", 2)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, source string, text string, size string, target int")


@pytest.mark.parametrize("share", [1.5, 0.4, 2.0])
def test_mix_takes_its_targets(spark, share):
    rows, df = mix_table(spark)
    found = mix_sources(df, share=share).collect()
    assert len(found) == len(rows)
    names = sorted({r[1] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(len((t or "").split()) for _, s, t, *_ in rows if s == name) for name in names]
    targets = plain_targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(names))], share, 2)
    for name, size, target in zip(names, sizes, targets, strict=True):
        of = [r for r in found if r["source"] == name]
        assert {r["source_size"] for r in of} == {size}
        assert all(r["target"] == pytest.approx(target) for r in of)
        assert sum(r["taken"] for r in of) == int(of[0]["target"])
        assert all(0 <= r["taken"] <= 2 * r["size"] for r in of)
        # One document at most is taken in part.
        assert sum(r["taken"] % r["size"] != 0 for r in of if r["size"]) <= 1
    assert sorted(map(key, found)) == sorted(map(key, mix_sources(df.repartition(5), share=share).collect()))


def test_mix_order_is_random_by_id(spark):
    _, df = mix_table(spark)
    part = mix_sources(df, share=0.3).where("source = 'hot' and size > 0")
    rows = part.withColumn("key", mix_key(F.col("doc_id"))).orderBy("key", "doc_id", "size").collect()
    whole = [r["taken"] == r["size"] for r in rows]
    assert whole == sorted(whole, reverse=True) and True in whole and False in whole
    assert [r["doc_id"] for r in rows] != sorted(r["doc_id"] for r in rows)


def test_mixed_texts_have_the_words_taken(spark):
    _, df = mix_table(spark)
    mix = mix_sources(df, keep=["text"])
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    texts = mixed_texts(mix)
    got = {r[0]: r[1] for r in texts.groupBy("source").agg(F.sum(words)).collect()}
    assert got == {r[0]: r[1] for r in mix.groupBy("source").agg(F.sum("taken")).where("sum(taken) > 0").collect()}
    assert texts.agg(F.max("epoch")).first()[0] == 1


def test_mix_of_odd_tables(spark, odd_docs):
    found = {r["doc_id"]: r["size"] for r in mix_sources(odd_docs).collect()}
    assert found == {1: 0, 2: 0, 3: 0, 4: 30_000, 5: 3, None: 2, 6: 3}
    assert mix_sources(odd_docs.where("doc_id < 0")).count() == 0
    nothing = mix_sources(odd_docs.where("doc_id in (1, 2)")).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in nothing] == [(0, 0.0, 0)] * 2
