"""Substring dedup: planted passages, exact similarities, cuts."""

import numpy as np
import pytest

from plain import near_classes, repeated_parts, without_parts

from stoplens.llm import paragraphs as P
from stoplens.llm.queries import QUERIES
from stoplens.llm.tables import table

RANDOM = np.random.default_rng(11)
VOCABULARY = [f"w{k}" for k in range(5000)]


def sentence(n):
    return " ".join(RANDOM.choice(VOCABULARY, n)).capitalize() + "."


def prose(words):
    return " ".join(sentence(8) for _ in range(words // 8))


PASSAGE = prose(72)
LINE = prose(80)


def edited(text, k):
    words = text.split()
    words[k] = "changed"
    return " ".join(words)


def test_planted_passages_are_found_and_clean_texts_are_not(docs):
    texts = [
        f"{prose(40)}\n{PASSAGE}\n{prose(24)}",
        f"{prose(40)} {PASSAGE} {prose(40)}",  # in the middle of a line
        prose(160),
        f"{prose(24)}\n{LINE}",
        f"{edited(LINE, 41)}\n{prose(24)}",  # nearly the same line
        f"{prose(16)}\nA stock phrase of six words.",
        f"A stock phrase of six words.\n{prose(16)}",
        None,
        "",
    ]
    frame = docs(*enumerate(texts))
    rows = P.repeated_paragraphs(frame).collect()
    assert {r["doc_id"] for r in rows} == {0, 1, 3, 4}
    assert {(r["doc_id"], r["kept_doc_id"]) for r in rows if r["removed"]} == {(1, 0), (4, 3)}
    kept = {r["doc_id"]: r for r in P.without_repeats(frame).collect()}
    assert P.without_repeats(frame).columns == frame.columns
    assert PASSAGE not in kept[1]["text"] and kept[0]["text"] == texts[0]
    assert "changed" not in kept[4]["text"] and kept[3]["text"] == texts[3]
    assert all(kept[k]["text"] == texts[k] for k in (2, 5, 6, 7, 8))
    assert kept[1]["n_chars"] == len(kept[1]["text"])


def test_whole_copies_go(docs):
    text = f"{PASSAGE}\n{LINE}"
    rows = P.without_repeats(docs((1, text), (2, text), (3, prose(64)))).collect()
    assert sorted(r["doc_id"] for r in rows) == [1, 3]


def test_odd_rows(odd_docs, docs):
    kept = P.without_repeats(odd_docs)
    assert kept.columns == odd_docs.columns
    # The very long text repeats itself.
    assert sorted(str(r["text"])[:20] for r in kept.collect()) == sorted(str(r["text"])[:20] for r in odd_docs.collect())
    assert P.without_repeats(docs()).count() == 0


def test_links_of_large_clusters_connect_what_pairs_connect(spark, monkeypatch):
    sets = []
    base = RANDOM.integers(0, 1 << 60, 40).astype(np.uint64)
    for _ in range(60):
        x = base.copy()
        x[RANDOM.integers(0, 40, RANDOM.integers(0, 9))] = RANDOM.integers(0, 1 << 60, 1)[0]
        sets.append(np.unique(np.concatenate((x, RANDOM.integers(0, 50, 2).astype(np.uint64)))))
    jaccard = lambda a, b: len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    near = np.array([[jaccard(a, b) >= 0.8 for b in sets] for a in sets])
    assert (P.similar(sets, sets, 0.8) == near).all()
    frame = spark.createDataFrame([(1, k, 1 + k % 3, bytearray(s.tobytes())) for k, s in enumerate(sets)], "cluster bigint, pid bigint, copies bigint, shingles binary")

    def groups(links):
        parent = list(range(len(sets)))

        def root(x):
            return x if parent[x] == x else root(parent[x])

        for a, b in links:
            parent[root(a)] = root(b)
        return [root(k) == root(j) for k in range(len(sets)) for j in range(len(sets))]

    plain = groups([(a, b) for a in range(60) for b in range(60) if near[a, b]])
    for block in (7, 25, 512):
        monkeypatch.setattr(P, "BLOCK", block)
        links = [tuple(r) for r in P.verified_links(frame).collect()]
        assert all(near[a, b] for a, b in links)
        assert groups(links) == plain


def test_bands_reach_the_recall():
    bands = P.tune_bands(0.8, 0.99, 4)
    assert 1 - (1 - 0.8**4) ** bands >= 0.99 > 1 - (1 - 0.8**4) ** (bands - 1)


@pytest.mark.parametrize(
    ("text", "spans", "left"),
    [
        ("ab cd. ef", [(0, 6)], "ef"),
        ("ab\ncd\nef", [(3, 2)], "ab\nef"),
        ("ab cd\nef", [(3, 2)], "ab \nef"),
        ("ab cd", [(3, 2)], "ab "),
        ("ab", [(0, 2)], ""),
        (None, None, None),
    ],
)
def test_cuts(text, spans, left):
    found = None if spans is None else [{"start": a, "length": n} for a, n in spans]
    assert P.cut_text(text, found) == left


def removed_texts(frame):
    texts = {r["doc_id"]: r["text"] for r in frame.collect()}
    rows = [r for r in P.repeated_paragraphs(frame).collect() if r["removed"]]
    rows = sorted((r["doc_id"], r["start"], r["length"]) for r in rows)
    return [(k, texts[k][start : start + n]) for k, start, n in rows]


def test_passages_cut_inside_sentences_and_short_near_lines_are_found(docs):
    inner = " ".join(RANDOM.choice(VOCABULARY, 30)) + ". " + " ".join(RANDOM.choice(VOCABULARY, 30))
    line = " ".join(RANDOM.choice(VOCABULARY, 20))
    frame = docs(
        (1, f"{sentence(20)[:-1]} {inner} {sentence(20)}"),
        (2, f"{sentence(20)[:-1]} {inner} {sentence(20)}"),
        (3, f"{prose(40)}\n{line} end\n{prose(40)}"),
        (4, f"{prose(40)}\n{line} stop\n{prose(40)}"),
    )
    found = removed_texts(frame)
    assert " ".join(t for k, t in found if k == 2) == inner
    assert [t for k, t in found if k == 4] == [f"{line} stop"]


def test_words_of_the_first_occurrence_stay_where_a_text_repeats_itself(docs):
    rows = P.without_repeats(docs((1, "na " * 500))).collect()
    assert [r["text"].split() for r in rows] == [["na"] * P.PASSAGE]


def test_unpunctuated_passages_and_edited_sentences_are_found(docs):
    inner = " ".join(RANDOM.choice(VOCABULARY, 60))
    sentences = [sentence(60) for _ in range(2)]
    changed = [edited(x, 30 + 5 * k) for k, x in enumerate(sentences)]
    plain = lambda n: " ".join(RANDOM.choice(VOCABULARY, n))
    frame = docs(
        (1, f"{plain(40)} {inner} {plain(40)}"),
        (2, f"{plain(40)} {inner} {plain(40)}"),
        (3, f"{prose(120)} {' '.join(sentences)} {prose(40)}"),
        (4, f"{prose(120)} {' '.join(changed)} {prose(40)}"),
        (5, "One. Two three four five six. " + plain(60)),  # a unit is not compared with its own line
    )
    assert removed_texts(frame) == [(2, inner), *((4, x) for x in changed)]


def test_rows_that_share_an_id_or_have_none_take_part(docs):
    mine, others = prose(64), [prose(40) for _ in range(6)]
    frame = docs(
        (-3, f"{others[0]} {PASSAGE}"),
        (7, f"{others[1]} {PASSAGE}"),
        (7, f"{others[2]} {PASSAGE}"),
        (7, f"{others[2]} {PASSAGE}"),
        (None, f"{others[3]} {PASSAGE}"),
        (None, f"{others[4]} {mine}"),
        (9, f"{others[5]} {mine}"),
    )
    found = [(r["doc_id"], r["kept_doc_id"]) for r in P.repeated_paragraphs(frame).collect() if r["removed"]]
    assert set(found) == {(7, -3), (7, 7), (None, -3), (None, 9)}
    left = sorted((str(r["doc_id"]), r["text"].strip()) for r in P.without_repeats(frame).collect())
    # Of the two equal rows with id 7 nothing is left of one.
    assert left == sorted(
        [("-3", f"{others[0]} {PASSAGE}"), ("7", others[1]), ("7", others[2]), ("None", others[3]), ("None", others[4]), ("9", f"{others[5]} {mine}")]
    )


# --- against plain versions -------------------------------------------------


def whole_rows(frame):
    names = ("doc_id", "para", "unit", "start", "length", "words", "kept_doc_id", "removed")
    return sorted(tuple(r[c] for c in names) for r in frame.collect())


def test_query_equals_all_pairs(spark, sf_dir):
    docs = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    expected, found = repeated_parts(docs), whole_rows(QUERIES["op3_substring_dedup"](spark, sf_dir))
    assert len(set(found) & set(expected)) >= 0.98 * max(len(found), len(expected)) > 100
    left = {r["doc_id"]: r["text"] for r in P.without_repeats(table(spark, sf_dir, "documents")).collect()}
    plain = without_parts(docs)
    assert sum(left.get(i) == plain.get(i) for i, _ in docs) >= 0.98 * len(docs)


def test_exact_and_near_lines_follow_one_rule(docs):
    """A line counts on its own from MIN_LINE words on, be its copies exact or not."""
    rows, wanted, n = [], set(), 0
    for words in (5, 8, 12, 13, 15, 20, 30, 34, 35, 60):
        for near in (False, True):
            line = " ".join(RANDOM.choice(VOCABULARY, words))
            rows += [(n, f"{prose(24)}\n{line}\n{prose(24)}"), (n + 1, f"{prose(24)}\n{line}{' more' * near}\n{prose(24)}")]
            if words >= P.MIN_LINE:
                wanted.add(n + 1)
            n += 2
    frame = docs(*rows)
    assert {r["doc_id"] for r in P.repeated_paragraphs(frame).collect() if r["removed"]} == wanted
    assert whole_rows(P.repeated_paragraphs(frame)) == repeated_parts(rows)


def test_scripts_without_spaces(docs):
    han = "".join(chr(0x4E00 + int(k)) for k in RANDOM.integers(0, 3000, 200))
    thai = "".join(chr(0x0E01 + int(k)) for k in RANDOM.integers(0, 40, 200))
    endless = "".join(chr(97 + int(k)) for k in RANDOM.integers(0, 26, 560))
    stops = "\u3002".join("".join(chr(0x4E00 + int(k)) for k in RANDOM.integers(0, 3000, 12)) for _ in range(8))
    rows = []
    for k, text in enumerate((han, thai, endless, stops)):
        rows += [(2 * k, f"{prose(16)}\nx {text}"), (2 * k + 1, f"ab{text[:0]} {text}\n{prose(16)}")]
    rows += [(20, "語" * 30), (21, "短い文章です"), (22, "短い文章です")]
    found = whole_rows(P.repeated_paragraphs(docs(*rows)))
    assert found == repeated_parts(rows)
    assert {r[0] for r in found if r[-1]} == {1, 3, 5, 7}
    left = {r["doc_id"]: r["text"] for r in P.without_repeats(docs(*rows)).collect()}
    assert all(t not in left[2 * k + 1] for k, t in enumerate((han, thai, endless, stops)))


def test_words_and_spans_agree():
    text = "Ab c\u3002d語e. f" + "x" * 300 + " İ\u00a0y\n" + "z" * 201 + "語" * 3 + "\u0e01\u0e02 q."
    spans = P.token_spans(text)
    assert [text[a:b].lower() for a, b in spans] == P.cut_words(text)
    units = [w for _, _, line in P.lines_of(text) for u in P.units_of(line) for w in u[2]]
    assert units == P.cut_words(text)
    assert P.plain_spans(text).tolist() == [list(m.span()) for m in P.TOKEN.finditer(text)]
    white = "".join(chr(c) for c in range(0x3100)) + "\U0001f600 x"
    assert P.plain_spans(white).tolist() == [list(m.span()) for m in P.TOKEN.finditer(white)]
    assert P.splitter("plain words here") is P.split_words and P.splitter(text) is P.cut_words


def test_wide_hashes_depend_on_their_words_only():
    words = RANDOM.integers(0, 1 << 63, 300).astype(np.uint64)
    there = np.concatenate((RANDOM.integers(0, 1 << 63, 77).astype(np.uint64), words))
    assert (P.window_hashes(words, 50) == P.window_hashes(there, 50)[77:]).all()
    grams, at = P.anchors_of(words)
    wide = P.PASSAGE - P.GRAM + 1
    assert at.tolist() == [i + int(grams[i : i + wide].argmin()) for i in range(len(grams) - wide + 1)]
    sizes = np.array([3, 1, 40, 256])
    parts = np.split(words, np.cumsum(sizes)[:-1])
    assert P.digests(words, sizes).tolist() == [int(P.digests(x, np.array([len(x)]))[0]) for x in parts]


def test_links_of_keys_reach_across_partitions(spark):
    from stoplens.llm.components import connected_components

    rows = [(k % 3 if k % 5 else 0, k % 211) for k in range(2000)] + [(100 + k, 5000 + k) for k in range(300)]
    keyed = spark.createDataFrame(rows, "key bigint, pid bigint")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        links = P.key_links(keyed)
        assert all(a != b for a, b in links.collect())
        assert {r["component"] for r in connected_components(links).collect()} == {0}
        assert connected_components(links).count() == 211
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_planted_near_lines_are_all_found(docs):
    """Recall of the bands on lines at and above the threshold."""
    rows = []
    for k in range(60):
        line = RANDOM.choice(VOCABULARY, 60).tolist()
        other = line.copy()
        other[30] = "changed"  # 51 of 61 shingles: 0.836
        rows += [(2 * k, " ".join(line)), (2 * k + 1, " ".join(other))]
    assert len(near_classes([tuple(t.split()) for _, t in rows])) == 120
    found = {r["doc_id"] for r in P.repeated_paragraphs(docs(*rows)).collect() if r["removed"]}
    assert len(found) >= 57


def test_hashes_and_units_of_many_texts_are_those_of_each():
    import xxhash

    signs = "abc.!? \n\t  \x85\x1c ÉİΣß\U0001f600"
    for t in range(200):
        texts = ["".join(RANDOM.choice(list(signs), RANDOM.integers(0, 300))) for _ in range(3)]
        texts += [None, "", "x" * 200 + " " + "É" * (199 + t % 3) + " a"]
        texts.insert(t % 4, "語a。b c. d" * (t % 2))
        texts = texts[: t % 4 + 1] if t % 9 == 0 else texts
        texts = ["語a。b c. d"] if t == 1 else texts
        hashes, sizes = P.text_hashes(texts)
        words = [P.cut_words(x or "") for x in texts]
        assert sizes.tolist() == [len(w) for w in words]
        assert hashes.tolist() == [xxhash.xxh64_intdigest(w) for some in words for w in some]
        plain, found, others = P.plain_and_others(texts)
        units = [[len(u[2]) for _, _, line in P.lines_of(x) for u in P.units_of(line)] for x in texts]
        assert np.diff(found.cuts()[1], append=len(found.starts)).tolist() == [n for k in plain for n in units[k]]
        assert sorted(plain + others) == list(range(len(texts)))
        assert [P.places_of(x)[2].tolist() for x in texts if x and x.strip()] == [u for x, u in zip(texts, units) if x and x.strip()]


def test_band_keys_leave_the_hashing_in_few_rows(spark, docs):
    frame = P._told_apart(docs(*((k, prose(400)) for k in range(60)))).select("doc_id", "text")
    rows = P.occurrences(frame, 9, 7).where("bucket IS NOT NULL").select("bucket", "pairs").collect()
    keys = sum(len(r["pairs"]) // 16 for r in rows if r["bucket"] >= 0)
    assert keys > 60 * 50 * 7  # a key a row before
    buckets = P.BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(rows) <= buckets * frame.rdd.getNumPartitions()
    assert len({r["bucket"] for r in rows}) > 0.9 * min(buckets, keys / 10)


def test_pids_of_a_common_key_become_links_at_once():
    pairs = P.Pairs(64)
    pids = np.arange(5000, dtype=np.uint64)
    pairs.add(np.full(5000, 7 << 50, dtype=np.uint64), pids)
    pairs.add(pids << np.uint64(40), pids)
    rows = pairs.rows().to_pylist()
    links = [np.frombuffer(r["pairs"], dtype=np.int64).reshape(2, -1) for r in rows if r["bucket"] < 0]
    assert len({*np.concatenate(links, axis=1).ravel().tolist()}) == 5000
    assert sum(len(r["pairs"]) // 16 for r in rows if r["bucket"] >= 0) == 5001
