"""Archives, search, classifiers, segmentations, components, the pipeline and the SQL comparisons."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from compare import connect, duckdb_rows, spark_rows
from plain import coordinates, plain_ftrl, sigmoid, without_parts
from pyspark.sql import functions as F
from test_documents import assert_packed, plain_components, plain_fingerprint, plain_pieces

import corpus_pipeline
from stoplens.llm import cotraining, lattice, secret_scan, toxicity, warc
from stoplens.llm.components import connected_components
from stoplens.llm.oracles import ORACLES
from stoplens.llm.queries import QUERIES
from stoplens.llm.tables import staged, table
from stoplens.llm.topk import SortedLists, top_k


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duckdb_rows(connect(sf_dir), ORACLES[name])


def test_every_operator_has_a_query():
    assert {x.split("_")[0] for x in QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_components(spark):
    random = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in random.integers(0, 400, (330, 2))] + [(k, k + 1) for k in range(1000, 1060)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    frame = spark.createDataFrame([*edges, (1, None), (7, 7)], "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in connected_components(frame).collect()}
    assert found == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert connected_components(frame.where("a < 0")).count() == 0


# --- top k ------------------------------------------------------------------


def test_sorted_lists_find_the_best_with_ties():
    random = np.random.default_rng(4)
    for kind in (np.int64, np.float64):
        values = random.integers(-3, 4, (300, 6)).astype(kind)
        ids = random.permutation(1000)[:300]
        lists = SortedLists(ids, values)
        for q in [*random.integers(-3, 4, (20, 6)).astype(kind), np.zeros(6, dtype=kind)]:
            found, scores = lists.search(int(ids[5]), q, 5)
            plain = sorted((-float(v @ q), int(i)) for i, v in zip(ids, values, strict=True) if i != ids[5])[:5]
            assert [(-float(s), int(i)) for i, s in zip(found, scores, strict=True)] == plain


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.5, 0.0]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, None), (5, [None, 1.0]), (None, [9.0, 9.0]), (6, [0.5]), (7, [])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = top_k(frame, F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    # The two rows with id 1 are two candidates.
    assert [tuple(r) for r in found] == [(0, 1, 1, 256 * 128), (0, 2, 1, 256 * 128), (0, 3, 6, 256 * 128), (0, 4, 7, 0)]
    assert top_k(frame.where("vec_id = 0"), F.lit(True)).count() == 0
    assert top_k(frame.where("vec_id < 0"), F.lit(True)).count() == 0


def test_rows_that_share_an_id_are_vectors_of_their_own(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.25, 0.0]), (1, [0.5, 0.0]), (1, [0.9, 0.0]), (1, [0.5, 0.0])]
    frame = spark.createDataFrame([(*r, 7, True) for r in rows], "vec_id bigint, embedding array<float>, row int, q boolean")
    found = sorted(tuple(r) for r in top_k(frame, F.col("vec_id") % 50 == 0, k=4).collect())
    of = lambda own, others: [(0, k + 1, i, own * x) for k, (i, x) in enumerate(others)]
    assert found == sorted(of(256, [(1, 230), (1, 128), (1, 128), (0, 64)]) + of(64, [(0, 256), (1, 230), (1, 128), (1, 128)]))


def test_shared_ids_equal_sql(spark, sf_dir, tmp_path):
    table(spark, sf_dir, "embeddings").withColumn("vec_id", F.expr("vec_id DIV 3 * 2")).coalesce(1).write.parquet(f"{tmp_path}/e")
    (part,) = (tmp_path / "e").glob("part-*.parquet")
    part.rename(tmp_path / "embeddings.parquet")
    assert spark_rows(QUERIES["op1_exact_top_k"](spark, str(tmp_path))) == duckdb_rows(connect(str(tmp_path)), ORACLES["op1_exact_top_k"])


# --- archives ---------------------------------------------------------------

PAGES = "page_id bigint, url string, html string, payload string, digest int"


def test_odd_pages_come_back(spark, tmp_path):
    long = "é" * 400_000
    rows = [(1, None, None), (2, "http://a b/\r\nX: y", ""), (3, "u", long), (4, "u", long), (4, "u", long), (None, "u", long), (5, "u", "short"), (6, "u", "short"), (7, "u", "\x00\n\r\n\r\n" + "x" * 200)]
    pages = spark.createDataFrame([(*r, "p", 0) for r in rows], PAGES)
    path = f"file://{tmp_path}/warc"
    warc.write_archives(pages, path, archive_bytes=100_000)
    found = warc.read_archives(spark, path).collect()
    assert not [r["error"] for r in found if r["error"]]
    kinds = Counter((r["record_id"], r["record_type"], r["refers_to_id"]) for r in found)
    urn = lambda x: f"<urn:page:{x}>"
    assert kinds == Counter([(urn(i), "response", None) for i in (1, 2, 3, 5, 6, 7)] + [(urn(i), "revisit", urn(3)) for i in (4, 4, "")])
    payloads = {r["record_id"]: bytes(r["payload"]).decode() for r in found if r["payload"] is not None}
    assert payloads == {urn(i): t or "" for i, _, t in rows if i in (1, 2, 3, 5, 6, 7)}
    assert all(r["payload_bytes"] == len(long.encode()) for r in found if r["record_type"] == "revisit")
    warc.write_archives(pages.where("page_id < 0"), f"{path}-none")
    assert warc.read_archives(spark, f"{path}-none").count() == 0


def archive(*records, dictionary=b"some dictionary text " * 9):
    encoder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    return warc.dictionary_frame(dictionary) + b"".join(map(encoder.compress, records))


def test_faults_are_told():
    import hashlib

    payload = b"payload"
    good = warc.build_record(1, "u", payload, hashlib.sha256(payload).hexdigest(), None)
    errors = lambda data: [r[8] for r in warc.read_records(data)]
    assert errors(archive(good, good)) == [None, None]
    packed = zstandard.ZstdCompressor().compress(b"some dictionary text " * 9)
    assert errors(warc.dictionary_frame(packed) + archive(good)[8 + 21 * 9 :]) == [None]
    cases = {
        "no record header": good.replace(b"WARC/1.1", b"HTTP/1.1"),
        "no WARC-Date": good.replace(b"WARC-Date", b"X-Date"),
        "block of another length": good[:-4],
        "payload of another digest": good.replace(b"payload\r\n\r\n", b"daoylap\r\n\r\n"),
        "payload of another length": good.replace(b"utf-8\r\nContent-Length: 7", b"utf-8\r\nContent-Length: 8"),
        "length that is no number": good.replace(b"utf-8\r\nContent-Length: 7", b"utf-8\r\nContent-Length: x"),
    }
    for said, record in cases.items():
        first, second = errors(archive(record, good))
        assert first.startswith(said) and second is None, said
    assert errors(archive(good)[:-3])[-1].startswith("frame cut short")
    assert errors(archive(good) + b"rubbish")[-1].startswith("no frame")


# --- classifiers ------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = QUERIES["op8_toxicity"](spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert sum(toxic) / len(toxic) > 0.8 and sum(clean) / len(clean) < 0.02
    assert all((r["score"] >= 0.5) == r["predicted"] and 0 <= r["score"] <= 1 for r in rows)


def test_toxicity_of_odd_rows(spark, odd_docs, docs):
    labels = spark.createDataFrame([(k, None, k % 2) for k in range(1, 7)] + [(None, 1, 1), (4, None, None)], "doc_id bigint, quality int, toxic int")
    for some in (labels, labels.where("doc_id < 0")):
        rows = toxicity.score_toxicity(odd_docs, toxicity.fit_toxicity(odd_docs, some)).collect()
        assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in odd_docs.collect())
        assert all(r["score"] is not None for r in rows)
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows if r["doc_id"])
    assert toxicity.score_toxicity(docs(), toxicity.Model(0.0)).count() == 0


def test_toxicity_equals_plain_ftrl(spark, sf_dir):
    """Every score of the query, by a plain FTRL over the same labelled rows in the same order."""
    rows = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in table(spark, sf_dir, "labels").collect()}
    known = [i for i in rows if toxic.get(i) in (0, 1) and zlib.crc32(str(i).encode()) % 5]
    order = spark.createDataFrame([(i,) for i in known], "id bigint").orderBy(F.xxhash64("id"), "id").collect()
    known = [r["id"] for r in order]
    sets = [coordinates(rows[i], toxicity.BITS) for i in known]
    model = plain_ftrl(sets, [toxic[i] for i in known], toxicity.MIN_ROWS, toxicity.PASSES, 2.0, 10.0, 0.1)
    found = {r["doc_id"]: r for r in QUERIES["op8_toxicity"](spark, sf_dir).collect()}
    assert found.keys() == rows.keys() and len(known) > 50
    for i, text in rows.items():
        expected = sigmoid(model.margin(coordinates(text, toxicity.BITS)))
        assert found[i]["score"] == pytest.approx(expected, abs=1e-4)
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_cotraining_equals_one_plain_fit_per_view(spark, sf_dir, monkeypatch):
    """With one shard, each round is a plain fit of each view on the labelled rows and all that the other is sure of."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model, views = cotraining.fit_quality(docs, labels, rounds=1)
    rows = {r["doc_id"]: r for r in views.collect()}
    as_set = lambda x: frozenset(np.frombuffer(x, dtype=np.int32).tolist())
    at = {i: (as_set(r["text_view"]), as_set(r["page_view"])) for i, r in rows.items()}
    quality = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] in (0, 1) and r["doc_id"] in at}
    by_hash = lambda ids: [r["id"] for r in spark.createDataFrame([(i,) for i in ids], "id bigint").orderBy(F.xxhash64("id"), "id").collect()]
    known = by_hash(quality)
    apart, train = [i for i in known if cotraining._is_apart(i)], [i for i in known if not cotraining._is_apart(i)]
    fit = lambda rows, y: plain_ftrl(rows, y, cotraining.MIN_ROWS, 4, 0.5, 2.0, 1.0)
    first = [fit([at[i][k] for i in train], [quality[i] for i in train]) for k in (0, 1)]
    y = np.array([quality[i] for i in apart], dtype=np.float64)
    scale = [cotraining.logistic(np.array([[m.margin(at[i][k])] for i in apart]), y) for k, m in enumerate(first)]
    sure = np.log(cotraining.SURE / (1 - cotraining.SURE))
    added = ([], [])
    for i in by_hash(set(at) - set(known)):
        logits = [a * m.margin(at[i][k]) + b for k, (m, (a, b)) in enumerate(zip(first, scale, strict=True))]
        if logits[0] * logits[1] < 0 and min(map(abs, logits)) >= sure:
            continue
        for k in (0, 1):
            if abs(logits[1 - k]) >= sure:
                added[k].append((i, int(logits[1 - k] > 0)))
    assert added[0] or added[1]
    second = []
    for k in (0, 1):
        some = [*[(at[i][k], quality[i]) for i in train], *[(at[i][k], label) for i, label in added[k]]]
        second.append(fit(*map(list, zip(*some, strict=True))) if added[k] else first[k])
    for k, name in enumerate(("text", "page")):
        ours = getattr(model.views, name)
        dense = ours.dense()
        for i in list(at)[:60]:
            margin = ours.intercept + dense[list(at[i][k])].sum(dtype=np.float64)
            assert margin == pytest.approx(second[k].margin(at[i][k]), abs=2e-3)


def test_toxicity_with_clashing_columns(spark, docs):
    frame = docs(*[(k, "good words here" if k % 2 else "bad words there") for k in range(60)]).withColumns({"id": F.lit(1), "toxic": F.lit(0), "at": F.lit("x")})
    labels = spark.createDataFrame([(k, 1 - k % 2, "t", 0) for k in range(60)], "doc_id bigint, toxic int, text string, id int")
    assert toxicity.score_toxicity(frame, toxicity.fit_toxicity(frame, labels)).count() == 60


def test_l1_leaves_few_weights():
    random = np.random.default_rng(6)
    rows, labels = [], []
    for k in range(600):
        x = set(random.integers(10, 4000, 30).tolist()) | ({3} if k % 3 == 0 else {4})
        rows.append(np.array(sorted(x), dtype=np.int32))
        labels.append(int(k % 3 == 0))
    model = toxicity.ftrl(rows, labels, bits=12)
    weight = dict(zip(model.at.tolist(), model.weights.tolist(), strict=True))
    assert weight[3] > 0 and max(weight, key=weight.get) == 3 and len(weight) < 100


def test_quality_on_rows_not_learned_from(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    apart = toxicity.held_out(F.col("doc_id"))
    model, views = cotraining.fit_quality(docs, labels.where(~apart))
    rows = cotraining.score_quality(views, model).join(labels, "doc_id").where(apart).collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    assert sum(good) / len(good) > 0.98


def test_quality_of_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(k, k % 2, None) for k in range(1, 7)] + [(None, 1, 1)], "doc_id bigint, quality int, toxic int")
    for some in (labels, labels.where("doc_id < 0")):
        model, views = cotraining.fit_quality(odd_docs, some)
        rows = cotraining.score_quality(views, model).collect()
        assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in odd_docs.collect())
        assert all(0 <= r["score"] <= 1 for r in rows)


def test_views_keep_words_that_no_labelled_row_has(docs, spark):
    frame = docs(*((k, f"common words {k % 2}") for k in range(20)), (99, "unheard of"))
    _, views = cotraining.fit_quality(frame, spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id bigint, quality int"))
    row = views.where("doc_id = 99").collect()[0]
    assert np.frombuffer(row["text_view"], dtype=np.int32).tolist() == cotraining.text_view("unheard of").tolist()


def test_all_sure_documents_add_words_that_no_labelled_row_has(spark, monkeypatch):
    random = np.random.default_rng(3)
    rows, labels = [], []
    for k in range(1500):
        good = k % 2
        known = k < 200  # later rows have other words, but the same pages
        words = " ".join(f"{'good' if good else 'bad'}{'a' if known else 'b'}{x}" for x in random.integers(0, 10, 8))
        rows.append((k, words, "en" if good else "xx", "a" if good else "b", 500 if good else 40))
        if known:
            labels.append((k, good))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    monkeypatch.setattr(cotraining, "SHARD", 700)
    model, views = cotraining.fit_quality(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    new = [cotraining._coordinate(f"{kind}b{x}") for kind in ("good", "bad") for x in range(10)]
    weights = model.views.text.dense()[new]
    assert (weights[:10] > 0).all() and (weights[10:] < 0).all()
    given = {"text": [], "page": []}
    counted = cotraining._learned_from(views, model.views, model.calibrations, given)
    passed = [x for x in cotraining._passed_on(model.views, model.calibrations, views.toPandas()) if x[0] == "text"]
    assert len(passed) > 1000 and counted["text"][new].all()


# --- segmentations ----------------------------------------------------------


@pytest.fixture(scope="module")
def words():
    return lattice.known_words(lattice.model_path())


def test_lifted_probabilities_are_those_of_the_pieces(words):
    v = words.v
    assert len(v.lifted) == len(v.pieces) + 1 and v.lifted[-1] == 0
    for i, piece in enumerate(v.pieces):
        length = 1 if v.model.is_byte(i) else len(piece)
        assert v.lifted[i] == pytest.approx(np.exp(v.log_prob[i]) * np.exp(lattice.LIFT * length), rel=1e-12), piece


def all_paths(v, text):
    """Every segmentation with the log of its probability."""
    plain = {p: i for i, p in enumerate(v.pieces) if np.isfinite(v.log_prob[i]) and not v.model.is_byte(i)}
    text, out = v.model.normalize(text), {}

    def on(at, ids, log):
        if at == len(text):
            out[tuple(ids)] = log
        for end in range(at + 1, min(len(text), at + 16) + 1):
            piece = text[at:end]
            if piece in plain:
                on(end, [*ids, plain[piece]], log + v.log_prob[plain[piece]])
            elif end == at + 1:
                spelled = [int(v.byte_ids[b]) for b in piece.encode()]
                on(end, ids + spelled, log + len(spelled) * v.byte_log_prob)

    on(0, [], 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {ids: log - total for ids, log in out.items()}


@pytest.mark.parametrize("text", ["the cat", "añb", "\n a𝄞", "x"])
def test_samples_are_distinct_paths_with_their_probabilities(words, text):
    paths = all_paths(words.v, text)
    for k in (1, 2, 5, 500):
        found = lattice.sample_texts([1], [text], words, k)[0]
        ids = [tuple(x[0].tolist()) for x in found]
        assert len(set(ids)) == len(ids) == min(k, len(paths))
        assert all(math.isclose(paths[i], x[1], abs_tol=1e-4) for i, x in zip(ids, found, strict=True))
        assert all(a[2] >= b[2] for a, b in zip(found, found[1:], strict=False))
        assert all(words.v.decode(i) == text for i in ids)
        assert (found[-1][3] == 0.0) == (k >= len(paths)) or k < len(paths)


def test_samples_follow_the_distribution(words):
    n, text = 20_000, "the cat"
    paths = {i: math.exp(p) for i, p in all_paths(words.v, text).items()}
    first, second = Counter(), Counter()
    for x in lattice.sample_texts(list(range(n)), [text] * n, words, 2):
        first[tuple(x[0][0].tolist())] += 1
        second[tuple(x[1][0].tolist())] += 1
    for i, p in paths.items():
        q = sum(paths[j] * p / (1 - paths[j]) for j in paths if j != i)
        assert abs(first[i] / n - p) < 5 * math.sqrt(p / n) + 1e-4
        assert abs(second[i] / n - q) < 5 * math.sqrt(q / n) + 1e-4


def test_samples_depend_on_their_row_only(words):
    texts = ["one text", "another text, longer", "a third one"]
    together = lattice.sample_texts([1, 2, 3], texts, words, 3)
    words.trim()
    alone = [lattice.sample_texts([k + 1], [t], words, 3)[0] for k, t in enumerate(texts)]
    for a, b in zip(together, alone, strict=True):
        assert [x[0].tolist() for x in a] == [x[0].tolist() for x in b]


def test_words_keep_their_numbers_through_trims(words, monkeypatch):
    letter = lambda x: chr(97 + x % 26)
    texts = [" ".join(letter(i) + letter(k) + letter(i // 26) + letter(k // 26) for i in range(60)) for k in range(40)]
    expected = [lattice.sample_texts([k], [t], words, 2)[0] for k, t in enumerate(texts)]
    monkeypatch.setattr(lattice, "WORDS_KEPT", 200)
    few, trims = lattice.Words(words.v), 0
    for k, t in enumerate(texts):
        held = len(few.index)
        found = lattice.sample_texts([k, k], [t, t], few, 2)
        trims += len(few.index) < held
        assert list(few.index.values()) == list(range(len(few.again))) == list(range(len(few.first)))
        assert all([x[0].tolist() for x in row] == [x[0].tolist() for x in expected[k]] for row in found)
    assert trims > 3


def test_query_decodes_to_the_normalised_text(spark, sf_dir):
    v = lattice.vocabulary(lattice.model_path())
    rows = QUERIES["op9_sentencepiece"](spark, sf_dir).collect()
    plain = lambda t: v.model.normalize(t or "").replace(lattice.SPACE, " ").removeprefix(" ")
    texts = [(r["doc_id"], plain(r["text"])) for r in table(spark, sf_dir, "documents").collect()]
    expected = dict(map(tuple, spark.createDataFrame(texts, "i bigint, t string").select("i", F.xxhash64("t")).collect()))
    assert {r["doc_id"] for r in rows} == set(expected)
    assert all(r["decoded_hash"] == expected[r["doc_id"]] for r in rows)
    found = {(r["doc_id"], r["ids_hash"]) for r in rows}
    assert len(found) == len(rows) and max(r["sample"] for r in rows) == lattice.K


def test_words_of_many_pieces_have_draws_of_their_own(words, monkeypatch):
    """A word of more than 4,096 pieces: no two draws of its samples are the same number."""
    random = np.random.default_rng(9)
    text = "".join(random.choice(list("qxzvjkw"), 9000))
    seen, plain = [], lattice.uniform

    def kept(seed, *counters):
        out = plain(seed, *counters)
        seen.extend(np.atleast_1d(out).tolist())
        return out

    monkeypatch.setattr(lattice, "uniform", kept)
    (samples,) = lattice.sample_texts([1], [text], words)
    assert min(len(s[0]) for s in samples) > 4096 and len(samples) == lattice.K
    assert all(words.v.decode(s[0].tolist()) == text for s in samples)
    assert len(set(seen)) == len(seen)


def test_no_piece_reaches_over_a_word(words):
    text = words.v.model.normalize("It's 12.5 x² a_b (c) ½.")
    assert "".join(words.v.words("It's 12.5 x² a_b (c) ½.")) == text
    assert all(len(lattice.WORD.findall(p)) == 1 for k, p in enumerate(words.v.pieces) if words.v.log_prob[k] > words.v.byte_log_prob)


def test_segmentations_of_odd_rows(odd_docs, docs):
    rows = lattice.sample_segmentations(odd_docs, decode=True).collect()
    model = lattice.vocabulary(lattice.model_path()).model
    texts = Counter((r["doc_id"], model.decode(model.encode(r["text"] or ""))) for r in odd_docs.collect())
    assert Counter((r["doc_id"], r["text"]) for r in rows if r["sample"] == 1) == texts
    assert all(r["sample"] == 1 and r["ids"] == [] for r in rows if r["doc_id"] in (1, 2))
    assert lattice.sample_segmentations(docs()).count() == 0


# --- pipeline ---------------------------------------------------------------


def test_pipeline_stages_keep_columns_and_take_effect(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = [docs.count()]
    frame = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, sf_dir)
        assert frame.columns == docs.columns
        kept.append(frame.count())
    assert kept[0] > kept[1] > kept[2] >= kept[3] == kept[4] > 0
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in frame.collect()}


def test_pipeline_equals_plain_stages(spark, sf_dir):
    """Every stage against a plain version over all of its input: rows kept, texts and pieces."""
    encode = secret_scan.encoding(secret_scan.vocabulary_path()).encode_ordinary

    def texts(frame):
        return {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}

    cursor = connect(sf_dir).execute(f"SELECT doc_id, kept FROM ({ORACLES['op6_quality_rules']})")
    frame = table(spark, sf_dir, "documents")
    plain = texts(frame)
    plain = {i: plain[i] for i, kept in cursor.fetchall() if kept}
    groups = plain_components([(i, plain_fingerprint(t)) for i, t in plain.items()])
    steps = [
        lambda x: x,
        lambda x: {i: x[i] for i, _, least in groups if i == least},
        lambda x: without_parts(list(x.items())),
        lambda x: {i: redact_plain(t, secret_scan.find_spans(t, encode)) for i, t in x.items()},
    ]
    for (name, stage), step in zip(corpus_pipeline.STAGES[:-1], steps, strict=True):
        frame, plain = staged(stage(spark, frame, sf_dir), "plain-stage"), step(plain)
        found = texts(frame)
        assert found.keys() == plain.keys(), name
        assert sum(found[i] == plain[i] for i in plain) >= (0.98 if name == "substring dedup" else 1) * len(plain), name
        plain = found
    rows = corpus_pipeline.STAGES[-1][1](spark, frame, sf_dir).collect()
    pieces = sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    assert pieces == sorted(plain_pieces(plain.items()))
    assert assert_packed(rows, 4096) <= 1.02 * sum(r["length"] for r in rows) / 4096 + 1


def redact_plain(text, spans):
    """Each covered stretch as one placeholder, by code points; stretches that only touch are two."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda x: x[1:]):
        if start >= at:
            out += [text[at:start], secret_scan.PLACEHOLDER]
        at = max(at, end)
    return "".join([*out, text[at:]])


def test_pipeline_on_an_empty_table(spark, docs):
    frame = docs()
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, "")
    assert frame.count() == 0
