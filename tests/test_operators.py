import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stoplens.operators import (
    changes,
    collapse_routes,
    contract_violations,
    keep_first,
    latest_windows,
    line_stats,
    match_routes,
    realtime_rows,
    window_stats,
)
from stoplens.operators.routes import match_by_index, text_bytes
from workload.fixtures import named_passages, named_routes, passages, routes


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- de-duplication ---------------------------------------------------------


def test_keep_first_is_chosen_by_order(spark):
    df = spark.createDataFrame(
        [("a", 1, "late", 9), ("a", 1, "early", 2), (None, 1, "n2", 5), (None, 1, "n1", 4), ("a", 2, "x", 1)],
        "id string, stamp int, v string, gid int",
    )
    kept = keep_first(df, ["id", "stamp"], ["gid"]).select("v").collect()
    assert sorted(r[0] for r in kept) == ["early", "n1", "x"]


def test_keep_first_limits_groups_before_the_shuffle(spark, sf_dir, plan):
    text = plan(keep_first(passages(spark, sf_dir), ["id", "last_update_fme"], ["gid"]))
    before_shuffle = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle
    assert text.count("Exchange") == 1


def test_dedup_comes_before_the_live_filter(spark):
    df = spark.createDataFrame(
        [("a", "s", 1, "T", "3 min", "L", "D"), ("a", "s", 2, "E", "4 min", "L", "D"), ("b", "s", 3, "E", "5 min", "L", "D")],
        "id string, last_update_fme string, gid int, type string, delaipassage string, ligne string, direction string",
    )
    stats = line_stats(df).first()
    assert (stats["attente_moyenne_min"], stats["total_enregistrements"]) == (5.0, 1)
    assert stats["ecart_type_attente"] == 0.0
    kept = realtime_rows(keep_first(df, ["id", "last_update_fme"], ["gid"]))
    assert [r["id"] for r in kept.collect()] == ["b"]


def test_ties_of_the_order_do_not_change_the_result(spark):
    pair = [("a", "s", 1, "E", wait, "L", "D") for wait in ("3 min", "9 min")]
    columns = "id string, last_update_fme string, gid int, type string, delaipassage string, ligne string, direction string"
    means = {
        line_stats(spark.createDataFrame(items, columns)).first()["attente_moyenne_min"]
        for items in (pair, pair[::-1])
    }
    assert means == {3.0}


def test_line_stats_shuffles_a_number_not_the_texts(spark, sf_dir, plan):
    text = plan(line_stats(passages(spark, sf_dir)))
    assert text.count("Exchange hashpartitioning") == 2
    shuffled = text[: text.rindex("Exchange hashpartitioning")]
    assert "delaipassage" not in shuffled and "type#" not in shuffled


# --- routes -----------------------------------------------------------------


def test_match_routes_forms_agree(spark, sf_dir, plan):
    feed = passages(spark, sf_dir)
    small = match_routes(feed, routes(spark))
    large = match_routes(feed, routes(spark), max_broadcast_bytes=0, salts=3)
    assert "BroadcastHashJoin" in plan(small)
    assert "SortMergeJoin" in plan(large) and "Broadcast" not in plan(large)
    assert rows(small) == rows(large)


def test_match_routes_cases(spark):
    df = spark.createDataFrame(
        [(1, "C3", "Gare Part-Dieu"), (2, "T1", "Bellecour"), (3, None, "Gare"), (4, "C3", None), (5, "ZZ", "Gare")],
        "gid int, ligne string, direction string",
    )
    found = sorted((r["gid"], r["route_code"]) for r in match_routes(df, routes(spark)).collect() if r["route_code"])
    assert found == [(1, "c3a"), (1, "c3b")]
    assert match_routes(df, routes(spark)).count() == 6


def test_match_by_index_equals_brute_force(spark):
    pick = random.Random(8)
    text = lambda n: "".join(pick.choice("ab ") for _ in range(n))
    names = [None, "", *[text(pick.choice([1, 2, 3, 7, 8, 9, 12, 55])) for _ in range(60)]]
    table = [(pick.choice([None, "hot", "hot", "L"]), f"c{k}", name, "", "", "", "") for k, name in enumerate(names)]
    ways = [None, "", *[text(pick.choice([3, 8, 20, 70])) for _ in range(20)], *[f"x{n}y" for n in names if n]]
    feed = [(k, pick.choice([None, "hot", "hot", "hot", "L", "M"]), pick.choice(ways)) for k in range(300)]
    df = spark.createDataFrame(feed, "gid int, ligne string, direction string")
    kinds = "ligne string, code_trace string, nom_trace string, sens string, nom_origine string, nom_destination string, pmr string"
    found = match_by_index(df, spark.createDataFrame(table, kinds), salts=3)
    expected = []
    for gid, line, way in feed:
        codes = [r[1] for r in table if None not in (line, way, r[2]) and r[0] == line and r[2][:50] in way]
        expected += [(gid, code) for code in codes or [None]]
    assert sorted(map(repr, map(tuple, found.select("gid", "route_code").collect()))) == sorted(map(repr, expected))
    none = match_by_index(df, spark.createDataFrame([], kinds))
    assert none.where("route_code is null").count() == len(feed)


def test_index_joins_by_equalities_only(spark, sf_dir, plan):
    text = plan(match_by_index(named_passages(spark, sf_dir), named_routes(spark, sf_dir)))
    assert "NestedLoop" not in text and "Cartesian" not in text
    joins = [x for x in text.splitlines() if "Join " in x and "_gram" in x]
    assert len(joins) == 1 and "ligne" in joins[0]


ROUTE_KINDS = "ligne string, code_trace string, nom_trace string, sens string, nom_origine string, nom_destination string, pmr string"


def test_names_that_start_alike_are_looked_up_whole(spark, plan):
    names = [f"Terminus {k:04d}" for k in range(200)] + ["Terminus 00", "Terminus 0007 Nord", "Terminus 0007 Nord", "Term", "us 00", ""]
    table = spark.createDataFrame([("C7", f"c{k}", n, "", "", "", "") for k, n in enumerate(names)], ROUTE_KINDS)
    ways = [f"Vers Terminus {k:04d} Nord Term" for k in range(200)] + ["Terminus 0003", "Terminus 0", "", None, *["Vers Terminus 0007 Nord"] * 40]
    feed = [(k, line, way) for k, (line, way) in enumerate((x, w) for x in ("C7", "93", None) for w in ways)]
    df = spark.createDataFrame(feed, "gid int, ligne string, direction string")
    assert "Contains(" not in plan(match_by_index(df, table))  # no pair meets the names that only start alike
    found = match_by_index(df, table, salts=3, busy=20)
    expected = []
    for gid, line, way in feed:
        codes = [f"c{k}" for k, n in enumerate(names) if line == "C7" and way is not None and n in way]
        expected += [(gid, code) for code in codes or [None]]
    assert sorted(map(repr, map(tuple, found.select("gid", "route_code").collect()))) == sorted(map(repr, expected))


def test_index_with_more_starts_than_are_listed(spark, monkeypatch):
    monkeypatch.setattr("stoplens.operators.routes.MAX_STARTS", 3)
    names = ["abcdefghij", "bcdefghijk", "cd", "x", "yz1"]
    table = spark.createDataFrame([("L", n, n, "", "", "", "") for n in names], ROUTE_KINDS)
    df = spark.createDataFrame([("L", "abcdefghijk"), ("L", "xyz"), ("L", "yz1")], "ligne string, direction string")
    found = match_by_index(df, table, salts=2)
    assert rows(found.select("direction", "route_code")) == [
        ("abcdefghijk", "abcdefghij"), ("abcdefghijk", "bcdefghijk"), ("abcdefghijk", "cd"), ("xyz", "x"), ("yz1", "yz1"),
    ]


def test_route_name_is_compared_by_its_first_characters(spark):
    name = "x" * 50
    table = routes(spark).limit(0).unionByName(
        spark.createDataFrame([("L", "c", name + "tail", "", "", "", "")], routes(spark).schema)
    )
    df = spark.createDataFrame([("L", name), ("L", name[:-1])], "ligne string, direction string")
    assert [r["route_code"] for r in match_routes(df, table).orderBy("direction").collect()] == [None, "c"]


def test_text_bytes_counts_every_field(spark):
    df = spark.createDataFrame([("abc", None), ("é", "z")], "a string, b string")
    assert text_bytes(df) == 3 + 0 + 2 + 1 + 4 * 16
    assert text_bytes(df.limit(0)) == 0


# --- window statistics ------------------------------------------------------


def test_window_stats_shuffles_once(spark, sf_dir, plan):
    text = plan(window_stats(passages(spark, sf_dir), routes(spark)))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("BroadcastExchange") == 1
    assert "event_id" not in text


def test_window_stats_equals_join_then_group(spark, sf_dir):
    from stoplens.functions import delay_minutes

    feed = passages(spark, sf_dir)
    joined = match_routes(feed.withColumn("w", delay_minutes("delaipassage")), routes(spark))
    direct = joined.groupBy(
        F.window("heurepassage", "10 minutes").start.alias("window_ts"), "ligne", "direction", "route_code", "pmr"
    ).agg(F.count("*"), F.avg("w"), F.count_if(F.col("type") == "E"))
    assert rows(window_stats(feed, routes(spark))) == rows(direct)


def test_routes_sharing_code_are_counted_together(spark):
    twice = spark.createDataFrame(
        [("L", "c", "Ga", "", "", "", "y"), ("L", "c", "Gare", "", "", "", "y")], routes(spark).schema
    )
    feed = spark.sql(
        "SELECT 'L' AS ligne, 'Gare' AS direction, timestamp'2024-01-01 00:01:00' AS heurepassage, "
        "'4 min' AS delaipassage, 'E' AS type"
    )
    found = window_stats(feed, twice).collect()
    assert [(r["total_passages"], r["avg_delay_min"], r["realtime_count"]) for r in found] == [(2, 4.0, 2)]


def test_collapse_and_latest_pick_one_row(spark, sf_dir):
    stats = window_stats(passages(spark, sf_dir), routes(spark))
    keys = ["window_ts", "ligne", "direction"]
    assert collapse_routes(stats).count() == stats.select(*keys).distinct().count()
    assert latest_windows(stats).count() == stats.select("ligne", "direction").distinct().count()


def test_contract_violations_report_both_kinds(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1), ("b", 1), ("b", 1)], "k string, w int")
    found = rows(contract_violations(df, ["k", "w"], required=["k"]))
    assert found == sorted(
        [("null_key", None, 1, 2), ("duplicate_key", None, 1, 2), ("duplicate_key", "b", 1, 2)], key=repr
    )


# --- changes ----------------------------------------------------------------


def brute_changes(items):
    """(gid, id, value) in order of gid and value, one dictionary of last values."""
    last, found = {}, []
    for gid, key, value in sorted(items, key=lambda i: (i[0], i[2] is not None, i[2] or "")):
        if key not in last:
            found.append(("NEW", key, gid, None, value))
        elif last[key] != value:
            found.append(("UPDATE", key, gid, last[key], value))
        last[key] = value
    return sorted(found, key=repr)


def change_rows(spark, items, **options):
    df = spark.createDataFrame(items, "gid bigint, id string, delaipassage string")
    return rows(changes(df, carry=(), **options).select("event", "id", "gid", "old_value", "new_value"))


KEYS = st.sampled_from([None, "a", "b"])
VALUES = st.sampled_from([None, "None", "1 min", "2 min"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(KEYS, VALUES), min_size=1, max_size=40), st.sampled_from([4, 1_000_000]))
def test_changes_equal_brute_force(spark, pairs, hot_rows):
    # Two neighbours share each place in the order.
    items = [(at // 2, key, value) for at, (key, value) in enumerate(pairs)]
    assert change_rows(spark, items, hot_rows=hot_rows) == brute_changes(items)


@pytest.mark.parametrize("hot", [None, "busy"])
def test_changes_with_a_hot_key_bunched_in_time(spark, hot):
    rng = random.Random(7)
    items = []
    for gid in range(3000):
        # Most rows of the hot key fall in a narrow band of the order.
        key = hot if gid < 1200 or rng.random() < 0.01 else f"k{rng.randrange(400)}"
        items.append((gid if gid < 1200 else gid * 1000, key, rng.choice([None, "1 min", "2 min"])))
    rng.shuffle(items)
    assert change_rows(spark, items, hot_rows=100) == brute_changes(items)


def test_hot_keys_are_split_over_tasks(spark, plan):
    df = spark.range(4000).selectExpr("id AS gid", "if(id % 4 = 0, CAST(id AS string), 'busy') AS id", "CAST(id % 3 AS string) AS delaipassage")
    found = changes(df, carry=(), hot_rows=500)
    assert found.count() > 3900
    text = plan(found)
    assert "BroadcastNestedLoopJoin" not in text and "Cartesian" not in text
