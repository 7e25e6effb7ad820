import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from pitchgrain.operators.choose import keep_one, nulls_last, share_of_total, where_in
from pitchgrain.operators.intervals import interval_lookup, interval_minutes, state_timeline
from pitchgrain.operators.merge import merge_latest, replace_scope
from pitchgrain.operators.neighbour import with_neighbour
from pitchgrain.operators.scope import Scope, resolve_matches
from pitchgrain.operators.sides import unpivot_sides
from pitchgrain.operators.skew import spread_join


def test_keep_one_orders_nulls_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 3, 3), ("b", None, 4)], "k string, o int, v int")
    assert sorted(rows(keep_one(df, ["k"], nulls_last(F.col("o"))))) == [("a", 3, 3), ("b", None, 4)]


def test_where_in_short_and_long(spark):
    df = spark.range(5000).select(F.col("id").alias("x"))
    assert where_in(df, "x", None).count() == 5000
    assert where_in(df, "x", [1, 2, 2, 9999]).count() == 2
    assert where_in(df, "x", list(range(0, 4000, 2))).count() == 2000
    assert where_in(df, "x", []).count() == 0


def test_share_of_total(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), ("c",)], "t string")
    assert rows(share_of_total(df, "t", 2)) == [("a", 2, 50.0), ("b", 1, 25.0)]


@pytest.mark.parametrize("ahead", [False, True])
@pytest.mark.parametrize("bits", [1, 2, 4, 16])
def test_with_neighbour_equals_a_plain_window(spark, ahead, bits):
    rng = random.Random(bits)
    data = [(g, i, rng.choice(["x", "y", None])) for g in range(3) for i in rng.sample(range(-40, 200), 60)]
    data += [(9, 7, "alone")]
    df = spark.createDataFrame(data, "g int, i bigint, v string")
    w = Window.partitionBy("g").orderBy("i")
    step = F.lead if ahead else F.lag
    want = sorted(map(repr, rows(df.withColumn("n", step("v").over(w)))))
    got = sorted(map(repr, rows(with_neighbour(df, ["g"], "i", {"n": "v"}, ahead, bits))))
    assert got == want


@pytest.mark.parametrize("ahead", [False, True])
def test_with_neighbour_over_a_sparse_order(spark, ahead):
    """Edges handed on through stretches of stretches, null keys and null values between."""
    rng = random.Random(4)
    data = [(rng.choice([1, None]), i, rng.choice(["x", "y", None])) for i in rng.sample(range(-(2**40), 2**40), 300)]
    df = spark.createDataFrame(data, "g int, i bigint, v string")
    w = Window.partitionBy("g").orderBy("i")
    step = F.lead if ahead else F.lag
    want = sorted(map(repr, rows(df.withColumn("n", step("v").over(w)))))
    assert sorted(map(repr, rows(with_neighbour(df, ["g"], "i", {"n": "v"}, ahead, 12, levels=3)))) == want


def test_spread_join_keeps_every_row_of_a_hot_key(spark):
    large = spark.createDataFrame([(1 if i % 3 else 2, i) for i in range(300)], "k int, i int")
    lookup = spark.createDataFrame([(1, "one"), (3, "three")], "k int, name string")
    inner = spread_join(large, lookup, ["k"], ["i"])
    left = spread_join(large, lookup, ["k"], ["i"], "left")
    assert inner.count() == 200 and left.count() == 300
    assert left.filter("name is null").count() == 100


def test_interval_minutes(spark):
    df = spark.createDataFrame(
        [(0, 45, 95), (60, None, 95), (None, 40, 95), (50, 40, 95), (96, None, 95)], "a int, b int, m int"
    )
    out = [r[0] for r in rows(df.select(interval_minutes(F.col("a"), F.col("b"), F.col("m"))))]
    assert out == [45, 35, 0, 0, 0]


def timeline(spark, reports):
    df = spark.createDataFrame(reports, "m int, i bigint, minute int, code string")
    return sorted(rows(state_timeline(df, ["m"], "i", "minute", "code")), key=repr)


def test_state_timeline(spark):
    # a repeated report is dropped
    assert timeline(spark, [(1, 1, 0, "A"), (1, 2, 10, "A"), (1, 3, 20, "B")]) == [
        (1, 0, 20, "A"), (1, 20, None, "B"),
    ]
    # two changes in a minute: the later one counts
    assert timeline(spark, [(1, 1, 0, "A"), (1, 2, 10, "B"), (1, 3, 10, "C")]) == [
        (1, 0, 10, "A"), (1, 10, None, "C"),
    ]
    # back to A within the minute: the change test came first, so equal neighbours remain
    assert timeline(spark, [(1, 1, 0, "A"), (1, 2, 10, "B"), (1, 3, 10, "A")]) == [
        (1, 0, 10, "A"), (1, 10, None, "A"),
    ]


def test_interval_lookup(spark):
    held = spark.createDataFrame(
        [(1, 5, 10, "A"), (1, 10, None, "B")], "m int, from_minute int, to_minute int, code string"
    )
    points = spark.createDataFrame([(1, 4), (1, 5), (1, 9), (1, 10), (1, 99), (2, 5), (1, 10), (1, None)], "m int, at int")
    # an interval that ends before it starts holds nothing, one that starts later is not reached
    odd = spark.createDataFrame([(1, 7, 5, "X"), (1, 120, None, "Y")], held.schema)
    held = held.union(odd)
    got = sorted(rows(interval_lookup(points, held, ["m"], "at", "code")), key=repr)
    want = [(1, 4, None), (1, 5, "A"), (1, 9, "A"), (1, 10, "B"), (1, 10, "B"), (1, 99, "B"), (1, None, None), (2, 5, None)]
    assert got == sorted(want, key=repr)


def test_merge_latest(spark):
    old = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "x int, y int, v string")
    new = spark.createDataFrame([(1, 2, "B", 1), (3, 3, "d", 1), (3, 3, "D", 2), (2, 1, None, 1)], "x int, y int, v string, o int")
    got = sorted(rows(merge_latest(old, new, ["x", "y"], "o")), key=repr)
    assert got == [(1, 1, "a"), (1, 2, "B"), (2, 1, None), (3, 3, "D")]


def test_replace_scope_is_idempotent_and_drops_emptied_keys(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "m int, v string")
    scope = spark.createDataFrame([(1,), (2,)], "m int")
    new = spark.createDataFrame([(1, "A"), (1, "AA")], "m int, v string")
    once = replace_scope(old, new, scope, ["m"])
    twice = replace_scope(once, new, scope, ["m"])
    assert sorted(rows(once)) == sorted(rows(twice)) == [(1, "A"), (1, "AA"), (3, "c")]


def test_resolve_matches(spark):
    m = spark.createDataFrame([(1, 43, 106), (2, 43, 106), (3, 43, 3), (4, 9, 106)], "match_id int, competition_id int, season_id int")
    s = Scope()
    assert sorted(r[0] for r in rows(resolve_matches(m, s), "match_id")) == [1, 2]
    assert rows(resolve_matches(m, s, [2, 2]), "match_id") == [(2,)]
    assert rows(resolve_matches(m, s, [])) == []
    with pytest.raises(ValueError, match=r"\[3, 77\]"):
        resolve_matches(m, s, [1, 3, 77])


def test_unpivot_sides(spark):
    m = spark.createDataFrame([(1, 10, 20, 2, 1)], "match_id int, home_team_id int, away_team_id int, home_score int, away_score int")
    got = rows(unpivot_sides(m), "side", "team_id", "opponent_id", "team_score", "opponent_score")
    assert sorted(got) == [("away", 20, 10, 1, 2), ("home", 10, 20, 2, 1)]
    assert rows(unpivot_sides(m, 20), "side") == [("away",)]
