import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from pitchgrain.functions import clean as C
from pitchgrain.functions import text as X
from pitchgrain.functions.encoder import (
    QUERY_PREFIX,
    encode_column,
    encode_query,
    l2_normalise,
    token_hash_encoder,
)
from pitchgrain.functions.numeric import exact_avg, exact_ratio


def test_clean(spark):
    df = spark.createDataFrame(
        [("", math.nan, 42), ("  ", 1.5, None), ("\t\n", None, 7), (" goal ", 0.0, 0), (None, 2.0, 1)],
        "s string, d double, i int",
    )
    out = rows(df.select(*[C.clean(F.col(f.name), f.dataType) for f in df.schema]))
    assert out == [(None, None, 42), (None, 1.5, None), (None, None, 7), (" goal ", 0.0, 0), (None, 2.0, 1)]


def test_clock_minute(spark):
    df = spark.createDataFrame([("64:10",), ("0:00",), ("45",), (None,), (" ",)], "c string")
    assert rows(df.select(C.clock_minute(F.col("c")))) == [(64,), (0,), (45,), (None,), (None,)]
    number = spark.createDataFrame([(45,)], "c int")
    assert rows(number.select(C.clock_minute(F.col("c")))) == [(45,)]


def test_single_outcome(spark):
    cases = [
        ("Pass", None, None, None),
        ("Pass", "Incomplete", "Goal", "Incomplete"),
        ("Pass", None, "Goal", None),
        ("Shot", "Incomplete", "Goal", "Goal"),
        ("Duel", " ", "Blocked", "Blocked"),
        ("Duel", "Won", "Blocked", "Won"),
    ]
    df = spark.createDataFrame(cases, "t string, p string, s string, want string")
    out = rows(df.select(C.single_outcome(F.col("t"), F.col("p"), F.col("s")), "want"))
    assert all(got == want for got, want in out)


def test_coordinate(spark):
    df = spark.createDataFrame([([1.5, 2.5],), ([1.5],), ([1.0, 2.0, 3.0],), (None,)], "l array<double>")
    out = rows(df.select(C.coordinate(F.col("l"), 0), C.coordinate(F.col("l"), 1)))
    assert out == [(1.5, 2.5), (None, None), (None, None), (None, None)]


def test_payload_prunes_at_every_depth(spark):
    schema = (
        "id string, a string, n double, flag boolean, "
        "deep struct<x: string, y: struct<z: int>, list: array<string>>, m map<string,string>, d date"
    )
    df = spark.createDataFrame(
        [
            ("1", " ", math.nan, False, None, None, None),
            ("2", "v", 1.5, None, ("", (None,), ["a", None, " "]), {"k": "v", "e": ""}, None),
        ],
        schema,
    )
    df = df.withColumn("d", F.when(F.col("id") == "2", F.lit("2022-12-05").cast("date")))
    out = [r[0] for r in rows(df.orderBy("id").select(C.payload(df.schema, {"id"})))]
    assert out == [
        '{"flag":false}',
        '{"a":"v","n":1.5,"deep":{"y":{},"list":["a"]},"m":{"k":"v"},"d":"2022-12-05"}',
    ]


def test_payload_without_other_columns(spark):
    df = spark.createDataFrame([("1",)], "id string")
    assert rows(df.select(C.payload(df.schema, {"id"}))) == [("{}",)]


def test_fixed_matches_binary_rounding(spark):
    rng = random.Random(3)
    values = [0.0, 0.125, 0.375, 3.45, 81.25, 0.485, 0.29, 1.005, 2.675, 99.95, -0.0004, -1.25, 1e6 + 0.5]
    values += [round(rng.uniform(0, 100), rng.choice([1, 2, 3, 4])) for _ in range(3000)]
    values += [k / 16 for k in range(200)] + [k / 8 * 0.1 for k in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for places in (0, 1, 2, 3):
        got = [r[0] for r in rows(df.select(X.fixed(F.col("v"), places)))]
        assert got == [f"{v:.{places}f}" for v in values]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, width=32), min_size=1, max_size=50))
def test_fixed_on_any_number(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = [r[0] for r in rows(df.select(X.fixed(F.col("v"), 2)))]
    assert got == [f"{float(v):.2f}" if v != 0 else "0.00" for v in values]


def test_percent(spark):
    df = spark.createDataFrame([(13, 16), (0, 0), (1, 3), (0, 5)], "c bigint, n bigint")
    assert [r[0] for r in rows(df.select(X.percent(F.col("c"), F.col("n"))))] == [
        "81.2%", "n/a", "33.3%", "0.0%",
    ]


def test_clock_and_labels(spark):
    df = spark.createDataFrame(
        [(12, 5, 9, "Nick", "Name"), (None, 5, None, None, "Name"), (90, None, 0, "", "Name"), (1, 0, 3, None, None)],
        "m int, s int, j int, nick string, name string",
    )
    out = rows(
        df.select(
            X.clock(F.col("m"), F.col("s")),
            X.jersey_label(F.col("j"), F.col("nick"), F.col("name")),
        )
    )
    assert out == [("12'05\"", "#9 Nick"), ("?", "Name"), ("90'00\"", "Name"), ("1'00\"", "#3 ?")]


def test_exact_arithmetic(spark):
    df = spark.createDataFrame([(3, 160), (0, 0), (1, 8)], "c bigint, n bigint")
    out = [r[0] for r in rows(df.select(F.round(exact_ratio(F.col("c"), F.col("n")), 4)))]
    assert [None if v is None else float(v) for v in out] == [0.0188, None, 0.125]
    many = spark.createDataFrame([(1,)] * 199 + [(2,)], "v int")  # average 1.005
    assert float(rows(many.agg(F.round(exact_avg(F.col("v")), 2)))[0][0]) == 1.01


def test_encoder_is_unit_length_and_deterministic(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, "Ab  B"), (4, None)], "id int, t string")
    out = {r[0]: np.array(r[1]) for r in rows(df.select("id", encode_column(F.col("t"))))}
    again = {r[0]: np.array(r[1]) for r in rows(df.select("id", encode_column(F.col("t"))))}
    assert all(np.array_equal(out[i], again[i]) for i in out)
    assert np.linalg.norm(out[1]) == pytest.approx(1, abs=1e-6)
    assert not out[2].any() and not out[4].any()
    direct = token_hash_encoder()(["a b a"])[0]
    assert np.allclose(out[1], direct / np.linalg.norm(direct), atol=1e-6)


def test_query_prefix_changes_the_vector(spark):
    df = spark.createDataFrame([("goal",)], "t string")
    plain, asked, spelled = rows(
        df.select(
            encode_column(F.col("t")),
            encode_query(F.col("t")),
            encode_column(F.concat(F.lit(QUERY_PREFIX), F.col("t"))),
        )
    )[0]
    assert plain != asked and asked == spelled


def test_l2_normalise(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], T.StructType().add("v", T.ArrayType(T.FloatType())))
    out = [list(r[0]) for r in rows(df.select(l2_normalise(F.col("v"))))]
    assert out[0] == pytest.approx([0.6, 0.8]) and out[1] == [0.0, 0.0]
