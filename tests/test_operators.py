from datetime import date

import pytest
from helpers import plan_of, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duelmetrics.functions.clock import epoch_from_utc, utc_from_epoch, utc_from_iso
from duelmetrics.functions.text import last_segment, one_decimal, signed_delta, tag_value, whole_number
from duelmetrics.operators.coverage import coverage_gaps
from duelmetrics.operators.latest import latest_per_key
from duelmetrics.operators.progression import packed_order
from duelmetrics.operators.ranking import (
    argmax_row,
    argmax_value,
    first_appearances,
    top_rows,
)
from duelmetrics.operators.reshape import long_form, pivot_metrics, share_of_total

small = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@small
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 9)),
        max_size=40,
    )
)
def test_latest_per_key_equals_brute_force(spark, data):
    df = spark.createDataFrame(data, "k int, t int, tie int").repartition(4)
    want = {}
    for k, t, tie in data:
        rank = (t is None, -(t or 0), tie)
        if k not in want or rank < want[k][0]:
            want[k] = (rank, (k, t, tie))
    got = latest_per_key(df, ["k"], ["t"], ["tie"])
    assert rows(got) == sorted(r for _, r in want.values())


@small
@given(st.sets(st.tuples(st.integers(0, 5), st.integers(0, 150)), max_size=60))
def test_coverage_equals_brute_force(spark, seen):
    expected = list(range(0, 140, 2))  # more than fits into one mask
    entities = spark.createDataFrame([(i,) for i in range(4)], "k int")
    landed = spark.createDataFrame(list(seen), "k int, p int")
    want = {(k, p) for k in range(4) for p in expected} - seen
    assert rows(coverage_gaps(entities, landed, "k", "p", expected)) == sorted(want)


def test_coverage_needs_one_shuffle_and_no_join(spark):
    entities = spark.range(100).select(F.col("id").alias("k"))
    landed = spark.range(1000).select((F.col("id") % 7).alias("k"), F.lit("2025-01").alias("p"))
    plan = plan_of(coverage_gaps(entities, landed, "k", "p", ["2025-01", "2025-02"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


def test_epoch_round_trip_in_another_zone(spark, zone):
    df = spark.createDataFrame([(0,), (1735689600,), (5000000000,), (None,)], "s bigint")
    back = df.select("s", epoch_from_utc(utc_from_epoch(F.col("s"))).alias("back"))
    assert all(a == b for a, b in rows(back))


def test_iso_text(spark):
    df = spark.createDataFrame(
        [("2025-01-01T00:00:00",), ("2025-01-01T00:00:00.25",), ("yesterday",), (None,)], "t string"
    )
    got = rows(df.select(utc_from_iso(F.col("t")).cast("string").alias("at")))
    assert [r[0] for r in got] == [None, None, "2025-01-01 00:00:00", "2025-01-01 00:00:00.25"]


def test_last_segment_and_tags(spark):
    df = spark.createDataFrame([("https://x/country/NO",), (None,), ("",), ("NO",)], "t string")
    assert rows(df.select(last_segment(F.col("t")))) == [("",), ("",), ("NO",), ("NO",)]
    tag = df.select(tag_value("t", "country/(.+)"))
    assert rows(tag) == [(None,), (None,), (None,), ("NO",)]


def test_share_of_total_keeps_rows_in_place(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n bigint")
    shared = share_of_total(df, "n", "share")
    assert rows(shared) == [("a", 1, 0.25), ("b", 3, 0.75)]
    assert "Window" not in plan_of(shared) and "Join" not in plan_of(shared)
    none = share_of_total(df.withColumn("n", F.lit(0)), "n", "share")
    assert rows(none, "share") == [(None,), (None,)]


def test_pivot_and_long_form(spark):
    cells = [("a", "x", 1), ("a", "y", 2), ("b", "z", 3)]
    df = spark.createDataFrame(cells, "k string, c string, n int")
    wide = pivot_metrics(df, "k", "c", ["x", "y"], {"n": "n"})
    assert rows(wide) == [("a", 1, 2)]
    wider = wide.withColumn("none", F.lit(None).cast("int"))
    long = long_form(wider, ["k"], ["x_n", "none"], "m", "v")
    assert rows(long) == [("a", "x_n", 1)]


def test_top_rows_order_and_plan(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", None), ("d", 1)], "k string, n int")
    assert [r.k for r in top_rows(df, 3, ["n"], ["k"]).collect()] == ["a", "b", "d"]
    assert "TakeOrderedAndProject" in plan_of(top_rows(df, 3, ["n"], ["k"]))
    assert rows(argmax_row(df.filter("k = 'c'"), "n", [], ["k"])) == []


def test_first_appearances_follow_row_order(spark):
    df = spark.createDataFrame(
        [("x", 5, "q"), ("y", 9, "p"), ("x", 1, "p"), ("z", 5, "a")], "v string, n int, t string"
    )
    got = first_appearances(df, "v", 2, down=["n"], up=["t"]).collect()
    assert [r.v for r in got] == ["y", "z"]


def test_dates_can_be_expected(spark):
    landed = spark.createDataFrame([(1, date(2025, 1, 1))], "k int, d date")
    got = coverage_gaps(landed, landed, "k", "d", [date(2025, 1, 1), date(2025, 1, 2)])
    assert rows(got) == [(1, date(2025, 1, 2))]


def test_null_ties_rank_alike_in_every_form(spark):
    df = spark.createDataFrame([("a", 9, None), ("b", 9, 5), ("c", 9, 3)], "k string, n int, t int")
    assert rows(argmax_row(df, "n", ["t"], ["k"]), "k") == [("b",)]
    assert rows(df.agg(argmax_value("k", "n", ["t"], ["k"]).alias("k"))) == [("b",)]
    assert rows(top_rows(df, 1, ["n", "t"], ["k"]), "k") == [("b",)]
    assert rows(first_appearances(df, "k", 1, ["n", "t"], ["k"])) == [("b",)]


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e14, 1e14), min_size=200, max_size=200))
def test_numbers_print_as_their_binary_value_rounds(spark, some):
    ties = [k / 20 for k in range(-200, 200)] + [k / 8 for k in range(-99, 99)]
    values = some + ties + [12.45, 62.25, 62.5, -0.04, 0.05, 0.25, 0.35, 1e15]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    shown = df.select(
        "v", one_decimal(F.col("v"), "").alias("a"), whole_number(F.col("v"), F.lit("")).alias("w")
    )
    for r in shown.collect():
        assert r.a == f"{r.v:.1f}" and float(r.w) == float(f"{r.v:.0f}"), r


def test_text_expressions_do_not_copy_their_input(spark):
    for text in (one_decimal(F.col("some_value"), ""), signed_delta(F.col("some_value"), F.lit("%"))):
        assert str(text).count("some_value") <= 12
    signs = spark.createDataFrame([(-0.0,), (0.0,), (-0.04,), (float("nan"),), (None,)], "v double")
    assert [r[0] for r in signs.select(one_decimal(F.col("v"), "")).collect()] == ["-0.0", "0.0", "-0.0", "NaN", None]


def test_ties_that_do_not_fit_end_the_job(spark):
    times = spark.createDataFrame([(5, 3), (5, (1 << 20) - 1), (6, 0), (4, None)], "t bigint, v bigint")
    ordered = times.orderBy(packed_order(F.col("t"), F.col("v"))).collect()
    assert [r.t for r in ordered] == [4, 5, 5, 6] and ordered[1].v == 3
    for tie in (1 << 20, -1):
        with pytest.raises(Exception, match="a tie outside"):
            spark.createDataFrame([(1, tie)], "t bigint, v bigint").select(packed_order(F.col("t"), F.col("v"))).collect()
