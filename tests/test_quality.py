import pytest
from helpers import plan_of, raw_games, rows
from pyspark.sql import functions as F

from duelmetrics.functions.clock import utc_from_iso
from duelmetrics.plans.staging import stage_games
from duelmetrics.quality import checks as dq
from duelmetrics.quality import history, monitors
from duelmetrics.quality.declared import expectations, schema_tests

RESULT = ["check_name", "column_name", "failures", "success"]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [(1, "a", 5), (2, "a", 10), (3, None, None), (3, "c", 11)], "id int, tag string, n int"
    )


def test_checks_count_failures(table):
    found = dq.run_suite(
        table,
        "t",
        [
            dq.not_null("tag"),
            dq.unique("id"),
            dq.unique("tag"),
            dq.accepted_values("tag", ["a", "b"]),
            dq.between("n", 5, 10),
            dq.row_count_between(4, 6),
            dq.row_count_above(4),
        ],
    )
    assert rows(found, *RESULT) == [
        ("accepted_values", "tag", 1, False),
        ("between", "n", 1, False),
        ("not_null", "tag", 1, False),
        ("row_count_above", None, 1, False),
        ("row_count_between", None, 0, True),
        ("unique", "id", 1, False),
        ("unique", "tag", 1, False),
    ]


def test_relationships_count_orphan_rows(spark, table):
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "key string")
    found = dq.run_suite(table, "t", [dq.relationships("tag", parent, "key")])
    assert rows(found, *RESULT, "rows_checked") == [("relationships", "tag", 1, False, 4)]


def test_empty_tables_pass_value_checks(table):
    empty = table.filter("id > 9")
    found = dq.run_suite(
        empty, "t", [dq.not_null("id"), dq.unique("id"), dq.relationships("tag", table, "tag")]
    )
    assert rows(found, "failures", "success") == [(0, True)] * 3


def test_summary_and_failure(table):
    found = dq.run_suite(table, "t", [dq.not_null("id"), dq.unique("id")])
    assert rows(dq.summarize(found)) == [("t", 1, 1, False)]
    with pytest.raises(dq.DataCheckFailed, match="unique"):
        dq.raise_on_failure(found)
    dq.raise_on_failure(found.filter("success"))


def test_declared_checks_are_complete():
    declared = [c for checks in schema_tests().values() for c in checks]
    kinds = [c.kind for c in declared]
    assert (len(declared), kinds.count("not_null")) == (39, 31)
    assert (kinds.count("unique"), kinds.count("accepted_values")) == (4, 4)
    assert sum(len(c) for c in expectations().values()) == 10


def test_default_players_are_checked(spark):
    staged = stage_games(raw_games(spark, {"username": "Hikaru"}, {"game_url": "2"}))
    found = dq.run_suite(staged, "stg_games", schema_tests()["stg_games"])
    broken = found.filter("not success")
    assert rows(broken, *RESULT) == [("accepted_values", "username", 1, False)]


@pytest.mark.parametrize(
    ("loaded", "status"),
    [
        ("2025-01-09T01:00:00", "pass"),
        ("2025-01-08T18:00:00", "warn"),
        ("2025-01-07T22:00:00", "error"),
        ("2025-01-09T00:00:00", "pass"),
        ("2025-01-08T00:00:00", "warn"),
        ("not a time", "error"),
    ],
)
def test_freshness(spark, zone, loaded, status):
    df = spark.createDataFrame([("2025-01-01T00:00:00",), (loaded,)], "at string")
    df = df if status != "error" or loaded[0] == "2" else df.filter(f"at = '{loaded}'")
    assert rows(monitors.freshness(df, "at", "2025-01-10T00:00:00"), "status") == [(status,)]


def test_volume_limits(spark):
    for n, strict in ((1000, False), (1001, True)):
        df = spark.range(n)
        assert rows(monitors.volume_check(df, "raw"), "success") == [(strict,)]
        inclusive = dq.run_suite(df, "raw", [dq.row_count_between(1000, 500000)])
        assert rows(inclusive, "success") == [(True,)]


def test_missing_day_is_an_anomaly(spark):
    days = [d for d in range(1, 15) for _ in range(100 + d % 3) if d != 12]
    seen = [("a", f"2025-01-{d:02d} 10:00:00") for d in days]
    df = spark.createDataFrame(seen, "k string, t string")
    df = df.withColumn("at", df.t.cast("timestamp_ntz"))
    found = monitors.volume_anomaly(df, ["k"], "at").collect()
    assert len(found) == 14
    assert [(r.day.day, r.n_rows) for r in found if r.is_anomaly] == [(12, 0)]


def test_schema_change(spark):
    data = [(i, "x", i, i) for i in range(100)]
    before = spark.createDataFrame(data, "a int, b string, c int, d int")
    after = before.selectExpr("a", "cast(c as bigint) c", "if(d < 50, d, null) d", "1 as e")
    found = monitors.schema_change(before, after)
    assert rows(found, "column_name", "change") == [
        ("b", "removed"),
        ("c", "retyped"),
        ("d", "drifted"),
        ("e", "added"),
    ]
    assert monitors.schema_change(before, before).count() == 0


def test_profile(spark):
    staged = stage_games(raw_games(spark, {}, {"game_url": "2", "username": "bob"}))
    (row,) = monitors.table_profile(staged, "username", "ended_at").collect()
    assert (row.total_games, row.unique_players) == (2, 2)
    assert row.earliest_game == row.latest_game


def test_checks_of_one_column_share_a_pass(spark, table):
    parent = spark.createDataFrame([(1,), (2,)], "key int")
    checks = [dq.unique("id"), dq.relationships("id", parent, "key")]
    found = dq.run_suite(table, "t", checks)
    assert rows(found, *RESULT, "rows_checked") == [
        ("relationships", "id", 2, False, 4),
        ("unique", "id", 1, False, 4),
    ]
    single = plan_of(dq.run_suite(table, "t", checks[:1])).count("Scan ExistingRDD")
    assert plan_of(found).count("Scan ExistingRDD") == single + 1


@pytest.mark.parametrize(
    "text", ["2025-01-01T05:00:00+05:00", "2024-12-31T19:00:00.0-0500", "2025-01-01T00:00:00Z"]
)
def test_load_times_with_offsets_are_converted(spark, zone, text):
    df = spark.createDataFrame([(text,)], "at string").select(utc_from_iso(F.col("at")).alias("t"))
    assert rows(df.select(F.col("t").cast("string"))) == [("2025-01-01 00:00:00",)]


def test_a_stray_year_costs_one_row(spark):
    df = spark.sql(
        "select 'a' k, explode(array(timestamp_ntz'2024-01-01', timestamp_ntz'9024-01-01')) at"
    )
    found = monitors.volume_anomaly(df, ["k"], "at").collect()
    assert [(r.n_rows, r.days, r.is_anomaly) for r in found] == [
        (1, 1, False),
        (0, 2556696, False),
        (1, 1, True),
    ]


def weekly(spark, spikes=(), days=70, extra=0):
    """Rows per day: 80 on Sundays, 30 on others, some chance, and planted days."""
    counts = [(d, (80 if d % 7 == 0 else 30) + d * 7919 % 3 + (extra if d in spikes else 0)) for d in range(days)]
    rows = [("k", d) for d, n in counts for _ in range(n)]
    start = F.lit("2024-01-07 12:00:00").cast("timestamp_ntz")
    return spark.createDataFrame(rows, "k string, d int").select("k", F.timestamp_add("DAY", F.col("d"), start).alias("at"))


def test_a_weekly_pattern_is_usual_and_a_spike_is_not(spark):
    quiet = monitors.seasonal_anomaly(weekly(spark), ["k"], "at").collect()
    assert len(quiet) == 70 and not any(r["is_anomaly"] for r in quiet)
    found = monitors.seasonal_anomaly(weekly(spark, (45, 52), extra=60), ["k"], "at").filter("is_anomaly").collect()
    assert [str(r["day"]) for r in found] == ["2024-02-21", "2024-02-28"]  # the first hides neither the second nor a usual day


def test_days_without_rows_are_seasonal_zeros(spark):
    gap = weekly(spark).filter("at < '2024-02-20' or at > '2024-02-25'")
    found = monitors.seasonal_anomaly(gap, ["k"], "at").filter("is_anomaly").collect()
    assert [(str(r["day"]), r["n_rows"], r["days"], r["usual"]) for r in found if r["n_rows"] == 0] == [("2024-02-20", 0, 5, found[0]["usual"])]
    assert monitors.seasonal_anomaly(gap.filter("false"), ["k"], "at").count() == 0


def load_of(spark, seed, shift=0, nulls=0):
    return spark.range(4_000).select(
        (F.col("id") * 7919 % 1_009 + 1_000 + shift).alias("rating"),
        F.when(F.col("id") % 10 >= nulls, F.concat(F.lit("n"), F.col("id") * seed % 3_001)).alias("name"),
        (F.col("id") % 2 == 0).alias("rated"),
        F.array(F.col("id")).alias("list"),
    )


def test_a_shifted_column_drifts_and_others_do_not(spark, tmp_path):
    folder = f"{tmp_path}/profiles"
    history.record_profile(load_of(spark, 7), folder, "one")
    history.record_profile(load_of(spark, 11), folder, "two")
    history.record_profile(load_of(spark, 13, shift=300, nulls=3), folder, "three")
    history.record_profile(load_of(spark, 7).withColumn("rating", F.col("rating").cast("string")).drop("rated").withColumn("more", F.lit(-1.5)), folder, "four")
    same = history.profile_drift(spark, folder, "one", "two")
    assert same.filter("change is not null").count() == 0 and same.count() == 4
    shifted = rows(history.profile_drift(spark, folder, "two", "three").filter("change is not null"), "column_name", "change")
    assert shifted == [("name", "drifted"), ("rating", "drifted")]
    other = rows(history.profile_drift(spark, folder, "one", "four").filter("change is not null"), "column_name", "change")
    assert other == [("more", "added"), ("rated", "removed"), ("rating", "retyped")]


def test_the_distance_is_that_of_the_distributions(spark, tmp_path):
    folder = f"{tmp_path}/profiles"
    history.record_profile(spark.range(100).select((F.col("id") % 10).cast("double").alias("x")), folder, "a")
    history.record_profile(spark.range(100).select((F.col("id") % 10 + F.when(F.col("id") < 50, 100).otherwise(0)).cast("double").alias("x")), folder, "b")
    history.record_profile(spark.createDataFrame([(float("nan"),), (None,), (float("inf"),)], "x double"), folder, "c")
    assert rows(history.profile_drift(spark, folder, "a", "b"), "distance", "change") == [(0.5, "drifted")]
    assert rows(history.profile_drift(spark, folder, "a", "c"), "distance", "null_share_after") == [(None, 0.3333)]


def test_sketches_of_loads_merge(spark, tmp_path):
    folder, exact = f"{tmp_path}/profiles", set()
    for k in range(5):
        ids = range(k * 3_000, k * 3_000 + 6_000)
        history.record_profile(spark.range(ids[0], ids[-1] + 1), folder, f"l{k}")
        exact |= set(ids)
    (merged,) = history.merged_columns(spark, folder).collect()
    assert merged["n_rows"] == 30_000 and abs(merged["distinct_estimate"] - len(exact)) < 0.05 * len(exact)
    (one,) = history.merged_columns(spark, folder, ["l0"]).collect()
    assert abs(one["distinct_estimate"] - 6_000) < 300


def test_a_profile_is_one_pass_and_bins_have_borders(spark):
    bins = spark.createDataFrame([(x,) for x in (0.0, -0.0, 0.5, 1.0, -1.0, -0.5, 1.03, 1e300, None)], "x double").select(history.bin_of(F.col("x")))
    found = [r[0] for r in bins.collect()]
    assert found[:7] == [0, 0, 1, 1, -1, -1, 2] and found[7] > 30_000 and found[8] is None
    assert plan_of(history.profile_bins(load_of(spark, 7), "x")).count("Range") == 1
