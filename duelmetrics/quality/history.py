"""Profiles of loads, kept from load to load, and what changed between them.

A profile has two tables, both small and mergeable. ``columns``: per column its
type, rows, NULLs and a sketch of its distinct values. ``bins``: how many values
fall into each bin of a logarithmic scale, whose bins are GROWTH times as wide as
the one before, so a quantile read from them is within that factor; texts are
counted by their length. Profiles of several loads merge by sums and by the union
of their sketches, without the rows. Two profiles are compared by the largest
distance between their distributions (the two-sample Kolmogorov-Smirnov distance
of the binned values), by the share of NULLs and by the type.
"""

from collections.abc import Sequence
from math import log

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duelmetrics.functions.measures import row_count
from duelmetrics.sources.parts import PART, append_parts, read_parts

#: A bin is so much wider than the one before.
GROWTH = 1.02
#: Logarithm of the sketch's size: relative standard error about 1.6 %.
SKETCH_BITS = 12
COLUMNS = "load string, column_name string, type string, n_rows bigint, n_nulls bigint, distinct binary"
BINS = "load string, column_name string, bin int, n bigint"


def _number(df: DataFrame, field: T.StructField) -> Column | None:
    """The value as a number, the length of a text; None for types that have no order to compare."""
    kind, value = field.dataType, F.col(f"`{field.name}`")
    if isinstance(kind, T.StringType):
        return F.length(value).cast("double")
    if isinstance(kind, T.BooleanType):
        return value.cast("int").cast("double")
    if isinstance(kind, T.NumericType):
        return value.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value) / 1e6
    if isinstance(kind, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("SECOND", epoch, value).cast("double")
    return None


def bin_of(value: Column) -> Column:
    """The bin of a number: 0 for 0, 1 and on for 1 and more, counting up by size, below 0 for negative ones.

    Numbers between -1 and 1 share the bins 1 and -1; NaN and infinity have none.
    """
    size = F.greatest(F.abs(value), F.lit(1.0))
    step = F.floor(F.ln(size) / F.lit(log(GROWTH))).cast("int") + 1
    usual = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return F.when(usual, F.signum(value).cast("int") * step)


def _comparable(kind: T.DataType) -> bool:
    return isinstance(kind, T.AtomicType)


def profile_columns(df: DataFrame, load: str) -> DataFrame:
    """One row per column, from one aggregation."""
    fields = df.schema.fields
    row = df.agg(
        row_count().alias("_rows"),
        *[F.count(F.col(f"`{f.name}`")).alias(f"_set{i}") for i, f in enumerate(fields)],
        *[
            F.hll_sketch_agg(F.col(f"`{f.name}`").cast("string"), SKETCH_BITS).alias(f"_sketch{i}")
            for i, f in enumerate(fields)
            if _comparable(f.dataType)
        ],
    )
    per_column = [
        F.struct(
            F.lit(load).alias("load"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col("_rows").alias("n_rows"),
            (F.col("_rows") - F.col(f"_set{i}")).alias("n_nulls"),
            (F.col(f"_sketch{i}") if _comparable(f.dataType) else F.lit(None).cast("binary")).alias("distinct"),
        )
        for i, f in enumerate(fields)
    ]
    return row.select(F.inline(F.array(*per_column)))


def profile_bins(df: DataFrame, load: str) -> DataFrame:
    """Values per column and bin: one pass, summed in each task before it shuffles."""
    numbers = [(f.name, _number(df, f)) for f in df.schema.fields]
    at = [F.struct(F.lit(c).alias("column_name"), bin_of(n).alias("bin")) for c, n in numbers if n is not None]
    if not at:
        return df.sparkSession.createDataFrame([], BINS)
    return (
        df.select(F.inline(F.array(*at)))
        .filter(F.col("bin").isNotNull())
        .groupBy("column_name", "bin")
        .agg(row_count().alias("n"))
        .select(F.lit(load).alias("load"), "column_name", "bin", "n")
    )


def record_profile(df: DataFrame, folder: str, load: str) -> None:
    """Add a load's profile to those kept in ``folder``; loads must have different names."""
    for name, rows in (("columns", profile_columns(df, load)), ("bins", profile_bins(df, load))):
        append_parts(rows.withColumn(PART, F.col("load")), f"{folder}/{name}")


def _kept(spark: SparkSession, folder: str, name: str, loads: Sequence[str] | None) -> DataFrame:
    schema = T.StructType.fromDDL(COLUMNS if name == "columns" else BINS)
    rows = read_parts(spark, f"{folder}/{name}", schema)
    return rows if loads is None else rows.filter(F.col("load").isin(*loads))


def merged_columns(spark: SparkSession, folder: str, loads: Sequence[str] | None = None) -> DataFrame:
    """Rows, NULLs and about how many distinct values each column has over several loads, all by default."""
    return (
        _kept(spark, folder, "columns", loads)
        .groupBy("column_name")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_nulls").alias("n_nulls"),
            F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_estimate"),
        )
    )


def profile_drift(
    spark: SparkSession,
    folder: str,
    before: str,
    after: str,
    distance: float = 0.1,
    null_drift: float = 0.1,
) -> DataFrame:
    """One row per column of either load: what changed (added, removed, retyped, drifted, or NULL) and by how much.

    ``distance`` is the largest difference between the shares of values up to any
    bin, 0 for equal and 1 for disjoint distributions; NULL where a column has no
    values in one load. Content has drifted when it, or the change of the share of
    NULLs, is above its limit.
    """
    columns = _kept(spark, folder, "columns", [before, after])
    share = F.col("n_nulls") / F.greatest("n_rows", F.lit(1))

    def of(load: str, value: Column) -> Column:
        return F.max(F.when(F.col("load") == load, value))

    kinds = columns.groupBy("column_name").agg(
        of(before, F.col("type")).alias("type_before"),
        of(after, F.col("type")).alias("type_after"),
        F.round(of(before, share), 4).alias("null_share_before"),
        F.round(of(after, share), 4).alias("null_share_after"),
    )
    counts = _kept(spark, folder, "bins", [before, after]).groupBy("column_name", "bin").agg(
        *[F.sum(F.when(F.col("load") == load, F.col("n")).otherwise(0)).alias(side) for side, load in (("_b", before), ("_a", after))]
    )
    # a row for each bin that occurs, some thousands a column at most
    every = Window.partitionBy("column_name")
    upto = every.orderBy("bin")
    shares = counts.select(
        "column_name",
        *[F.try_divide(F.sum(c).over(upto), F.sum(c).over(every)).alias(c) for c in ("_b", "_a")],
    )
    apart = shares.groupBy("column_name").agg(F.round(F.max(F.abs(F.col("_b") - F.col("_a"))), 6).alias("distance"))
    drifted = (F.coalesce("distance", F.lit(0.0)) > distance) | (
        F.abs(F.col("null_share_after") - F.col("null_share_before")) > null_drift
    )
    change = (
        F.when(F.col("type_before").isNull(), "added")
        .when(F.col("type_after").isNull(), "removed")
        .when(F.col("type_before") != F.col("type_after"), "retyped")
        .when(drifted, "drifted")
    )
    return kinds.join(apart, "column_name", "left").withColumn("change", change)
