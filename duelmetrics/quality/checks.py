"""Checks on a table and a runner that fuses them.

A NULL breaks ``not_null`` only; the other column checks pass over it.
"""

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelmetrics.functions.measures import row_count


class DataCheckFailed(Exception):
    """A job that must not go on found failing checks."""


@dataclass(frozen=True)
class Check:
    kind: str
    column: str | None = None
    values: tuple = ()
    low: Any = None
    high: Any = None
    parent: DataFrame | None = field(default=None, compare=False)
    parent_key: str | None = None

    def failures(self) -> Column:
        """Aggregate that counts what breaks the check."""
        value = F.col(self.column) if self.column else None
        if self.kind == "not_null":
            return F.count_if(value.isNull())
        if self.kind == "accepted_values":
            return F.count_if(~value.isin(*self.values))
        if self.kind == "between":
            return F.count_if(~value.between(self.low, self.high))
        if self.kind == "row_count_between":
            outside = ~row_count().between(self.low, self.high)
        elif self.kind == "row_count_above":
            outside = row_count() <= self.low
        else:
            raise ValueError(f"{self.kind} needs its own pass")
        return outside.cast("bigint")


def not_null(column: str) -> Check:
    return Check("not_null", column)


def unique(column: str) -> Check:
    return Check("unique", column)


def accepted_values(column: str, values: Sequence) -> Check:
    return Check("accepted_values", column, tuple(values))


def between(column: str, low, high) -> Check:
    """Both bounds belong to the range."""
    return Check("between", column, low=low, high=high)


def row_count_between(low: int, high: int) -> Check:
    return Check("row_count_between", low=low, high=high)


def row_count_above(low: int) -> Check:
    return Check("row_count_above", low=low)


def relationships(column: str, parent: DataFrame, parent_key: str) -> Check:
    """Every value of ``column`` is found in ``parent_key`` of ``parent``."""
    return Check("relationships", column, parent=parent, parent_key=parent_key)


def _result(suite: str, check: Check, rows: Column, failures: Column) -> Column:
    return F.struct(
        F.lit(suite).alias("suite"),
        F.lit(check.kind).alias("check_name"),
        F.lit(check.column).cast("string").alias("column_name"),
        rows.alias("rows_checked"),
        failures.alias("failures"),
        (failures == 0).alias("success"),
    )


def _fused(df: DataFrame, suite: str, checks: Sequence[Check]) -> DataFrame:
    """All checks that look at one row at a time, in one aggregation."""
    counts = df.agg(
        row_count().alias("_rows"),
        *[c.failures().alias(f"_{i}") for i, c in enumerate(checks)],
    )
    results = [
        _result(suite, c, F.col("_rows"), F.col(f"_{i}")) for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*results)))


def _per_value(df: DataFrame, check: Check) -> DataFrame:
    """(value, n), NULL among the values; partial counts precede the shuffle."""
    return df.groupBy(F.col(check.column).alias("_value")).agg(row_count().alias("_n"))


def _grouped(df: DataFrame, suite: str, checks: Sequence[Check]) -> DataFrame:
    """All checks over the values of one column, from one aggregation per value.

    ``unique`` counts values that occur more than once, ``relationships`` counts
    rows without a parent. Values are grouped first, so a value that many rows
    share is one row in the shuffle and in the joins.
    """
    values = _per_value(df, checks[0])
    broken = []
    for i, check in enumerate(checks):
        if check.kind == "unique":
            broken.append(F.count_if(F.col("_value").isNotNull() & (F.col("_n") > 1)))
            continue
        known = f"_known{i}"
        parents = check.parent.select(F.col(check.parent_key).alias("_value")).distinct()
        values = values.join(parents.withColumn(known, F.lit(True)), "_value", "left")
        orphan = F.col("_value").isNotNull() & F.col(known).isNull()
        broken.append(F.coalesce(F.sum(F.when(orphan, F.col("_n"))), F.lit(0)))
    counts = values.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows"),
        *[b.alias(f"_{i}") for i, b in enumerate(broken)],
    )
    results = [_result(suite, c, F.col("_rows"), F.col(f"_{i}")) for i, c in enumerate(checks)]
    return counts.select(F.inline(F.array(*results)))


def run_suite(df: DataFrame, suite: str, checks: Sequence[Check]) -> DataFrame:
    """One result row per check; ``rows_checked`` counts all rows of the table."""
    per_value = ("unique", "relationships")
    fused = [c for c in checks if c.kind not in per_value]
    parts = [_fused(df, suite, fused)] if fused else []
    columns = dict.fromkeys(c.column for c in checks if c.kind in per_value)
    parts += [
        _grouped(df, suite, [c for c in checks if c.kind in per_value and c.column == column])
        for column in columns
    ]
    return reduce(DataFrame.unionByName, parts)


def summarize(results: DataFrame) -> DataFrame:
    """Passed and failed checks per suite."""
    return results.groupBy("suite").agg(
        F.count_if("success").alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.every("success").alias("success"),
    )


def settled(results: DataFrame) -> DataFrame:
    """The results as fixed rows, so that reading them again checks nothing anew.

    There is one row per declared check, whatever the size of the tables.
    """
    return results.sparkSession.createDataFrame(results.collect(), results.schema)


def raise_on_failure(results: DataFrame) -> None:
    """Raise if a check failed; the rows read are one per declared check."""
    failed = results.filter(~F.col("success")).collect()
    if failed:
        lines = [
            f"{r.suite}: {r.check_name}({r.column_name or ''}) {r.failures} failures"
            for r in failed
        ]
        raise DataCheckFailed("; ".join(lines))
