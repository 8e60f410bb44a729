"""Text expressions."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def tag_value(text: Column | str, pattern: str) -> Column:
    """Group 1 of the first match, NULL when there is none.

    ``regexp_extract`` gives ``''`` for no match; callers that put a default in
    place of a missing tag need NULL.
    """
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def last_segment(path: Column) -> Column:
    """Text after the last ``/``; ``''`` for NULL."""
    return F.element_at(F.split(F.coalesce(path, F.lit("")), "/"), -1)


def format_label(metric: Column, suffix: str) -> Column:
    """``blitz_win_rate_pct`` -> ``Blitz``."""
    return F.initcap(F.replace(metric, F.lit(suffix), F.lit("")))


def leader_arrow(first: Column, second: Column) -> Column:
    return F.when(first > second, "←").when(second > first, "→").otherwise("=")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used.

    A column expression that names another one twice holds two copies of it, and
    copies of copies multiply; the variable of a higher-order function does not.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def _tenths(size: Column) -> Column:
    """Tenths of a number >= 0, rounded to the nearest and at a tie to the even one.

    The binary value decides, not its shortest decimal form: 12.45 lies below
    the middle. Whole part and fraction separate exactly. Twenty times the
    fraction is the sum of 16 and 4 times it, both exact, and the error of that
    sum follows from its parts.
    """

    def rounded(fraction: Column, total: Column, taken: Column, down: Column) -> Column:
        error = (fraction * 16 - (total - taken)) + (fraction * 4 - taken)
        past_middle = (total - (down * 2 + 1)) + error
        return _bound(
            past_middle, lambda past: down + ((past > 0) | ((past == 0) & (down % 2 == 1))).cast("bigint")
        )

    def of_fraction(fraction: Column) -> Column:
        larger, smaller = fraction * 16, fraction * 4
        return _bound(
            larger + smaller,
            lambda total: rounded(fraction, total, total - larger, F.floor(total / 2)),
        )

    return F.floor(size) * 10 + _bound(size - F.floor(size), of_fraction)


def _one_decimal(value: Column) -> Column:
    """``3.5``, ``-2.0``; numbers too large for a tenth, NaN and infinity as they print."""

    def text(v: Column) -> Column:
        minus = (v < 0) | ((v == 0) & (v.cast("string") == "-0.0"))
        return _bound(
            _tenths(F.abs(v)),
            lambda t: F.concat(
                F.when(minus, "-").otherwise(""),
                F.floor(t / 10).cast("string"),
                F.lit("."),
                (t % 10).cast("string"),
            ),
        )

    return F.when(F.abs(value) < 1e15, _bound(value, text)).otherwise(F.format_string("%.1f", value))


def signed_delta(delta: Column, unit: Column) -> Column:
    """``+3.5%`` / ``-2.0``; NULL when the values are equal."""
    plus = F.when(delta > 0, "+").otherwise("")
    return F.when(delta != 0, F.concat(plus, _one_decimal(delta), unit))


def whole_number(value: Column, unit: Column) -> Column:
    return F.format_string("%.0f%s", F.rint(value), unit)


def grouped_number(value: Column) -> Column:
    """``12,345``."""
    return F.format_number(value, 0)


def one_decimal(value: Column, unit: str) -> Column:
    return F.when(value.isNotNull(), F.concat(_one_decimal(value.cast("double")), F.lit(unit)))
