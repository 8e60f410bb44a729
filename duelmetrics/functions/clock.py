"""Time expressions that give the same answer in every session time zone.

Instants are kept as ``timestamp_ntz`` in UTC, so the day of an instant never
depends on ``spark.sql.session.timeZone``.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def utc_from_epoch(seconds: Column) -> Column:
    """Epoch seconds to a UTC ``timestamp_ntz``."""
    return F.timestamp_add("SECOND", seconds, _epoch())


def epoch_from_utc(instant: Column) -> Column:
    """UTC ``timestamp_ntz`` to whole epoch seconds."""
    return F.timestamp_diff("SECOND", _epoch(), instant)


def utc_day(instant: Column) -> Column:
    return F.to_date(instant)


def utc_from_iso(text: Column) -> Column:
    """ISO-8601 text to UTC ``timestamp_ntz``; NULL if malformed.

    Text without a zone is taken for UTC; ``Z`` and offsets like ``+05:00`` or
    ``-0300`` are converted. Places from the end tell them apart, so plain text
    costs no pattern.
    """
    length, timed = F.length(text), F.contains(text, F.lit(":"))

    def shifted(width: int) -> Column:
        sign = F.substring(text, -width, 1)
        hours = F.substring(text, 1 - width, 2).try_cast("int")
        minutes = hours * 60 + F.substring(text, -2, 2).try_cast("int")
        at = F.substring(text, F.lit(1), length - width).try_cast("timestamp_ntz")
        return F.timestamp_add("MINUTE", F.when(sign == "-", minutes).otherwise(-minutes), at)

    def signed(width: int) -> Column:
        return timed & F.substring(text, -width, 1).isin("+", "-")

    return (
        F.when(signed(6), shifted(6))
        .when(signed(5), shifted(5))
        .when(
            F.upper(F.substring(text, -1, 1)) == "Z",
            F.substring(text, F.lit(1), length - 1).try_cast("timestamp_ntz"),
        )
        .otherwise(text.try_cast("timestamp_ntz"))
    )


def iso_from_utc(instant: Column) -> Column:
    """``timestamp_ntz`` to ISO-8601 text with six decimals."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
