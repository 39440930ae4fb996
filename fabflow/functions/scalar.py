"""Column-level helpers. All return built-in Spark expressions (codegen-able)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fabflow import constants as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def format_wafer_id(ordinal) -> Column:
    """``W`` + zero-padded ordinal; wider ordinals keep all digits (no truncation)."""
    return F.format_string(C.WAFER_ID_FORMAT, _c(ordinal).cast("long"))


def wafer_ordinal(wafer_id) -> Column:
    """Inverse of :func:`format_wafer_id`: the integer after the leading ``W``."""
    return F.substring(_c(wafer_id), 2, 1 << 20).try_cast("bigint")


def safe_percentage(part, total) -> Column:
    """part / total * 100, and 0 when total is 0 or null (never raises under ANSI)."""
    return F.coalesce(F.try_divide(_c(part).cast("double"), _c(total).cast("double")) * F.lit(100.0),
                      F.lit(0.0))


def parse_event_time(text) -> Column:
    """Text timestamp in either wire encoding to TIMESTAMP (UTC session).

    All-digit text is epoch milliseconds; anything else is parsed as an
    ISO-8601 timestamp. Unparseable text gives NULL (callers quarantine it).
    """
    t = F.trim(_c(text))
    millis = F.when(t.rlike(r"^-?[0-9]{1,18}$"), F.timestamp_millis(t.try_cast("long")))
    return F.coalesce(millis, F.try_to_timestamp(t))


def iso_format(ts) -> Column:
    """Timestamp to ISO-8601 text with microseconds."""
    return F.date_format(_c(ts), C.ISO_FORMAT)


def archive_day(ts) -> Column:
    """``YYYYMMDD`` label of a timestamp."""
    return F.date_format(_c(ts), "yyyyMMdd")


def affine(x, offset: float, scale: float) -> Column:
    """offset + scale * x."""
    return F.lit(float(offset)) + F.lit(float(scale)) * _c(x)


def is_null_or_nan(x, dtype: str) -> Column:
    """Missing value in the pandas sense: NULL, or NaN for floating columns."""
    c = _c(x)
    if dtype in ("double", "float"):
        return c.isNull() | F.isnan(c)
    return c.isNull()
