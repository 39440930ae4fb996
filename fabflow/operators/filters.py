"""Row filters and projections (FLT, PRJ). All are narrow transformations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabflow import constants as C
from fabflow.operators.profile import numeric_columns


def filter_anomalies(df: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    return df.filter(F.col(flag))


def filter_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def filter_not_in_set(df: DataFrame, column: str, values) -> DataFrame:
    """Rows whose value is outside the set (null is neither in nor out: not returned)."""
    return df.filter(~F.col(column).isin(list(values)))


def filter_out_of_range(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """Rows strictly below ``lo`` or above ``hi`` (bounds themselves pass)."""
    return df.filter((F.col(column) < F.lit(lo)) | (F.col(column) > F.lit(hi)))


def numeric_projection(df: DataFrame) -> DataFrame:
    """Only the floating and integral columns."""
    return df.select(*numeric_columns(df))


def column_subset(df: DataFrame, columns=tuple(C.PROCESS_COLUMNS)) -> DataFrame:
    return df.select(*columns)


def round_values(df: DataFrame, digits: int = 2, columns=None) -> DataFrame:
    cols = set(columns) if columns else {c for c, t in df.dtypes if t in ("double", "float")}
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])
