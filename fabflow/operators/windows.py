"""Window operators, written so that no window depends on a low-cardinality key alone.

``rolling_mean`` partitions by (key, time bucket) and carries the last
``rows - 1`` readings of earlier buckets into each bucket as a halo, so a
chamber with a third of all readings is still spread over many tasks and the
result equals the unbucketed ``ROWS BETWEEN rows-1 PRECEDING AND CURRENT ROW``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabflow.operators.running import running_totals


def _micros(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _bucket(ts: str, bucket_seconds: int):
    return F.floor(_micros(ts) / F.lit(bucket_seconds * 1_000_000)).cast("long")


#: Time quantiles kept per key: 32 coarse steps of 32 fine ones.
COARSE, FINE = 32, 32


def _cut(df: DataFrame, keys: list[str], micros: str, target_rows: int, sub: str) -> tuple[DataFrame, bool]:
    """``df`` plus ``sub``, up to COARSE * FINE time ranges of each key, and whether a range is still too large."""
    from fabflow.operators.joins import join_small
    from fabflow.session import staging_path
    steps = COARSE * FINE
    probs = [i / steps for i in range(1, steps)]
    n = F.count(F.lit(1))
    need = F.ceil(n / F.lit(float(target_rows)))
    st = df.groupBy(*keys).agg(F.least(F.lit(steps), need).cast("int").alias("_need"), F.percentile_approx(micros, probs, 50_000).alias("_q"),
                               need.alias("_rows"))
    # every (steps / need)-th quantile is a split point, the last of a few equal ones closes the bucket
    wanted = F.transform(F.sequence(F.lit(1), F.col("_need") - 1),
                         lambda i: F.element_at("_q", F.greatest(F.lit(1), F.floor(i * F.lit(steps) / F.col("_need")).cast("int"))))
    splits = F.when((F.col("_need") > 1) & F.col("_q").isNotNull(), F.array_distinct(wanted)).otherwise(F.array().cast("array<bigint>"))
    st = st.select(*[F.col(k).alias(f"_at{i}") for i, k in enumerate(keys)], splits.alias("_splits"),
                   F.coalesce((F.col("_rows") > steps) & (F.element_at("_q", 1) < F.element_at("_q", -1)), F.lit(False)).alias("_more"))
    path = staging_path(df.sparkSession, "time-splits")
    st.withColumn("_coarse", F.filter("_splits", lambda x, i: (i + 1) % FINE == 0)).write.mode("overwrite").parquet(path)
    st = df.sparkSession.read.parquet(path)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_at{i}"))
    cut = join_small(df, st.drop("_more"), same, "left")
    block = F.size(F.filter("_coarse", lambda x: x <= F.col(micros))) * FINE
    inside = F.size(F.filter(F.slice("_splits", F.col("_block") + 1, FINE), lambda x: x <= F.col(micros)))
    cut = cut.withColumn("_block", block).withColumn(sub, F.coalesce(F.col("_block") + inside, F.lit(0)).cast("long"))
    return cut.drop("_block", "_splits", "_coarse", *[f"_at{i}" for i, _ in enumerate(keys)]), not st.filter("_more").isEmpty()


def row_count_buckets(df: DataFrame, key: str, ts: str, target_rows: int = 1_000_000, out: str = "_bk") -> DataFrame:
    """``df`` with a bucket number per key that rises with time and holds about ``target_rows`` rows.

    Split points are the key's own time quantiles (a sketch, one aggregate), as many as its row
    count asks for, so a burst of rows in one hour is cut as finely as a quiet year. One pass makes
    up to COARSE * FINE buckets of a key; where that is not enough every bucket is cut again in the
    same way, until only rows of one and the same microsecond are left together. Rows without a
    timestamp sort first and have the lowest bucket, -1.
    """
    tagged, more = _cut(df.withColumn("_us", _micros(ts)), [key], "_us", target_rows, out)
    while more:
        tagged, more = _cut(tagged, [key, out], "_us", target_rows, "_sub")
        tagged = tagged.withColumn(out, F.col(out) * (COARSE * FINE) + F.col("_sub")).drop("_sub")
    return tagged.withColumn(out, F.when(F.col("_us").isNull(), F.lit(-1)).otherwise(F.col(out)).cast("long")).drop("_us")


def rolling_mean(df: DataFrame, column, key: str = "equipment_id", order=("timestamp", "wafer_id"),
                 rows: int = 5, bucket_seconds: int | str = "auto", out: str | None = None,
                 target_rows_per_bucket: int = 1_000_000) -> DataFrame:
    """Mean of the current and ``rows-1`` preceding readings per key, ordered by ``order``.

    ``column`` may be a list: all columns share one bucketing, halo and window
    pass, each output named ``<column>_rolling_mean``.

    Exact for any bucket width: a bucket's halo is the latest ``rows-1`` rows
    before it, found among the per-bucket tails (each tail row is copied to at
    most ``rows-1`` later buckets). ``bucket_seconds="auto"`` cuts each key at its
    own time quantiles into buckets of about ``target_rows_per_bucket`` rows, so
    neither a hot key nor a burst makes one huge task. Rows without a timestamp
    come first, as in the plain window.
    """
    o = list(order)
    cols = [column] if isinstance(column, str) else list(column)
    outs = [out] if (out and isinstance(column, str)) else [f"{c}_rolling_mean" for c in cols]
    ts = o[0]
    if rows <= 1:
        return df.withColumns({n: F.col(c).cast("double") for c, n in zip(cols, outs)})
    if bucket_seconds == "auto":
        tagged = row_count_buckets(df, key, ts, target_rows_per_bucket).select(*df.columns, "_bk")
    else:
        # no timestamp: below every real bucket
        tagged = df.withColumn("_bk", F.coalesce(_bucket(ts, int(bucket_seconds)), F.lit(-(1 << 62))))
    # last rows-1 rows of every (key, bucket)
    desc = Window.partitionBy(key, "_bk").orderBy(*[F.col(c).desc() for c in o])
    tails = (tagged.select(key, "_bk", *o, *cols)
             .withColumn("_rn", F.row_number().over(desc)).filter(F.col("_rn") < rows).drop("_rn"))
    # each tail row joins the halo of the later buckets among the next rows-1 tail rows
    stream = Window.partitionBy(key).orderBy(*o).rowsBetween(1, rows - 1)
    halo = (tails.withColumn("_to", F.array_distinct(F.collect_list("_bk").over(stream)))
            .select(key, F.explode("_to").alias("_target"), "_bk", *o, *cols)
            .filter(F.col("_target") > F.col("_bk"))
            .select(key, F.col("_target").alias("_bk"), *o, *cols, F.lit(True).alias("_halo")))
    body = tagged.withColumn("_halo", F.lit(False))
    both = body.unionByName(halo, allowMissingColumns=True)
    frame = Window.partitionBy(key, "_bk").orderBy(*o).rowsBetween(-(rows - 1), 0)
    res = both.withColumns({n: F.avg(F.col(c).cast("double")).over(frame) for c, n in zip(cols, outs)})
    return res.filter(~F.col("_halo")).drop("_halo", "_bk")


def daily_defect_trend(df: DataFrame, key: str = "equipment_id", ts: str = "timestamp",
                       value: str = "defect_count") -> DataFrame:
    """Daily total per key and the change from the key's previous day with data.

    The lag runs over the aggregated (key, day) rows only.
    """
    daily = (df.groupBy(key, F.to_date(ts).alias("date"))
             .agg(F.sum(value).alias("daily_defects"), F.count(F.lit(1)).alias("wafers")))
    w = Window.partitionBy(key).orderBy("date")
    return daily.withColumn("change", F.col("daily_defects") - F.lag("daily_defects").over(w))


def share_of_total(df: DataFrame, column: str) -> DataFrame:
    """Count per value and its share of all rows (the total is a scalar subquery)."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
            .withColumn("share", F.col("count") / total))


def batch_ordinal(df: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Per source file: ordinal among files (by name), row count, ``HHMMSS`` label from the name.

    The ordinal is a distributed running total over one row per file; the
    number of files is a scalar subquery.
    """
    per = df.groupBy(file_col).agg(F.count(F.lit(1)).alias("row_count")).withColumn("_one", F.lit(1))
    numbered = running_totals(per, file_col, "_one", "_no")
    return numbered.select(F.col("_no").cast("int").alias("batch_no"), numbered.agg(F.count(F.lit(1))).scalar().alias("batch_total"),
                           file_col, F.substring(F.element_at(F.split(F.col(file_col), "/"), -1), 22, 6).alias("batch_label"),
                           "row_count")
