"""Skewed-volume probe: synthesize N readings with a hot chamber (1/3 of rows) and a
hot wafer id (1/3 of rows), write Parquet, then time the main operators on it.

usage: python scripts/scale_probe.py [rows] [scratch_dir]
Prints one JSON line of timings and result sizes.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from fabflow.functions.synth import generate_batch  # noqa: E402
from fabflow.operators import dedup as DD  # noqa: E402
from fabflow.operators import profile as P  # noqa: E402
from fabflow.operators import quality as Q  # noqa: E402
from fabflow.operators import sorting as SR  # noqa: E402
from fabflow.operators import windows as W  # noqa: E402
from fabflow.plans import medallion as M  # noqa: E402
from fabflow.session import get_session  # noqa: E402


def main():
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 10_000_000
    root = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="scale-", dir="/tmp")
    spark = get_session("local[8]", 64, extra={"spark.driver.memory": "16g"})
    path = f"{root}/telemetry"
    out = {"rows": n}
    t0 = time.perf_counter()
    g = generate_batch(spark, n)
    hot = F.col("wafer_id").substr(2, 12).cast("long") % 3 == 0
    skewed = g.withColumns({
        "equipment_id": F.when(hot, F.lit("EQ001")).otherwise(F.col("equipment_id")),   # hot chamber
        "wafer_id": F.when(hot, F.lit("W_HOT")).otherwise(F.col("wafer_id")),             # hot key
        "timestamp": F.col("timestamp").cast("timestamp"),
    })
    M.bronze(skewed).write.mode("overwrite").partitionBy("date").parquet(path)
    out["write_sec"] = round(time.perf_counter() - t0, 2)
    df = spark.read.parquet(path)

    def timed(name, frame):
        t = time.perf_counter()
        frame.write.format("noop").mode("overwrite").save()
        out[name] = round(time.perf_counter() - t, 2)

    timed("dq_fused", Q.validation_report(df, "native", "bronze"))
    t = time.perf_counter()
    df.count(); df.select(F.count_distinct("wafer_id")).collect()
    for c in ("wafer_id", "equipment_id", "timestamp", "temperature_c", "yield_rate"):
        df.filter(F.col(c).isNull()).count()
    df.filter(~F.col("equipment_id").isin("EQ001", "EQ002", "EQ003", "EQ004")).count()
    for c in ("temperature_c", "pressure_torr", "yield_rate", "defect_count"):
        df.filter((F.col(c) < 0) | (F.col(c) > 1e9)).count()
    df.select(F.avg("temperature_c")).collect(); df.select(F.avg("yield_rate")).collect()
    out["dq_per_check"] = round(time.perf_counter() - t, 2)
    timed("describe_default_auto", P.describe_numeric(df))
    timed("describe_percentile", P.describe_numeric(df, exact=True))
    timed("describe_bounded", P.describe_numeric(df, exact="bounded", accuracy=10000))
    timed("describe_approx", P.describe_numeric(df, exact=False))
    timed("dedup_latest_hot_key", DD.dedup_latest(df))
    timed("rolling_mean_auto", W.rolling_mean(df, "temperature_c", bucket_seconds="auto",
                                              target_rows_per_bucket=200_000))
    timed("unique_counts", P.unique_counts(df))
    timed("value_counts", P.value_counts(df))
    timed("histogram", P.histogram(df, "temperature_c", 50))
    timed("exact_sample_1pct", SR.exact_sample(df.filter(F.col("wafer_id") != "W_HOT"), 0.01))
    timed("silver", M.silver(df))
    from fabflow.operators.spc import control_limits, ks_normal
    from fabflow.streaming.alerts import run_alerts_batch
    timed("ks_normal", ks_normal(df, "temperature_c"))
    alerts, _ = run_alerts_batch(df, control_limits(df, "temperature_c", "equipment_id", k=1.0), 3,
                                 target_rows_per_bucket=200_000)
    timed("alerts_distributed", alerts)
    from fabflow.operators.merge import upsert_partitioned
    silver_path = f"{root}/silver"
    t = time.perf_counter()
    M.silver(df).drop("silver_ingestion_time").write.mode("overwrite").partitionBy("date").parquet(silver_path)
    out["silver_write"] = round(time.perf_counter() - t, 2)
    inc = (spark.read.parquet(silver_path).filter(F.col("wafer_id").substr(-2, 2) == "07")
           .withColumn("temperature_c", F.col("temperature_c") + 0.5))      # 1 % of wafers re-delivered
    t = time.perf_counter()
    res = upsert_partitioned(inc, silver_path)
    out["upsert_1pct"] = round(time.perf_counter() - t, 2)
    out["upsert_touched_partitions"] = res["touched_partitions"]
    out["dedup_rows"] = DD.dedup_latest(df).count()
    out["scratch"] = root
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
