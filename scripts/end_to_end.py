"""End-to-end run over the test tables: raw JSON lines -> streaming bronze archive
(with quarantine) -> gated silver table (upsert) -> gold KPIs -> profiles and
process control. Writes into a fresh scratch folder and prints a short summary.

usage: python scripts/end_to_end.py [sf_dir] [scratch_dir]
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from fabflow.operators import profile as P  # noqa: E402
from fabflow.operators import quality as Q  # noqa: E402
from fabflow.operators import spc as SPC  # noqa: E402
from fabflow.plans import medallion as M  # noqa: E402
from fabflow.session import get_session  # noqa: E402
from fabflow.sinks.files import write_json_lines  # noqa: E402
from fabflow.sources.bridge import telemetry_raw  # noqa: E402
from fabflow.streaming import jobs as J  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    root = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="e2e-")
    spark = get_session("local[8]", 8)

    # 1. raw feed: JSON lines with ISO timestamps (as a producer would write them)
    write_json_lines(telemetry_raw(spark, sf), f"{root}/raw")

    # 2. bronze: stream the files into a date-partitioned archive, malformed rows quarantined
    q = J.start_archive(spark, f"{root}/raw", f"{root}/bronze", f"{root}/ck/bronze", max_files_per_trigger=4,
                        quarantine=f"{root}/quarantine")
    q.awaitTermination()
    bronze = spark.read.parquet(f"{root}/bronze").drop("batch_id")
    report = Q.validate_dataframe(bronze, layer="bronze")
    print(f"bronze rows {bronze.count()}, checks passed {report['passed']}/{report['total_validations']}, "
          f"critical failures {report['critical_failures']}")

    # 3. silver: only chambers in the valid set pass the gate; the rest stay in bronze for review
    clean = bronze.filter(F.col("equipment_id").isin("EQ001", "EQ002", "EQ003", "EQ004")
                          & F.col("temperature_c").isNotNull())
    result = M.build_silver_table(clean, f"{root}/silver")
    silver = spark.read.parquet(f"{root}/silver")
    print(f"silver rows {silver.count()} (gate valid: {result['is_valid']}, "
          f"touched partitions {result['touched_partitions']})")

    # 4. gold
    kpis = M.equipment_kpis(silver)
    kpis.write.mode("overwrite").parquet(f"{root}/gold/equipment_kpis")
    print(f"gold equipment-day rows {spark.read.parquet(f'{root}/gold/equipment_kpis').count()}")

    # 5. profiles and process control
    P.describe_numeric(silver, ["temperature_c", "pressure_torr", "yield_rate", "defect_count"]).show()
    s = SPC.detection_summary(silver, silver, "temperature_c").first()
    print(f"3-sigma: {s.detected} of {s.total} readings ({s.rate_pct:.2f} %)")
    print(f"scratch: {root}")
    spark.stop()


if __name__ == "__main__":
    main()
