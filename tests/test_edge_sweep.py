"""Every profile, process-control and window operator runs on edge inputs without raising."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fabflow.operators import profile as P
from fabflow.operators import sorting as SR
from fabflow.operators import spc as SPC
from fabflow.operators import windows as W
from fabflow.operators.quantiles import exact_quantiles
from fabflow.plans import medallion as M
from helpers import frame

BASE = datetime(2024, 1, 1)


def _cases(spark):
    one = frame(spark, [{}], with_date=False)
    return {
        "empty": one.limit(0),
        "single": one,
        "constant": frame(spark, [{"wafer_id": f"W{i}", "timestamp": BASE + timedelta(seconds=i)} for i in range(6)],
                          with_date=False),
        "all_null_readings": frame(spark, [{"wafer_id": f"W{i}", "temperature_c": None, "pressure_torr": None}
                                           for i in range(4)], with_date=False),
    }


OPS = {
    "describe_auto": lambda d: P.describe_numeric(d),
    "describe_bounded": lambda d: P.describe_numeric(d, exact="bounded"),
    "describe_approx": lambda d: P.describe_numeric(d, exact=False),
    "describe_all": lambda d: P.describe_all(d),
    "null_profile": lambda d: P.null_profile(d),
    "duplicates": lambda d: P.duplicate_row_profile(d),
    "unique": lambda d: P.unique_counts(d),
    "value_counts": lambda d: P.value_counts(d),
    "corr": lambda d: P.correlation_matrix(d),
    "corr_grouped": lambda d: P.correlation_matrix(d, group="equipment_id"),
    "bytes": lambda d: P.column_bytes(d),
    "distribution": lambda d: P.distribution_stats(d, "temperature_c"),
    "mode": lambda d: P.mode_value(d, "defect_count"),
    "frequency": lambda d: P.frequency_distribution(d, "defect_count"),
    "histogram": lambda d: P.histogram(d, "temperature_c", 10),
    "anomalies": lambda d: P.anomaly_summary(d),
    "quantiles": lambda d: exact_quantiles(d, ["temperature_c"], [0.1, 0.9], bits=6),
    "limits": lambda d: SPC.detection_summary(d, d, "temperature_c"),
    "limits_grouped": lambda d: SPC.detection_summary(d, d, "temperature_c", "equipment_id"),
    "zscore": lambda d: SPC.anomaly_score(d, "temperature_c"),
    "expected": lambda d: SPC.expected_vs_actual(d),
    "chi_square": lambda d: SPC.poisson_chi_square(d),
    "ks": lambda d: SPC.ks_normal(d, "temperature_c"),
    "quality": lambda d: SPC.detector_quality(d, d, "temperature_c"),
    "rolling": lambda d: W.rolling_mean(d, "temperature_c"),
    "trend": lambda d: W.daily_defect_trend(d),
    "share": lambda d: W.share_of_total(d, "equipment_id"),
    "sample": lambda d: SR.exact_sample(d, 0.5),
    "silver": lambda d: M.silver(d),
}


@pytest.mark.parametrize("op", sorted(OPS))
def test_operator_on_edge_inputs(spark, op):
    for name, df in _cases(spark).items():
        try:
            OPS[op](df).collect()
        except Exception as e:  # noqa: BLE001
            pytest.fail(f"{op} on {name}: {str(e)[:300]}")
