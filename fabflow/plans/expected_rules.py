"""The rules of the validation reports, written out for the oracle.

These are fixed values stated a second time, on purpose: the oracle takes
limits, sets and order from here and not from the rule sets that the reports
are compiled from, so a wrong threshold there shows as a difference.
"""

from __future__ import annotations

from fabflow.operators.quality import Rule

RAW = ("timestamp", "wafer_id", "equipment_id", "temperature_c", "pressure_torr", "yield_rate", "defect_count", "is_anomaly")
SILVER = (*RAW, "date", "shift_number", "hour_of_day", "equipment_age_days", "temperature_deviation_c", "pressure_deviation_torr",
          "quality_flag", "silver_ingestion_time", "quality_score")
EQUIPMENT = ("EQ001", "EQ002", "EQ003", "EQ004")


def _native(layer: str, columns: tuple, extra: tuple = ()) -> list[Rule]:
    return [
        Rule("schema_superset", name="schema_columns", critical=True, columns=columns, layer=layer),
        Rule("unique", "wafer_id", critical=True),
        Rule("not_null", "wafer_id", critical=True),
        Rule("not_null", "equipment_id", critical=True),
        Rule("not_null", "timestamp", critical=True),
        Rule("not_null", "temperature_c", critical=True),
        Rule("not_null", "yield_rate", critical=True),
        Rule("in_set", "equipment_id", critical=True, values=EQUIPMENT),
        *extra,
        Rule("range", "temperature_c", lo=330.0, hi=380.0, tolerance=0.98),
        Rule("range", "pressure_torr", lo=6.0, hi=14.0, tolerance=0.98),
        Rule("range", "yield_rate", lo=0.5, hi=1.0, tolerance=0.98),
        Rule("range", "defect_count", lo=0, hi=30, tolerance=0.98),
        Rule("mean", "temperature_c", lo=345.0, hi=355.0),
        Rule("mean", "yield_rate", lo=0.9, hi=0.98),
    ]


NATIVE = {
    "bronze": _native("bronze", (*RAW, "date")),
    "gold": _native("gold", (*RAW, "date")),
    "silver": _native("silver", SILVER, (
        Rule("in_set", "shift_number", critical=True, values=(1, 2, 3), optional=True),
        Rule("in_set", "quality_flag", critical=True, values=("PASS", "FAIL"), optional=True))),
}
SUITE = [
    Rule("schema_ordered", name="table_columns_match_ordered_list", critical=False, columns=SILVER, null_policy="ignore"),
    Rule("unique", "wafer_id", critical=True, null_policy="ignore"),
    Rule("not_null", "wafer_id", critical=True, null_policy="ignore"),
    Rule("not_null", "equipment_id", critical=True, null_policy="ignore"),
    Rule("not_null", "timestamp", critical=True, null_policy="ignore"),
    Rule("in_set", "equipment_id", critical=True, values=EQUIPMENT, null_policy="ignore"),
    Rule("range", "temperature_c", lo=330.0, hi=380.0, tolerance=0.98, null_policy="ignore"),
    Rule("range", "pressure_torr", lo=6.0, hi=14.0, tolerance=0.98, null_policy="ignore"),
    Rule("range", "yield_rate", lo=0.5, hi=1.0, tolerance=0.95, null_policy="ignore"),
    Rule("range", "defect_count", lo=0, hi=30, tolerance=0.98, null_policy="ignore"),
    Rule("in_set", "shift_number", critical=True, values=(1, 2, 3), null_policy="ignore"),
    Rule("in_set", "quality_flag", critical=True, values=("PASS", "FAIL"), null_policy="ignore"),
    Rule("range", "quality_score", lo=0, hi=100, tolerance=1.0, null_policy="ignore"),
    Rule("mean", "temperature_c", lo=345.0, hi=355.0, null_policy="ignore"),
    Rule("mean", "yield_rate", lo=0.9, hi=0.98, null_policy="ignore"),
    Rule("max", "timestamp", lo="2024-01-01", hi="2026-12-31", null_policy="ignore"),
]
