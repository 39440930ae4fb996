"""Data-quality rules compiled to a single aggregate pass.

A rule set is a list of :class:`Rule`. :func:`validation_report` turns every
row-level rule into aggregate expressions, evaluates *all* of them in one
global ``agg`` (one scan, one row per map task shuffled), and reshapes the
single result row into one report row per rule with ``inline``. The exact
distinct count of a uniqueness rule is a separate key-only subquery: a second
read of the input that shuffles keys only. A rule that cannot be evaluated on
the columns as they are is a failed critical row, never a failed report. Schema
rules and rules that reference missing columns are resolved from metadata and
never start a job.

Two semantics are supported (see ``null_policy``):

* ``native``: null is never out of range or out of set, but stays in the
  denominator; uniqueness counts every row (nulls make it fail); a range on
  zero rows has pass rate 0 and fails; a mean over no values fails.
* ``ignore``: rules look only at non-null values; tolerances are taken over
  non-null rows; any rule error is a critical failure.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabflow import constants as C

# The report's column names and types.
REPORT_FIELDS = [
    ("validation", "string"), ("column", "string"), ("rule", "string"),
    ("success", "boolean"), ("critical", "boolean"),
    ("element_count", "bigint"), ("unexpected_count", "bigint"),
    ("pass_rate", "double"), ("observed", "double"),
    ("expected_min", "double"), ("expected_max", "double"),
    ("details", "string"), ("error", "string"),
]
_TYPES = {"string": T.StringType(), "boolean": T.BooleanType(), "bigint": T.LongType(), "double": T.DoubleType()}
REPORT_SCHEMA = T.StructType([T.StructField(n, _TYPES[t]) for n, t in REPORT_FIELDS])


@dataclass(frozen=True)
class Rule:
    """One data-quality rule.

    kind: ``schema_superset`` | ``schema_ordered`` | ``unique`` | ``not_null``
    | ``in_set`` | ``range`` | ``mean`` | ``max``.
    """

    kind: str
    column: str | None = None
    name: str | None = None
    critical: bool = False
    values: tuple = ()
    lo: object = None
    hi: object = None
    tolerance: float = 1.0
    columns: tuple = ()
    null_policy: str = "native"
    layer: str | None = None
    optional: bool = False  # skipped silently when the column is absent

    @property
    def validation(self) -> str:
        if self.name:
            return self.name
        suffix = {"unique": "uniqueness", "not_null": "not_null", "in_set": "values",
                  "range": "range", "mean": "mean", "max": "max"}[self.kind]
        return f"{self.column}_{suffix}"


def _lit_list(values) -> str:
    return ",".join(str(v) for v in values)


# ---------------------------------------------------------------------------
# Rule sets.
# ---------------------------------------------------------------------------
def native_rules(layer: str = "silver") -> list[Rule]:
    """The native validator's checks: 14 on bronze/gold, 16 on silver."""
    expected = C.SILVER_COLUMNS if layer == "silver" else C.BRONZE_COLUMNS
    rules = [
        Rule("schema_superset", name="schema_columns", critical=True, columns=tuple(expected), layer=layer),
        Rule("unique", "wafer_id", critical=True),
    ]
    rules += [Rule("not_null", c, critical=True) for c in C.NATIVE_NOT_NULL]
    rules.append(Rule("in_set", "equipment_id", critical=True, values=tuple(C.VALID_EQUIPMENT)))
    if layer == "silver":
        rules.append(Rule("in_set", "shift_number", critical=True, values=tuple(C.VALID_SHIFTS), optional=True))
        rules.append(Rule("in_set", "quality_flag", critical=True, values=tuple(C.VALID_QUALITY_FLAGS), optional=True))
    rules += [
        Rule("range", "temperature_c", lo=C.TEMP_MIN, hi=C.TEMP_MAX, tolerance=C.TOLERANCE),
        Rule("range", "pressure_torr", lo=C.PRESSURE_MIN, hi=C.PRESSURE_MAX, tolerance=C.TOLERANCE),
        Rule("range", "yield_rate", lo=C.YIELD_MIN, hi=C.YIELD_MAX, tolerance=C.TOLERANCE),
        Rule("range", "defect_count", lo=C.DEFECT_MIN, hi=C.DEFECT_MAX, tolerance=C.TOLERANCE),
        Rule("mean", "temperature_c", lo=C.TEMP_MEAN_MIN, hi=C.TEMP_MEAN_MAX),
        Rule("mean", "yield_rate", lo=C.YIELD_MEAN_MIN, hi=C.YIELD_MEAN_MAX),
    ]
    return rules


def suite_rules() -> list[Rule]:
    """The declarative 16-rule silver suite; unique / not-null / in-set are critical."""
    p = "ignore"
    rules = [
        Rule("schema_ordered", name="table_columns_match_ordered_list", critical=False,
             columns=tuple(C.SILVER_COLUMNS), null_policy=p),
        Rule("unique", "wafer_id", critical=True, null_policy=p),
    ]
    rules += [Rule("not_null", c, critical=True, null_policy=p) for c in C.SUITE_NOT_NULL]
    rules += [
        Rule("in_set", "equipment_id", critical=True, values=tuple(C.VALID_EQUIPMENT), null_policy=p),
        Rule("range", "temperature_c", lo=C.TEMP_MIN, hi=C.TEMP_MAX, tolerance=C.TOLERANCE, null_policy=p),
        Rule("range", "pressure_torr", lo=C.PRESSURE_MIN, hi=C.PRESSURE_MAX, tolerance=C.TOLERANCE, null_policy=p),
        Rule("range", "yield_rate", lo=C.YIELD_MIN, hi=C.YIELD_MAX, tolerance=C.SUITE_YIELD_TOLERANCE, null_policy=p),
        Rule("range", "defect_count", lo=C.DEFECT_MIN, hi=C.DEFECT_MAX, tolerance=C.TOLERANCE, null_policy=p),
        Rule("in_set", "shift_number", critical=True, values=tuple(C.VALID_SHIFTS), null_policy=p),
        Rule("in_set", "quality_flag", critical=True, values=tuple(C.VALID_QUALITY_FLAGS), null_policy=p),
        Rule("range", "quality_score", lo=C.QUALITY_SCORE_MIN, hi=C.QUALITY_SCORE_MAX, tolerance=1.0, null_policy=p),
        Rule("mean", "temperature_c", lo=C.TEMP_MEAN_MIN, hi=C.TEMP_MEAN_MAX, null_policy=p),
        Rule("mean", "yield_rate", lo=C.YIELD_MEAN_MIN, hi=C.YIELD_MEAN_MAX, null_policy=p),
        Rule("max", "timestamp", lo=C.FRESHNESS_MIN, hi=C.FRESHNESS_MAX, null_policy=p),
    ]
    return rules


def rule_set(name: str, layer: str = "silver") -> list[Rule]:
    if name == "native":
        return native_rules(layer)
    if name == "suite":
        return suite_rules()
    raise ValueError(f"unknown rule set {name!r}")


# ---------------------------------------------------------------------------
# Compilation.
# ---------------------------------------------------------------------------
def _row(rule: Rule, *, success, element_count=None, unexpected=None, pass_rate=None,
         observed=None, expected_min=None, expected_max=None, details=None, error=None,
         critical=None) -> Column:
    vals = {
        "validation": F.lit(rule.validation),
        "column": F.lit(rule.column).cast("string"),
        "rule": F.lit(rule.kind),
        "success": success if isinstance(success, Column) else F.lit(bool(success)),
        "critical": F.lit(rule.critical if critical is None else critical),
        "element_count": element_count, "unexpected_count": unexpected,
        "pass_rate": pass_rate, "observed": observed,
        "expected_min": expected_min, "expected_max": expected_max,
        "details": details, "error": error,
    }
    cols = []
    for n, t in REPORT_FIELDS:
        v = vals[n]
        if v is None:
            v = F.lit(None)
        elif not isinstance(v, Column):
            v = F.lit(v)
        cols.append(v.cast(t).alias(n))
    return F.struct(*cols)


def _numeric_bound(v):
    return None if v is None or isinstance(v, str) else float(v)


def _check_bounds(rule: Rule, kind: str) -> None:
    """Raise ValueError where a bound can never be compared with a column of this type."""
    for bound in (rule.lo, rule.hi):
        if bound is None or (kind == "string" and isinstance(bound, str)):
            continue
        if kind == "boolean":
            raise ValueError(f"{rule.column} is boolean and has no order to bound")
        if kind.startswith("timestamp") or kind == "date":
            if isinstance(bound, str):
                datetime.fromisoformat(bound)
        elif isinstance(bound, str):
            float(bound)


def _outside(c: Column, lo, hi) -> Column:
    """Value below or above the bounds that are given; null for a null value."""
    below = F.lit(False) if lo is None else c < lo
    above = F.lit(False) if hi is None else c > hi
    return F.when(c.isNotNull(), below | above)


class _Compiler:
    def __init__(self, df: DataFrame):
        self.df = df
        self.types = dict(df.dtypes)
        self.aggs: list[Column] = []
        self.post: dict[str, Column] = {}   # scalar subqueries attached once to the result row
        self._n = 0

    def agg(self, expr: Column) -> Column:
        """Register an aggregate; return a reference to its value in the result row."""
        name = f"_a{self._n}"
        self._n += 1
        self.aggs.append(expr.alias(name))
        return F.col(name)

    def distinct_count(self, c: Column) -> Column:
        """Exact distinct count as its own key-only scalar subquery.

        Inside the main aggregate, a single distinct would make Spark group
        every other partial buffer by the key and shuffle them all per key;
        on its own it shuffles only (map-side deduplicated) keys, and the main
        aggregate stays a plain global aggregate.
        """
        name = f"_d{self._n}"
        self._n += 1
        self.post[name] = self.df.agg(F.count_distinct(c)).scalar()
        return F.col(name)

    def total(self) -> Column:
        if not hasattr(self, "_total"):
            self._total = self.agg(F.count(F.lit(1)))
        return self._total

    def attempt(self, rule: Rule) -> Column | None:
        """``compile``, with whatever cannot be evaluated on these columns as a failed critical row."""
        before, n = list(self.aggs), self._n
        try:
            row = self.compile(rule)
            new = self.aggs[len(before):]
            if new:
                self.df.agg(*new).schema                        # analysis only, no job
            return row
        except (AnalysisException, TypeError, ValueError) as e:
            self.aggs, self._n = before, n
            reason = str(e).split("\n")[0][:200]
            return _row(rule, success=False, critical=True, error=reason)

    def compile(self, rule: Rule) -> Column | None:
        ignore = rule.null_policy == "ignore"
        if rule.kind == "schema_superset":
            missing = sorted(set(rule.columns) - set(self.df.columns))
            details = "missing=" + _lit_list(missing) + (f";layer={rule.layer}" if rule.layer else "")
            return _row(rule, success=not missing, unexpected=len(missing), details=details)
        if rule.kind == "schema_ordered":
            ok = list(self.df.columns) == list(rule.columns)
            return _row(rule, success=ok, details=None if ok else "actual=" + _lit_list(self.df.columns))
        if rule.column not in self.types:
            if rule.optional:
                return None
            return _row(rule, success=False, critical=True if ignore else rule.critical,
                        error=f"column {rule.column!r} not found")
        c = F.col(rule.column)
        kind = self.types[rule.column]
        bounds = [b for b in (rule.lo, rule.hi) if b is not None]
        if rule.kind in ("range", "mean", "max") and kind == "string" and not any(isinstance(b, str) for b in bounds):
            # numbers kept as text: judged as numbers, an error where some text is none
            number = c.try_cast("double")
            wrong = self.agg(F.count_if(c.isNotNull() & number.isNull()))
            failed = _row(rule, success=False, critical=True,
                          error=F.concat(wrong.cast("string"), F.lit(f" values of {rule.column} are no numbers")))
            return F.when(wrong > 0, failed).otherwise(self.evaluate(rule, number, "double"))
        return self.evaluate(rule, c, kind)

    def evaluate(self, rule: Rule, c: Column, kind: str) -> Column:
        """The report row of a rule over one column expression of type ``kind``."""
        ignore = rule.null_policy == "ignore"
        if rule.kind in ("range", "mean", "max"):
            _check_bounds(rule, kind)
        if rule.kind == "unique":
            distinct = self.distinct_count(c)
            base = self.agg(F.count(c)) if ignore else self.total()
            return _row(rule, success=base == distinct, element_count=base, unexpected=base - distinct)
        if rule.kind == "not_null":
            nulls = self.agg(F.count_if(c.isNull()))
            return _row(rule, success=nulls == 0, element_count=self.total(), unexpected=nulls)
        if rule.kind == "in_set":
            values = list(rule.values)
            if kind == "string" and not all(isinstance(v, str) for v in values):
                number = c.try_cast("double")     # text that is no number is not in a set of numbers
                bad = self.agg(F.count_if(c.isNotNull() & ~F.coalesce(number.isin(values), F.lit(False))))
            else:
                bad = self.agg(F.count_if(~c.isin(values)))
            base = self.agg(F.count(c)) if ignore else self.total()
            return _row(rule, success=bad == 0, element_count=base, unexpected=bad,
                        details="valid=" + _lit_list(rule.values))
        if rule.kind == "range":
            out = self.agg(F.count_if(_outside(c, rule.lo, rule.hi)))
            if ignore:
                base = self.agg(F.count(c))
                rate = F.when(base > 0, (base - out) / base)
                ok = F.coalesce(rate >= F.lit(rule.tolerance), F.lit(True))
            else:
                base = self.total()
                rate = F.when(base > 0, (base - out) / base).otherwise(F.lit(0.0))
                ok = rate >= F.lit(rule.tolerance)
            return _row(rule, success=ok, element_count=base, unexpected=out, pass_rate=rate,
                        expected_min=_numeric_bound(rule.lo), expected_max=_numeric_bound(rule.hi),
                        details=f"tolerance={rule.tolerance}")
        if rule.kind == "mean":
            m = self.agg(F.avg(c.cast("double")))
            ok = F.coalesce(~_outside(m, rule.lo, rule.hi), F.lit(False))
            return _row(rule, success=ok, element_count=self.agg(F.count(c)), observed=m,
                        expected_min=_numeric_bound(rule.lo), expected_max=_numeric_bound(rule.hi))
        if rule.kind == "max":
            if kind.startswith("timestamp") or kind == "date":
                mx = self.agg(F.max(c.cast("timestamp")))
                lo, hi = (None if v is None else F.to_timestamp(F.lit(v)) for v in (rule.lo, rule.hi))
                observed = F.unix_micros(mx) / F.lit(1e6)
                bmin = bmax = None
                details = "between=" + "..".join("" if v is None else str(v) for v in (rule.lo, rule.hi))
            else:
                mx = self.agg(F.max(c.cast("double")))
                lo, hi = _numeric_bound(rule.lo), _numeric_bound(rule.hi)
                observed, bmin, bmax, details = mx, lo, hi, None
            ok = F.coalesce(~_outside(mx, lo, hi), F.lit(False))
            return _row(rule, success=ok, element_count=self.agg(F.count(c)), observed=observed,
                        expected_min=bmin, expected_max=bmax, details=details)
        raise ValueError(f"unknown rule kind {rule.kind!r}")


def _report(df: DataFrame, rules: list[Rule], row_of) -> DataFrame:
    comp = _Compiler(df)
    comp.total()
    rows = [r for r in (row_of(comp, rule) for rule in rules) if r is not None]
    one = df.agg(*comp.aggs)
    if comp.post:
        one = one.withColumns(comp.post)
    return one.select(F.inline(F.array(*rows)))


def validation_report(df: DataFrame, rules: list[Rule] | str = "native", layer: str = "silver") -> DataFrame:
    """One row per rule (columns :data:`REPORT_FIELDS`), from one aggregate pass.

    All rules are analysed together; only where that fails is each tried on its own, so that the
    rules at fault become failed rows and the others still count.
    """
    if isinstance(rules, str):
        rules = rule_set(rules, layer)
    try:
        return _report(df, rules, _Compiler.compile)
    except (AnalysisException, TypeError, ValueError):
        return _report(df, rules, _Compiler.attempt)


def validation_summary(report: DataFrame) -> DataFrame:
    """total_validations, passed, failed, critical_failures (one row)."""
    return report.agg(
        F.count(F.lit(1)).alias("total_validations"),
        F.count_if(F.col("success")).alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.count_if(~F.col("success") & F.col("critical")).alias("critical_failures"),
    )


def quality_gate(report: DataFrame) -> DataFrame:
    """Summary plus ``is_valid``: true iff no critical rule failed."""
    s = validation_summary(report)
    return s.withColumn("is_valid", F.col("critical_failures") == 0)


class QualityGateError(RuntimeError):
    pass


def assert_valid(report: DataFrame) -> dict:
    """Driver-side gate: one action on the 1-row summary; raise on critical failure."""
    row = quality_gate(report).first().asDict()
    if not row["is_valid"]:
        raise QualityGateError(f"pipeline blocked: {row['critical_failures']} critical validations failed")
    return row


def row_conditions(df: DataFrame, rules: list[Rule] | str = "native", layer: str = "silver") -> list[tuple[str, Column]]:
    """(rule name, violation predicate) for every row-level rule whose column exists."""
    if isinstance(rules, str):
        rules = rule_set(rules, layer)
    cols = set(df.columns)
    out = []
    for r in rules:
        if r.column not in cols:
            continue
        c = F.col(r.column)
        if r.kind == "not_null":
            out.append((r.validation, c.isNull()))
        elif r.kind == "in_set":
            out.append((r.validation, F.coalesce(~c.isin(list(r.values)), F.lit(False))))
        elif r.kind == "range":
            out.append((r.validation, F.coalesce((c < F.lit(r.lo)) | (c > F.lit(r.hi)), F.lit(False))))
    return out


def row_level_violations(df: DataFrame, rules: list[Rule] | str = "native", layer: str = "silver") -> DataFrame:
    """Rows that break at least one row-level rule, with the rule names (comma-joined)."""
    conds = row_conditions(df, rules, layer)
    names = F.concat_ws(",", *[F.when(cond, F.lit(name)) for name, cond in conds])
    return df.withColumn("violations", names).filter(F.col("violations") != "")


def validate(df: DataFrame, layer: str = "silver", rules: str = "native") -> tuple[DataFrame, DataFrame]:
    """(report, gate) pair for a layer; both lazy."""
    report = validation_report(df, rules, layer)
    return report, quality_gate(report)


def _details(rule: Rule | None, r: dict) -> dict:
    """Per-kind details with the familiar keys, from one report row."""
    if r.get("error"):
        return {"error": r["error"]}
    kind = r["rule"]
    if kind == "unique":
        return {"duplicates": r["unexpected_count"]}
    if kind == "not_null":
        return {"null_count": r["unexpected_count"]}
    if kind == "in_set":
        return {"invalid_count": r["unexpected_count"], "valid_values": list(rule.values) if rule else None}
    if kind == "range":
        return {"min": r["expected_min"], "max": r["expected_max"], "out_of_range": r["unexpected_count"],
                "pass_rate": r["pass_rate"]}
    if kind in ("mean", "max"):
        return {"expected_min": rule.lo if rule else r["expected_min"], "expected_max": rule.hi if rule else r["expected_max"],
                "actual": r["observed"]}
    if kind == "schema_superset":
        missing = (r["details"] or "").split(";")[0].removeprefix("missing=")
        return {"missing": [m for m in missing.split(",") if m], "layer": rule.layer if rule else None}
    return {"details": r["details"]}


def validate_dataframe(df: DataFrame, layer: str = "silver", rules: str | list[Rule] = "native") -> dict:
    """Validator-style summary dict: total_validations, passed, failed, critical_failures, results.

    One Spark job (the fused report); only the report rows (at most 16) reach
    the driver. Each result carries ``validation``, ``column``, ``success``,
    ``critical`` and ``details`` with per-kind keys (duplicates, null_count,
    invalid_count / valid_values, min / max / out_of_range / pass_rate,
    expected_min / expected_max / actual, missing / layer).
    """
    rule_list = rule_set(rules, layer) if isinstance(rules, str) else list(rules)
    by_name = {r.validation: r for r in rule_list}
    rows = [r.asDict() for r in validation_report(df, rule_list, layer).collect()]
    results = [{"validation": r["validation"], "column": r["column"], "success": r["success"],
                "critical": r["critical"], "details": _details(by_name.get(r["validation"]), r)} for r in rows]
    passed = sum(1 for r in results if r["success"])
    crit = sum(1 for r in results if not r["success"] and r["critical"])
    return {"total_validations": len(results), "passed": passed, "failed": len(results) - passed,
            "critical_failures": crit, "results": results}


def is_valid(summary: dict) -> bool:
    """True iff no critical validation failed."""
    return summary["critical_failures"] == 0


# Expectation-style configuration -> rules. Critical by type: unique, not-null, in-set.
_CONFIG_KINDS = {
    "expect_table_columns_to_match_ordered_list": "schema_ordered",
    "expect_column_values_to_be_unique": "unique",
    "expect_column_values_to_not_be_null": "not_null",
    "expect_column_values_to_be_in_set": "in_set",
    "expect_column_values_to_be_between": "range",
    "expect_column_mean_to_be_between": "mean",
    "expect_column_max_to_be_between": "max",
}
_CRITICAL_KINDS = {"unique", "not_null", "in_set"}


def rules_from_config(configs: list[dict], null_policy: str = "ignore") -> list[Rule]:
    """Rules from expectation-style configs: ``{"expectation_type": ..., "kwargs": {...}}``.

    Supported kwargs: ``column``, ``column_list``, ``value_set``, ``min_value``,
    ``max_value``, ``mostly``. An unknown type raises ``ValueError``.
    """
    rules = []
    for cfg in configs:
        etype = cfg["expectation_type"]
        kind = _CONFIG_KINDS.get(etype)
        if kind is None:
            raise ValueError(f"unsupported expectation type {etype!r}")
        kw = cfg.get("kwargs", {})
        crit = kind in _CRITICAL_KINDS
        if kind == "schema_ordered":
            rules.append(Rule(kind, name="table_columns_match_ordered_list", critical=crit,
                              columns=tuple(kw["column_list"]), null_policy=null_policy))
        elif kind == "in_set":
            rules.append(Rule(kind, kw["column"], critical=crit, values=tuple(kw["value_set"]), null_policy=null_policy))
        elif kind in ("range", "mean", "max"):
            rules.append(Rule(kind, kw["column"], critical=crit, lo=kw.get("min_value"), hi=kw.get("max_value"),
                              tolerance=float(kw.get("mostly", 1.0)), null_policy=null_policy))
        else:
            rules.append(Rule(kind, kw["column"], critical=crit, null_policy=null_policy))
    return rules
