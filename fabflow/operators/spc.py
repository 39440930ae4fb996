"""Statistical process control.

Control limits come from a *baseline* frame and are applied to a *target*
frame. Whole-table limits are scalar subqueries (two numbers, no join);
per-group limits are a grouped aggregate joined back on the group key through
:func:`fabflow.operators.joins.join_small`: broadcast when the limits table is
within its size check, a shuffle join otherwise.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabflow import constants as C
from fabflow.functions.scalar import safe_percentage
from fabflow.operators.joins import join_small
from fabflow.operators.running import running_totals


def _g(group) -> list[str]:
    return [] if not group else ([group] if isinstance(group, str) else list(group))


def control_limits(baseline: DataFrame, column: str, group=None, k: float = 3.0) -> DataFrame:
    """mean, population std, UCL = mean + k*std, LCL = mean - k*std (per group when given)."""
    g = _g(group)
    v = F.col(column).cast("double")
    lim = baseline.groupBy(*g).agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))
    return lim.withColumns({"ucl": F.col("mean") + F.lit(k) * F.col("std"),
                            "lcl": F.col("mean") - F.lit(k) * F.col("std")})


def apply_limits(target: DataFrame, baseline: DataFrame, column: str, group=None, k: float = 3.0) -> DataFrame:
    """Target rows with ``ucl``/``lcl`` attached and ``beyond_limits`` (strictly outside)."""
    g = _g(group)
    lim = control_limits(baseline, column, g, k)
    if g:
        out = join_small(target, lim.select(*g, "ucl", "lcl"), g, "left")
        ucl, lcl = F.col("ucl"), F.col("lcl")
    else:
        one = lim.select(F.struct("ucl", "lcl")).scalar()  # one scalar subquery for both limits
        out = target.withColumns({"ucl": one["ucl"], "lcl": one["lcl"]})
        ucl, lcl = F.col("ucl"), F.col("lcl")
    flag = F.coalesce((F.col(column) > ucl) | (F.col(column) < lcl), F.lit(False))
    return out.withColumn("beyond_limits", flag)


def detect_3sigma(target: DataFrame, baseline: DataFrame, column: str, group=None, k: float = 3.0) -> DataFrame:
    """Readings strictly beyond the baseline's k-sigma limits."""
    return apply_limits(target, baseline, column, group, k).filter("beyond_limits")


def detection_summary(target: DataFrame, baseline: DataFrame, column: str, group=None, k: float = 3.0) -> DataFrame:
    """total, detected, rate % (and the detected range)."""
    g = _g(group)
    flagged = apply_limits(target, baseline, column, g, k)
    det = F.count_if("beyond_limits")
    return flagged.groupBy(*g).agg(
        F.count(F.lit(1)).alias("total"), det.alias("detected"),
        safe_percentage(det, F.count(F.lit(1))).alias("rate_pct"),
        F.min(F.when(F.col("beyond_limits"), F.col(column))).alias("detected_min"),
        F.max(F.when(F.col("beyond_limits"), F.col(column))).alias("detected_max"))


def _zone(v: Column) -> Column:
    lo1, hi1 = C.CHART_BAND
    lcl, ucl = C.CHART_LIMITS
    return (F.when(v.isNull(), F.lit("missing"))
            .when(v > ucl, F.lit("above_ucl")).when(v < lcl, F.lit("below_lcl"))
            .when((v > hi1) | (v < lo1), F.lit("outside_1sigma")).otherwise(F.lit("within_1sigma")))


def first_n(df: DataFrame, n: int = C.CHART_POINTS, order=("timestamp", "wafer_id")) -> DataFrame:
    """First n rows by ``order`` numbered 1..n (bounded take-ordered, then a window over n rows)."""
    from pyspark.sql import Window
    o = list(order)
    top = df.orderBy(*o).limit(n)
    return top.withColumn("point", F.row_number().over(Window.orderBy(*o)))


def fixed_control_chart(df: DataFrame, column: str = "temperature_c", n: int = C.CHART_POINTS,
                        order=("timestamp", "wafer_id")) -> DataFrame:
    """Series of the first n points with the fixed chart lines and the zone of each point."""
    s = first_n(df, n, order)
    lcl, ucl = C.CHART_LIMITS
    lo1, hi1 = C.CHART_BAND
    return s.select("point", "wafer_id", F.col(column).alias("value"),
                    F.lit(C.CHART_TARGET).alias("target"), F.lit(lo1).alias("band_low"), F.lit(hi1).alias("band_high"),
                    F.lit(lcl).alias("lcl"), F.lit(ucl).alias("ucl"), _zone(F.col(column)).alias("zone"))


def target_line_series(df: DataFrame, n: int = C.CHART_POINTS, order=("timestamp", "wafer_id")) -> DataFrame:
    """Yield against its 0.92 target line and defects against the expected 2, first n points."""
    s = first_n(df, n, order)
    return s.select("point", "wafer_id", "yield_rate",
                    (F.col("yield_rate") - F.lit(C.YIELD_RESEARCH_TARGET)).alias("yield_vs_target"),
                    "defect_count",
                    (F.col("defect_count") - F.lit(C.DEFECT_LAMBDA)).alias("defects_vs_expected"))


def expected_vs_actual(df: DataFrame) -> DataFrame:
    """Observed moments beside the process model's expected values (one aggregate)."""
    t, y, d = (F.col(c).cast("double") for c in ("temperature_c", "yield_rate", "defect_count"))
    one = df.agg(F.avg(t).alias("t_mean"), F.stddev_pop(t).alias("t_std"),
                 F.avg(y).alias("y_mean"), F.stddev_pop(y).alias("y_std"),
                 F.avg(d).alias("d_mean"), F.stddev_pop(d).alias("d_std"))
    rows = [("temperature_c", "mean", "t_mean", C.TEMP_MEAN), ("temperature_c", "std", "t_std", C.TEMP_STD),
            ("yield_rate", "mean", "y_mean", C.YIELD_RESEARCH_TARGET), ("yield_rate", "std", "y_std", None),
            ("defect_count", "mean", "d_mean", C.DEFECT_LAMBDA),
            ("defect_count", "std", "d_std", math.sqrt(C.DEFECT_LAMBDA))]
    structs = [F.struct(F.lit(c).alias("column"), F.lit(s).alias("statistic"), F.col(a).alias("observed"),
                        F.lit(e).cast("double").alias("expected")) for c, s, a, e in rows]
    return one.select(F.inline(F.array(*structs))).withColumn("difference", F.col("observed") - F.col("expected"))


def classify_anomaly_type(df: DataFrame) -> DataFrame:
    """Inverse of anomaly injection, checked in order: spike, drop, pressure, burst, else none."""
    t, p = F.col("temperature_c"), F.col("pressure_torr")
    kind = (F.when(t >= F.lit(C.TEMP_MEAN + 15), F.lit("temp_spike"))
            .when(t <= F.lit(C.TEMP_MEAN - 15), F.lit("temp_drop"))
            .when(F.abs(p - F.lit(C.PRESSURE_MEAN)) >= F.lit(3.0), F.lit("pressure_fluctuation"))
            .when((F.col("defect_count") >= 10) & F.col("yield_rate").between(0.50, 0.70), F.lit("defect_burst"))
            .otherwise(F.lit("none")))
    return df.withColumn("anomaly_type", kind)


def anomaly_score(df: DataFrame, column: str, group="equipment_id") -> DataFrame:
    """z-score of each reading against its group's mean and sample std.

    Group statistics are an aggregate joined back (not a window over the
    group), so a group holding a third of the rows is combined map-side.
    """
    g = _g(group)
    v = F.col(column).cast("double")
    stats = df.groupBy(*g).agg(F.avg(v).alias("_mu"), F.stddev_samp(v).alias("_sd"))
    if g:
        out = join_small(df, stats, g, "left")
    else:
        one = stats.select(F.struct("_mu", "_sd")).scalar()
        out = df.withColumns({"_mu": one["_mu"], "_sd": one["_sd"]})
    z = F.when(F.col("_sd") > 0, (v - F.col("_mu")) / F.col("_sd"))
    return out.withColumn(f"{column}_zscore", z).drop("_mu", "_sd")


def detector_quality(target: DataFrame, baseline: DataFrame, column: str, truth: str = "is_anomaly",
                     k: float = 3.0) -> DataFrame:
    """Confusion counts, precision and recall of the k-sigma detector against a label."""
    f = apply_limits(target, baseline, column, None, k)
    p, t = F.col("beyond_limits"), F.coalesce(F.col(truth), F.lit(False))
    tp, fp = F.count_if(p & t), F.count_if(p & ~t)
    fn, tn = F.count_if(~p & t), F.count_if(~p & ~t)
    return f.agg(tp.alias("true_positive"), fp.alias("false_positive"), fn.alias("false_negative"),
                 tn.alias("true_negative"),
                 F.try_divide(tp.cast("double"), (tp + fp).cast("double")).alias("precision"),
                 F.try_divide(tp.cast("double"), (tp + fn).cast("double")).alias("recall"))


#: Terms of the Poisson tail that are summed; beyond the mean they fall at least geometrically.
TAIL_TERMS = 400


def poisson_chi_square(df: DataFrame, column: str = "defect_count", lam: float | None = None,
                       max_k: int = 20) -> DataFrame:
    """Chi-square statistic of observed counts against a Poisson pmf.

    Counts 0..max_k-1 get their own cell; the last cell is ``>= max_k``, for any
    ``max_k``. ``lam`` defaults to the sample mean, which costs one more degree of
    freedom: cells - 2 when it is fitted, cells - 1 when it is given. Nulls are
    left out; a negative count raises. Output: statistic, degrees of freedom, cells.
    """
    from pyspark.sql import Window
    v = F.col(column)
    st = df.agg(F.struct(F.count(v).alias("n"), F.avg(v.cast("double")).alias("m"))).scalar()
    total = st["n"]
    lam_c = F.lit(float(lam)) if lam is not None else st["m"]
    whole = F.when(v < 0, F.raise_error(F.lit(f"negative count in {column}"))).otherwise(F.least(v, F.lit(max_k)))
    obs = df.filter(v.isNotNull()).groupBy(whole.cast("int").alias("k")).agg(F.count(F.lit(1)).alias("observed"))
    cells = df.sparkSession.range(max_k + 1 + TAIL_TERMS).select(F.col("id").cast("int").alias("k"))
    # ln k! as a running sum over the cells (a few hundred rows); a mean of zero puts everything in cell 0
    ln_factorial = F.sum(F.log(F.greatest(F.col("k"), F.lit(1)).cast("double"))).over(Window.orderBy("k"))
    pmf = F.when(lam_c > 0, F.exp(-lam_c + F.col("k") * F.log(lam_c) - ln_factorial)).otherwise((F.col("k") == 0).cast("double"))
    # last cell: 1 - P(k < max_k), or the sum of the tail itself where that difference would cancel
    every = Window.partitionBy()
    head = F.coalesce(F.sum(F.when(F.col("k") < max_k, F.col("p"))).over(every), F.lit(0.0))
    tail = F.sum(F.when(F.col("k") >= max_k, F.col("p"))).over(every)
    last = F.when(head < 0.5, F.lit(1.0) - head).otherwise(tail)
    pmfs = (cells.withColumn("p", pmf).withColumn("p", F.when(F.col("k") == max_k, last).otherwise(F.col("p")))
            .filter(F.col("k") <= max_k))
    joined = F.broadcast(pmfs).join(obs, "k", "left").withColumn("observed", F.coalesce("observed", F.lit(0)))
    exp_ = F.col("p") * total
    return joined.agg(F.sum(F.when(exp_ > 0, (F.col("observed") - exp_) ** 2 / exp_).otherwise(F.lit(0.0)))
                      .alias("chi_square"),
                      (F.count(F.lit(1)) - (2 if lam is None else 1)).alias("degrees_of_freedom"),
                      F.count(F.lit(1)).alias("cells"))


def normal_ks_test(df: DataFrame, column: str, mean: float | None = None, std: float | None = None) -> DataFrame:
    """One-sample Kolmogorov-Smirnov test against N(mean, std) (Spark ML's distributed test).

    mean/std default to the process model (350, 5) for temperature.
    """
    from pyspark.ml.stat import KolmogorovSmirnovTest
    mu = C.TEMP_MEAN if mean is None else mean
    sd = C.TEMP_STD if std is None else std
    clean = df.select(F.col(column).cast("double").alias(column)).filter(F.col(column).isNotNull())
    return KolmogorovSmirnovTest.test(clean, column, "norm", float(mu), float(sd))


# Coefficients of the Abramowitz & Stegun 7.1.26 approximation of
# erf (absolute error at most 1.5e-7); Spark SQL has no built-in erf.
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def normal_cdf(z: Column) -> Column:
    """Standard normal CDF from the erf approximation above."""
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERF_P) * x)
    a1, a2, a3, a4, a5 = (F.lit(a) for a in ERF_A)
    poly = ((((a5 * t + a4) * t + a3) * t + a2) * t + a1) * t
    erf = F.lit(1.0) - poly * F.exp(-x * x)
    return F.lit(0.5) * (F.lit(1.0) + F.signum(z) * erf)


def ks_normal(df: DataFrame, column: str, mean: float | None = None, std: float | None = None,
              buckets: int | None = None, terms: int = 100) -> DataFrame:
    """One-sample Kolmogorov-Smirnov statistic against N(mean, std), distributed.

    D = max over distinct values x of max(F_n(x) - Phi(x), Phi(x) - F_n(x-)).
    F_n needs running counts over the sorted values: values are grouped (ties
    collapse map-side) and totalled over ``buckets`` range partitions
    (:func:`fabflow.operators.running.running_totals`), which hold about as
    many values each for any distribution. The p-value is the asymptotic
    Kolmogorov series with ``terms`` terms. mean/std default to the process
    model (350, 5). Without a value the statistic is null.
    """
    mu = C.TEMP_MEAN if mean is None else float(mean)
    sd = C.TEMP_STD if std is None else float(std)
    v = F.col(column).cast("double")
    vals = df.select(v.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan(F.col("x")))
    counts = vals.groupBy("x").agg(F.count(F.lit(1)).alias("c"))
    ranked = running_totals(counts, "x", "c", "_cum", buckets)
    n = ranked.agg(F.sum("c")).scalar()
    phi = normal_cdf((F.col("x") - F.lit(mu)) / F.lit(sd))
    cum = F.col("_cum")
    gap = F.greatest(cum / n - phi, phi - (cum - F.col("c")) / n)
    stat = ranked.agg(F.max(gap).alias("statistic"), F.sum("c").alias("n"))
    lam = F.sqrt(F.col("n").cast("double")) * F.col("statistic")
    series = sum((F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * lam * lam) for k in range(1, terms + 1)),
                 F.lit(0.0))
    return stat.select("statistic", "n", F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)).alias("p_value"))
