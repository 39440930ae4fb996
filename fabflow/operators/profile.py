"""Column profiles and descriptive statistics as DataFrames.

Every profile takes an optional ``group`` (list of columns): the empty group
profiles the whole table; ``group=["source_file"]`` gives the per-file form.
Wide aggregates are computed in one ``agg`` (one scan, partial aggregation)
and reshaped to long form with ``inline`` on the already-aggregated rows.
Frequency-type profiles use two-stage ``groupBy`` so that a value holding a
third of all rows is combined map-side before the shuffle.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabflow import constants as C
from fabflow.functions.scalar import safe_percentage
from fabflow.operators import comoments as CM
from fabflow.operators import sorting as SR
from fabflow.operators.joins import join_groups, renamed, same

NUMERIC_TYPES = ("double", "float", "bigint", "int", "smallint", "tinyint")
FIXED_WIDTH = {"double": 8, "bigint": 8, "timestamp": 8, "timestamp_ntz": 8, "int": 4, "date": 4,
               "float": 4, "smallint": 2, "tinyint": 1, "boolean": 1}


def _g(group) -> list[str]:
    return [] if not group else ([group] if isinstance(group, str) else list(group))


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Columns of floating or integral type (booleans and timestamps excluded)."""
    return [c for c, t in df.dtypes if t in NUMERIC_TYPES and c not in exclude]


def _value(df: DataFrame, c: str) -> Column:
    """Column with NaN read as missing (the profile convention)."""
    t = dict(df.dtypes)[c]
    return F.when(~F.isnan(F.col(c)), F.col(c)) if t in ("double", "float") else F.col(c)


def _agg_long(df: DataFrame, group: list[str], per_column: dict[str, list[tuple[str, Column]]]) -> DataFrame:
    """One aggregate over all columns, reshaped to one row per (group, column)."""
    aggs, rows = [], []
    for i, (c, stats) in enumerate(per_column.items()):
        fields = [F.lit(c).alias("column")]
        for j, (name, expr) in enumerate(stats):
            alias = f"_s{i}_{j}"
            aggs.append(expr.alias(alias))
            fields.append(F.col(alias).alias(name))
        rows.append(F.struct(*fields))
    wide = df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)
    return wide.select(*group, F.inline(F.array(*rows)))


# AGG-1..3 -------------------------------------------------------------------
def row_count(df: DataFrame, group=None) -> DataFrame:
    return df.groupBy(*_g(group)).agg(F.count(F.lit(1)).alias("row_count"))


def count_distinct(df: DataFrame, column: str, group=None, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    g = _g(group)
    expr = F.approx_count_distinct(column, rsd) if approx else F.count_distinct(column)
    return df.groupBy(*g).agg(expr.alias("distinct_count"))


def column_mean(df: DataFrame, column: str, group=None) -> DataFrame:
    g = _g(group)
    return df.groupBy(*g).agg(F.avg(_value(df, column)).alias("mean"))


# AGG-4, 5, 23 ----------------------------------------------------------------
def anomaly_summary(df: DataFrame, group=None, flag: str = "is_anomaly") -> DataFrame:
    """Anomaly count, rate in percent, and normal count."""
    g = _g(group)
    n, a = F.count(F.lit(1)), F.count_if(F.col(flag))
    return df.groupBy(*g).agg(
        a.alias("anomaly_count"),
        safe_percentage(a, n).alias("anomaly_rate_pct"),
        (n - a).alias("normal_count"),
    )


def anomaly_stats(df: DataFrame, group=None, flag: str = "is_anomaly", exact: bool | str = "bounded") -> DataFrame:
    """describe() of the four process readings over anomalous rows only."""
    cols = [c for c in C.PROCESS_COLUMNS if c in df.columns]
    return describe_numeric(df.filter(F.col(flag)), cols, group, exact)


def min_max(df: DataFrame, column: str, group=None) -> DataFrame:
    g = _g(group)
    return df.groupBy(*g).agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


# AGG-6, FLT-5 ---------------------------------------------------------------
def null_profile(df: DataFrame, group=None, nulls_only: bool = False) -> DataFrame:
    """Per column: null count and null percentage (2 digits). NaN counts as null."""
    g = _g(group)
    types = dict(df.dtypes)
    n = F.count(F.lit(1))
    per = {}
    for c in df.columns:
        if c in g:
            continue
        miss = F.col(c).isNull() | F.isnan(F.col(c)) if types[c] in ("double", "float") else F.col(c).isNull()
        per[c] = [("null_count", F.count_if(miss)), ("_rows", n)]
    out = _agg_long(df, g, per)
    out = out.select(*g, "column", "null_count",
                     F.round(safe_percentage(F.col("null_count"), F.col("_rows")), 2).alias("null_percentage"))
    return out.filter(F.col("null_count") > 0) if nulls_only else out


# AGG-7, 8 -------------------------------------------------------------------
def duplicate_row_profile(df: DataFrame, group=None) -> DataFrame:
    """Fully identical rows after the first: count and percent of all rows."""
    g = _g(group)
    cols = [c for c in df.columns if c not in g]
    per_row = df.groupBy(*g, *cols).agg(F.count(F.lit(1)).alias("_n"))
    dup = F.sum(F.col("_n") - 1)
    tot = F.sum("_n")
    return per_row.groupBy(*g).agg(dup.alias("duplicate_rows"),
                                  F.round(safe_percentage(dup, tot), 2).alias("duplicate_pct"))


def duplicate_key_profile(df: DataFrame, key: str = "wafer_id", group=None) -> DataFrame:
    """Occurrences of a key beyond its first (null keys count as one value)."""
    g = _g(group)
    per_key = df.groupBy(*g, key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy(*g).agg(F.sum(F.col("_n") - 1).alias("duplicate_keys"))


# AGG-9, 10 ------------------------------------------------------------------
def describe_numeric(df: DataFrame, columns=None, group=None, exact: bool | str = "bounded",
                     accuracy: int = 10000) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (linear interpolation), max per column.

    Every column has a row in every group (null groups included); without a value its count is 0
    and the rest null. An empty table has one row per column, or none when grouped.

    Quartiles (all exact except ``False``):
    * ``exact="bounded"`` (default, at every size): exact quartiles in bounded
      memory by histogram levels (:mod:`fabflow.operators.quantiles`);
    * ``exact=True``: Spark's exact ``percentile`` in one pass with identical
      results, whose buffer holds every distinct value of a group (for callers
      who know their input to be small);
    * ``exact=False``: the ``percentile_approx`` sketch (rank error 1/accuracy).
    """
    g = _g(group)
    cols = list(columns) if columns else numeric_columns(df, g)
    moments = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    if exact == "bounded":
        from fabflow.operators.quantiles import quantile_table
        out = quantile_table(df, cols, [0.25, 0.5, 0.75], g, moments).withColumnRenamed("quantiles", "_q")
    else:
        per = {}
        for c in cols:
            vd = _value(df, c).cast("double")
            q = F.percentile(vd, [0.25, 0.5, 0.75]) if exact else F.percentile_approx(vd, [0.25, 0.5, 0.75], accuracy)
            per[c] = [("count", F.count(vd)), ("_q", q), *[(name, f(vd)) for name, f in moments.items()]]
        out = _agg_long(df, g, per)
    return out.select(*g, "column", "count", "mean", "std", "min",
                      *[F.col("_q")[i].cast("double").alias(name) for i, name in enumerate(("p25", "p50", "p75"))], "max")


def _typed_long(df: DataFrame, cols: list[str], group: list[str], missing: bool = False) -> tuple[DataFrame, list[str], Column]:
    """(group..., column, one nullable slot per input type) for the given columns.

    Values keep their own type (no per-row text cast); NaN reads as missing;
    rows whose value is missing are dropped unless ``missing`` asks for them.
    Returns the frame, the slot names and the test for a present value.
    """
    types = dict(df.dtypes)
    slot_types = sorted({types[c] for c in cols})
    slot = {t: f"_v{i}" for i, t in enumerate(slot_types)}
    rows = []
    for c in cols:
        fields = [F.lit(c).alias("column")]
        for t in slot_types:
            v = _value(df, c) if types[c] == t else F.lit(None).cast(t)
            fields.append(v.alias(slot[t]))
        rows.append(F.struct(*fields))
    long = df.select(*group, F.inline(F.array(*rows)))
    present = F.lit(False)
    for t in slot_types:
        present = present | F.col(slot[t]).isNotNull()
    return long if missing else long.filter(present), [slot[t] for t in slot_types], present


def _as_text(slots: list[str]) -> Column:
    """The one non-null slot rendered as text (applied after aggregation)."""
    return F.coalesce(*[F.col(s).cast("string") for s in slots])


def _every_column(out: DataFrame, cols: list[str], g: list[str], counts: list[str]) -> DataFrame:
    """Without a group, one row for each of ``cols`` also from an empty table (``counts`` 0, the rest null)."""
    if g:
        return out
    listed = out.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    return F.broadcast(listed).join(out, "column", "left").fillna(0, counts).select(*out.columns)


def describe_categorical(df: DataFrame, columns=None, group=None) -> DataFrame:
    """count, unique, top (most frequent; smallest on ties), freq per non-numeric column.

    Columns without a value have count and unique 0, no top and no freq.
    """
    g = _g(group)
    cols = list(columns) if columns else [c for c, t in df.dtypes if t not in NUMERIC_TYPES and c not in g]
    long, slots, present = _typed_long(df, cols, g, missing=True)
    counts = (long.groupBy(*g, "column", *slots).agg(F.count(F.lit(1)).alias("_n"))
              .select(*g, "column", _as_text(slots).alias("value"), "_n", present.alias("_has")))
    best = F.min(F.when(F.col("_has"), F.struct((-F.col("_n")).alias("neg"), F.col("value").alias("v"))))
    out = (counts.groupBy(*g, "column")
           .agg(F.coalesce(F.sum(F.when(F.col("_has"), F.col("_n"))), F.lit(0)).alias("count"), F.count_if("_has").alias("unique"), best.alias("_b"))
           .select(*g, "column", "count", "unique", F.col("_b.v").alias("top"), (-F.col("_b.neg")).alias("freq")))
    return _every_column(out, cols, g, ["count", "unique"])


TIME_TYPES = ("timestamp", "timestamp_ntz", "date")


def _micros(df: DataFrame, cols: list[str]) -> list[Column]:
    """Times as microseconds: whole numbers below 2^53, so the numeric statistics are exact to the microsecond."""
    return [F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in cols]


def _as_times(num: DataFrame, g: list[str]) -> DataFrame:
    stats = ["mean", "min", "p25", "p50", "p75", "max"]
    at = {s: F.timestamp_micros(F.round(F.col(s)).cast("bigint")).cast("timestamp_ntz").alias(f"{s}_time") for s in stats}
    return num.select(*g, "column", "count", *at.values())


def describe_times(df: DataFrame, columns=None, group=None, exact: bool | str = "bounded") -> DataFrame:
    """count and mean, min, quartiles and max as timestamps, per timestamp or date column."""
    g = _g(group)
    cols = list(columns) if columns else [c for c, t in df.dtypes if t in TIME_TYPES and c not in g]
    return _as_times(describe_numeric(df.select(*g, *_micros(df, cols)), cols, g, exact), g)


def describe_all(df: DataFrame, group=None, exact: bool | str = "bounded") -> DataFrame:
    """describe(include='all'): numeric, timestamp and categorical statistics in one long table.

    Timestamps have a mean, range and quartiles (``*_time`` columns), no unique, top and freq; they
    share the passes of the numeric columns.
    """
    g = _g(group)
    numbers, times = numeric_columns(df, g), [c for c, t in df.dtypes if t in TIME_TYPES and c not in g]
    parts = []
    if numbers or times:
        num = describe_numeric(df.select(*g, *numbers, *_micros(df, times)), numbers + times, g, exact)
        parts = ([num.filter(F.col("column").isin(numbers))] if numbers else []) + ([_as_times(num.filter(F.col("column").isin(times)), g)] if times else [])
    if texts := [c for c, t in df.dtypes if t not in NUMERIC_TYPES and c not in g and c not in times]:
        parts.append(describe_categorical(df, texts, g))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# AGG-11..14 -----------------------------------------------------------------
def shape(df: DataFrame, group=None) -> DataFrame:
    g = _g(group)
    cols = [c for c in df.columns if c not in g]
    n = F.count(F.lit(1))
    return df.groupBy(*g).agg(n.alias("rows"), F.lit(len(cols)).cast("bigint").alias("columns"),
                              (n * len(cols)).alias("elements"), F.lit(",".join(cols)).alias("column_names"))


def column_types(df: DataFrame):
    """(column, type) pairs from the schema (metadata only, no job)."""
    return [(c, t) for c, t in df.dtypes]


def table_info(df: DataFrame, group=None) -> DataFrame:
    """Per column: non-null count and Spark type (one aggregate)."""
    g = _g(group)
    types = dict(df.dtypes)
    per = {c: [("non_null_count", F.count(F.col(c))), ("dtype", F.lit(types[c]))] for c in df.columns if c not in g}
    # dtype is a constant; keep it out of the aggregate.
    out = _agg_long(df, g, {c: [s[0]] for c, s in per.items()})
    mapping = F.create_map(*itertools.chain.from_iterable((F.lit(c), F.lit(types[c])) for c in per))
    return out.withColumn("dtype", mapping[F.col("column")])


def unique_counts(df: DataFrame, group=None, columns=None, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct non-null values per column (NaN excluded; 0 for a column without a value).

    Exact: (column, typed value) grouping, whose shuffle grows with the number
    of distinct values. ``approx=True``: one pass of HyperLogLog sketches
    (relative error ``rsd``), for very large high-cardinality tables.
    """
    g = _g(group)
    cols = list(columns) if columns else [c for c in df.columns if c not in g]
    if approx:
        per = {c: [("unique_count", F.approx_count_distinct(_value(df, c), rsd))] for c in cols}
        return _agg_long(df, g, per)
    long, slots, present = _typed_long(df, cols, g, missing=True)
    values = long.select(*g, "column", *slots).distinct()
    out = values.groupBy(*g, "column").agg(F.count_if(present).alias("unique_count"))
    return _every_column(out, cols, g, ["unique_count"])


# AGG-15 ---------------------------------------------------------------------
def value_counts(df: DataFrame, columns=("equipment_id", "is_anomaly"), group=None) -> DataFrame:
    """Frequency of each value per column (nulls dropped), most frequent first."""
    g = _g(group)
    cols = [c for c in columns if c in df.columns]
    long, slots, _ = _typed_long(df, cols, g)
    return (long.groupBy(*g, "column", *slots).agg(F.count(F.lit(1)).alias("count"))
            .select(*g, "column", _as_text(slots).alias("value"), "count")
            .orderBy(*g, "column", F.desc("count"), "value"))


# AGG-16 ---------------------------------------------------------------------
def correlation_matrix(df: DataFrame, columns=None, group=None, digits: int = 3) -> DataFrame:
    """Pearson correlation of every pair of numeric columns (pairwise complete), long form.

    One pass of matrix products over the rows where both values are present
    (:mod:`fabflow.operators.comoments`), whatever the number of columns. A
    constant column (zero variance) and a pair that is never present together
    give NULL; infinite values give NaN. Every pair has a row in every group.
    """
    g = _g(group)
    cols = list(columns) if columns else numeric_columns(df, g)
    marks = [f"_g{i}" for i, _ in enumerate(g)]
    values = df.select(*[F.col(c).alias(m) for c, m in zip(g, marks, strict=True)], *[_value(df, c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)])
    sums = CM.pair_sums(values, marks, len(cols), CM.centres(values.select(*[f"_x{i}" for i, _ in enumerate(cols)]), len(cols)))
    keys = [*marks, "i", "j"]
    back = sums.select(*[F.col(m).alias("_o" + m) for m in marks], F.col("j").alias("_oi"), F.col("i").alias("_oj"),
                       F.col("sx").alias("sy"), F.col("sxx").alias("syy"), F.col("wild").alias("wild_y"))
    n = F.col("n")

    def spread(squares: str, total: str) -> Column:
        v = F.col(squares) - F.col(total) * F.col(total) / n
        return F.when(v > F.lit(CM.NOISE) * F.col(squares), v)

    r = F.when(F.col("wild") + F.col("wild_y") > 0, F.lit(float("nan"))).otherwise(
        F.try_divide(F.col("sxy") - F.col("sx") * F.col("sy") / n, F.sqrt(spread("sxx", "sx") * spread("syy", "sy"))))
    found = sums.join(back, same(keys)).select(*keys, F.round(r, digits).alias("correlation"))
    listed = df.sparkSession.createDataFrame([(i, j, a, b) for i, a in enumerate(cols) for j, b in enumerate(cols)],
                                             "i int, j int, column_a string, column_b string")
    if g:
        every = values.select(*marks).distinct().crossJoin(F.broadcast(listed))        # groups times pairs: the rows of the result
    else:
        every = listed
    out = every.join(renamed(found, keys), same(keys), "left")
    return out.select(*[F.col(m).alias(c) for m, c in zip(marks, g, strict=True)], "column_a", "column_b", "correlation")


# AGG-17 ---------------------------------------------------------------------
def column_bytes(df: DataFrame, group=None) -> DataFrame:
    """Logical bytes per column (fixed width x non-null values; UTF-8 length for text), in MB too."""
    g = _g(group)
    types = dict(df.dtypes)
    per = {}
    for c in df.columns:
        if c in g:
            continue
        w = FIXED_WIDTH.get(types[c])
        b = F.count(F.col(c)) * F.lit(w) if w else F.coalesce(F.sum(F.octet_length(F.col(c).cast("string"))), F.lit(0))
        per[c] = [("bytes", b.cast("bigint"))]
    out = _agg_long(df, g, per)
    return out.withColumn("megabytes", F.round(F.col("bytes") / F.lit(1024.0 * 1024.0), 2)) \
        .orderBy(*g, F.desc("bytes"), "column")


def total_bytes(df: DataFrame, group=None) -> DataFrame:
    g = _g(group)
    return column_bytes(df, g).groupBy(*g).agg(F.sum("bytes").alias("bytes"),
                                               F.round(F.sum("bytes") / F.lit(1024.0 * 1024.0), 2).alias("megabytes"))


# AGG-18..21 -----------------------------------------------------------------
def distribution_stats(df: DataFrame, column: str, group=None) -> DataFrame:
    """Mean, population std, 1- and 2-sigma bands, min, max."""
    g = _g(group)
    v = _value(df, column).cast("double")
    base = df.groupBy(*g).agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"),
                              F.min(v).alias("min"), F.max(v).alias("max"), F.count(v).alias("count"))
    m, s = F.col("mean"), F.col("std")
    return base.select(*g, "count", "mean", "std", (m - s).alias("band1_low"), (m + s).alias("band1_high"),
                       (m - 2 * s).alias("band2_low"), (m + 2 * s).alias("band2_high"), "min", "max")


def mode_value(df: DataFrame, column: str, group=None) -> DataFrame:
    """Most common non-null value; the smallest one on ties. Two-stage, skew-safe."""
    g = _g(group)
    counts = df.filter(F.col(column).isNotNull()).groupBy(*g, column).agg(F.count(F.lit(1)).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("neg"), F.col(column).alias("v")))
    return counts.groupBy(*g).agg(best.alias("_b")).select(*g, F.col("_b.v").alias("mode"),
                                                             (-F.col("_b.neg")).alias("mode_count"))


def frequency_distribution(df: DataFrame, column: str) -> DataFrame:
    """value, count, percent of all rows; ordered by value.

    The total is a scalar subquery (one number), not a window over all groups.
    """
    total = df.agg(F.count(F.lit(1))).scalar()
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
            .withColumn("percent", F.col("count") * F.lit(100.0) / total)
            .orderBy(F.col(column).asc_nulls_first()))


def histogram(df: DataFrame, column: str, bins: int = 50, lo=None, hi=None) -> DataFrame:
    """Equal-width histogram: ``bins`` bins over [lo, hi] (default min..max), last bin closed.

    Values outside [lo, hi] are not counted. Every bin is present, empty ones
    with count 0. Default bounds are one bounded action (a single row: min,
    max); as literals they reach the scan as pushed filters. The bin table has
    exactly ``bins`` rows.
    """
    spark = df.sparkSession
    v = _value(df, column).cast("double")
    if lo is None or hi is None:
        mn, mx = df.agg(F.min(v), F.max(v)).first()
        if mn is not None and mn == mx:
            mn, mx = mn - 0.5, mx + 0.5
        lo = mn if lo is None else lo
        hi = mx if hi is None else hi
    lo_c = F.lit(None).cast("double") if lo is None else F.lit(float(lo))
    hi_c = F.lit(None).cast("double") if hi is None else F.lit(float(hi))
    width = (hi_c - lo_c) / F.lit(float(bins))
    counted = (df.select(v.alias("_v")).filter((F.col("_v") >= lo_c) & (F.col("_v") <= hi_c))
               .select(F.least(F.floor((F.col("_v") - lo_c) / width), F.lit(bins - 1)).cast("int").alias("bin"))
               .groupBy("bin").agg(F.count(F.lit(1)).alias("count")))
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (all_bins.join(F.broadcast(counted), "bin", "left")
            .select("bin", (lo_c + F.col("bin") * width).alias("lower"),
                    (lo_c + (F.col("bin") + 1) * width).alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


# ---------------------------------------------------------------------------
# One entry point per summary type (the profiler menu), whole table or per file.
# ---------------------------------------------------------------------------

def profile(df: DataFrame, summary_type: str, group=None, order=("timestamp", "wafer_id"), exact="bounded") -> DataFrame:
    """The named summary as a DataFrame; ``group=["source_file"]`` gives it per file."""
    if summary_type not in SUMMARIES:
        raise ValueError(f"unknown summary type {summary_type!r}; one of {SUMMARY_TYPES}")
    return SUMMARIES[summary_type](df, _g(group), order, exact)


def _duplicates(df: DataFrame, g: list[str]) -> DataFrame:
    rows = duplicate_row_profile(df, g)
    if "wafer_id" not in df.columns:
        return rows
    keys = duplicate_key_profile(df, "wafer_id", g)
    return join_groups(rows, keys, g) if g else rows.withColumn("duplicate_keys", keys.scalar())


def info(df: DataFrame, group=None) -> DataFrame:
    """Column, type, non-null count and bytes of every column, with the table's total bytes on each row."""
    g = _g(group)
    table, total = table_info(df, g), total_bytes(df, g).select(*g, F.col("bytes").alias("total_bytes"))
    return join_groups(table, total, g) if g else table.withColumn("total_bytes", total.scalar())


def anomalies(df: DataFrame, group=None, flag: str = "is_anomaly", exact="bounded") -> DataFrame:
    """The anomaly summary and the statistics of the anomalous rows in one long table (``part`` tells which).

    Without the flag column there are no anomalies to speak of: the result is empty.
    """
    g = _g(group)
    if flag not in df.columns:
        empty = df.withColumn(flag, F.lit(False)).limit(0)
        return anomalies(empty, g, flag, exact).filter(F.lit(False))
    summary = anomaly_summary(df, g).withColumn("part", F.lit("summary"))
    stats = anomaly_stats(df, group=g, exact=exact).withColumn("part", F.lit("statistics"))
    return summary.unionByName(stats, allowMissingColumns=True)


#: The names users ask for, each with its operator.
SUMMARIES = {
    "head": lambda df, g, order, exact: SR.head_rows(df, 5, order, g or None),
    "tail": lambda df, g, order, exact: SR.tail_rows(df, 5, order, g or None),
    "sample": lambda df, g, order, exact: SR.sample_rows(df, 5, group=g or None),
    "dtypes": lambda df, g, order, exact: table_info(df, g),
    "info": lambda df, g, order, exact: info(df, g),
    "describe": lambda df, g, order, exact: describe_numeric(df, None, g, exact),
    "describe_all": lambda df, g, order, exact: describe_all(df, g, exact),
    "shape": lambda df, g, order, exact: shape(df, g),
    "nulls": lambda df, g, order, exact: null_profile(df, g, nulls_only=True),
    "duplicates": lambda df, g, order, exact: _duplicates(df, g),
    "unique": lambda df, g, order, exact: unique_counts(df, g),
    "value_counts": lambda df, g, order, exact: value_counts(df, group=g),
    "anomalies": lambda df, g, order, exact: anomalies(df, g, exact=exact),
    "corr": lambda df, g, order, exact: correlation_matrix(df, None, g),
    "memory": lambda df, g, order, exact: column_bytes(df, g),
}
SUMMARY_TYPES = tuple(SUMMARIES)
