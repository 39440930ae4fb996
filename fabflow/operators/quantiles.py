"""Exact quantiles by multi-level histogram selection (no sort, no window, no value list).

``percentile`` keeps every distinct value of a group in one buffer, which
cannot hold a whole-table profile of continuous readings at scale. Here every
value has an order-preserving 64-bit key, and the order statistics wanted are
narrowed level by level, all columns, groups and probabilities at once:

1. one aggregate gives each column's count and its least and greatest key;
2. a level cuts the key range of each open target into at most 2^LEVEL_BITS
   bins, counts them (partial counts first, then one shuffle of bin counts)
   and keeps the bin that holds the target's rank, with the rank inside it;
3. a bin with at most 2^LEVEL_BITS rows is cut to single keys by the next
   level, and a bin with one key is the answer.

A column of n rows takes about log(n) / LEVEL_BITS levels and never more than
five, whatever its distribution; later levels read only rows inside the open
bins. The state between levels is two rows per group, column and probability.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabflow.operators.joins import join_small, renamed, same
from fabflow.session import staging_path

LEVEL_BITS = 16
WHOLE_TYPES = ("bigint", "int", "smallint", "tinyint")
#: Implicit leading bit of a double's significand.
UNIT = 1 << 52


def _g(group) -> list[str]:
    return [] if not group else ([group] if isinstance(group, str) else list(group))


def _exponent(v: Column) -> Column:
    """Binary exponent of a double, possibly one off (the logarithm is rounded); subnormals count as -1022."""
    return F.greatest(F.least(F.floor(F.log2(F.abs(v))), F.lit(1023)), F.lit(-1022))


def _key(v: Column, e: Column) -> Column:
    """The IEEE 754 bits of |v| as a whole number, with the sign of v: rises with v, equal only for equal values."""
    bits = (e + 1022) * F.lit(UNIT) + (F.abs(v) / F.pow(F.lit(2.0), e) * F.lit(float(UNIT))).cast("long")
    size = F.when(v == 0, F.lit(0)).when(F.abs(v) == float("inf"), F.lit(2047 * UNIT)).otherwise(bits)
    return F.when(v < 0, -size).otherwise(size)


def keyed_values(df: DataFrame, columns, group=None) -> DataFrame:
    """Group columns as ``_g0..``, and per column its value ``_v<i>`` (double, NaN read as missing) and order key ``_k<i>``."""
    types, cols = dict(df.dtypes), list(columns)
    floats = [i for i, c in enumerate(cols) if types[c] not in WHOLE_TYPES]
    value = {c: F.when(~F.isnan(F.col(c)), F.col(c)) if types[c] in ("double", "float") else F.col(c) for c in cols}
    out = df.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(_g(group))],
                    *[value[c].cast("double").alias(f"_v{i}") for i, c in enumerate(cols)],
                    *[F.col(c).cast("long").alias(f"_k{i}") for i, c in enumerate(cols) if i not in floats])
    if not floats:
        return out
    out = out.withColumns({f"_e{i}": _exponent(F.col(f"_v{i}")) for i in floats})
    part = {i: F.abs(F.col(f"_v{i}")) / F.pow(F.lit(2.0), F.col(f"_e{i}")) for i in floats}
    out = out.withColumns({f"_e{i}": F.when((part[i] < 1) & (F.col(f"_e{i}") > -1022), F.col(f"_e{i}") - 1)
                           .when((part[i] >= 2) & (F.col(f"_e{i}") < 1023), F.col(f"_e{i}") + 1).otherwise(F.col(f"_e{i}")) for i in floats})
    return out.withColumns({f"_k{i}": _key(F.col(f"_v{i}"), F.col(f"_e{i}")) for i in floats}).drop(*[f"_e{i}" for i in floats])


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = staging_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column_statistics(keyed: DataFrame, cols: list[str], g: list[str],
                      extra: dict[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """(group..., _c, _n, _lo, _hi, extra...) per column; empty tables and all-missing columns have count 0."""
    aggs, rows = [], []
    for i, _ in enumerate(cols):
        v, k = F.col(f"_v{i}"), F.col(f"_k{i}")
        stats = {"_n": F.count(v), "_lo": F.min(k), "_hi": F.max(k), **{n: f(v) for n, f in (extra or {}).items()}}
        aggs += [e.alias(f"_s{i}{n}") for n, e in stats.items()]
        rows.append(F.struct(F.lit(i).alias("_c"), *[F.col(f"_s{i}{n}").alias(n) for n in stats]))
    wide = keyed.groupBy(*g).agg(*aggs) if g else keyed.agg(*aggs)
    return wide.select(*g, F.inline(F.array(*rows)))


def _shift(bits: int) -> Column:
    """Bits left out of a bin number: none for few rows, else so many that about 2^bits bins remain."""
    width = F.col("_hi").cast("double") - F.col("_lo").cast("double") + 1
    return F.when(F.col("_n") <= (1 << bits), F.lit(0)).otherwise(F.greatest(F.lit(0), F.ceil(F.log2(width)) - bits)).cast("int")


def _histogram(base: DataFrame, g: list[str], ranges: dict[int, tuple[Column, Column, Column]], slots: int) -> DataFrame:
    """``(group..., _r, _bins)``: the bins of every range (low key, high key, bits left out), in order."""
    tags = []
    for r, (lo, hi, s) in ranges.items():
        k, v = F.col(f"_k{r // slots}"), F.col(f"_v{r // slots}")
        tags.append(F.when(k.between(lo, hi), F.struct(F.lit(r).alias("r"), F.call_function("shiftright", k, s).alias("d"), k.alias("k"), v.alias("v"))))
    hist = (base.select(*g, F.explode(F.array_compact(F.array(*tags))).alias("_b"))
            .groupBy(*g, F.col("_b.r").alias("_r"), F.col("_b.d").alias("d"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("_b.k").alias("lo"), F.max("_b.k").alias("hi"),
                 F.min("_b.v").alias("v"), F.max("_b.v").alias("w")))
    return hist.groupBy(*g, "_r").agg(F.sort_array(F.collect_list(F.struct("d", "n", "lo", "hi", "v", "w"))).alias("_bins"))


def _pick(targets: DataFrame, g: list[str]) -> DataFrame:
    """The bin of each target ``_of`` (number, rank) among ``_bins``: ``(group..., _t, _k, _lo, _hi, _n, _x, _y)``, ``_x`` to ``_y`` its values."""
    start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast("struct<d:bigint,n:bigint,lo:bigint,hi:bigint,v:double,w:double>").alias("hit"))
    rank = F.col("_of._k")

    def step(seen, b):
        found = seen["hit"].isNotNull() | (seen["before"] + b["n"] > rank)
        return F.when(found, F.struct(seen["before"].alias("before"), F.coalesce(seen["hit"], b).alias("hit"))).otherwise(
            F.struct((seen["before"] + b["n"]).alias("before"), seen["hit"].alias("hit")))

    got = targets.select(*g, F.col("_of._t").alias("_t"), rank.alias("_rank"), F.aggregate("_bins", start, step).alias("_hit"))
    return got.select(*g, "_t", (F.col("_rank") - F.col("_hit.before")).alias("_k"), F.col("_hit.hit.lo").alias("_lo"),
                      F.col("_hit.hit.hi").alias("_hi"), F.col("_hit.hit.n").alias("_n"), F.col("_hit.hit.v").alias("_x"), F.col("_hit.hit.w").alias("_y"))


def _whole_table(keyed: DataFrame, stats: DataFrame, probs: list[float], bits: int) -> tuple[list, dict[int, float]]:
    """Statistics rows and the values of the order statistics of ungrouped columns; two targets per column and probability."""
    slots, rows = 2 * len(probs), stats.collect()
    todo, values = {}, {}
    for r in rows:
        for j, p in enumerate(probs if r["_n"] else []):
            for side, rank in enumerate((math.floor, math.ceil)):
                todo[r["_c"] * slots + 2 * j + side] = (rank(p * (r["_n"] - 1)), r["_lo"], r["_hi"], r["_n"], None, None)
    while todo:
        shared: dict[tuple, list] = {}
        for t, (k, lo, hi, n, low, high) in sorted(todo.items()):
            shared.setdefault((t // slots, lo, hi, n, low, high), []).append((t, k))
        ranges, wanted, inside = {}, [], F.lit(False)
        for (c, lo, hi, n, low, high), some in shared.items():
            r = some[0][0]
            ranges[r] = (F.lit(lo), F.lit(hi), F.lit(0 if n <= 1 << bits else max(0, (hi - lo).bit_length() - bits)))
            wanted += [F.lit(r), F.array(*[F.struct(F.lit(t).alias("_t"), F.lit(k).cast("long").alias("_k")) for t, k in some])]
            # by value, not by key: the filter goes below the keys' arithmetic, where a key would be computed again for each use
            inside = inside | (F.lit(True) if low is None else F.col(f"_v{c}").between(low, high))
        bins = _histogram(keyed.filter(inside), [], ranges, slots)      # only rows inside an open bin are expanded
        for h in _pick(bins.select("_bins", F.explode(F.create_map(*wanted)[F.col("_r")]).alias("_of")), []).collect():
            if h["_lo"] == h["_hi"]:
                values[h["_t"]] = h["_x"]
                del todo[h["_t"]]
            else:
                todo[h["_t"]] = (h["_k"], h["_lo"], h["_hi"], h["_n"], h["_x"], h["_y"])
    return rows, values


def _group_level(keyed: DataFrame, state: DataFrame, columns: int, g: list[str], slots: int, first: bool) -> DataFrame:
    """The targets of ``state`` after one level, as :func:`_pick` gives them; a group's ranges are joined to its rows."""
    ranges = _staged(state.groupBy(*g, F.floor(F.col("_t") / slots).alias("_c"), "_lo").agg(
        F.min("_t").alias("_r"), F.first("_hi").alias("_hi"), F.first("_s").alias("_s"),
        F.collect_list(F.struct("_t", "_k")).alias("_targets")), "quantile-ranges")
    wide = ranges.groupBy(*g).agg(F.map_from_entries(F.collect_list(F.struct("_r", F.struct("_lo", "_hi", "_s")))).alias("_m"))
    base = join_small(keyed, renamed(wide, g), same(g), "inner")
    of = {r: (F.col("_m")[r]["_lo"], F.col("_m")[r]["_hi"], F.col("_m")[r]["_s"]) for r in range(0, columns * slots, slots if first else 1)}
    keys = [*g, "_r"]
    bins = _histogram(base, g, of, slots).join(renamed(ranges.select(*keys, "_targets"), keys), same(keys))
    return _pick(bins.select(*g, "_bins", F.explode("_targets").alias("_of")), g)


def quantile_table(df: DataFrame, columns, probs, group=None,
                   extra: dict[str, Callable[[Column], Column]] | None = None, bits: int = LEVEL_BITS) -> DataFrame:
    """(group..., column, count, extra..., quantiles): one row per group and column, ``quantiles`` in the order of ``probs``.

    ``extra`` are further aggregates of each column's values, taken in the same
    pass as the counts. Null groups are groups; columns without a value, and
    every column of an empty ungrouped table, have count 0 and null quantiles.
    """
    names, cols, probs = _g(group), list(columns), [float(p) for p in probs]
    g = [f"_g{i}" for i, _ in enumerate(names)]
    slots = 2 * len(probs)
    keyed = keyed_values(df, cols, names)
    stats = column_statistics(keyed, cols, g, extra)
    if not g:
        rows, values = _whole_table(keyed, stats, probs, bits)

        def at(r, j: int, p: float) -> float | None:
            lo, hi, pos = values.get(r["_c"] * slots + 2 * j), values.get(r["_c"] * slots + 2 * j + 1), p * (r["_n"] - 1)
            return lo if lo == hi else (math.ceil(pos) - pos) * lo + (pos - math.floor(pos)) * hi

        fields = [T.StructField("column", T.StringType()), T.StructField("count", T.LongType()),
                  *[T.StructField(n, stats.schema[n].dataType) for n in extra or {}], T.StructField("quantiles", T.ArrayType(T.DoubleType()))]
        return df.sparkSession.createDataFrame(
            [(cols[r["_c"]], r["_n"], *[r[n] for n in extra or {}], [at(r, j, p) for j, p in enumerate(probs)]) for r in rows], T.StructType(fields))

    stats = _staged(stats, "quantile-counts")

    def position(p: float) -> Column:
        return F.lit(p) * (F.col("_n") - 1)

    wanted = [f(position(p)).cast("long") for p in probs for f in (F.floor, F.ceil)]
    targets = [F.struct((F.col("_c") * slots + i).cast("int").alias("_t"), k.alias("_k")) for i, k in enumerate(wanted)]
    state = stats.filter("_n > 0").select(*g, "_n", "_lo", "_hi", F.inline(F.array(*targets))).withColumn("_s", _shift(bits)).drop("_n")
    state, done, level = _staged(state, "quantile-state"), None, 0
    while not state.isEmpty():
        after = _staged(_group_level(keyed, state, len(cols), g, slots, level == 0), "quantile-state")
        got = after.filter("_lo = _hi").select(*g, "_t", "_x")
        done = got if done is None else done.unionByName(got)
        state = after.filter("_lo < _hi").withColumn("_s", _shift(bits)).drop("_n", "_x", "_y")
        level += 1
    label = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("_c") + 1).alias("column")
    shown = [F.col(a).alias(b) for a, b in zip(g, names, strict=True)] + [label, F.col("_n").alias("count"), *(extra or {})]
    if done is None:
        return stats.select(*shown, F.array_repeat(F.lit(None).cast("double"), len(probs)).alias("quantiles"))
    values = done.groupBy(*g, F.floor(F.col("_t") / slots).cast("int").alias("_c")).agg(
        F.map_from_entries(F.collect_list(F.struct((F.col("_t") % slots).alias("i"), F.col("_x").alias("x")))).alias("_m"))
    keys = [*g, "_c"]
    both = stats.join(renamed(values, keys), same(keys), "left")

    def value(j: int, p: float) -> Column:
        pos, lo, hi = position(p), F.col("_m")[2 * j], F.col("_m")[2 * j + 1]
        return F.when(lo == hi, lo).otherwise((F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi)

    return both.select(*shown, F.array(*[value(j, p) for j, p in enumerate(probs)]).alias("quantiles"))


def exact_quantiles(df: DataFrame, columns, probs, group=None, bits: int = LEVEL_BITS) -> DataFrame:
    """Exact linear-interpolated quantiles of each column (NaN and NULL ignored), as ``percentile`` gives them.

    Returns (group..., column, q_index, prob, quantile), one row per column,
    probability and group; ``q_index`` is the position in ``probs``. Columns
    without a value have null quantiles. A level has about 2^``bits`` bins.
    """
    table = quantile_table(df, columns, probs, group, bits=bits)
    rows = [F.struct(F.lit(j).alias("q_index"), F.lit(float(p)).alias("prob"), F.col("quantiles")[j].alias("quantile"))
            for j, p in enumerate(probs)]
    return table.select(*_g(group), "column", F.inline(F.array(*rows)))
