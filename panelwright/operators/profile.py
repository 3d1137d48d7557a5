"""Profiles, audits and descriptive statistics as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelwright.operators.scale import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def rows_from(stats: DataFrame, label: str, rows: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row frame of statistics into one row per label."""
    return stats.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias(label), *[c.alias(k) for k, c in cols.items()]) for name, cols in rows.items()
    ])).alias("_r")).select("_r.*")


def value_counts(df: DataFrame, column: str, n: int | None = None, out: str = "n") -> DataFrame:
    """Frequency table, most frequent first, ties by value; the first ``n`` rows if given."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias(out))
    return counts.orderBy(F.col(out).desc(), column).limit(n) if n else counts


def numeric_profile(df: DataFrame, columns: Sequence[str], probs: Sequence[float] = QUARTILES) -> DataFrame:
    """Count, mean, sample deviation, min, exact quantiles and max, one row per column."""
    aggs = []
    for c in columns:
        aggs += [F.count(c).alias(f"{c}|n"), F.avg(c).alias(f"{c}|mean"), F.stddev_samp(c).alias(f"{c}|std"),
                 F.min(c).cast("double").alias(f"{c}|min"), F.max(c).cast("double").alias(f"{c}|max")]
    keys = ("n", "mean", "std", "min", "max")
    moments = rows_from(df.agg(*aggs), "column", {c: {k: F.col(f"`{c}|{k}`") for k in keys} for c in columns})
    quantiles = exact_quantiles(df, columns, probs).drop("n_values")
    return moments.join(F.broadcast(quantiles), "column", "left")


def categorical_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, number of levels, most frequent level (smallest on ties) and its frequency per column."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in columns])).alias("_r")
    ).select("_r.*").where(F.col("level").isNotNull())
    counts = long.groupBy("column", "level").agg(F.count(F.lit(1)).alias("f"))
    # max of (frequency, reversed order) combines before the shuffle: no window over all levels
    best = F.min(F.struct((-F.col("f")).alias("neg"), "level"))
    return counts.groupBy("column").agg(
        F.sum("f").alias("n"), F.count(F.lit(1)).alias("n_levels"), best.alias("_b")
    ).select("column", "n", "n_levels", F.col("_b.level").alias("top"), (-F.col("_b.neg")).alias("freq"))


def missing_audit(df: DataFrame) -> DataFrame:
    """NULL count and ratio per column, from one pass."""
    stats = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return rows_from(stats, "column", {
        c: {"n_missing": F.col(c), "ratio": F.try_divide(F.col(c), F.col("_rows"))} for c in df.columns})


def duplicate_audit(df: DataFrame, columns: Sequence[str], digest: bool = False) -> DataFrame:
    """Rows, distinct keys, duplicate rows beyond the first, and keys that repeat.

    ``digest`` groups by a SHA-256 of the columns, so long payloads are not shuffled.
    """
    key = [F.sha2(F.to_json(F.struct(*columns)), 256).alias("_key")] if digest else list(columns)
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.sum("_n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"),
        F.sum(F.col("_n") - 1).alias("n_duplicates"), F.count_if(F.col("_n") > 1).alias("n_repeated_keys"),
        F.max("_n").alias("largest_group"))


def range_audit(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Number of rows that break each rule; a NULL outcome does not count as a violation."""
    stats = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(~r).alias(n) for n, r in rules.items()])
    return rows_from(stats, "rule", {n: {"n_violations": F.col(n), "n_rows": F.col("_rows")} for n in rules})


def crosstab(df: DataFrame, a: str, b: str, b_values: Sequence) -> DataFrame:
    """Wide contingency table; the columns are the given values of ``b``, empty cells are 0."""
    return df.groupBy(a).pivot(b, list(b_values)).agg(F.count(F.lit(1))).na.fill(0)


def contingency(df: DataFrame, a: str, b: str, empty_up_to: int = 0) -> DataFrame:
    """Observed and expected count of every observed cell; rows with a NULL level do not count.

    With ``empty_up_to`` the empty cells are returned too, if the product of the
    two numbers of levels is at most that; otherwise it raises.
    """
    cells = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("observed"))
    rows = cells.groupBy(a).agg(F.sum("observed").alias("row_total"))
    cols = cells.groupBy(b).agg(F.sum("observed").alias("col_total"))
    total = F.broadcast(cells.agg(F.sum("observed").alias("total")))  # one row
    if empty_up_to:
        n, m = rows.count(), cols.count()
        if n * m > empty_up_to:
            raise ValueError(f"{n} x {m} cells exceed {empty_up_to}")
        levels = [r[b] for r in cols.select(b).collect()]  # fewer than empty_up_to
        cells = rows.select(a, F.explode(F.array(*[F.lit(v) for v in levels])).alias(b)).join(cells, [a, b], "left").na.fill(0, ["observed"])
    return cells.join(rows, a).join(cols, b).join(total).select(
        a, b, "observed", "row_total", "col_total", "total", (F.col("row_total") * F.col("col_total") / F.col("total")).alias("expected"))


def margins(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cell, row, column and grand totals from one grouping-sets aggregation; a NULL key marks a total."""
    return df.cube(a, b).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("int").alias("level"))


def histogram(df: DataFrame, column: str, bins: int, low: float, high: float) -> DataFrame:
    """Equal-width counts over [low, high]; the last bin includes its upper edge, empty bins are kept."""
    x = F.col(column).cast("double")
    width = (high - low) / bins
    index = F.least(F.floor((x - low) / width), F.lit(bins - 1)).cast("int")
    counts = df.where(x.between(low, high)).groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(F.broadcast(counts), "bin", "left").select(
        "bin", (F.lit(low) + F.col("bin") * width).alias("lower"),
        (F.lit(low) + (F.col("bin") + 1) * width).alias("upper"), F.coalesce("n", F.lit(0)).alias("n"))


def column_range(df: DataFrame, column: str) -> tuple[float, float]:
    row = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).first()
    return row["lo"], row["hi"]


def outlier_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Three-sigma and Tukey bounds with the number of values outside, one row per column."""
    fitted = numeric_profile(df, columns, (0.25, 0.75)).select(
        "column", F.col("n").alias("n_values"),
        (F.col("mean") - 3 * F.col("std")).alias("gauss_lower"), (F.col("mean") + 3 * F.col("std")).alias("gauss_upper"),
        (F.col("q0") - 1.5 * (F.col("q1") - F.col("q0"))).alias("iqr_lower"),
        (F.col("q1") + 1.5 * (F.col("q1") - F.col("q0"))).alias("iqr_upper"))
    bounds = {r["column"]: r for r in fitted.collect()}  # one row per requested column
    aggs = []
    for c in columns:
        for kind in ("gauss", "iqr"):
            lo, hi = bounds[c][f"{kind}_lower"], bounds[c][f"{kind}_upper"]
            outside = (F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi))
            aggs.append(F.count_if(outside).alias(f"{c}|{kind}"))
    counts = rows_from(df.agg(*aggs), "column", {
        c: {"gauss_out": F.col(f"`{c}|gauss`"), "iqr_out": F.col(f"`{c}|iqr`"),
            **{k: F.lit(bounds[c][k]) for k in ("n_values", "gauss_lower", "gauss_upper", "iqr_lower", "iqr_upper")}}
        for c in columns})
    return counts


def quantile_edges(df: DataFrame, column: str, bins: int, where: Column | None = None) -> DataFrame:
    """Quantile bin edges over the rows that pass ``where``; zeros when there are none. One row per edge."""
    rows = df.where(where) if where is not None else df
    q = exact_quantiles(rows, [column], [i / bins for i in range(bins + 1)])
    edges = F.array(*[F.struct(F.lit(i).alias("edge"), F.col(f"q{i}").alias("value")) for i in range(bins + 1)])
    one = df.sparkSession.range(1).select(F.lit(column).alias("column"))
    return one.join(F.broadcast(q), "column", "left").select(F.explode(edges).alias("e")).select(
        "e.edge", F.coalesce("e.value", F.lit(0.0)).alias("value"))


def shape_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population skewness and excess kurtosis per column; NULL for a constant column."""
    aggs = []
    for c in columns:
        aggs += [F.skewness(c).alias(f"{c}|s"), F.kurtosis(c).alias(f"{c}|k")]
    return rows_from(df.agg(*aggs), "column", {
        c: {"skewness": F.nanvl(F.col(f"`{c}|s`"), F.lit(None)), "kurtosis": F.nanvl(F.col(f"`{c}|k`"), F.lit(None))}
        for c in columns})


def array_statistics(df: DataFrame, array: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation of every array position (per group); combines before the shuffle."""
    flat = df.select(*by, F.posexplode(array).alias("position", "_v"))
    return flat.groupBy(*by, "position").agg(
        F.avg(F.col("_v").cast("double")).alias("mean"), F.stddev_pop(F.col("_v").cast("double")).alias("std"))


def active_centroids(df: DataFrame, array: str, label: str, width: int, threshold: float) -> DataFrame:
    """Per label, the mean row and column of the grid cells whose class mean exceeds the threshold."""
    active = array_statistics(df, array, [label]).where(F.col("mean") > threshold)
    return active.groupBy(label).agg(
        F.avg(F.floor(F.col("position") / width)).alias("row"), F.avg(F.col("position") % width).alias("col"),
        F.count(F.lit(1)).alias("n_active"))


def group_rates(df: DataFrame, by: str, target: str, k: int) -> DataFrame:
    """Mean target and size per group, the ``k`` highest means first, ties by group."""
    return df.groupBy(by).agg(F.avg(target).alias("rate"), F.count(F.lit(1)).alias("n")).orderBy(
        F.col("rate").desc(), by).limit(k)
