"""Skew-safe building blocks that the other operators are composed of.

None of them pulls rows to the driver, and none sends one key's rows to one
task: hot keys are spread by a salt and ordered computations are cut into value
ranges whose partial sums are added back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# A key with more rows than this is spread over FAN tasks. The list of such keys
# holds at most rows / HOT_ROWS entries, which bounds what is broadcast.
HOT_ROWS = 2_000_000
FAN = 64
# A key with more distinct values than this is cut into value ranges of its own.
HOT_VALUES = 65_536


def join_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str], count_col: str,
                spread_by: Sequence[str] | None = None, how: str = "left",
                hot_rows: int | None = None, fan: int | None = None) -> DataFrame:
    """Join a one-row-per-key table that was aggregated from ``df`` (or a like frame).

    Spark's runtime skew join cannot split a side that sits below an aggregate,
    so keys whose ``count_col`` exceeds ``hot_rows`` get a salt on the left and
    are repeated once per salt on the right. ``count_col`` stays in the result.
    ``spread_by`` names columns that differ between a key's rows.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    fan = FAN if fan is None else fan
    keys = list(keys)
    # a few columns are enough to spread a hot key; hashing every column would bloat the generated code
    spread = [F.col(c) for c in (spread_by or [c for c in df.columns if c not in keys][:3] or keys)]
    hot = lookup.where(F.col(count_col) > hot_rows).select(*keys, F.lit(True).alias("_hot"))
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    left = df.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt",
        F.when(F.coalesce(F.col("_hot"), F.lit(False)) | no_key,
               F.pmod(F.xxhash64(*spread), F.lit(fan))).otherwise(F.lit(0).cast("long")),
    ).drop("_hot")
    zero = F.lit(0).cast("long")
    salts = F.when(F.col(count_col) > hot_rows, F.sequence(zero, F.lit(fan - 1).cast("long"))).otherwise(F.array(zero))
    right = lookup.withColumn("_salt", F.explode(salts))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def with_group_stats(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column],
                     spread_by: Sequence[str] | None = None, hot_rows: int | None = None) -> DataFrame:
    """Aggregate by ``keys`` and attach the results to every row (pandas ``transform``).

    Unlike a window without order, the aggregation combines before the shuffle
    and a hot group is never gathered in one task. Rows with a NULL key get NULLs.
    """
    stats = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[c.alias(name) for name, c in aggregates.items()]
    )
    return join_lookup(df, stats, keys, "_n", spread_by, hot_rows=hot_rows).drop("_n")


def _range_probs(df: DataFrame, ranges: int | None = None) -> list[float]:
    """Inner quantiles of as many ranges as the session shuffles into."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if ranges is None else ranges
    return [i / n for i in range(1, n)] or [0.5]


def value_edges(df: DataFrame, value: str, ranges: int | None = None) -> list[float]:
    """Split points of a numeric column for about equal ranges, from a mergeable sketch.

    They only balance work: any split points give the same final result.
    """
    probs = _range_probs(df, ranges)
    row = df.agg(F.percentile_approx(F.col(value).cast("double"), probs, 10 * len(probs) + 10).alias("e")).first()
    return sorted(set(row["e"] or []))


def edges_below(value: Column, edges: Column) -> Column:
    """How many of the sorted array ``edges`` lie below ``value``, by binary search."""
    steps = F.array(*[F.lit(1 << k) for k in range(20, -1, -1)])

    def advance(at: Column, step: Column) -> Column:
        return F.when((at + step <= F.size(edges)) & (F.try_element_at(edges, at + step) < value), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), advance)


def _with_range(freq: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Adds ``_range``: keys with more than HOT_VALUES rows are cut by split points of their own, others stay whole.

    The split points of hot keys are broadcast, at most rows / HOT_VALUES arrays.
    """
    x, probs = F.col(value).cast("double"), _range_probs(freq)
    hot = freq.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(x, probs, 10 * len(probs) + 10).alias("_edges"))
    hot = hot.where(F.col("_n") > HOT_VALUES).drop("_n")
    cut = freq.join(F.broadcast(hot), list(keys), "left")
    return cut.withColumn("_range", F.when(F.col("_edges").isNull(), 0).otherwise(edges_below(x, F.col("_edges")))).drop("_edges")


def range_index(value: Column, edges: Sequence[float]) -> Column:
    """Position of the range that holds ``value``: the number of edges below it.

    A balanced tree of comparisons, so that it stays inside generated code; many
    edges are searched in a constant array instead.
    """
    if len(edges) > 64:
        return edges_below(value.cast("double"), F.split(F.lit(",".join(repr(float(e)) for e in edges)), ",").cast("array<double>"))

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(value > F.lit(float(edges[mid])), search(mid + 1, high)).otherwise(search(low, mid))

    return search(0, len(edges))


def running_totals(freq: DataFrame, value: str, measures: Sequence[str], keys: Sequence[str] = (),
                   edges: Sequence[float] | None = None) -> DataFrame:
    """Inclusive running totals of ``measures`` in ascending ``value`` order, per key.

    ``freq`` holds one row per (keys, value). Adds ``cum_<m>`` and ``tot_<m>``.
    Each (key, value range) is summed locally and shifted by the totals of the
    ranges below it, so no task sees more than about one range of the data.
    """
    keys = list(keys)
    if keys and edges is None:
        cut = _with_range(freq, value, keys)
    else:
        cut = freq.withColumn("_range", range_index(F.col(value), value_edges(freq, value) if edges is None else edges))
    part = keys or [F.lit(0)]
    below = Window.partitionBy(*part).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*part)
    offsets = cut.groupBy(*keys, "_range").agg(*[F.sum(m).alias(f"_s_{m}") for m in measures]).select(
        *keys, "_range",
        *[F.coalesce(F.sum(f"_s_{m}").over(below), F.lit(0)).alias(f"_o_{m}") for m in measures],
        *[F.sum(f"_s_{m}").over(whole).alias(f"tot_{m}") for m in measures],
    )
    local = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    summed = cut.select("*", *[F.sum(m).over(local).alias(f"_c_{m}") for m in measures])
    joined = summed.join(offsets, [*keys, "_range"])
    return joined.select(
        *freq.columns,
        *[(F.col(f"_c_{m}") + F.col(f"_o_{m}")).alias(f"cum_{m}") for m in measures],
        *[F.col(f"tot_{m}") for m in measures],
    )


def value_counts_ranked(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct values with count ``n`` and inclusive rank ``cum_n`` of ``tot_n``."""
    present = df.where(F.col(value).isNotNull())
    freq = present.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return running_totals(freq, value, ["n"], keys, None if keys else value_edges(present, value))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    keys: Sequence[str] = ()) -> DataFrame:
    """Exact linearly interpolated quantiles: one row per (keys, column), columns ``q0..``.

    A group of more than HOT_VALUES values works on distinct values with counts and
    their running ranks, so unlike with the built-in exact ``percentile`` its values
    never meet in one task; the values of other groups are sorted where they meet.
    Also returns the number of values ``n_values``. Rows with a NULL key form no
    group, as in pandas.
    """
    keys = list(keys)
    if len(columns) == 1:
        long = df.select(*keys, F.lit(0).alias("_col"), F.col(columns[0]).cast("double").alias("value"))
    else:
        long = df.select(*keys, F.posexplode(F.array(*[F.col(c).cast("double") for c in columns])).alias("_col", "value"))
    if not keys:
        return _ranked_quantiles(long, columns, probs, keys)
    held = long.where(F.col("value").isNotNull() & _all_present(keys))
    crowded = F.broadcast(held.groupBy(*keys, "_col").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_VALUES).drop("_n"))
    few = _sorted_quantiles(held.join(crowded, [*keys, "_col"], "left_anti"), columns, probs, keys)
    return few.unionByName(_ranked_quantiles(held.join(crowded, [*keys, "_col"], "left_semi"), columns, probs, keys))


def _all_present(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def _ranked_quantiles(long: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """Quantiles from the distinct values of a group, in as many tasks as it has value ranges."""
    ranked = value_counts_ranked(long, "value", [*keys, "_col"])
    return _interpolated(ranked, F.col("cum_n") - F.col("n"), F.col("cum_n") - 1, columns, probs, keys)


def _sorted_quantiles(long: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """Quantiles of groups of at most HOT_VALUES values: one shuffle, each group sorted inside one task."""
    value = F.when(F.col("value") == 0, F.lit(0.0)).otherwise(F.col("value"))  # one zero, as after a grouping
    group = Window.partitionBy(*keys, "_col").orderBy("value")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = long.select(*keys, "_col", value.alias("value")).select(
        *keys, "_col", "value", (F.row_number().over(group) - 1).alias("_at"), F.count(F.lit(1)).over(whole).alias("tot_n"))
    return _interpolated(ranked, F.col("_at"), F.col("_at"), columns, probs, keys)


def _interpolated(ranked: DataFrame, first: Column, last: Column, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """Quantiles of values that hold the sorted places ``first`` to ``last`` of the ``tot_n`` of their group."""
    def at(position: Column) -> Column:
        return F.max(F.when((first <= position) & (position <= last), F.col("value")))

    aggs = [F.max("tot_n").alias("n_values")]
    for i, p in enumerate(probs):
        target = F.lit(float(p)) * (F.col("tot_n") - 1)
        aggs += [at(F.floor(target)).alias(f"_lo{i}"), at(F.ceil(target)).alias(f"_hi{i}"),
                 F.max(target - F.floor(target)).alias(f"_fr{i}")]
    out = ranked.groupBy(*keys, "_col").agg(*aggs)
    return out.select(
        *keys, F.get(F.array(*[F.lit(c) for c in columns]), F.col("_col")).alias("column"), "n_values",
        *[(F.col(f"_lo{i}") + F.col(f"_fr{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(f"q{i}")
          for i in range(len(probs))],
    )


def quantile_values(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float]]:
    """Fitted quantiles of a few columns as Python numbers (``columns`` x ``probs`` values)."""
    rows = exact_quantiles(df, columns, probs).collect()
    found = {r["column"]: [r[f"q{i}"] for i in range(len(probs))] for r in rows}
    return {c: found.get(c, []) for c in columns}


def average_ranks(df: DataFrame, value: str, rank_col: str, keys: Sequence[str] = (),
                  spread_by: Sequence[str] | None = None, source: DataFrame | None = None) -> DataFrame:
    """Attach the average-tie rank of ``value`` (per key); NULL values get NULL.

    ``source`` names the table to rank within when ``df`` already carries other joins.
    """
    ranked = value_counts_ranked(df if source is None else source, value, keys).select(
        *keys, value, F.col("n").alias("_n"),
        (F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2).alias(rank_col),
    )
    return join_lookup(df, ranked, [*keys, value], "_n", spread_by).drop("_n")


def hash_key(*parts: Column | str, seed: int | str = 0) -> Column:
    """Hex digest of the seed and the key parts; equal on any engine with md5."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def hash_number(digest: Column) -> Column:
    """The first eight hex digits of a digest as a number below 2**32."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def numbered_by_hash(df: DataFrame, id_cols: Sequence[str], keys: Sequence[str] = (), seed: int | str = 0,
                     out: str = "row_no", total: str | None = None) -> DataFrame:
    """1-based row numbers in hash order (within each key, if any).

    The order is cut by the leading hex digits of the digest, which are uniform,
    so a key that holds a third of all rows is still spread over 4,096 ranges.
    """
    # one text key that is never NULL, so that rows without a key form a group of their own
    group = F.to_json(F.struct(*keys)) if keys else F.lit("")
    h = df.withColumn("_h", hash_key(*id_cols, seed=seed)).withColumn("_p", F.substring("_h", 1, 3)).withColumn("_g", group)
    below = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = h.groupBy("_g", "_p").agg(F.count(F.lit(1)).alias("_n")).select(
        "_g", "_p", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy("_g")).alias("_tot"),
    )
    local = Window.partitionBy("_g", "_p").orderBy("_h", *id_cols)
    cols = [*df.columns, (F.col("_rn") + F.col("_off")).cast("long").alias(out)]
    if total:
        cols.append(F.col("_tot").alias(total))
    return h.withColumn("_rn", F.row_number().over(local)).join(counts, ["_g", "_p"]).select(*cols)
