"""Projection, conditional and numeric expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the named columns; names that are absent are ignored."""
    return df.drop(*names)


def strip_prefixes(df: DataFrame, separator: str = "__") -> DataFrame:
    """Rename ``step__column`` to ``column``; other names stay."""
    return df.withColumnsRenamed({c: c.split(separator, 1)[1] for c in df.columns if separator in c})


def route_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric and string column names, by schema."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return numeric, text


def route_by_name(columns: Sequence[str], contains: Sequence[str], prefixes: Sequence[str]) -> dict[str, list[str]]:
    """Group columns by name: ``numeric`` on a substring, else ``dummy`` on a prefix, else ``event``."""
    numeric = [c for c in columns if any(s in c for s in contains)]
    dummy = [c for c in columns if c not in numeric and c.startswith(tuple(prefixes))]
    return {"numeric": numeric, "dummy": dummy,
            "event": [c for c in columns if c not in numeric and c not in dummy]}


def update_where(current: Column, rules: Sequence[tuple[Column, Column]]) -> Column:
    """Masked assignments in order: a later rule overrides an earlier one."""
    out = current
    for mask, value in rules:
        out = F.when(mask, value).otherwise(out)
    return out


def null_flag(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).isNull().cast("int")


def sentinel_to_null(c: Column, sentinel) -> Column:
    return F.nullif(c, F.lit(sentinel))


def row_sum(columns: Sequence[str]) -> Column:
    """Sum across columns with NULL counted as zero."""
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(F.col(c), F.lit(0.0))
    return total


def guarded_ratio(part: Column, total: Column) -> Column:
    """``part / total``, or 0 where the total is not positive."""
    return F.when(total > 0, F.try_divide(part, total)).otherwise(F.lit(0.0))


def clip(c: Column, lower=None, upper=None) -> Column:
    """Bound a value and keep NULL."""
    out = c
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(c.isNotNull(), out)


# The transforms that a normality check runs over, with their guards.
TRANSFORMS: dict[str, Callable[[Column], Column]] = {
    "raw": lambda x: x,
    "log1p": lambda x: F.log1p(clip(x, lower=0.0)),
    "exp": lambda x: F.exp(clip(x, upper=20.0)),
    "inverse": lambda x: F.try_divide(F.lit(1.0), x + F.lit(1e-2)),
    "sqrt": lambda x: F.sqrt(clip(x, lower=0.0)),
    "square": lambda x: x * x,
    "cuberoot": lambda x: F.cbrt(x),
}


def box_cox(x: Column, lam: float) -> Column:
    """Box-Cox transform of a positive column."""
    return F.log(x) if lam == 0 else (F.pow(x, F.lit(lam)) - 1) / F.lit(lam)


def yeo_johnson(x: Column, lam: float) -> Column:
    """Yeo-Johnson transform of any real column."""
    up = F.log1p(x) if lam == 0 else (F.pow(x + 1, F.lit(lam)) - 1) / F.lit(lam)
    down = -F.log1p(-x) if lam == 2 else -(F.pow(1 - x, F.lit(2 - lam)) - 1) / F.lit(2 - lam)
    return F.when(x >= 0, up).otherwise(down)


def power_likelihoods(df: DataFrame, value: str, grid: Sequence[float], family: str = "box-cox") -> DataFrame:
    """Profile log-likelihood for every lambda of the grid, from one aggregation over the table."""
    x = F.col(value).cast("double")
    if family == "box-cox":
        rows, transform, jacobian = df.where(x > 0), box_cox, F.log(x)
    elif family == "yeo-johnson":
        rows, transform, jacobian = df.where(x.isNotNull()), yeo_johnson, F.signum(x) * F.log1p(F.abs(x))
    else:
        raise ValueError(f"unknown power family {family!r}")
    n, j = F.col("_n"), F.col("_j")
    sums = rows.agg(F.count(x).alias("_n"), F.sum(jacobian).alias("_j"),
                    *[F.var_pop(transform(x, lam)).alias(f"_v{i}") for i, lam in enumerate(grid)])
    curve = F.array(*[
        F.struct(F.lit(float(lam)).alias("lambda"),
                 (F.lit(float(lam) - 1) * j - n / 2 * F.log(F.when(F.col(f"_v{i}") > 0, F.col(f"_v{i}"))))
                 .alias("log_likelihood"))
        for i, lam in enumerate(grid)
    ])
    return sums.select(F.explode(curve).alias("c")).select("c.lambda", "c.log_likelihood")


def fit_power(df: DataFrame, value: str, family: str = "box-cox", low: float = -2.0, high: float = 2.0,
              steps: int = 17, rounds: int = 3) -> float:
    """Maximum-likelihood lambda by ``rounds`` successively finer grids (one aggregation each).

    While the best lambda of a grid sits on its border, the grid moves on in that
    direction; it stops where no further lambda has a finite likelihood.
    """
    best, done = 0.0, 0
    while done < rounds:
        width = (high - low) / (steps - 1)
        grid = [low + i * width for i in range(steps)]
        row = (power_likelihoods(df, value, grid, family)
               .orderBy(F.col("log_likelihood").desc_nulls_last(), "lambda").first())
        if row["log_likelihood"] is None:
            break
        last, best = best, row["lambda"]
        if best in (grid[0], grid[-1]) and abs(best) < 64 and best != last:
            low, high = best - (high - low) / 2, best + (high - low) / 2
        else:
            done += 1
            low, high = best - width, best + width
    return best


def cross(*columns: str, missing: str = "Missing") -> Column:
    """Categorical cross of filled values, joined by an underscore."""
    return F.concat_ws("_", *[F.coalesce(F.col(c), F.lit(missing)) for c in columns])


def literal_map(c: Column, mapping: Mapping, default) -> Column:
    """Look a value up in a fixed dictionary, with a default for the rest."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(default))


def align_columns(df: DataFrame, frozen: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Exactly the frozen columns in frozen order: absent ones are filled, extra ones dropped."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(fill).alias(c) for c in frozen])


def match_key(df: DataFrame, column: str, key) -> DataFrame:
    """Rows whose key has the same text form as ``key``; KeyError with up to ten known keys if none has."""
    hit = df.where(F.col(column).cast("string") == F.lit(str(key)))
    if hit.isEmpty():
        known = [str(r[0]) for r in df.select(column).distinct().orderBy(column).limit(10).collect()]
        raise KeyError(f"{key!r} not found. Available (first 10): {known}")
    return hit
