"""Single preprocessing steps: impute, bin, collapse, encode, scale and filter.

Every fit is one or two aggregation jobs; every transform is column expressions
or a lookup join.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA, OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from panelwright.features.base import FitError, StateEstimator, StateModel, freeze
from panelwright.operators.profile import categorical_profile
from panelwright.operators.reshape import collinear_columns, constant_columns, spearman_matrix
from panelwright.operators.scale import exact_quantiles, join_lookup, numbered_by_hash, quantile_values

# One-hot domains become columns, so a fit refuses more levels than this.
MAX_LEVELS = 5_000


def bin_left_closed(c: Column, edges: Sequence[float], labels: Sequence, default) -> Column:
    """Label of [edge_i, edge_{i+1}); the default outside the edges and for NULL."""
    out = F.lit(default)
    for low, high, label in zip(edges[:-1], edges[1:], labels, strict=True):
        out = F.when((c >= float(low)) & (c < float(high)), F.lit(label)).otherwise(out)
    return out


def bin_right_closed(c: Column, edges: Sequence[float], labels: Sequence | None = None, default=None,
                     include_lowest: bool = True) -> Column:
    """Label of (edge_i, edge_{i+1}], the first bin also holding its lower edge; the default outside.

    Repeated edges are dropped first, which keeps the remaining bins' numbers dense.
    """
    edges = sorted(set(float(e) for e in edges))
    labels = list(range(len(edges) - 1)) if labels is None else list(labels)
    if len(edges) < 2:
        return F.lit(default)
    if len(labels) != len(edges) - 1:
        raise ValueError("one label for each bin")
    low, high = F.lit(edges[0]), F.lit(edges[-1])
    # a search in an array: a branch for each edge of many columns makes code that the JVM does not compile
    below = F.size(F.filter(F.array(*[F.lit(e) for e in edges[1:]]), lambda e: e < c))
    inside = F.get(F.array(*[F.lit(label) for label in labels]), below)
    return F.when((c >= low if include_lowest else c > low) & (c <= high), inside).otherwise(F.lit(default))


def zero_aware_bin(c: Column, edges: Sequence[float], default=-1) -> Column:
    """0 for a value that is not positive, else its right-closed bin plus one."""
    return F.when(c > 0, bin_right_closed(c, edges, range(1, len(set(edges))), default)).otherwise(F.lit(0))


class SimpleImputer(StateEstimator):
    """Exact median for numeric columns; most frequent level or a constant for text columns."""

    def __init__(self, numeric: Sequence[str] = (), text: Sequence[str] = (), text_fill: str | None = None):
        super().__init__()
        self.numeric, self.text, self.text_fill = list(numeric), list(text), text_fill

    def _fit(self, df: DataFrame) -> "SimpleImputerModel":
        fills: dict = {}
        if self.numeric:
            for c, q in quantile_values(df, self.numeric, [0.5]).items():
                if not q:
                    raise FitError(f"column {c} has no value to take a median of")
                fills[c] = q[0]
        if self.text and self.text_fill is not None:
            fills |= {c: self.text_fill for c in self.text}
        elif self.text:
            modes = {r["column"]: r["top"] for r in categorical_profile(df, self.text).collect()}
            missing = [c for c in self.text if c not in modes]
            if missing:
                raise FitError(f"columns {missing} have no level")
            fills |= modes
        return SimpleImputerModel({"fills": fills})


class SimpleImputerModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c).cast("double") if isinstance(v, float) else F.col(c), F.lit(v))
                               for c, v in self.state["fills"].items()})


class GroupMedianImputer(StateEstimator):
    """Median of the training group, else of the training table (also on the training table itself)."""

    def __init__(self, keys: Sequence[str], value: str):
        super().__init__()
        self.keys, self.value = list(keys), value

    def _fit(self, df: DataFrame) -> "GroupMedianImputerModel":
        groups = exact_quantiles(df, [self.value], [0.5], self.keys).select(
            *self.keys, F.col("q0").alias("_median"), F.col("n_values").alias("_n"))
        overall = quantile_values(df, [self.value], [0.5])[self.value]
        if not overall:
            raise FitError(f"column {self.value} has no value to take a median of")
        return GroupMedianImputerModel({"keys": self.keys, "value": self.value, "overall": overall[0]},
                                       {"groups": freeze(groups, "group-medians")})


class GroupMedianImputerModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        value = self.state["value"]
        joined = join_lookup(df, self.tables["groups"], self.state["keys"], "_n")
        filled = F.coalesce(F.col(value), "_median", F.lit(self.state["overall"]))
        return joined.withColumn(value, filled).select(*df.columns)


class QuantileBinner(StateEstimator):
    """Right-closed bins at training quantiles; out-of-range values and NULL get -1.

    ``zero_aware`` fits on positive values only and reserves bin 0 for the rest;
    ``sentinel_below`` sends values below it to -1 and leaves them out of the fit.
    """

    def __init__(self, column: str, bins: int, out: str, zero_aware: bool = False, sentinel_below: float | None = None):
        super().__init__()
        self.column, self.bins, self.out = column, bins, out
        self.zero_aware, self.sentinel_below = zero_aware, sentinel_below

    def _fit(self, df: DataFrame) -> "QuantileBinnerModel":
        c, rows = F.col(self.column), df
        if self.zero_aware:
            rows = df.where(c > 0)
        elif self.sentinel_below is not None:
            rows = df.where(c >= self.sentinel_below)
        probs = [i / self.bins for i in range(self.bins + 1)]
        edges = quantile_values(rows, [self.column], probs)[self.column] or [0.0]
        return QuantileBinnerModel({"column": self.column, "out": self.out, "edges": edges,
                                    "zero_aware": self.zero_aware, "sentinel_below": self.sentinel_below})


class QuantileBinnerModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.state
        c = F.col(s["column"])
        if s["zero_aware"]:
            out = zero_aware_bin(c, s["edges"])
        else:
            out = bin_right_closed(c, s["edges"], default=-1)
            if s["sentinel_below"] is not None:
                out = F.when(c >= s["sentinel_below"], out).otherwise(F.lit(-1))
        return df.withColumn(s["out"], out)


class RareLevelCollapser(StateEstimator):
    """Replace rare, unseen and NULL levels by ``Other``.

    ``base='rows'`` keeps levels with at least ``int(min_freq * rows)`` rows: at
    most about 2 / min_freq levels, kept in the state. ``base='levels'`` compares
    with ``min_freq * number of levels``; up to MAX_LEVELS kept levels go to the
    state, a larger level table is joined. One pass counts the levels of all columns.
    """

    def __init__(self, columns: Sequence[str], min_freq: float = 0.01, base: str = "rows"):
        super().__init__()
        if base not in ("rows", "levels"):
            raise ValueError("base must be 'rows' or 'levels'")
        self.columns, self.min_freq, self.base = list(columns), min_freq, base

    def _fit(self, df: DataFrame) -> "RareLevelCollapserModel":
        state = {"columns": self.columns, "base": self.base, "kept": {c: [] for c in self.columns}}
        tables = {}
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("level")) for c in self.columns])).alias("r"))
        counts = freeze(long.select("r.*").where(F.col("level").isNotNull()).groupBy("column", "level").agg(
            F.count(F.lit(1)).alias("_n")), "level-counts")
        n_rows = df.count()
        if self.base == "rows":
            threshold = F.lit(int(self.min_freq * n_rows))
        else:
            sizes = {r["column"]: r["count"] for r in counts.groupBy("column").count().collect()}
            threshold = F.lit(0.0)
            for c, n in sizes.items():
                threshold = F.when(F.col("column") == c, F.lit(self.min_freq * n)).otherwise(threshold)
        kept = counts.where(F.col("_n") >= threshold)
        covered = {r["column"]: r["n"] for r in kept.groupBy("column").agg(F.sum("_n").alias("n")).collect()}
        # columns with training rows that become Other
        state["other"] = {c: covered.get(c, 0) < n_rows for c in self.columns}
        n_kept = {r["column"]: r["count"] for r in kept.groupBy("column").count().collect()}
        small = [c for c in self.columns if n_kept.get(c, 0) <= MAX_LEVELS or self.base == "rows"]
        for r in kept.where(F.col("column").isin(*small)).orderBy("column", "level").collect():
            state["kept"][r["column"]].append(r["level"])
        for c in self.columns:
            if c not in small:
                tables[c] = freeze(kept.where(F.col("column") == c).select(F.col("level").alias(c), "_n"), "levels")
        return RareLevelCollapserModel(state, tables)


class RareLevelCollapserModel(StateModel):
    def domains(self, columns: Sequence[str]) -> dict[str, list[str]]:
        """Sorted levels of the collapsed training columns, known without reading them again."""
        return {c: sorted({*self.state["kept"][c], *(["Other"] if self.state["other"][c] else [])}) for c in columns}

    def _transform(self, df: DataFrame) -> DataFrame:
        kept = self.state["kept"]
        out = df.withColumns({
            c: F.when(F.col(c).isin(*kept[c]), F.col(c)).otherwise(F.lit("Other")) if kept[c] else F.lit("Other")
            for c in self.state["columns"] if c not in self.tables})
        for c, table in self.tables.items():
            joined = join_lookup(out, table, [c], "_n")
            out = joined.withColumn(c, F.when(F.col("_n").isNotNull(), F.col(c)).otherwise(F.lit("Other"))).select(*df.columns)
        return out


class DomainOneHot(StateEstimator):
    """Frozen one-hot columns ``<column>_<level>``; unknown levels are all zeros.

    Levels are sorted; ``drop_first`` leaves out the first one. The domain may be
    given, else it is fitted; more than MAX_LEVELS levels are
    refused: ``SparseOneHot`` takes any number.
    """

    def __init__(self, columns: Sequence[str], drop_first: bool = False, domains: dict[str, list[str]] | None = None,
                 keep_input: bool = False):
        super().__init__()
        self.columns, self.drop_first, self.domains, self.keep_input = list(columns), drop_first, domains, keep_input

    def _fit(self, df: DataFrame) -> "DomainOneHotModel":
        domains = {c: list(self.domains[c]) for c in self.columns if self.domains and c in self.domains}
        open_columns = [c for c in self.columns if c not in domains]
        if open_columns:
            long = df.select(F.explode(F.array(*[
                F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in open_columns])).alias("r")).select("r.*")
            found = long.where(F.col("v").isNotNull()).distinct().limit(MAX_LEVELS * len(open_columns) + 1).collect()
            fitted = {c: sorted(r["v"] for r in found if r["c"] == c) for c in open_columns}
            wide = [c for c, levels in fitted.items() if len(levels) > MAX_LEVELS]
            if wide or len(found) > MAX_LEVELS * len(open_columns):
                raise FitError(f"columns {wide or open_columns} have more than {MAX_LEVELS} levels; collapse rare ones first")
            domains |= fitted
        return DomainOneHotModel({"columns": self.columns, "domains": domains, "drop_first": self.drop_first,
                                  "keep_input": self.keep_input})


class DomainOneHotModel(StateModel):
    def names(self) -> list[str]:
        skip = 1 if self.state["drop_first"] else 0
        return [f"{c}_{lv}" for c in self.state["columns"] for lv in self.state["domains"][c][skip:]]

    def _transform(self, df: DataFrame) -> DataFrame:
        skip = 1 if self.state["drop_first"] else 0
        # a text is searched once in its levels: a comparison of texts a level makes code that the JVM does not compile
        shown = {c: self.state["domains"][c][skip:] for c in self.state["columns"] if self.state["domains"][c][skip:]}
        met = df.select("*", *[F.coalesce(F.array_position(F.array(*[F.lit(lv) for lv in levels]), F.col(c).cast("string")), F.lit(0)).alias(f"_at_{c}")
                               for c, levels in shown.items()])
        hot = [(F.col(f"`_at_{c}`") == F.lit(i)).cast("double").alias(f"{c}_{lv}") for c, levels in shown.items() for i, lv in enumerate(levels, 1)]
        keep = [f"`{c}`" for c in df.columns if self.state["keep_input"] or c not in self.state["columns"]]
        return met.select(*keep, *hot)


class PopulationScaler(StateEstimator):
    """Standardise with the population deviation; a constant column stays unscaled (centred to zero)."""

    def __init__(self, columns: Sequence[str], with_mean: bool = True, suffix: str = ""):
        super().__init__()
        self.columns, self.with_mean, self.suffix = list(columns), with_mean, suffix

    def _fit(self, df: DataFrame) -> "PopulationScalerModel":
        row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(self.columns)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(self.columns)]).first()
        mean = [row[f"m{i}"] if self.with_mean else 0.0 for i in range(len(self.columns))]
        return PopulationScalerModel({"columns": self.columns, "suffix": self.suffix, "mean": mean,
                                      "std": [row[f"s{i}"] or 1.0 for i in range(len(self.columns))]})


class PopulationScalerModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.state
        return df.withColumns({c + s["suffix"]: (F.col(c) - F.lit(m)) / F.lit(d)
                               for c, m, d in zip(s["columns"], s["mean"], s["std"], strict=True)})


class RangeScaler(StateEstimator):
    """Scale to [0, 1] by the training minimum and maximum; a constant column becomes 0."""

    def __init__(self, columns: Sequence[str]):
        super().__init__()
        self.columns = list(columns)

    def _fit(self, df: DataFrame) -> "RangeScalerModel":
        row = df.agg(*[F.min(c).cast("double").alias(f"a{i}") for i, c in enumerate(self.columns)],
                     *[F.max(c).cast("double").alias(f"b{i}") for i, c in enumerate(self.columns)]).first()
        return RangeScalerModel({"columns": self.columns, "low": [row[f"a{i}"] for i in range(len(self.columns))],
                                 "high": [row[f"b{i}"] for i in range(len(self.columns))]})


class RangeScalerModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.state
        return df.withColumns({c: (F.col(c) - F.lit(a)) / F.lit((b - a) or 1.0)
                               for c, a, b in zip(s["columns"], s["low"], s["high"], strict=True)})


class SparseOneHot(StateEstimator):
    """One sparse vector for a column with any number of levels; unseen levels and NULL give the zero vector.

    Levels are numbered in hash order in a table that is joined, not collected.
    """

    def __init__(self, column: str, out: str, index: str | None = None):
        super().__init__()
        self.column, self.out, self.index = column, out, index or f"{column}_index"

    def _fit(self, df: DataFrame) -> "SparseOneHotModel":
        counts = df.where(F.col(self.column).isNotNull()).groupBy(F.col(self.column).cast("string").alias("level")).agg(F.count(F.lit(1)).alias("_n"))
        levels = freeze(numbered_by_hash(freeze(counts, "level-counts"), ["level"], out="_no").withColumn("_no", F.col("_no") - 1), "level-index")
        return SparseOneHotModel({"column": self.column, "out": self.out, "index": self.index, "size": levels.count()}, {"levels": levels})


class SparseOneHotModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.state
        named = df.withColumn("level", F.col(s["column"]).cast("string"))
        # the last category stands for everything unseen and is the one that the encoder leaves out
        indexed = join_lookup(named, self.tables["levels"], ["level"], "_n").withColumn(s["index"], F.coalesce("_no", F.lit(s["size"])).cast("double"))
        indexed = indexed.select(*df.columns, s["index"])
        encoder = OneHotEncoder(inputCol=s["index"], outputCol=s["out"], dropLast=True)
        return encoder.fit(df.sparkSession.createDataFrame([(float(s["size"]),)], f"`{s['index']}` double")).transform(indexed)


class FrequencyEncoder(StateEstimator):
    """Training count of a level; unseen levels and NULL get the default."""

    def __init__(self, column: str, out: str, default: int = 0):
        super().__init__()
        self.column, self.out, self.default = column, out, default

    def _fit(self, df: DataFrame) -> "FrequencyEncoderModel":
        counts = df.where(F.col(self.column).isNotNull()).groupBy(self.column).agg(F.count(F.lit(1)).alias("_n"))
        return FrequencyEncoderModel({"column": self.column, "out": self.out, "default": self.default},
                                     {"counts": freeze(counts, "level-counts")})


class FrequencyEncoderModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.state
        joined = join_lookup(df, self.tables["counts"], [s["column"]], "_n")
        return joined.withColumn("_f", F.coalesce("_n", F.lit(s["default"]))).select(*df.columns, F.col("_f").alias(s["out"]))


class ConstantFilter(StateEstimator):
    """Drop the columns that hold one value in the training table."""

    def __init__(self, columns: Sequence[str]):
        super().__init__()
        self.columns = list(columns)

    def _fit(self, df: DataFrame) -> "DropModel":
        return DropModel({"dropped": constant_columns(df, self.columns)})


class CollinearityFilter(StateEstimator):
    """Drop the columns whose Spearman correlation with an earlier column exceeds the threshold."""

    def __init__(self, columns: Sequence[str], id_cols: Sequence[str], threshold: float = 0.9):
        super().__init__()
        self.columns, self.id_cols, self.threshold = list(columns), list(id_cols), threshold

    def _fit(self, df: DataFrame) -> "DropModel":
        found = collinear_columns(spearman_matrix(df, self.columns, self.id_cols), self.threshold)
        partners = {r["column"]: r["partners"] for r in found.collect()}  # at most one row per column
        return DropModel({"dropped": sorted(partners), "partners": partners})


class DropModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.state["dropped"])


class SignedPCA(StateEstimator):
    """Principal components of an array column after population scaling.

    Each component's sign is fixed so that its largest loading is positive.
    """

    def __init__(self, column: str, k: int, out: str = "components"):
        super().__init__()
        self.column, self.k, self.out = column, k, out

    def _fit(self, df: DataFrame) -> "SignedPCAModel":
        size = df.select(F.max(F.size(self.column)).alias("n")).first()["n"]
        elements = [F.get(F.col(self.column), F.lit(i)).cast("double") for i in range(size)]
        row = df.agg(F.array(*[F.avg(e) for e in elements]).alias("m"),
                     F.array(*[F.stddev_pop(e) for e in elements]).alias("s")).first()
        mean, std = list(row["m"]), [v or 1.0 for v in row["s"]]
        scaled = df.select(array_to_vector(_scaled_array(F.col(self.column), mean, std)).alias("_v"))
        loadings = PCA(k=self.k, inputCol="_v", outputCol="_o").fit(scaled).pc.toArray()
        peak = np.abs(loadings).argmax(axis=0)
        loadings = loadings * np.where(loadings[peak, np.arange(loadings.shape[1])] < 0, -1.0, 1.0)
        return SignedPCAModel({"column": self.column, "out": self.out, "mean": mean, "std": std,
                               "loadings": loadings.T.tolist()})


def _scaled_array(c: Column, mean: Sequence[float], std: Sequence[float]) -> Column:
    centre, spread = F.array(*[F.lit(float(v)) for v in mean]), F.array(*[F.lit(float(v)) for v in std])
    centred = F.zip_with(c.cast("array<double>"), centre, lambda a, b: a - b)
    return F.zip_with(centred, spread, lambda a, b: a / b)


class SignedPCAModel(StateModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.state
        scaled = df.withColumn("_scaled", _scaled_array(F.col(s["column"]), s["mean"], s["std"]))
        dots = [F.aggregate(F.zip_with("_scaled", F.array(*[F.lit(float(v)) for v in row]), lambda a, b: a * b),
                            F.lit(0.0), lambda acc, v: acc + v) for row in s["loadings"]]
        return scaled.withColumn(s["out"], F.array(*dots)).drop("_scaled")


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Vector column for Spark ML, NULLs kept out by an error."""
    safe = {c: c.replace(".", "_") for c in columns}
    renamed = df.withColumnsRenamed({c: s for c, s in safe.items() if c != s})
    return VectorAssembler(inputCols=list(safe.values()), outputCol=out).transform(renamed)


def positive_probability(c: Column | str = "probability") -> Column:
    return F.get(vector_to_array(c), F.lit(1))
