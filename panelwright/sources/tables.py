"""Table scans and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from panelwright.sources.scratch import scratch_path


def scan(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; the column list only documents intent, Catalyst prunes anyway."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


# A session that works on few large files of one row group (a laptop, a bench) may set this to deal their rows to all cores.
SPREAD_SCANS = "spark.panelwright.spreadScans"


def spread(df: DataFrame) -> DataFrame:
    """The table as it is, or dealt to all cores where the session asks for it."""
    spark = df.sparkSession
    asked = spark.conf.get(SPREAD_SCANS, "false").lower() == "true"
    return df.repartition(spark.sparkContext.defaultParallelism) if asked else df


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn NaN and infinities of floating columns into NULL."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    chosen = floats & set(columns) if columns is not None else floats
    return df.select(
        *[
            finite_or_null(F.col(c)).alias(c) if c in chosen else F.col(c)
            for c in df.columns
        ]
    )


def finite_or_null(c: Column) -> Column:
    """NULL for NaN and for both infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             columns: Sequence[str] | None = None, dates: Sequence[str] = ()) -> DataFrame:
    """Headered CSV scan with an explicit schema; types are inferred only without one.

    ``columns`` prunes the scan and ``dates`` truncates the named columns to days.
    Floating columns come back with NaN turned into NULL.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    df = reader.csv(path)
    if columns:
        df = df.select(*columns)
    for c in dates:
        df = df.withColumn(c, F.to_date(c))
    return nan_to_null(df)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """Headered CSV sink."""
    out = df.coalesce(1) if single_file else df
    out.write.option("header", True).csv(path)
    return path


def write_predictions(df: DataFrame, id_col: str, prediction: str, path: str,
                      id_name: str = "id", prediction_name: str = "prediction",
                      single_file: bool = False) -> str:
    """Two-column prediction CSV sorted by id, in as many range-ordered parts as Spark plans."""
    out = df.select(F.col(id_col).alias(id_name), F.col(prediction).alias(prediction_name)).orderBy(id_name)
    return write_csv(out, path, single_file)


def write_predictions_to_scratch(df: DataFrame, id_col: str, prediction: str) -> str:
    return write_predictions(df, id_col, prediction, scratch_path(df.sparkSession, "predictions"))


def tolerant_records(df: DataFrame, payload: Sequence[str], label: Sequence[str], record_id: str | None,
                     missing_label: int = -1) -> DataFrame:
    """Records whose payload, label and id may sit under alternative field names.

    The first non-empty payload field wins, then the first non-negative label;
    absent fields are skipped and a missing id becomes the empty string.
    """
    have = set(df.columns)
    pay = [F.when(F.length(c) > 0, F.col(c)) for c in payload if c in have]
    lab = [F.when(F.col(c) >= 0, F.col(c).cast("long")) for c in label if c in have]
    rid = F.coalesce(F.col(record_id).cast("string"), F.lit("")) if record_id in have else F.lit("")
    return df.select(
        rid.alias("record_id"),
        F.coalesce(*pay, F.lit(None)).cast("binary").alias("payload"),
        F.coalesce(*lab, F.lit(missing_label).cast("long")).alias("label"),
    )


def schema_report(df: DataFrame) -> DataFrame:
    """Column names, Spark types and the row count as a small table (one count job)."""
    fields = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                 F.lit(f.dataType.simpleString()).alias("column_type"))
        for i, f in enumerate(df.schema.fields)
    ])
    return (
        df.agg(F.count(F.lit(1)).alias("n_rows"))
        .select("n_rows", F.explode(fields).alias("f"))
        .select("f.position", "f.column_name", "f.column_type", "n_rows")
    )


def csv_schema(df: DataFrame, overrides: Mapping[str, T.DataType] | None = None) -> T.StructType:
    """The schema of ``df`` as nullable CSV columns, with optional type overrides."""
    overrides = overrides or {}
    return T.StructType([T.StructField(f.name, overrides.get(f.name, f.dataType), True) for f in df.schema.fields])
