"""Calendar events: cleaning, the national matrix, and local and regional tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from panelwright.functions.expr import update_where
from panelwright.functions.text import extract_int
from panelwright.operators.joins import outer_fill_zero
from panelwright.operators.reshape import keep_one

# The event vocabulary of the cleaner.
MOVED_PREFIX = r"(?i)^\s*(Traslado|Puente)\s+"
OFFSET = r"([+-]\d+)$"
FOLDED_TYPES = ("Transfer", "Bridge")
SHOPPING = ("Cyber Monday", "Black Friday")
DISASTER = "Terremoto Manabi"
WORLD_CUP = r"(?i)Mundial de f[uú]tbol"


def clean_events(df: DataFrame) -> DataFrame:
    """Observed events with folded types, signed day offsets and grouped descriptions.

    Needs date, type, locale, locale_name, description, transferred.
    """
    kept = df.where(~F.col("transferred")).withColumn("description", F.regexp_replace("description", MOVED_PREFIX, ""))
    typed = kept.withColumn("type", F.when(F.col("type").isin(*FOLDED_TYPES), "Holiday").otherwise(F.col("type")))
    named = typed.withColumn("description", F.when(F.col("type") == "Work Day", "Work Day").otherwise(F.col("description")))
    offset = named.withColumn("additional", extract_int(F.col("description"), OFFSET).cast("int"))
    base = offset.withColumn("description", F.trim(F.regexp_replace("description", r"[+-]\d+$", "")))
    d = F.col("description")
    grouped = update_where(d, [
        (d.isin(*SHOPPING), F.lit("Shopping Day")), (d == DISASTER, F.lit("Disaster")),
        (F.coalesce(F.rlike(d, F.lit(WORLD_CUP)), F.lit(False)), F.lit("World Cup")),
        (F.col("locale") == "Local", F.lit("Local")), (F.col("locale") == "Regional", F.lit("Regional"))])
    return base.withColumn("description", grouped).withColumn(
        "additional_squared", F.col("additional") * F.col("additional")).drop("locale", "transferred")


def national_matrix(events: DataFrame, country: str, levels: Sequence[str], date: str = "date") -> DataFrame:
    """One row per date: one-hot national events with offsets, joined with disaster events.

    Of several rows on a date, the one with the largest absolute offset stays.
    """
    def one_hot(level: str) -> Column:
        return (F.col("description") == level).cast("double").alias(level)

    national = events.where((F.col("locale_name") == country) & (F.col("description") != "Disaster")).select(
        date, *[one_hot(lv) for lv in levels], F.col("additional").cast("double").alias("additional"),
        F.col("additional_squared").cast("double").alias("additional_squared"))
    disaster = events.where(F.col("description") == "Disaster").select(
        date, F.lit(1.0).alias("Disaster"), F.col("additional").cast("double").alias("days_from_dis"),
        F.col("additional_squared").cast("double").alias("days_from_dis_squared"))
    payload = [*levels, "additional", "additional_squared", "Disaster", "days_from_dis", "days_from_dis_squared"]
    # both sides are cut to one row per date and order before the join, so the join cannot multiply rows
    best_national = keep_one(national, [date], _order(levels), payload[:len(levels) + 2])
    best_disaster = keep_one(disaster, [date], [-F.abs("days_from_dis"), F.col("days_from_dis")], payload[-3:])
    return outer_fill_zero(best_national, best_disaster, [date])


def _order(levels: Sequence[str]) -> list[Column]:
    return [-F.abs("additional"), F.col("additional"), *[-F.col(f"`{lv}`") for lv in levels]]


def local_table(events: DataFrame, place: str = "city", date: str = "date") -> DataFrame:
    """Local holidays keyed by (date, city): the row with the smallest absolute offset, flag 1.0."""
    local = events.where(F.col("description") == "Local").withColumnRenamed("locale_name", place)
    out = keep_one(local, [date, place], [F.abs("additional"), F.col("additional")], ["additional", "additional_squared"])
    return out.withColumn("local_holiday", F.lit(1.0))


def regional_table(events: DataFrame, place: str = "state", date: str = "date") -> DataFrame:
    """Regional holidays keyed by (date, state), flag 1.0."""
    return events.where(F.col("description") == "Regional").select(
        date, F.col("locale_name").alias(place)).distinct().withColumn("regional_holiday", F.lit(1.0))
