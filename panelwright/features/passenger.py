"""Passenger featurizer: parsed codes, imputed and binned numbers, collapsed and encoded levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from panelwright.features.base import StateEstimator, StateModel, freeze
from panelwright.features.steps import (
    DomainOneHot, DomainOneHotModel, FrequencyEncoder, FrequencyEncoderModel, GroupMedianImputer, GroupMedianImputerModel,
    PopulationScaler, PopulationScalerModel, RareLevelCollapser, RareLevelCollapserModel, SimpleImputer, SimpleImputerModel,
    bin_left_closed)
from panelwright.functions.text import all_but_last, extract, extract_int, words

NUMERIC = ["Pclass", "SibSp", "Parch", "FamilySize", "CabinCount", "HasCabin", "CabinNumber", "TicketNumber",
           "FareScaled", "SurnameCount"]
CATEGORICAL = ["Sex", "Embarked", "Title", "Deck", "TicketItem", "AgeGroup"]
# Decades 0-10 .. 70-80, closed on the left.
DECADES = list(range(0, 81, 10))
# The steps in order of application, with the classes that restore them.
STEPS = {"embarked_fare": SimpleImputerModel, "age": GroupMedianImputerModel, "fare_scale": PopulationScalerModel,
         "surname": FrequencyEncoderModel, "rare": RareLevelCollapserModel, "one_hot": DomainOneHotModel}


def parse_passengers(df: DataFrame) -> DataFrame:
    """Columns that need no other row: title, surname, family size, cabin and ticket parts."""
    cabin, ticket = F.col("Cabin"), F.col("Ticket")
    return df.withColumns({
        "Title": extract(F.col("Name"), r",\s*([^\.]+)\."),
        "Surname": F.split_part("Name", F.lit(","), F.lit(1)),
        "FamilySize": F.col("SibSp") + F.col("Parch") + 1,
        "CabinCount": F.size(words(cabin)),
        "Deck": F.coalesce(F.substring(cabin, 1, 1), F.lit("Missing")),
        "HasCabin": cabin.isNotNull().cast("int"),
        "CabinNumber": extract_int(cabin, r"(\d+)"),
        "TicketNumber": extract_int(ticket, r"(\d+)$"),
        "TicketItem": all_but_last(ticket),
    })


def age_group(df: DataFrame) -> DataFrame:
    labels = [f"{a}-{a + 10}" for a in DECADES[:-1]]
    return df.withColumn("AgeGroup", bin_left_closed(F.col("Age"), DECADES, labels, "Missing"))


class PassengerFeaturizer(StateEstimator):
    """Fits all statistics on the training table; levels below ``min_freq`` of its rows become ``Other``."""

    def __init__(self, min_freq: float = 0.01):
        super().__init__()
        self.min_freq = min_freq

    def _fit(self, df: DataFrame) -> "PassengerFeaturizerModel":
        needed = ["Pclass", "Sex", "Age", "SibSp", "Parch", "Fare", "Embarked", "Surname", *NUMERIC[3:8], "Title", "Deck", "TicketItem"]
        rows = freeze(parse_passengers(df).select(*needed), "passengers")  # read by every statistic below
        # medians, mode and counts need parsed columns only; the age groups alone need an imputed one
        fitted = {"embarked_fare": SimpleImputer(["Fare"], ["Embarked"]).fit(rows),
                  "age": GroupMedianImputer(["Pclass", "Sex", "Title"], "Age").fit(rows),
                  "surname": FrequencyEncoder("Surname", "SurnameCount").fit(rows)}
        filled = fitted["embarked_fare"].transform(rows)
        fitted["fare_scale"] = PopulationScaler(["FareScaled"]).fit(filled.withColumn("FareScaled", F.log1p("Fare")))
        fitted["rare"] = RareLevelCollapser(CATEGORICAL, self.min_freq).fit(age_group(fitted["age"].transform(filled)))
        fitted["one_hot"] = DomainOneHot(CATEGORICAL, drop_first=True, domains=fitted["rare"].domains(CATEGORICAL)).fit(filled)
        tables = {f"{n}.{t}": frame for n, m in fitted.items() for t, frame in m.tables.items()}
        return PassengerFeaturizerModel({n: m.state for n, m in fitted.items()}, tables)


class PassengerFeaturizerModel(StateModel):
    """Adds ``raw_view`` (numeric plus text levels) or the default numeric view (numeric plus one-hot)."""

    def _step(self, name: str) -> StateModel:
        tables = {t.split(".", 1)[1]: f for t, f in self.tables.items() if t.startswith(name + ".")}
        return STEPS[name](self.state[name], tables)

    def raw_view(self, df: DataFrame) -> DataFrame:
        kept = [c for c in ("PassengerId", "Survived") if c in df.columns]
        rows = self._step("embarked_fare").transform(parse_passengers(df))
        rows = age_group(self._step("age").transform(rows)).withColumn("FareScaled", F.log1p("Fare"))
        rows = self._step("surname").transform(self._step("fare_scale").transform(rows))
        return self._step("rare").transform(rows).select(*kept, *NUMERIC, *CATEGORICAL)

    def feature_names(self) -> list[str]:
        return NUMERIC + self._step("one_hot").names()

    def _transform(self, df: DataFrame) -> DataFrame:
        return self._step("one_hot").transform(self.raw_view(df))
