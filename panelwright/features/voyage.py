"""Group-and-spend featurizer: parsed cabins, group statistics, spend shares and bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from panelwright.features.base import FitError, StateEstimator, StateModel, freeze
from panelwright.features.steps import (
    DomainOneHot, DomainOneHotModel, PopulationScaler, PopulationScalerModel, RareLevelCollapser, RareLevelCollapserModel,
    bin_right_closed, zero_aware_bin)
from panelwright.functions.expr import clip, cross, guarded_ratio, literal_map, null_flag, row_sum
from panelwright.functions.text import extract, words
from panelwright.operators.scale import exact_quantiles, join_lookup, quantile_values, with_group_stats

# Input columns and patterns of codes.
SPEND = ["RoomService", "FoodCourt", "ShoppingMall", "Spa", "VRDeck"]
LEVELS = ["HomePlanet", "Destination", "Deck", "Side", "Surname", "DeckSide", "HomeDest"]
CABIN = r"([A-Z])/(\d+)/([PS])"
GROUP = r"(\d+)_(\d+)"
INFINITY = float("inf")
# Columns that name or label a row.
NOT_FEATURES = ("PassengerId", "Transported")
# Domain bins and the deck order.
AGE_BINS = [0, 12, 18, 25, 30, 50, 100]
SECTION_BINS = [-1, 300, 600, 900, 2000]
GROUP_BINS = [0, 1, 2, 4, 10, INFINITY]
DECK_LEVEL = {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "F": 6, "G": 7, "T": 8}


def parsed(df: DataFrame) -> DataFrame:
    """The given columns with the parts of their codes and names; each row for itself."""
    cabin = F.col("Cabin")
    return df.withColumns({
        "Deck": extract(cabin, CABIN, 1), "Side": extract(cabin, CABIN, 3),
        "CabinNum": extract(cabin, CABIN, 2).cast("double"),
        "GroupNum": extract(F.col("PassengerId"), GROUP, 1).cast("bigint"),
        "Surname": F.try_element_at(words(F.col("Name")), F.lit(-1)),
    })


def sized_features(sized: DataFrame) -> DataFrame:
    """First-order features of parsed rows that know their ``GroupSize``."""
    filled = sized.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in SPEND})
    total = filled.withColumn("TotalSpend", row_sum(SPEND))
    shares = total.withColumns({
        "SpendPerPerson": F.col("TotalSpend") / clip(F.col("GroupSize"), lower=1),
        **{f"{c}Ratio": guarded_ratio(F.col(c), F.col("TotalSpend")) for c in SPEND},
        **{f"{c}_NA": null_flag(c) for c in ("CryoSleep", "VIP", "CabinNum")},
    })
    known = shares.withColumns({
        **{c: flag(c) for c in ("CryoSleep", "VIP")},
        "CabinNum": F.coalesce("CabinNum", F.lit(-1.0)),
        **{c: F.coalesce(c, F.lit("Missing")) for c in LEVELS[:5]},
    })
    return known.withColumns({"DeckSide": cross("Deck", "Side"), "HomeDest": cross("HomePlanet", "Destination")}).drop("Cabin", "Name")


def flag(c: str) -> Column:
    return F.coalesce(F.col(c).cast("int"), F.lit(0))


def row_features(df: DataFrame) -> DataFrame:
    """First-order features; only the group size looks at other rows of the given table."""
    return sized_features(with_group_stats(parsed(df), ["GroupNum"], {"GroupSize": F.count(F.lit(1))}, spread_by=["PassengerId"]))


class GroupSpendFeaturizer(StateEstimator):
    """Fits bin edges, group statistics and level tables."""

    def __init__(self, min_freq: float = 0.01, n_age_bins: int = 6, n_spend_bins: int = 3, n_cabin_bins: int = 5,
                 n_group_bins: int = 5, use_fixed_group_bins: bool = True, drop_cols: tuple[str, ...] = ("GroupNum",)):
        super().__init__()
        self.min_freq, self.n_age_bins, self.n_spend_bins = min_freq, n_age_bins, n_spend_bins
        self.n_cabin_bins, self.n_group_bins = n_cabin_bins, n_group_bins
        self.use_fixed_group_bins, self.drop_cols = use_fixed_group_bins, list(drop_cols)

    def _fit(self, df: DataFrame) -> "GroupSpendFeaturizerModel":
        return self.fit_rows(df)[0]

    def fit_rows(self, df: DataFrame) -> tuple["GroupSpendFeaturizerModel", DataFrame]:
        """The model, and the rows of ``df`` with its group statistics for ``raw_from_grouped``.

        A table that is fitted and transformed is so parsed, shuffled by group and written once.
        """
        groups = self._groups(df)
        columns = [c for c in groups.columns if c not in ("GroupNum", "_n")]
        met = join_lookup(parsed(df), groups, ["GroupNum"], "_n", ["PassengerId"]).withColumnRenamed("_n", "GroupSize")
        sized = sized_features(met)
        # the group's statistics come last, as where they are joined to finished rows
        rows = freeze(sized.select(*[c for c in sized.columns if c not in columns], *columns), "voyage-rows")  # read by every statistic below

        def steps(n: int) -> list[float]:
            return [i / n for i in range(n + 1)]

        spends = [*SPEND, "TotalSpend", "SpendPerPerson"]
        wanted = {"Age": [0.5], "CabinNum": steps(self.n_cabin_bins), **{c: steps(self.n_spend_bins) for c in spends}}
        if not self.use_fixed_group_bins:
            wanted["GroupSize"] = steps(self.n_group_bins)
        probs = sorted({p for of in wanted.values() for p in of})
        used = {**{c: F.when(F.col(c) > 0, F.col(c)) for c in spends}, "CabinNum": F.when(F.col("CabinNum") >= 0, F.col("CabinNum"))}
        found = quantile_values(rows.select(*[used.get(c, F.col(c)).alias(c) for c in wanted]), list(wanted), probs)
        edges = {c: [found[c][probs.index(p)] for p in of] if found[c] else [] for c, of in wanted.items()}
        median = edges["Age"]
        if not median:
            raise FitError("column Age has no value")
        state = {
            "age_median": median[0],
            "age_edges": quantile_values(rows.select(F.coalesce("Age", F.lit(median[0])).alias("Age")), ["Age"],
                                         steps(self.n_age_bins))["Age"],
            "spend_edges": {c: edges[c] or [0.0] for c in spends},
            "cabin_edges": edges["CabinNum"],
            "group_edges": GROUP_BINS if self.use_fixed_group_bins else edges["GroupSize"],
            "drop_cols": self.drop_cols,
        }
        surnames = rows.groupBy("Surname").agg(F.count(F.lit(1)).alias("FamilySize"))
        tables = {"groups": groups,
                  "surnames": freeze(surnames.withColumn("_n", F.col("FamilySize")), "voyage-surnames")}
        rare = RareLevelCollapser(LEVELS, self.min_freq, base="levels").fit(rows)
        state["rare"] = rare.state
        tables |= {f"level.{c}": t for c, t in rare.tables.items()}
        state["scale"] = PopulationScaler(["TotalSpend"]).fit(rows).state
        # surnames may have any number of levels: the matrix holds their share of the training rows instead
        shown = [c for c in LEVELS if c not in ("Surname", *self.drop_cols)]
        state["one_hot"] = DomainOneHot(shown, drop_first=True, domains=rare.domains(shown)).fit(rows).state
        state["n_rows"] = rows.count()
        model = GroupSpendFeaturizerModel(state, tables)
        state["names"] = [c for c in model.matrix(model.raw_from_grouped(rows)).columns if c not in NOT_FEATURES]
        return model, rows

    def _groups(self, df: DataFrame) -> DataFrame:
        members = freeze(parsed(df).select("GroupNum", flag("CryoSleep").alias("CryoSleep"), "Age"), "voyage-members")
        gap = F.max("Age") - F.min("Age")
        groups = members.groupBy("GroupNum").agg(F.avg("CryoSleep").alias("GroupCryoFrac"), gap.alias("FamilyAgeGap"),
                                                 F.count(F.lit(1)).alias("_n"))
        ages = exact_quantiles(members, ["Age"], [0.5], ["GroupNum"]).select("GroupNum", F.col("q0").alias("GroupAgeMedian"))
        return freeze(groups.join(ages, "GroupNum", "left"), "voyage-groups")


class GroupSpendFeaturizerModel(StateModel):
    def raw_view(self, df: DataFrame) -> DataFrame:
        """Numeric features and collapsed text levels, without encoding."""
        return self.raw_from_rows(row_features(df))

    def raw_from_rows(self, rows: DataFrame) -> DataFrame:
        return self.raw_from_grouped(join_lookup(rows, self.tables["groups"], ["GroupNum"], "_n", ["PassengerId"]).drop("_n"))

    def raw_from_grouped(self, rows: DataFrame) -> DataFrame:
        """The raw view of rows that hold the statistics of their group."""
        s = self.state
        d = rows.withColumn("Age", F.coalesce("Age", F.lit(s["age_median"])))
        d = join_lookup(d, self.tables["surnames"], ["Surname"], "_n", ["PassengerId"]).drop("_n")
        d = d.withColumns({
            "FamilySize": F.coalesce("FamilySize", F.lit(1)),
            **{c: F.coalesce(c, F.lit(-1.0)) for c in ("GroupAgeMedian", "GroupCryoFrac", "FamilyAgeGap")},
            "Age_qbin": bin_right_closed(F.col("Age"), s["age_edges"], default=-1),
            "Age_group_dom": bin_right_closed(F.col("Age"), AGE_BINS, default=-1),
            "LuxurySpend": F.col("Spa") + F.col("VRDeck"),
            "DeckLevel": literal_map(F.col("Deck"), DECK_LEVEL, 0),
            "CabinSection": bin_right_closed(F.col("CabinNum"), SECTION_BINS, default=4, include_lowest=False),
            "IsSolo": (F.col("GroupSize") == 1).cast("int"),
            "GroupSize_bin": bin_right_closed(F.col("GroupSize"), s["group_edges"], default=-1),
            "CabinNum_qbin": F.when(F.col("CabinNum") >= 0, bin_right_closed(F.col("CabinNum"), s["cabin_edges"], default=-1)).otherwise(F.lit(-1)),
            **{f"{c}_bin": zero_aware_bin(F.col(c), e) for c, e in s["spend_edges"].items()},
        })
        d = d.withColumns({
            "DeckDistMid": F.abs(F.col("DeckLevel") - 4),
            "PremiumCabin": ((F.col("DeckLevel") <= 3) & (F.col("CabinSection") == 1)).cast("int"),
            **{f"Cryo_x_{c}": F.col("CryoSleep") * F.col(c) for c in ("Age", "DeckLevel", "GroupSize")},
        })
        levels = {t.split(".", 1)[1]: f for t, f in self.tables.items() if t.startswith("level.")}
        d = RareLevelCollapserModel(s["rare"], levels).transform(d)
        return d.drop(*s["drop_cols"])

    def feature_names(self) -> list[str]:
        """All features of the matrix in output order: numeric ones, then encoded levels."""
        return list(self.state["names"])

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.matrix(self.raw_view(df))

    def matrix(self, raw: DataFrame) -> DataFrame:
        """The numeric matrix of a raw view; ``drop_cols`` may name encoded columns too."""
        scaled = PopulationScalerModel(self.state["scale"]).transform(raw)
        shares = scaled.withColumn("Surname", F.when(F.col("Surname") != "Other", F.col("FamilySize")).otherwise(F.lit(0)) / F.lit(self.state["n_rows"])) if "Surname" in scaled.columns else scaled
        return DomainOneHotModel(self.state["one_hot"]).transform(shares).drop(*self.state["drop_cols"])
