"""Feature preprocessing plans: fitted on one part of a table, applied to all of it."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from panelwright.features import steps as S
from panelwright.features.mixed import MixedPreprocessor
from panelwright.features.passenger import PassengerFeaturizer
from panelwright.features.voyage import GroupSpendFeaturizer, row_features
from panelwright.operators.splits import group_fold
from panelwright.plans.expressions import GAPPY, gappy_customers
from panelwright.plans.registry import plan, rounded
from panelwright.plans.reshape import NET_SQL, priced_lines, spearman_sql
from panelwright.plans.splits import CUST, hash_sql
from panelwright.sources.scratch import scratch_path
from panelwright.sources.tables import scan, spread

IMPUTED_SQL = f"""
SELECT c_custkey, round(coalesce(acctbal, (SELECT quantile_cont(acctbal, 0.5) FROM {GAPPY})), 4) + 0.0 AS acctbal,
  coalesce(segment, (SELECT segment FROM {GAPPY} WHERE segment IS NOT NULL GROUP BY segment ORDER BY count(*) DESC, segment LIMIT 1)) AS segment
FROM {GAPPY}"""


def _imputed(df):
    return df.select("c_custkey", rounded("acctbal").alias("acctbal"), "segment")


@plan("a8_saved_state", IMPUTED_SQL)
def saved_state(spark, sf):
    df = gappy_customers(spark, sf)
    path = scratch_path(spark, "model")
    Pipeline(stages=[S.SimpleImputer(["acctbal"], ["segment"]), S.FrequencyEncoder("segment", "n_segment")]).fit(df).write().save(path)
    return _imputed(PipelineModel.load(path).transform(df))


@plan("j1_simple_imputer", IMPUTED_SQL)
def simple_imputer(spark, sf):
    df = gappy_customers(spark, sf)
    return _imputed(S.SimpleImputer(["acctbal"], ["segment"]).fit(df).transform(df))


@plan("j1_constant_imputer", f"SELECT c_custkey, coalesce(segment, 'MISSING') AS segment, coalesce(name, 'MISSING') AS name FROM {GAPPY}")
def constant_imputer(spark, sf):
    df = gappy_customers(spark, sf)
    return S.SimpleImputer(text=["segment", "name"], text_fill="MISSING").fit(df).transform(df).select("c_custkey", "segment", "name")


@plan("j2_group_median_imputer", f"""
WITH t AS (SELECT * FROM {GAPPY} WHERE c_custkey % 3 = 0), g AS (SELECT c_nationkey, quantile_cont(acctbal, 0.5) AS m FROM t GROUP BY ALL)
SELECT c_custkey, round(coalesce(acctbal, m, (SELECT quantile_cont(acctbal, 0.5) FROM t)), 4) + 0.0 AS acctbal FROM {GAPPY} x LEFT JOIN g USING (c_nationkey)""")
def group_median_imputer(spark, sf):
    df = gappy_customers(spark, sf)
    model = S.GroupMedianImputer(["c_nationkey"], "acctbal").fit(df.where(F.col("c_custkey") % 3 == 0))
    return model.transform(df).select("c_custkey", rounded("acctbal").alias("acctbal"))


@plan("j3_left_closed_bins", """
SELECT p_partkey, CASE WHEN p_size >= 0 AND p_size < 40 THEN (p_size // 10 * 10) || '-' || (p_size // 10 * 10 + 10) ELSE 'Missing' END AS size_group FROM part""")
def left_closed(spark, sf):
    edges = [0, 10, 20, 30, 40]
    out = S.bin_left_closed(F.col("p_size"), edges, [f"{a}-{a + 10}" for a in edges[:-1]], "Missing")
    return scan(spark, sf, "part").select("p_partkey", out.alias("size_group"))


@plan("j4_right_closed_bins", """
SELECT l_quantity, CASE WHEN l_quantity < 2 THEN -1 WHEN l_quantity <= 12 THEN 0 WHEN l_quantity <= 18 THEN 1 WHEN l_quantity <= 30 THEN 2
  WHEN l_quantity <= 45 THEN 3 ELSE -1 END AS closed_bin, CASE WHEN l_quantity <= 1 THEN 'alone' WHEN l_quantity <= 2 THEN 'pair'
  WHEN l_quantity <= 10 THEN 'medium' ELSE 'large' END AS size_label, count(*) AS n FROM lineitem GROUP BY ALL""")
def right_closed(spark, sf):
    q = F.col("l_quantity")
    return scan(spark, sf, "lineitem").groupBy(
        "l_quantity", S.bin_right_closed(q, [2, 12, 18, 30, 45], default=-1).alias("closed_bin"),
        S.bin_right_closed(q, [0, 1, 2, 10, float("inf")], ["alone", "pair", "medium", "large"], "none").alias("size_label"),
    ).agg(F.count(F.lit(1)).alias("n"))


def _quantile_bin_sql(x, edges, n, shift=0):
    whens = " ".join(f"WHEN {x} <= {edges}[{i + 2}] THEN {i + shift}" for i in range(n))
    return f"CASE WHEN {x} < {edges}[1] THEN -1 {whens} ELSE -1 END"


@plan("j5_quantile_bins", f"""
WITH e AS (SELECT quantile_cont(p_retailprice, [0, 0.2, 0.4, 0.6, 0.8, 1]) AS e FROM part WHERE p_partkey % 3 = 0 AND p_retailprice >= 910)
SELECT p_partkey, CASE WHEN p_retailprice >= 910 THEN {_quantile_bin_sql('p_retailprice', 'e', 5)} ELSE -1 END AS price_bin FROM part, e""")
def quantile_bins(spark, sf):
    part = scan(spark, sf, "part")
    model = S.QuantileBinner("p_retailprice", 5, "price_bin", sentinel_below=910).fit(part.where(F.col("p_partkey") % 3 == 0))
    return model.transform(part).select("p_partkey", "price_bin")


@plan("j6_zero_aware_bins", f"""
WITH e AS (SELECT quantile_cont(l_discount, [0, 1 / 3.0, 2 / 3.0, 1]) AS e FROM lineitem WHERE l_discount > 0 AND l_orderkey % 2 = 0)
SELECT l_discount, CASE WHEN l_discount > 0 THEN {_quantile_bin_sql('l_discount', 'e', 3, 1)} ELSE 0 END AS discount_bin, count(*) AS n FROM lineitem, e GROUP BY ALL""")
def zero_aware(spark, sf):
    li = scan(spark, sf, "lineitem")
    model = S.QuantileBinner("l_discount", 3, "discount_bin", zero_aware=True).fit(li.where(F.col("l_orderkey") % 2 == 0))
    return model.transform(li).groupBy("l_discount", "discount_bin").agg(F.count(F.lit(1)).alias("n"))


@plan("j7_rare_levels_by_rows", """
WITH t AS (SELECT * FROM part WHERE p_partkey % 4 <> 0), k AS (SELECT p_brand FROM t GROUP BY p_brand HAVING count(*) >= floor(0.041 * (SELECT count(*) FROM t)))
SELECT p_partkey, CASE WHEN p_brand IN (FROM k) THEN p_brand ELSE 'Other' END AS brand FROM part""")
def rare_by_rows(spark, sf):
    part = scan(spark, sf, "part")
    model = S.RareLevelCollapser(["p_brand"], 0.041).fit(part.where(F.col("p_partkey") % 4 != 0))
    return model.transform(part).select("p_partkey", F.col("p_brand").alias("brand"))


@plan("j8_rare_levels_by_levels", """
WITH t AS (SELECT * FROM part WHERE p_partkey % 4 <> 0), c AS (SELECT p_name, count(*) AS n FROM t GROUP BY p_name),
k AS (SELECT p_name FROM c WHERE n >= 0.6 * (SELECT count(*) FROM c))
SELECT p_partkey, CASE WHEN p_name IN (FROM k) THEN p_name ELSE 'Other' END AS name FROM part""")
def rare_by_levels(spark, sf):
    part = scan(spark, sf, "part")
    model = S.RareLevelCollapser(["p_name"], 0.6, base="levels").fit(part.where(F.col("p_partkey") % 4 != 0))
    return model.transform(part).select("p_partkey", F.col("p_name").alias("name"))


@plan("j9_one_hot", """
SELECT o_orderkey, """ + ", ".join(f"CAST(o_orderpriority = '{p}' AS DOUBLE) AS \"o_orderpriority_{p}\"" for p in ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"))
      + """, CAST(o_orderstatus = 'O' AS DOUBLE) AS "o_orderstatus_O", CAST(o_orderstatus = 'P' AS DOUBLE) AS "o_orderstatus_P" FROM orders""")
def one_hot(spark, sf):
    orders = scan(spark, sf, "orders", ["o_orderkey", "o_orderpriority", "o_orderstatus"])
    train = orders.where(F.col("o_orderpriority") != "5-LOW")  # 5-LOW is unseen and stays all zeros
    return S.DomainOneHot(["o_orderpriority", "o_orderstatus"], drop_first=True).fit(train).transform(orders)


@plan("j9_sparse_one_hot", """
WITH l AS (SELECT c_name, row_number() OVER (ORDER BY md5(concat_ws(':', '0', c_name)), c_name) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT c_name FROM customer WHERE c_custkey % 7 <> 0))
SELECT c_custkey, coalesce(CAST(i AS DOUBLE), (SELECT CAST(max(n) AS DOUBLE) FROM l)) AS c_name_index, (SELECT CAST(max(n) AS INTEGER) FROM l) AS size, CAST(i IS NOT NULL AS INTEGER) AS ones
FROM customer LEFT JOIN l USING (c_name)""")
def sparse_one_hot(spark, sf):
    c = scan(spark, sf, "customer", ["c_custkey", "c_name"])
    model = S.SparseOneHot("c_name", "name_vector").fit(c.where(F.col("c_custkey") % 7 != 0))
    size = F.lit(model.state["size"])
    return model.transform(c).select("c_custkey", "c_name_index", size.cast("int").alias("size"), (F.col("c_name_index") < size).cast("int").alias("ones"))


@plan("j10_standard_scaler", """
WITH t AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer WHERE c_custkey % 5 <> 0)
SELECT c_custkey, round((c_acctbal - m) / s, 6) + 0.0 AS c_acctbal, round((c_acctbal - 0) / s, 6) + 0.0 AS not_centred FROM customer, t""")
def standard_scaler(spark, sf):
    c = scan(spark, sf, "customer", ["c_custkey", "c_acctbal"]).withColumn("not_centred", F.col("c_acctbal"))
    train = c.where(F.col("c_custkey") % 5 != 0)
    out = S.PopulationScaler(["c_acctbal"]).fit(train).transform(c)
    out = S.PopulationScaler(["not_centred"], with_mean=False).fit(train).transform(out)
    return out.select("c_custkey", rounded("c_acctbal", 6).alias("c_acctbal"), rounded("not_centred", 6).alias("not_centred"))


@plan("j11_range_scaler", """
WITH t AS (SELECT min(p_retailprice) AS a, max(p_retailprice) AS b FROM part WHERE p_partkey % 2 = 0)
SELECT p_partkey, round((p_retailprice - a) / (b - a), 6) + 0.0 AS p_retailprice FROM part, t""")
def range_scaler(spark, sf):
    part = scan(spark, sf, "part", ["p_partkey", "p_retailprice"])
    return S.RangeScaler(["p_retailprice"]).fit(part.where(F.col("p_partkey") % 2 == 0)).transform(part).withColumn(
        "p_retailprice", rounded("p_retailprice", 6))


@plan("j12_frequency_encoder", """
SELECT p_partkey, coalesce(n, 0) AS name_count FROM part LEFT JOIN (SELECT p_name, count(*) AS n FROM part WHERE p_partkey % 10 = 0 GROUP BY ALL) USING (p_name)""")
def frequency_encoder(spark, sf):
    part = scan(spark, sf, "part")
    model = S.FrequencyEncoder("p_name", "name_count").fit(part.where(F.col("p_partkey") % 10 == 0))
    return model.transform(part).select("p_partkey", "name_count")


@plan("j13_constant_filter", "SELECT l_orderkey, l_quantity, count(*) AS n FROM lineitem GROUP BY ALL")
def constant_filter(spark, sf):
    li = scan(spark, sf, "lineitem").select("l_orderkey", "l_quantity", (F.col("l_quantity") >= 0).cast("int").alias("always_one"),
                                            F.lit(None).cast("double").alias("always_null"))
    kept = S.ConstantFilter(["l_quantity", "always_one", "always_null"]).fit(li).transform(li)
    return kept.groupBy(*kept.columns).agg(F.count(F.lit(1)).alias("n"))


COLLINEAR = ["l_quantity", "l_extendedprice", "net_price", "l_discount"]


@plan("j14_collinearity_filter", spearman_sql(COLLINEAR, NET_SQL) + """,
h AS (SELECT a, b FROM m WHERE abs(rho) > 0.9), u AS (SELECT a AS c, b AS p FROM h UNION ALL SELECT b, a FROM h)
SELECT DISTINCT b AS "column", (SELECT string_agg(p, ',' ORDER BY p) FROM u WHERE u.c = h.b) AS partners FROM h""")
def collinearity(spark, sf):
    from panelwright.operators.reshape import collinear_columns, spearman_matrix
    m = spearman_matrix(priced_lines(spark, sf), COLLINEAR, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return collinear_columns(m, 0.9).select("column", F.array_join("partners", ",").alias("partners"))


@plan("j15_pca")
def pca(spark, sf):
    df = scan(spark, sf, "embeddings")
    return S.SignedPCA("embedding", 8).fit(df).transform(df).select("vec_id", "components")


# Passengers derived from orders and their customers.
TITLES = ["Mr", "Mrs", "Miss", "Dr"]
PASSENGER_SQL = """(SELECT o_orderkey AS PassengerId, CAST(o_totalprice > 250000 AS INTEGER) AS Survived, CAST(o_orderkey % 3 + 1 AS INTEGER) AS Pclass,
  'Sur' || c_nationkey || ', ' || ['Mr', 'Mrs', 'Miss', 'Dr'][o_custkey % 4 + 1] || '. ' || c_name AS Name,
  CASE WHEN o_orderstatus = 'F' THEN 'female' ELSE 'male' END AS Sex, CASE WHEN o_orderkey % 7 <> 0 THEN c_acctbal / 120 END AS Age,
  CAST(o_orderkey % 2 AS INTEGER) AS SibSp, CAST(o_custkey % 3 AS INTEGER) AS Parch,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'PC ' || c_mktsegment || ' ' END || o_orderkey AS Ticket,
  CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS Fare,
  CASE WHEN o_orderkey % 4 = 0 THEN substr(c_mktsegment, 1, 1) || (o_custkey % 200) || CASE WHEN o_orderkey % 8 = 0 THEN ' C1' ELSE '' END END AS Cabin,
  CASE WHEN o_orderkey % 17 <> 0 THEN substr(o_orderpriority, 3, 1) END AS Embarked FROM orders JOIN customer ON o_custkey = c_custkey)"""


def passengers(spark, sf):
    o, c = scan(spark, sf, "orders"), scan(spark, sf, "customer")
    k, u = F.col("o_orderkey"), F.col("o_custkey")
    title = F.element_at(F.array(*[F.lit(t) for t in TITLES]), (u % 4 + 1).cast("int"))
    return o.join(c, o.o_custkey == c.c_custkey).select(
        k.alias("PassengerId"), (F.col("o_totalprice") > 250000).cast("int").alias("Survived"),
        (k % 3 + 1).cast("int").alias("Pclass"),
        F.concat(F.lit("Sur"), F.col("c_nationkey").cast("string"), F.lit(", "), title, F.lit(". "), "c_name").alias("Name"),
        F.when(F.col("o_orderstatus") == "F", "female").otherwise("male").alias("Sex"),
        F.when(k % 7 != 0, F.col("c_acctbal") / 120).alias("Age"),
        (k % 2).cast("int").alias("SibSp"), (u % 3).cast("int").alias("Parch"),
        F.concat(F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("PC "), "c_mktsegment", F.lit(" "))), k.cast("string")).alias("Ticket"),
        F.when(k % 13 != 0, F.col("o_totalprice")).alias("Fare"),
        F.when(k % 4 == 0, F.concat(F.substring("c_mktsegment", 1, 1), (u % 200).cast("string"), F.when(k % 8 == 0, " C1").otherwise(""))).alias("Cabin"),
        F.when(k % 17 != 0, F.substring("o_orderpriority", 3, 1)).alias("Embarked"))


PARSED_SQL = f"""p AS (SELECT *, nullif(regexp_extract(Name, ',\\s*([^\\.]+)\\.', 1), '') AS Title, split_part(Name, ',', 1) AS Surname,
  SibSp + Parch + 1 AS FamilySize, len(list_filter(string_split(coalesce(Cabin, ''), ' '), lambda w: w <> '')) AS CabinCount,
  coalesce(substr(Cabin, 1, 1), 'Missing') AS Deck, CAST(Cabin IS NOT NULL AS INTEGER) AS HasCabin,
  coalesce(TRY_CAST(nullif(regexp_extract(Cabin, '(\\d+)', 1), '') AS BIGINT), 0) AS CabinNumber,
  coalesce(TRY_CAST(nullif(regexp_extract(Ticket, '(\\d+)$', 1), '') AS BIGINT), 0) AS TicketNumber,
  CASE WHEN len(string_split(Ticket, ' ')) > 1 THEN array_to_string(string_split(Ticket, ' ')[1:len(string_split(Ticket, ' ')) - 1], '_') ELSE 'NONE' END AS TicketItem
  FROM {PASSENGER_SQL}),
tr AS (SELECT * FROM p WHERE PassengerId % 5 <> 0),
md AS (SELECT (SELECT Embarked FROM tr WHERE Embarked IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS em, (SELECT quantile_cont(Fare, 0.5) FROM tr) AS fm,
  (SELECT quantile_cont(Age, 0.5) FROM tr) AS am),
ag AS (SELECT Pclass, Sex, Title, quantile_cont(Age, 0.5) AS gm FROM tr GROUP BY ALL),
sc AS (SELECT avg(ln(1 + coalesce(Fare, fm))) AS m, stddev_pop(ln(1 + coalesce(Fare, fm))) AS s FROM tr, md),
sn AS (SELECT Surname, count(*) AS SurnameCount FROM tr GROUP BY ALL),
x AS (SELECT p.* EXCLUDE (Embarked, Age, Fare), coalesce(Embarked, em) AS Embarked, coalesce(Age, gm, am) AS Age, (ln(1 + coalesce(Fare, fm)) - m) / s AS FareScaled,
  coalesce(SurnameCount, 0) AS SurnameCount FROM p LEFT JOIN ag USING (Pclass, Sex, Title) LEFT JOIN sn USING (Surname), md, sc),
y AS (SELECT *, CASE WHEN Age >= 0 AND Age < 80 THEN CAST(floor(Age / 10) * 10 AS INTEGER) || '-' || CAST(floor(Age / 10) * 10 + 10 AS INTEGER) ELSE 'Missing' END AS AgeGroup FROM x),
th AS (SELECT floor(0.05 * count(*)) AS t FROM tr)"""
PASSENGER_LEVELS = ["Sex", "Embarked", "Title", "Deck", "TicketItem", "AgeGroup"]
COLLAPSED = ", ".join(f"CASE WHEN {c} IN (SELECT {c} FROM y WHERE PassengerId % 5 <> 0 GROUP BY {c} HAVING count(*) >= (SELECT t FROM th)) THEN {c} ELSE 'Other' END AS {c}"
                      for c in PASSENGER_LEVELS)


def passenger_model(spark, sf):
    df = passengers(spark, sf)
    return PassengerFeaturizer(0.05).fit(df.where(F.col("PassengerId") % 5 != 0)), df


@plan("j16_passenger_raw_view", f"""WITH {PARSED_SQL} SELECT PassengerId, Survived, Pclass, SibSp, Parch, CAST(FamilySize AS INTEGER) AS FamilySize, CAST(CabinCount AS INTEGER) AS CabinCount,
  HasCabin, CabinNumber, TicketNumber, round(FareScaled, 6) + 0.0 AS FareScaled, SurnameCount, {COLLAPSED} FROM y""")
def passenger_raw(spark, sf):
    model, df = passenger_model(spark, sf)
    return model.raw_view(df).withColumn("FareScaled", rounded("FareScaled", 6))


@plan("j16_passenger_numeric_view")
def passenger_numeric(spark, sf):
    model, df = passenger_model(spark, sf)
    return model.transform(df)


# Voyagers derived from line items: group = order, spend = discount, tax and price parts.
VOYAGE_SQL = """(SELECT l_orderkey || '_' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS PassengerId,
  CASE WHEN l_partkey % 11 <> 0 THEN l_returnflag END AS HomePlanet, CASE WHEN l_suppkey % 9 <> 0 THEN 'D' || l_suppkey % 3 END AS Destination,
  CASE WHEN l_partkey % 10 <> 0 THEN l_linestatus = 'F' END AS CryoSleep, CASE WHEN l_partkey % 13 <> 0 THEN l_suppkey % 20 = 0 END AS VIP,
  CASE WHEN l_partkey % 8 <> 0 THEN substr('ABCDEFGT', CAST(l_suppkey % 8 + 1 AS INTEGER), 1) || '/' || l_partkey % 1900 || '/' || CASE WHEN l_linestatus = 'F' THEN 'P' ELSE 'S' END END AS Cabin,
  CASE WHEN l_partkey % 6 <> 0 THEN l_quantity * 1.5 END AS Age, CASE WHEN l_suppkey % 7 <> 0 THEN l_discount * 100 END AS RoomService, l_tax * 100 AS FoodCourt,
  CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END AS ShoppingMall, CASE WHEN l_returnflag = 'N' THEN l_quantity * 2 ELSE 0 END AS Spa, 0.0::DOUBLE AS VRDeck,
  CASE WHEN l_partkey % 15 <> 0 THEN 'Ann Sur' || l_suppkey % 50 END AS Name FROM lineitem)"""


def voyagers(spark, sf):
    p, s, q, flag = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity"), F.col("l_returnflag")
    side = F.when(F.col("l_linestatus") == "F", "P").otherwise("S")
    cabin = F.concat_ws("/", F.substring(F.lit("ABCDEFGT"), (s % 8 + 1).cast("int"), F.lit(1)), (p % 1900).cast("string"), side)
    return spread(scan(spark, sf, "lineitem")).select(
        F.concat_ws("_", F.col("l_orderkey").cast("string"), F.lpad(F.col("l_linenumber").cast("string"), 2, "0")).alias("PassengerId"),
        F.when(p % 11 != 0, flag).alias("HomePlanet"), F.when(s % 9 != 0, F.concat(F.lit("D"), (s % 3).cast("string"))).alias("Destination"),
        F.when(p % 10 != 0, F.col("l_linestatus") == "F").alias("CryoSleep"), F.when(p % 13 != 0, s % 20 == 0).alias("VIP"),
        F.when(p % 8 != 0, cabin).alias("Cabin"), F.when(p % 6 != 0, q * 1.5).alias("Age"),
        F.when(s % 7 != 0, F.col("l_discount") * 100).alias("RoomService"), (F.col("l_tax") * 100).alias("FoodCourt"),
        F.when(flag == "A", q).otherwise(0.0).alias("ShoppingMall"), F.when(flag == "N", q * 2).otherwise(0.0).alias("Spa"),
        F.lit(0.0).alias("VRDeck"), F.when(p % 15 != 0, F.concat(F.lit("Ann Sur"), (s % 50).cast("string"))).alias("Name"))


ROWS_SQL = f"""b AS (SELECT * EXCLUDE (CryoSleep, VIP, HomePlanet, Destination, RoomService), coalesce(CAST(CryoSleep AS INTEGER), 0) AS CryoSleep, CAST(CryoSleep IS NULL AS INTEGER) AS CryoSleep_NA,
  coalesce(CAST(VIP AS INTEGER), 0) AS VIP, CAST(split_part(PassengerId, '_', 1) AS BIGINT) AS GroupNum, coalesce(HomePlanet, 'Missing') AS HomePlanet, coalesce(Destination, 'Missing') AS Destination,
  coalesce(RoomService, 0) AS RoomService, coalesce(split_part(Cabin, '/', 1), 'Missing') AS Deck, coalesce(split_part(Cabin, '/', 3), 'Missing') AS Side,
  CAST(coalesce(CAST(split_part(Cabin, '/', 2) AS DOUBLE), -1) AS DOUBLE) AS CabinNum, CAST(Cabin IS NULL AS INTEGER) AS CabinNum_NA, coalesce(split_part(Name, ' ', -1), 'Missing') AS Surname FROM {VOYAGE_SQL}),
r AS (SELECT *, count(*) OVER (PARTITION BY GroupNum) AS GroupSize, RoomService + FoodCourt + ShoppingMall + Spa + VRDeck AS TotalSpend FROM b)"""


@plan("j17_row_features", f"""WITH {ROWS_SQL} SELECT PassengerId, GroupNum, GroupSize, Deck, Side, CabinNum, CabinNum_NA, CryoSleep, CryoSleep_NA, VIP, Surname,
  Deck || '_' || Side AS DeckSide, HomePlanet || '_' || Destination AS HomeDest, round(TotalSpend, 4) + 0.0 AS TotalSpend, round(TotalSpend / GroupSize, 4) + 0.0 AS SpendPerPerson,
  round(CASE WHEN TotalSpend > 0 THEN Spa / TotalSpend ELSE 0 END, 6) + 0.0 AS SpaRatio FROM r""")
def voyage_rows(spark, sf):
    return row_features(voyagers(spark, sf)).select(
        "PassengerId", "GroupNum", "GroupSize", "Deck", "Side", "CabinNum", "CabinNum_NA", "CryoSleep", "CryoSleep_NA", "VIP", "Surname",
        "DeckSide", "HomeDest", rounded("TotalSpend").alias("TotalSpend"), rounded("SpendPerPerson").alias("SpendPerPerson"), rounded("SpaRatio", 6).alias("SpaRatio"))


@plan("j18_group_spend_features", f"""WITH {ROWS_SQL}, am AS (SELECT quantile_cont(Age, 0.5) AS am FROM r),
q AS (SELECT r.*, coalesce(Age, am) AS A FROM r, am),
e AS (SELECT quantile_cont(A, [0, 1 / 6.0, 2 / 6.0, 0.5, 4 / 6.0, 5 / 6.0, 1]) AS ae, quantile_cont(CabinNum, [0, .2, .4, .6, .8, 1]) FILTER (WHERE CabinNum >= 0) AS ce,
  quantile_cont(FoodCourt, [0, 1 / 3.0, 2 / 3.0, 1]) FILTER (WHERE FoodCourt > 0) AS fe FROM q),
g AS (SELECT GroupNum, avg(CryoSleep) AS cf, max(Age) - min(Age) AS gap, quantile_cont(Age, 0.5) AS gm FROM r GROUP BY GroupNum),
sn AS (SELECT Surname, count(*) AS FamilySize FROM r GROUP BY ALL)
SELECT PassengerId, {_quantile_bin_sql('A', 'ae', 6)} AS Age_qbin, CASE WHEN A <= 12 THEN 0 WHEN A <= 18 THEN 1 WHEN A <= 25 THEN 2 WHEN A <= 30 THEN 3 WHEN A <= 50 THEN 4 WHEN A <= 100 THEN 5 ELSE -1 END AS Age_group_dom,
  FamilySize, CASE WHEN CabinNum >= 0 THEN {_quantile_bin_sql('CabinNum', 'ce', 5)} ELSE -1 END AS CabinNum_qbin,
  CASE WHEN CabinNum <= -1 THEN 4 WHEN CabinNum <= 300 THEN 0 WHEN CabinNum <= 600 THEN 1 WHEN CabinNum <= 900 THEN 2 WHEN CabinNum <= 2000 THEN 3 ELSE 4 END AS CabinSection,
  CASE WHEN FoodCourt > 0 THEN {_quantile_bin_sql('FoodCourt', 'fe', 3, 1)} ELSE 0 END AS FoodCourt_bin,
  CASE WHEN GroupSize <= 1 THEN 0 WHEN GroupSize <= 2 THEN 1 WHEN GroupSize <= 4 THEN 2 WHEN GroupSize <= 10 THEN 3 ELSE 4 END AS GroupSize_bin,
  round(coalesce(gm, -1), 4) + 0.0 AS GroupAgeMedian, round(cf, 6) + 0.0 AS GroupCryoFrac, round(coalesce(gap, -1), 4) + 0.0 AS FamilyAgeGap,
  round(CryoSleep * A, 4) + 0.0 AS Cryo_x_Age, CAST(GroupSize = 1 AS INTEGER) AS IsSolo, coalesce(instr('ABCDEFGT', Deck), 0) AS DeckLevel
FROM q JOIN g USING (GroupNum) JOIN sn USING (Surname), e""")
def voyage_features(spark, sf):
    df = voyagers(spark, sf)
    model, rows = GroupSpendFeaturizer(drop_cols=("GroupNum",)).fit_rows(df)
    out = model.raw_from_grouped(rows)
    return out.select(
        "PassengerId", "Age_qbin", "Age_group_dom", "FamilySize", "CabinNum_qbin", "CabinSection", "FoodCourt_bin", "GroupSize_bin", "IsSolo",
        F.col("DeckLevel").cast("bigint").alias("DeckLevel"), rounded("GroupAgeMedian").alias("GroupAgeMedian"),
        rounded("GroupCryoFrac", 6).alias("GroupCryoFrac"), rounded("FamilyAgeGap").alias("FamilyAgeGap"), rounded("Cryo_x_Age").alias("Cryo_x_Age"))


@plan("j18_group_spend_matrix")
def voyage_matrix(spark, sf):
    df = voyagers(spark, sf)
    model, rows = GroupSpendFeaturizer(min_freq=0.02, use_fixed_group_bins=False).fit_rows(df)
    return model.matrix(model.raw_from_grouped(rows))


def parts(spark, sf):
    return scan(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 9 != 0, F.col("p_size")).alias("p_size"), (F.col("p_partkey") % 50).alias("p_lot"),
        F.when(F.col("p_partkey") % 8 != 0, F.col("p_type")).alias("p_type"), "p_retailprice")


PART_KEY = "CAST(p_partkey AS VARCHAR)"


@plan("j19_mixed_preprocessor", f"""
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN p_size END AS p_size, CAST(p_partkey % 50 AS DOUBLE) AS p_lot, coalesce(CASE WHEN p_partkey % 8 <> 0 THEN p_type END, 'MISSING') AS p_type,
  p_retailprice, {hash_sql(PART_KEY, 42)} / 4294967296.0 < 0.2 AS is_valid FROM part),
f AS (SELECT quantile_cont(p_size, 0.5) AS m FROM p WHERE NOT is_valid), s AS (SELECT avg(coalesce(p_size, m)) AS a, stddev_pop(coalesce(p_size, m)) AS d FROM p, f WHERE NOT is_valid)
SELECT p_partkey, is_valid, round((coalesce(p_size, m) - a) / d, 6) + 0.0 AS p_size, CAST(p_type = 'MISSING' AS DOUBLE) AS "p_type_MISSING", CAST(p_type = 'ECONOMY' AS DOUBLE) AS "p_type_ECONOMY",
  round(ln(1 + p_retailprice), 6) + 0.0 AS label FROM p, f, s""")
def mixed(spark, sf):
    prep = MixedPreprocessor("p_retailprice", ["p_partkey"], scale_numeric=True)
    train, valid = prep.fit_split(parts(spark, sf))
    both = train.withColumn("is_valid", F.lit(False)).unionByName(valid.withColumn("is_valid", F.lit(True)))
    return both.select("p_partkey", "is_valid", rounded("p_size", 6).alias("p_size"), "p_type_MISSING", "p_type_ECONOMY",
                       rounded("label", 6).alias("label"))


@plan("j20_feature_names", """
SELECT 'p_size' AS feature, count(*) AS n_rows FROM part UNION ALL SELECT 'p_lot', count(*) FROM part
UNION ALL SELECT 'p_type_' || t, (SELECT count(*) FROM part) FROM (SELECT DISTINCT coalesce(CASE WHEN p_partkey % 8 <> 0 THEN p_type END, 'MISSING') AS t FROM part)""")
def feature_names(spark, sf):
    df = parts(spark, sf)
    names = MixedPreprocessor("p_retailprice", ["p_partkey"]).fit(df).feature_names()
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("feature"), "n_rows")


@plan("j21_leak_free_folds", f"""
WITH f AS (SELECT c_custkey, c_acctbal, CAST({hash_sql(CUST, 1)} % 3 AS INTEGER) AS fold FROM customer)
SELECT a.c_custkey, a.fold, round((a.c_acctbal - m) / s, 6) + 0.0 AS scaled FROM f a JOIN (SELECT k AS fold, avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s
  FROM f, (SELECT unnest([0, 1, 2]) AS k) g WHERE f.fold <> k GROUP BY k) t ON a.fold = t.fold""")
def leak_free(spark, sf):
    df = scan(spark, sf, "customer").select("c_custkey", "c_acctbal", group_fold(["c_custkey"], 3, 1).alias("fold"))
    out = None
    for k in range(3):
        part = S.PopulationScaler(["c_acctbal"]).fit(df.where(F.col("fold") != k)).transform(df.where(F.col("fold") == k))
        out = part if out is None else out.unionByName(part)
    return out.select("c_custkey", "fold", rounded("c_acctbal", 6).alias("scaled"))


@plan("j22_feature_scale_model_chain")
def model_chain(spark, sf):
    df = gappy_customers(spark, sf).withColumn("label", (F.col("c_nationkey") < 12).cast("double"))
    chain = Pipeline(stages=[
        S.SimpleImputer(["acctbal"], ["segment"]), S.DomainOneHot(["segment"], drop_first=True), S.PopulationScaler(["acctbal"]),
        VectorAssembler(inputCols=["acctbal", "segment_BUILDING", "segment_FURNITURE"], outputCol="features"), LogisticRegression(maxIter=20)])
    return chain.fit(df).transform(df).select("c_custkey", S.positive_probability().alias("score"), "prediction")
