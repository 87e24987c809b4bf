"""The source pipeline's feature preparation for its own table schema
(one row per passenger), composed from the library operators in the source's
order (the order changes results: sizes and bucket codes are taken before
imputation, zones and cabin label features after it).

    feats = prepare_features(train_df, test_df)

``train_df`` / ``test_df`` follow ``SOURCE_SCHEMA`` (test without the label);
read them with ``sextant.sources.read_csv(spark, path, SOURCE_SCHEMA)``. The
result has one row per passenger: id, is_train, label (NULL on test) and the
configured features as doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (AGE_BAND_EDGES, AGE_BAND_LABELS, argmax_name, bool_text, category_cross,
                                 equal_width_code, flag, infer_flag_from_amounts, parity,
                                 parse_delimited_field, positive_count, rank_in_edges,
                                 right_closed_band, row_entropy, row_sum, safe_divide,
                                 split_composite_key, surname_extract)
from ..operators import encode, groups, impute
from ..operators.folds import fold_of
from ..operators.stats import (attach_global, distinct_count_table, group_size_table, lookup, mode_table,
                               percentile_table)
from ..session import cut_lineage

# Fixed values (must equal the source configuration): label, amount columns,
# target-encoded columns and categorical columns.
LABEL = "Transported"
SPEND_COLS = ["RoomService", "FoodCourt", "ShoppingMall", "Spa", "VRDeck"]
TE_COLS = ["HomePlanet", "CabinDeck", "HomeDest", "DeckSide", "AgeBand", "CryoSleep", "CabinZone"]
CATEGORICAL = ["HomePlanet", "CryoSleep", "Destination", "VIP", "CabinDeck", "CabinSide", "HomeDest",
               "DeckSide", "CabinZone", "AgeBand", "Surname", "MaxSpendCategory"]

SOURCE_SCHEMA = T.StructType(
    [T.StructField("PassengerId", T.StringType(), False),
     T.StructField("HomePlanet", T.StringType(), True),
     T.StructField("CryoSleep", T.BooleanType(), True),
     T.StructField("Cabin", T.StringType(), True),
     T.StructField("Destination", T.StringType(), True),
     T.StructField("Age", T.DoubleType(), True),
     T.StructField("VIP", T.BooleanType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in SPEND_COLS]
    + [T.StructField("Name", T.StringType(), True), T.StructField(LABEL, T.BooleanType(), True)])

LOG_COLS = SPEND_COLS + ["TotalSpend", "AvgSpendPerService", "SpendPerGroupMember"]
NUMERIC_FEATURES = (
    ["GroupSize", "Solo", "FamilySize", "Age", "CabinNum", "CryoFlag", "VipFlag", "IsChild", "IsTeen",
     "IsSenior", "SpendPositiveCount", "NoSpend"] + SPEND_COLS
    + ["TotalSpend", "AvgSpendPerService", "SpendPerGroupMember"] + [f"Log_{c}" for c in LOG_COLS]
    + ["AgeSpendInteraction", "CabinNumParity", "CabinNumBucket", "SurnameGroupSize", "SpendEntropy",
       "CryoNoSpend", "NotCryoHasSpend", "CabinAgreementScore", "CabinMean"])


def _fill_group_modes(df: DataFrame, key: str, cols) -> DataFrame:
    """Group-mode fill of several columns; each column's mode depends only on
    that column, so all tables come from the same frame."""
    for c in cols:
        df = lookup(df, mode_table(df, key, c, f"_m_{c}"), key)
    for c in cols:
        df = df.withColumn(c, F.coalesce(F.col(c), F.col(f"_m_{c}"))).drop(f"_m_{c}")
    return df


def prepare_features(train: DataFrame, test: DataFrame, n_folds: int = 5, seed: int = 42,
                     smoothing: float = 10.0, svd_k: int = 5, checkpoint: bool = True) -> DataFrame:
    cut = cut_lineage if checkpoint else (lambda d: d)
    tr = train.withColumn("is_train", F.lit(True)).withColumn("label", F.col(LABEL).cast("int")).drop(LABEL)
    te = test.drop(LABEL) if LABEL in test.columns else test
    te = te.withColumn("is_train", F.lit(False))
    full = tr.unionByName(te, allowMissingColumns=True)

    # keys, sizes and codes taken before imputation
    g, m = split_composite_key("PassengerId", "_")
    full = full.withColumn("GroupId", g).withColumn("GroupMember", m)
    full = lookup(full, group_size_table(full, "GroupId", "GroupSize"), "GroupId")
    full = full.withColumn("Solo", flag(F.col("GroupSize") == 1))
    deck, num, side = parse_delimited_field("Cabin", "/", "U/9999/U")
    full = full.withColumn("CabinDeck", deck).withColumn("CabinNum", num).withColumn("CabinSide", side)
    full = full.withColumn("CabinNumParity", parity("CabinNum"))
    rng = full.agg(F.min("CabinNum").alias("_lo"), F.max("CabinNum").alias("_hi"))
    full = attach_global(full, rng).withColumn(
        "CabinNumBucket", equal_width_code("CabinNum", F.col("_lo"), F.col("_hi"), 10)).drop("_lo", "_hi")
    full = full.withColumn("Surname", surname_extract("Name"))
    full = lookup(full, group_size_table(full, "Surname", "FamilySize"), "Surname")
    full = lookup(full, distinct_count_table(full, "Surname", "GroupId", "SurnameGroupSize"), "Surname")

    # imputation, in order
    full = full.withColumn("CryoSleep", infer_flag_from_amounts("CryoSleep", SPEND_COLS))
    full = cut(_fill_group_modes(full, "GroupId", ["HomePlanet", "Destination", "CabinDeck", "CabinSide",
                                                   "Surname"]))
    full = cut(impute.impute_category_cascade(
        full, [("CabinDeck", "HomePlanet"), ("HomePlanet", "Destination"), ("HomePlanet", "CabinDeck")],
        {"HomePlanet": "mode", "Destination": "mode", "CabinDeck": "U", "CabinSide": "mode"}))
    full = cut(impute.impute_median_cascade(full, "CabinNum", ["GroupId"]))
    full = impute.impute_median_cascade(full, "Age", ["GroupId", "HomePlanet"])
    full = impute.impute_bool_default(full, "VIP")
    full = cut(impute.impute_amounts(full, SPEND_COLS, "CryoSleep", "HomePlanet"))

    # row features
    full = (full.withColumn("TotalSpend", row_sum(SPEND_COLS))
                .withColumn("SpendPositiveCount", positive_count(SPEND_COLS)))
    full = (full.withColumn("NoSpend", flag(F.col("TotalSpend") == 0))
                .withColumn("AvgSpendPerService", safe_divide("TotalSpend", "SpendPositiveCount"))
                .withColumn("SpendPerGroupMember", safe_divide("TotalSpend", "GroupSize"))
                .withColumn("SpendEntropy", row_entropy(SPEND_COLS, F.col("TotalSpend")))
                .withColumn("MaxSpendCategory", argmax_name(SPEND_COLS)))
    for c in LOG_COLS:
        full = full.withColumn(f"Log_{c}", F.log1p(c))
    age = F.col("Age")
    full = (full.withColumn("CryoFlag", flag(F.col("CryoSleep")))
                .withColumn("VipFlag", flag(F.col("VIP")))
                .withColumn("IsChild", flag(age < 13))
                .withColumn("IsTeen", flag((age >= 13) & (age < 18)))
                .withColumn("IsSenior", flag(age >= 60))
                .withColumn("AgeSpendInteraction", age * F.col("Log_TotalSpend")))
    full = (full.withColumn("CryoNoSpend", flag((F.col("CryoFlag") == 1) & (F.col("NoSpend") == 1)))
                .withColumn("NotCryoHasSpend", flag((F.col("CryoFlag") == 0) & (F.col("TotalSpend") > 0))))
    full = full.withColumn("AgeBand", right_closed_band("Age", AGE_BAND_EDGES, AGE_BAND_LABELS))
    q6 = [k / 6 for k in range(7)]
    edges = percentile_table(full, [], "CabinNum", q6).select(
        F.array_distinct(F.array(*[F.col(f"CabinNum_q{j}") for j in range(7)])).alias("_e"))
    full = attach_global(full, edges).withColumn(
        "CabinZone", F.concat(F.lit("zone_"), rank_in_edges("CabinNum", F.col("_e")).cast("string"))).drop("_e")
    full = cut(full)
    full = (full.withColumn("HomeDest", category_cross("HomePlanet", "Destination"))
                .withColumn("DeckSide", category_cross("CabinDeck", "CabinSide"))
                .withColumn("CryoSleep", bool_text("CryoSleep"))
                .withColumn("VIP", bool_text("VIP")))

    # surname text dimensions (fitted on train and test together)
    svd = encode.text_svd(full.select("PassengerId", "Surname"), "PassengerId", "Surname", svd_k, 1000)
    for j in range(svd_k):
        svd = svd.withColumnRenamed(f"svd_{j}", f"Surname_tfidf_{j}")
    full = cut(lookup(full, svd, "PassengerId"))

    # cabin label features: leave-one-out on train rows, plain mean on test rows
    trf, tef = full.where("is_train"), full.where("NOT is_train")
    trf = groups.loo_target_mean(trf, "CabinNum", "label", "_cab")
    tef = groups.test_group_mean(full.where("is_train"), tef, "CabinNum", "label", "_cab")
    ren = {"_cab_mean": "CabinMean", "_cab_agreement": "CabinAgreementScore"}
    trf = trf.withColumnsRenamed(ren)
    tef = tef.withColumnsRenamed(ren)

    # out-of-fold target encoding on train, full-train encoding on test
    trf = trf.withColumn("fold", fold_of("PassengerId", seed, n_folds))
    tr_enc = encode.target_encode_oof(trf, TE_COLS, "label", "fold", smoothing, prefix="TE_")
    te_enc = encode.target_encode_full(trf, tef, TE_COLS, "label", smoothing, prefix="TE_")
    full = tr_enc.drop("fold").unionByName(te_enc, allowMissingColumns=True)

    # ordinal codes over train and test together, then every feature as double
    full = encode.ordinal_encode(full, CATEGORICAL)
    feats = ([F.col(f"{c}_code").cast("double").alias(c) for c in CATEGORICAL]
             + [F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES]
             + [F.col(f"Surname_tfidf_{j}").cast("double").alias(f"Surname_tfidf_{j}") for j in range(svd_k)]
             + [F.col(f"TE_{c}").cast("double").alias(f"TE_{c}") for c in TE_COLS])
    return full.select(F.col("PassengerId").alias("id"), "is_train", "label", "GroupId", *feats)
