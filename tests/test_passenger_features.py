"""The composed feature preparation on a hand-made table in the source schema."""
import pytest
from pyspark.sql import functions as F

from sextant.plans.passenger_features import (CATEGORICAL, NUMERIC_FEATURES, SOURCE_SCHEMA, TE_COLS,
                                              prepare_features)

TRAIN = [
    ("0001_01", "Earth", False, "B/0/P", "TRAPPIST", 39.0, False, 0.0, 0.0, 0.0, 0.0, 0.0, "Ada Stone", False),
    ("0002_01", "Earth", False, "F/0/S", "TRAPPIST", 24.0, False, 109.0, 9.0, 25.0, 549.0, 44.0, "Bo Vale", True),
    ("0003_01", "Europa", False, "A/0/S", "TRAPPIST", 58.0, True, 43.0, 3576.0, 0.0, 6715.0, 49.0, "Cy Rook", False),
    ("0003_02", "Europa", False, "A/0/S", "TRAPPIST", 33.0, False, 0.0, 1283.0, 371.0, 3329.0, 193.0, "Di Rook", False),
    ("0004_01", None, None, "F/1/S", "TRAPPIST", 16.0, False, 303.0, 70.0, 151.0, 565.0, 2.0, "Ed Park", True),
    ("0005_01", "Earth", None, None, "PSO", None, None, 0.0, 0.0, 0.0, 0.0, 0.0, None, True),
    ("0006_01", "Earth", False, "F/2/S", "TRAPPIST", 28.0, False, 0.0, 483.0, 0.0, 291.0, 0.0, "Fe Mill", True),
    ("0006_02", None, True, "G/0/S", None, 4.0, False, 0.0, 0.0, 0.0, 0.0, 0.0, "Gi Mill", True),
    ("0007_01", "Mars", True, "F/3/P", "TRAPPIST", 45.0, None, 0.0, 0.0, None, 0.0, 0.0, "Ha Ford", True),
    ("0008_01", "Europa", True, "B/1/P", "CANCRI", 14.0, False, 0.0, 0.0, 0.0, 0.0, 0.0, "Io Salt", True),
    ("0008_02", "Europa", False, "B/1/P", "CANCRI", 34.0, False, 0.0, 0.0, 0.0, 0.0, None, "Ja Salt", True),
    ("0009_01", "Mars", False, "F/x/P", "TRAPPIST", 61.0, False, 1.0, 2.0, 3.0, 4.0, 5.0, "Ka Dunn", False),
]
TEST = [
    ("0013_01", "Earth", True, "G/3/S", "TRAPPIST", 27.0, False, 0.0, 0.0, 0.0, 0.0, 0.0, "La Stone"),
    ("0018_01", "Earth", False, "F/4/S", "TRAPPIST", 19.0, False, 0.0, 9.0, 0.0, 2823.0, 0.0, "Mo Vale"),
    ("0019_01", "Europa", None, "C/0/S", "CANCRI", 31.0, False, 0.0, 0.0, 0.0, 0.0, 0.0, "Ni Rook"),
    ("0021_01", None, False, "F/5/P", "CANCRI", 38.0, None, 0.0, 6652.0, 0.0, 181.0, 585.0, None),
]


def test_prepare_features(spark):
    train = spark.createDataFrame(TRAIN, SOURCE_SCHEMA)
    test_schema = SOURCE_SCHEMA[:-1]
    test = spark.createDataFrame(TEST, test_schema)
    feats = prepare_features(train, test, n_folds=3, svd_k=2)
    rows = {r["id"]: r for r in feats.collect()}
    assert len(rows) == len(TRAIN) + len(TEST)
    names = CATEGORICAL + NUMERIC_FEATURES + [f"TE_{c}" for c in TE_COLS] + ["Surname_tfidf_0", "Surname_tfidf_1"]
    for r in rows.values():
        for n in names:
            assert r[n] is not None, n
    # CryoSleep unknown, no spending -> True; unknown with spending -> False
    assert rows["0005_01"]["CryoFlag"] == 1.0 and rows["0004_01"]["CryoFlag"] == 0.0
    assert rows["0019_01"]["CryoFlag"] == 1.0
    # group sizes before imputation; surname family size
    assert rows["0003_01"]["GroupSize"] == 2.0 and rows["0001_01"]["Solo"] == 1.0
    assert rows["0003_01"]["FamilySize"] == 3.0        # Rook: two train rows and one test row
    # missing cabin -> sentinel number 9999, bucket 9; bad number -> group / global median
    assert rows["0005_01"]["CabinNum"] == 9999.0 and rows["0005_01"]["CabinNumBucket"] == 9.0
    # amounts are zero under CryoSleep and filled by the planet median otherwise
    assert rows["0007_01"]["ShoppingMall"] == 0.0
    # label features stay inside [0, 1]
    for r in rows.values():
        assert 0.0 <= r["CabinMean"] <= 1.0 and 0.5 <= r["CabinAgreementScore"] <= 1.0
        for c in TE_COLS:
            assert 0.0 <= r[f"TE_{c}"] <= 1.0
    assert all(r["label"] is None for k, r in rows.items() if not r["is_train"])
