import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens import params as P
from fleetlens.functions import (
    bucket_of, feature_category, finite_or_null, maintenance_priority, round_even, sensor_families, sensor_role,
)
from fleetlens.functions.naming import parse_sensor, sensor_columns


@pytest.mark.parametrize("bins, mono, role", [
    (1, 0.99, P.ROLE_COUNTER), (36, 0.5, P.ROLE_FINE), (16, 0.5, P.ROLE_FINE), (10, 0.5, P.ROLE_MEDIUM),
    (15, 0.5, P.ROLE_MEDIUM), (5, 0.5, P.ROLE_COARSE), (9, 0.5, P.ROLE_COARSE), (1, 0.5, P.ROLE_GAUGE),
    (4, 0.5, P.ROLE_GAUGE), (1, 0.96, P.ROLE_COUNTER), (1, 0.95, P.ROLE_GAUGE),
])
def test_sensor_role(spark, bins, mono, role):
    assert spark.range(1).select(sensor_role(F.lit(bins), F.lit(mono))).first()[0] == role


@pytest.mark.parametrize("probability, tier", [
    (0.05, P.TIER_CRITICAL), (0.5, P.TIER_CRITICAL), (0.03, P.TIER_PREVENTATIVE), (0.04, P.TIER_PREVENTATIVE),
    (0.02, P.TIER_STABLE), (0.0, P.TIER_STABLE), (0.0499, P.TIER_PREVENTATIVE),
])
def test_maintenance_priority(spark, probability, tier):
    assert spark.range(1).select(maintenance_priority(F.lit(probability))).first()[0] == tier


@pytest.mark.parametrize("name, category", [
    ("s_397_0_mean", "Exhaust Temperature"), ("s_459_3_max", "DPF Pressure"), ("s_291_1_std", "Soot"),
    ("s_397_0_trend_slope", "Exhaust Temperature"), ("s_100_0_trend_slope", "Trend"), ("s_100_0_mean", "Other"),
    ("s_397_0_last", "Other"), ("S_459_0_MEAN", "DPF Pressure"), ("spec_0_A", "Other"), ("", "Other"),
    ("s_397_0_min", "Other"), ("s_397_0_coeff_variation", "Other"),
])
def test_feature_category(spark, name, category):
    assert spark.range(1).select(feature_category(F.lit(name))).first()[0] == category


def test_family_detection():
    assert sensor_families(["459_0", "100_0", "397_0"]) == ["100", "397", "459"]
    assert sensor_families(["vehicle_id", "time_step", "Spec_0"]) == []
    assert sensor_families([]) == []
    assert sensor_columns(["397_10", "397_2", "100_0"]) == ["100_0", "397_2", "397_10"]
    assert parse_sensor("a_1") is None and parse_sensor("12_3") == (12, 3)
    assert P.RISK.high > P.RISK.medium


def test_round_even_equals_numpy(spark):
    values = [i / 2000.0 for i in range(-500, 500)] + [0.12345, 2.675, 1e6 + 0.005]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", round_even(F.col("v"), 2), round_even(F.col("v"), 0))
    for value, two, zero in rows.collect():
        assert two == np.round(value, 2) and zero == np.round(value, 0)


def test_bucket_of_counts_boundaries(spark):
    cuts = [0.1, 0.2, 0.5, 0.9]
    values = [0.0, 0.1, 0.15, 0.5, 0.89, 0.9, 2.0]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", bucket_of(F.col("v"), cuts))
    assert all(b == sum(c <= v for c in cuts) for v, b in rows.collect())


def test_finite_or_null(spark):
    rows = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (1.5,)], "v double")
    assert [r[0] for r in rows.select(finite_or_null(F.col("v"))).collect()] == [None, None, None, None, 1.5]
