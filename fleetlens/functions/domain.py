"""Domain classifications as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens import params as P


def maintenance_priority(probability: Column, risk: P.RiskParams = P.RISK) -> Column:
    """Tier of an unrounded failure probability."""
    return (
        F.when(probability >= F.lit(risk.high), F.lit(P.TIER_CRITICAL))
        .when(probability >= F.lit(risk.medium), F.lit(P.TIER_PREVENTATIVE))
        .otherwise(F.lit(P.TIER_STABLE))
    )


def sensor_role(n_bins: Column, monotonicity: Column) -> Column:
    """Likely physical nature of a sensor family; only a monotonicity strictly above 0.95 makes a counter."""
    return (
        F.when(monotonicity > F.lit(0.95), F.lit(P.ROLE_COUNTER))
        .when(n_bins >= 16, F.lit(P.ROLE_FINE))
        .when(n_bins >= 10, F.lit(P.ROLE_MEDIUM))
        .when(n_bins >= 5, F.lit(P.ROLE_COARSE))
        .otherwise(F.lit(P.ROLE_GAUGE))
    )


def feature_category(name: Column) -> Column:
    """Dashboard category of a feature name.

    Only trend, mean, max and std features are tied to a physical quantity; an unmapped trend keeps its own class.
    """
    lowered = F.lower(name)
    mapped = F.coalesce(*[F.when(lowered.contains(k), F.lit(v)) for k, v in P.FEATURE_CATEGORIES.items()])
    is_trend = lowered.contains("trend_slope")
    is_level = lowered.rlike("mean|max|std")
    return (
        F.when(is_trend, F.coalesce(mapped, F.lit("Trend")))
        .when(is_level, F.coalesce(mapped, F.lit("Other")))
        .otherwise(F.lit("Other"))
    )
