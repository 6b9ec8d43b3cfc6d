"""Parameters shared by the operators.

Every operator takes these as arguments with the values below as defaults, so a caller can score a
different fleet without touching module state.
"""

from __future__ import annotations

from dataclasses import dataclass

ID = "vehicle_id"
TIME = "time_step"
ACCOUNT = "account_id"
LABEL = "in_study_repair"
STUDY_LENGTH = "length_of_study_time_step"
NON_FEATURES = (ID, LABEL, STUDY_LENGTH)

# --- Fixed values: result-defining constants, tables and formats --------------------------------

STATISTICS = (
    "mean", "max", "min", "std", "last", "range", "missing_count", "trend_slope", "coeff_variation",
)

TIER_CRITICAL = "CRITICAL DISPATCH"
TIER_PREVENTATIVE = "PREVENTATIVE MONITOR"
TIER_STABLE = "STABLE OPERATION"

ROLE_COUNTER = "CUMULATIVE COUNTER (Mileage / Hours / Cycles)"
ROLE_FINE = "FINE-GRAIN HISTOGRAM (Likely Temperature or RPM profile)"
ROLE_MEDIUM = "MED-GRAIN HISTOGRAM (Likely Pressure or Load distribution)"
ROLE_COARSE = "COARSE HISTOGRAM (State tracking / Duty cycle)"
ROLE_GAUGE = "SINGLE-VALUE GAUGE (Instantaneous reading)"

# dashboard alias -> engineered source column
DASHBOARD_ALIASES = {
    "total_operating_hours": "length_of_study_time_step",
    "component_x_primary_hist_mean": "s_397_0_mean",
    "component_x_primary_hist_max": "s_397_0_max",
    "component_x_secondary_hist_mean": "s_459_0_mean",
    "component_x_secondary_hist_max": "s_459_0_max",
    "component_x_tertiary_hist_mean": "s_291_0_mean",
    "component_x_tertiary_hist_max": "s_291_0_max",
    "component_x_cumulative_counter_1": "s_100_0_mean",
    "component_x_cumulative_counter_2": "s_666_0_mean",
}

DASHBOARD_COLUMNS = (
    "vehicle_id", "company_name", "operating_prefecture", "fleet_size", "vehicle_age_years",
    "failure_probability", "risk_percentage", "maintenance_priority",
    "expected_breakdown_cost_jpy", "net_savings_jpy",
    "expected_co2_saved_kg", "expected_materials_saved_kg", "expected_repair_avoided",
    "feature_importance_rank", "model_version", "prediction_timestamp",
    "total_operating_hours",
    "avg_exhaust_temperature_c", "peak_exhaust_temperature_c",
    "avg_dpf_differential_pressure_kpa", "peak_dpf_differential_pressure_kpa",
    "avg_engine_soot_mass_index", "peak_engine_soot_mass_index",
)

# sensor family -> physical quantity shown on the dashboard
OPERATIONAL_METRICS = {
    "397": ("avg_exhaust_temperature_c", "peak_exhaust_temperature_c"),
    "459": ("avg_dpf_differential_pressure_kpa", "peak_dpf_differential_pressure_kpa"),
    "291": ("avg_engine_soot_mass_index", "peak_engine_soot_mass_index"),
}

# sensor family -> feature-importance category
FEATURE_CATEGORIES = {
    "s_397": "Exhaust Temperature",
    "s_459": "DPF Pressure",
    "s_291": "Soot",
}

# search grid of the primary model
TREE_GRID = {"maxIter": [100, 200, 300, 500], "maxDepth": [6, 8, 10, 12], "minInstancesPerNode": [3, 5, 10]}
# search grid of the challenger; Spark trees have no L1/L2 term, so those two axes are absent
CHALLENGER_GRID = {
    "maxIter": [100, 200, 300, 500], "maxDepth": [4, 6, 8, 10, 12], "minInstancesPerNode": [1, 3, 5, 7],
    "stepSize": [0.01, 0.05, 0.1, 0.2], "subsamplingRate": [0.7, 0.8, 0.9, 1.0],
    "featureSubsetStrategy": ["0.6", "0.7", "0.8", "0.9", "all"],
}

# F2 sweep: 0.05, 0.07, ... 0.53
SWEEP_THRESHOLDS = tuple(t / 100.0 for t in range(5, 55, 2))

MODEL_VERSION = "1.0.0"
ALGORITHM_NAME = "GBT (Spark ML)"
SEARCH_NAME = "RandomizedSearchCV"

# --- End of fixed values ------------------------------------------------------------------------


@dataclass(frozen=True)
class RiskParams:
    """Risk thresholds and per-failure money and material constants."""

    high: float = 0.05
    medium: float = 0.03
    breakdown_cost_jpy: float = 500000.0
    maintenance_cost_jpy: float = 30000.0
    co2_per_failure_kg: float = 350.0
    materials_per_failure_kg: float = 45.0


@dataclass(frozen=True)
class TrainParams:
    """Split, fold and tree settings."""

    test_size: float = 0.2
    folds: int = 5
    seed: int = 42
    trees: int = 300
    depth: int = 10
    min_leaf: int = 5
    default_class_ratio: float = 15.0


RISK = RiskParams()
TRAIN = TrainParams()
