from fleetlens.functions.domain import feature_category, maintenance_priority, sensor_role
from fleetlens.functions.naming import bin_of, family_of, feature_name, parse_sensor, sensor_families
from fleetlens.functions.numeric import (
    bucket_of, finite_or_null, hash_order, ratio_or_zero, round_even, unit_hash,
)

__all__ = [
    "bin_of", "bucket_of", "family_of", "feature_category", "feature_name", "finite_or_null",
    "hash_order", "maintenance_priority", "parse_sensor", "ratio_or_zero", "round_even",
    "sensor_families", "sensor_role", "unit_hash",
]
