from fleetlens.streaming.incremental import (
    compact_states, features_so_far, latest_statistics, run_state_deltas, run_statistics, states_so_far,
)
from fleetlens.streaming.sink import FeatureSink, run_features

__all__ = [
    "FeatureSink", "run_features", "compact_states", "features_so_far", "latest_statistics", "run_state_deltas", "run_statistics", "states_so_far",
]
