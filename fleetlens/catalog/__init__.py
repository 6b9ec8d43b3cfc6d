"""Registered queries over the driver tables, one module per area."""

from fleetlens.catalog import evaluation, features, fleet, learning, scoring, storage  # noqa: F401
from fleetlens.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
