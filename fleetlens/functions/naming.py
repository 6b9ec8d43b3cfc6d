"""Sensor and feature naming: sensors are ``<family>_<bin>``, features ``s_<sensor>_<statistic>``."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

SENSOR_PATTERN = r"^(\d+)_(\d+)$"
_SENSOR = re.compile(SENSOR_PATTERN)


def parse_sensor(name: str) -> tuple[int, int] | None:
    """(family, bin) of a sensor column name, None for any other column."""
    match = _SENSOR.match(name)
    return (int(match.group(1)), int(match.group(2))) if match else None


def sensor_columns(columns: Iterable[str], family: str | None = None) -> list[str]:
    """Sensor columns ordered by numeric family, then numeric bin."""
    found = [c for c in columns if parse_sensor(c) and (family is None or c.rsplit("_", 1)[0] == family)]
    return sorted(found, key=parse_sensor)


def sensor_families(columns: Iterable[str]) -> list[str]:
    """Distinct families among the columns, in numeric order."""
    return list(dict.fromkeys(c.rsplit("_", 1)[0] for c in sensor_columns(columns)))


def feature_name(sensor: str, statistic: str) -> str:
    return f"s_{sensor}_{statistic}"


def family_of(sensor: Column) -> Column:
    """Family part, empty string where the name is no sensor."""
    return F.regexp_extract(sensor, SENSOR_PATTERN, 1)


def bin_of(sensor: Column) -> Column:
    return F.substring_index(sensor, "_", -1).cast("int")
