"""Row-wise measures over several columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sub-indices in order of priority, the measures that completeness counts, and the index bands.
SUB_INDICES = ("pm25", "pm10", "o3", "no2", "so2", "co")
MEASURES = ("pm25", "pm10", "o3", "no2", "so2", "co", "aod", "dust", "uv_index", "co2")
BANDS = {"good": (0, 50), "moderate": (51, 100), "usg": (101, 150), "unhealthy": (151, 200), "very_unhealthy": (201, 300), "hazardous": (301, None)}


def row_max(*columns: str) -> Column:
    """Largest value, nulls as 0."""
    return F.greatest(*[F.coalesce(F.col(c), F.lit(0)) for c in columns])


def dominant(prefix: str = "aqi_", names: tuple[str, ...] = SUB_INDICES) -> Column:
    """Name of the largest sub-index, the first of ``names`` at ties; null when all are null or 0."""
    top = row_max(*[prefix + n for n in names])
    first = F.coalesce(*[F.when(F.col(prefix + n) == top, n) for n in names])
    return F.when(top != 0, first)


def completeness(columns: tuple[str, ...] = MEASURES) -> Column:
    """Percent of ``columns`` that are not null."""
    return reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in columns]).cast("double") / len(columns) * 100


def in_band(value: Column, band: str) -> Column:
    low, high = BANDS[band]
    return value >= low if high is None else value.between(low, high)


def stable_id(*columns: Column) -> Column:
    return F.md5(F.concat_ws("#", *columns))


def clean_int(c: Column) -> Column:
    """NaN and null to null, else the nearest integer, halves to even."""
    return F.when(~F.isnan(c), F.bround(c)).cast("int")
