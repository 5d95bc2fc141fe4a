"""Ratios, ages, body mass and quality flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is zero or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def effective(nominal: float, share: Column) -> Column:
    """The nominal amount times the share, at most once; an unknown share keeps it whole."""
    return F.lit(float(nominal)) * F.least(F.lit(1.0), share)


def years_between(born: Column, at: Column) -> Column:
    return F.datediff(at, born) / F.lit(365.25)


def body_mass(height_cm: Column, weight_kg: Column) -> Column:
    return F.when(height_cm > 0, weight_kg / F.pow(height_cm / 100.0, F.lit(2.0)))


def measurement_flag(date_issue: Column, height: Column, weight: Column, heights: tuple[float, float] = (80.0, 200.0), weights: tuple[float, float] = (10.0, 100.0)) -> Column:
    return (
        F.when(date_issue, "date_issue")
        .when(height.isNull() | weight.isNull(), "missing_measurement")
        .when(~height.between(*heights) | ~weight.between(*weights), "implausible")
        .otherwise("valid")
    )


def delivery_flag(tranches: Column) -> Column:
    return F.when(tranches.isNull(), "unknown").when(tranches < 2, "delayed_or_incomplete").otherwise("on_schedule")
