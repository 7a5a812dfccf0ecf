"""The delivery lateness rule as a column expression (FLT-14), usable as a label or a what-if."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTES_PER_KM = 3


def estimated_minutes(prep: Column, km: Column, noise: Column, is_peak: Column,
                      peak_delay: float = 0.0) -> Column:
    """prep + 3 min/km + noise (+ the rush-hour delay when the order is at a peak hour)."""
    est = prep.cast("double") + F.lit(float(MINUTES_PER_KM)) * km.cast("double") + noise.cast("double")
    return est + F.when(is_peak.cast("boolean"), F.lit(float(peak_delay))).otherwise(F.lit(0.0))


def is_late(prep: Column, km: Column, noise: Column, is_peak: Column, threshold: float,
            peak_delay: float = 0.0) -> Column:
    """Strictly above the threshold is late."""
    return (estimated_minutes(prep, km, noise, is_peak, peak_delay) > F.lit(float(threshold))).cast("int")
