"""Job options as frozen, validated dataclasses.

Validation mirrors what a bad setting must never be allowed to do: a window
that is not a whole number of buckets, more buckets than a chart can hold,
non-positive sizes or non-finite bounds.
"""
from __future__ import annotations

import math
from dataclasses import dataclass, field

# Fixed values that must equal the reference for identical results.
# Reject reasons, in the order the rules are checked (first failing rule wins):
REJECT_REASONS = ("duplicate_id", "wrong_field_count", "blank", "bad_timestamp",
                  "not_a_number", "out_of_range", "bad_label")
# Raw columns, in file order:
RAW_COLUMNS = ("order_id", "timestamp", "distance_km", "prep_minutes", "order_value", "was_late")
# Feature columns, label last:
FEATURE_COLUMNS = ("order_id", "timestamp", "hour", "is_peak", "distance_km", "prep_minutes",
                   "order_value", "was_late")
# Peak hours (UTC): lunch 11-13, dinner 17-20.
PEAK_HOURS = (11, 12, 13, 17, 18, 19, 20)
# Plausibility bounds, exclusive low and inclusive high.
VALID_RANGES = {"distance_km": (0.0, 50.0), "prep_minutes": (0, 120), "order_value": (0.0, 1000.0)}
# Most buckets a window may hold.
MAX_BUCKETS = 288
# Reason code -> plain-English label, and the label as the subject of a sentence.
REASON_LABELS = {
    "out_of_range": "Value out of range",
    "blank": "Missing value",
    "not_a_number": "Not a number",
    "duplicate_id": "Duplicate order ID",
    "bad_label": "Late flag not 0/1",
    "wrong_field_count": "Wrong number of fields",
    "bad_timestamp": "Unreadable timestamp",
}
REASON_PHRASES = {
    "Value out of range": "Out-of-range values",
    "Missing value": "Missing values",
    "Not a number": "Non-numeric values",
    "Duplicate order ID": "Duplicate order IDs",
    "Late flag not 0/1": "Invalid late flags",
    "Wrong number of fields": "Rows with the wrong number of fields",
    "Unreadable timestamp": "Unreadable timestamps",
}
# Finding thresholds.
RECENT_BUCKETS = 10
STEADY_BAND = 0.15
FLAG_CHANGE_PP = 5
STALL_MINUTES = 2
FAST_CLOCK_LEAD_MINUTES = 5
EPS = 1e-9
# Timestamp text format of raw and feature rows, and of batch stamps.
ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"
STAMP_PATTERN = "yyyyMMdd'T'HHmmss'Z'"
# Score threshold on the 3-dp rounded probability.
SCORE_THRESHOLD = 0.5


@dataclass(frozen=True)
class QualityOptions:
    ranges: dict = field(default_factory=lambda: dict(VALID_RANGES))
    peak_hours: tuple = PEAK_HOURS

    def __post_init__(self):
        for name, (low, high) in self.ranges.items():
            if not (math.isfinite(low) and math.isfinite(high)) or low >= high:
                raise ValueError(f"bad range for {name}: ({low}, {high}]")
        if any(not 0 <= h <= 23 for h in self.peak_hours):
            raise ValueError("peak hours must be within 0..23")


@dataclass(frozen=True)
class WindowOptions:
    window_minutes: int = 60
    bucket_minutes: int = 1

    def __post_init__(self):
        if self.window_minutes <= 0 or self.bucket_minutes <= 0:
            raise ValueError("window and bucket must be positive")
        if self.window_minutes % self.bucket_minutes:
            raise ValueError("window must be a whole number of buckets")
        if self.n_buckets > MAX_BUCKETS:
            raise ValueError(f"{self.n_buckets} buckets exceed the limit of {MAX_BUCKETS}")

    @property
    def n_buckets(self) -> int:
        return self.window_minutes // self.bucket_minutes

    @property
    def bucket_seconds(self) -> int:
        return self.bucket_minutes * 60

    @property
    def window_seconds(self) -> int:
        return self.window_minutes * 60


@dataclass(frozen=True)
class TrainOptions:
    min_rows: int = 50
    test_fraction: float = 0.2
    retrain_every: int = 400
    max_iter: int = 200
    tol: float = 1e-10
    features: tuple = ("distance_km", "prep_minutes")
    label: str = "was_late"

    def __post_init__(self):
        if self.min_rows <= 0 or self.retrain_every <= 0:
            raise ValueError("row counts must be positive")
        if not 0.0 < self.test_fraction < 1.0:
            raise ValueError("test_fraction must be in (0, 1)")


# Feed adapter window used by the catalogue (the driver's feed has ~14 rows/hour
# at sf0.01, so a week of hourly buckets is the meaningful view).
FEED_WINDOW = WindowOptions(window_minutes=10080, bucket_minutes=60)

# Fixed texts: what a bucket of one minute, and of n minutes, is called in sentences.
BUCKET_UNITS = ("per minute", "per {n} min")

# Fixed value: the longest field a CSV record of a raw batch may have (the csv module's limit)
FIELD_LIMIT = 131072
