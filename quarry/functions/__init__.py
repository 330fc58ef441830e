"""Scalar column functions (parsing, cleaning, tokenising, banding, formatting)."""

from quarry.functions.scalar import (  # noqa: F401
    AGE_LABELS_LEFT,
    AGE_LABELS_RIGHT,
    age_band,
    bag_to_string,
    days_between,
    epoch_utc_year,
    fmt2,
    java_trim,
    money_to_double,
    normalize_label,
    pad_right,
    parse_double,
    parse_int,
    round_half_up,
    round_python,
    rounded,
    split_list,
    to_epoch_seconds,
    year_range,
)
