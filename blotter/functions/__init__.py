"""Column expressions; every one stays inside the JVM."""

from blotter.functions.json import field_struct, quoted_list
from blotter.functions.scores import (
    density_score,
    diversity_index,
    severity_label,
    variety_ratio,
)
from blotter.functions.text import anonymous_id, area_from_message, collated, fold_key
from blotter.functions.time import (
    age_label,
    age_seconds,
    day_key,
    minute_bucket,
    seconds,
    time_bucket,
)

__all__ = [
    "age_label",
    "age_seconds",
    "anonymous_id",
    "area_from_message",
    "collated",
    "day_key",
    "density_score",
    "diversity_index",
    "field_struct",
    "fold_key",
    "minute_bucket",
    "quoted_list",
    "seconds",
    "severity_label",
    "time_bucket",
    "variety_ratio",
]
