from wintide.functions.dates import (
    days_left,
    elapsed_days,
    elapsed_months31,
    quarter_end,
    year_quarter,
    yesterday_in,
)
from wintide.functions.labels import band, group_values, lifecycle_status
from wintide.functions.numbers import (
    complement,
    license_floor,
    pct_change,
    ratio,
    strict_greatest,
    strict_least,
    weighted_level,
)
from wintide.functions.text import (
    composite_key,
    distinct_list,
    normalize_id,
    presence_flag,
    role_label,
    split_name,
    transition,
)

__all__ = [
    "band",
    "complement",
    "composite_key",
    "days_left",
    "distinct_list",
    "elapsed_days",
    "elapsed_months31",
    "group_values",
    "license_floor",
    "lifecycle_status",
    "normalize_id",
    "pct_change",
    "presence_flag",
    "quarter_end",
    "ratio",
    "role_label",
    "split_name",
    "strict_greatest",
    "strict_least",
    "transition",
    "weighted_level",
    "year_quarter",
    "yesterday_in",
]
