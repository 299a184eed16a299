from wintide.operators._join import lookup, lookup_many
from wintide.operators.assemble import (
    Feature,
    account_360,
    coalesce_sources,
    one_per_key,
    owner_chain,
)
from wintide.operators.cohort import (
    cohort_rollup,
    funnel_durations,
    funnel_rollup,
    milestones,
    month_offsets,
    tenure_windows,
)
from wintide.operators.membership import (
    ACCOUNT_FILTER_BITS,
    ACCOUNT_FILTER_WORDS,
    Flag,
    exclude_members_unless,
    flagged_accounts,
    flags_of_set,
    is_member,
    may_hold,
    membership_flag,
    on_days,
    semi_filter,
)
from wintide.operators.ranking import dominant_value, edge_events, latest_per_key, quota_cut
from wintide.operators.rollup import (
    any_like,
    classify_set,
    engagement_score,
    more_than,
    only,
    preaggregate_join,
    product_rollup,
    set_label,
    trailing_sum,
    typed_metrics,
    within,
)
from wintide.operators.temporal import (
    as_of_instant,
    current_rows,
    latest_snapshot,
    reporting_dates,
    scd2_as_of,
    snapshot_join,
    state_at,
    with_calendar,
)

__all__ = [
    "ACCOUNT_FILTER_BITS",
    "ACCOUNT_FILTER_WORDS",
    "Feature",
    "Flag",
    "account_360",
    "any_like",
    "as_of_instant",
    "classify_set",
    "coalesce_sources",
    "cohort_rollup",
    "current_rows",
    "dominant_value",
    "edge_events",
    "engagement_score",
    "exclude_members_unless",
    "flagged_accounts",
    "flags_of_set",
    "funnel_durations",
    "funnel_rollup",
    "is_member",
    "latest_per_key",
    "latest_snapshot",
    "lookup",
    "lookup_many",
    "may_hold",
    "membership_flag",
    "milestones",
    "month_offsets",
    "more_than",
    "on_days",
    "one_per_key",
    "only",
    "owner_chain",
    "preaggregate_join",
    "product_rollup",
    "quota_cut",
    "reporting_dates",
    "scd2_as_of",
    "semi_filter",
    "set_label",
    "snapshot_join",
    "state_at",
    "tenure_windows",
    "trailing_sum",
    "typed_metrics",
    "with_calendar",
    "within",
]
