from wintide.plans.account360 import account_360_report, account_overview_report
from wintide.plans.midmarket import (
    accounts_granular,
    expansion_windows,
    expansions_by_type,
    expansions_granular,
    instance_months,
    leads_to_accounts,
    won_leads,
)
from wintide.plans.smb import account_expansions, accounts_at_win, accounts_today
from wintide.plans.targets import cross_sell_targets, product_targets

__all__ = [
    "account_360_report",
    "account_expansions",
    "account_overview_report",
    "accounts_at_win",
    "accounts_granular",
    "accounts_today",
    "cross_sell_targets",
    "expansion_windows",
    "expansions_by_type",
    "expansions_granular",
    "instance_months",
    "leads_to_accounts",
    "product_targets",
    "won_leads",
]
