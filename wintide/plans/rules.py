"""Fixed values shared by the reports: product names, plan groups, bands, event groups.

They have to equal the values in the source data, so they are listed as they are.
"""

from __future__ import annotations

from datetime import date

from wintide.operators import any_like, more_than, only, within

# Start of revenue history: earlier win dates are read at this day.
REVENUE_START = date(2014, 1, 1)
# Start of dimension history, and the day a fact must lie past it.
DIMENSION_START = date(2017, 5, 3)
OPEN_END = date(9999, 12, 31)

FRAUD_BATCHES = ["Batch13"]
FRAUD_ACCOUNT_TYPES = ["Fraudulent"]
EXCLUDED_BILLING_TYPES = ["Sponsored", "Test", "Employee", "Fraudulent"]

CLOSED_STAGE = "07 - Closed"
EXPANSION_TYPE = "%Expansion%"
NOT_EXPANSIONS = ["Agent Contraction", "Churn", "Expiring One-Time Discount"]

EXPANSION_GROUPS = {
    "agent": ["Agent Adds", "Temporary Agents"],
    "plan_shift": ["Plan Shift"],
    "product": ["Add Product", "New Product"],
    "new_instance": ["New Instance"],
    "new_contract": ["New Contract Term"],
}
# Output column of each group's distinct count.
EXPANSION_COUNTS = {
    "agent": "total_agent_expansions",
    "plan_shift": "total_plan_shifts",
    "product": "total_product_expansions",
    "new_instance": "total_new_instance_expansions",
    "new_contract": "total_new_contract_expansions",
}
ACCOUNT_EXPANSION_RULES = [
    ("Agent Expansion Only", within("type", ["Agent Adds", "Temporary Agents"])),
    ("Plan Shift Only", only("type", "Plan Shift")),
    ("Product Expansion Only", within("type", ["Add Product", "New Product"])),
    ("New Instance Only", only("type", "New Instance")),
    ("New Contract Only", only("type", "New Contract Term")),
    ("Multiple Expansions", more_than("type", 1)),
]
FIRST_EXPANSION_TYPES = [
    ("Agent Add", ["Agent Adds", "Agent Add"]),
    ("Add Product", ["Add Product", "New Product"]),
    (None, ["Plan Shift", "New Instance", "New Contract Term"]),
]

CUSTOMER_TYPE_RULES = [
    ("Starter-only", only("product_offering", "Support Starter")),
    ("Suite", any_like("product_line", "%Suite%")),
    ("Support-only", only("product_line", "Support")),
    ("Chat-only", only("product_line", "Chat")),
    ("Other Multi-Product", more_than("product_line", 1)),
]
# Same labels in the spelling and order of the target list.
PRODUCT_MIX_RULES = [
    ("Starter-Only", only("product_offering", "Support Starter")),
    ("Support-Only", only("product_line", "Support")),
    ("Chat-Only", only("product_line", "Chat")),
    ("Suite", any_like("product_line", "%Suite%")),
    ("Other Multi-Product", more_than("product_line", 1)),
]

SUPPORT_PLAN_GROUPS = [
    ("Support Essential", ["Essential", "Starter"]),
    ("Support Team", ["Team", "Regular"]),
    ("Support Professional", ["Professional", "Plus", "Premium"]),
    ("Support Enterprise", "%Enterprise%"),
]
INSTANCE_PLAN_GROUPS = [
    ("Essential", "%Essential%"),
    ("Team", ["Team", "Regular"]),
    ("Professional", ["Professional", "Plus"]),
    ("Enterprise", "%Enterprise%"),
]

SEAT_LINES = ["Support", "Chat", "Talk"]
ENGAGED_PRODUCTS = ["support", "guide", "chat", "talk"]

NO_REVENUE = {0: "n/a"}
SUB_ARR_BANDS = [
    (1000, "A. $0-1K"),
    (2000, "B. $1-2K"),
    (3000, "C. $2-3K"),
    (4000, "D. $3-4K"),
    (5000, "E. $4-5K"),
    (6000, "F. $5-6K"),
    (7000, "G. $6-7K"),
    (8000, "H. $7-8K"),
    (9000, "I. $8-9K"),
    (10000, "J. $9-10K"),
    (11000, "K. $10-11K"),
    (12000, "L. $11-12K"),
    (24000, "M. $12-24K"),
    (36000, "N. $24-36K"),
    (48000, "O. $36-48K"),
    (60000, "P. $48-60K"),
    (120000, "Q. $60-120K"),
    (300000, "R. $120-300K"),
]
SUB_ARR_TOP = "S. $300K+"
PRIMARY_ARR_BANDS = [(10000, "1. <$10K"), (100000, "2. $10-100K")]
PRIMARY_ARR_TOP = "3. $100K+"

AGENT_EXACT = {0: "0", 1: "1"}
AGENT_BANDS = [(10, "2 - 9"), (50, "10 - 49"), (100, "50 - 99"), (500, "100 - 499")]
AGENT_TOP = "500+"

OPS_ARR_BANDS = [
    (12000, "$  1 - $12K"),
    (60000, "$ 12K - $60K"),
    (120000, "$ 60K - $120K"),
    (300000, "$120K - $300K"),
]
OPS_ARR_TOP = "$300K+"
OPS_PRIMARY_BANDS = [(10000, "<$10K"), (100000, "$10-100K")]
OPS_PRIMARY_TOP = "$100K+"

AGE_BANDS = [(1, "0-1 yr"), (2, "1-2 yr"), (3, "2-3 yr"), (4, "3-4 yr"), (5, "4-5 yr")]
AGE_TOP = "5+ yrs"

SUITE_ERA = ["2018Q3", "2018Q4", "2019Q1", "2019Q2", "2019Q3"]
FUNNEL_QUARTERS = ["2018Q3", "2018Q4", "2019Q1", "2019Q2"]
FUNNEL_SOURCES = ["Support Trial", "Suite Trial", "Contact Us", "Demo Request", "Chat Trial"]
SOURCE_GROUPS = [
    ("Support/Suite Trial", ["Support Trial", "Suite Trial"]),
    ("Contact Us/Demo Request", ["Contact Us", "Demo Request"]),
    ("Chat Trial", ["Chat Trial"]),
]

CROSS_SELL_QUOTAS = {"AMER": 4500, "EMEA": 3500, "APAC": 2000, "LATAM": 1000}
