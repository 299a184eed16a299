"""Conditional roll-ups, set classification and pre-aggregation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wintide.functions import distinct_list, license_floor, weighted_level
from wintide.operators._join import Keys, key_pairs, lookup

SetRule = Callable[[Mapping[str, Column]], Column]


def only(item: str, value: str) -> SetRule:
    """The set holds exactly this value."""
    return lambda sets: sets[item] == F.array(F.lit(value))


def within(item: str, values: Sequence[str]) -> SetRule:
    """The set is not empty and holds nothing but these values."""
    return lambda sets: (F.size(sets[item]) > 0) & (
        F.size(F.array_except(sets[item], F.array(*[F.lit(v) for v in values]))) == 0
    )


def any_like(item: str, pattern: str) -> SetRule:
    """Some value matches the LIKE pattern."""
    return lambda sets: F.exists(sets[item], lambda v: v.like(pattern))


def more_than(item: str, count: int) -> SetRule:
    return lambda sets: F.size(sets[item]) > count


def set_label(
    sets: Mapping[str, Column], rules: Sequence[tuple[str, SetRule]], default: str
) -> Column:
    label: Column | None = None
    for text, rule in rules:
        hit = rule(sets)
        label = F.when(hit, text) if label is None else label.when(hit, text)
    if label is None:
        raise ValueError("at least one rule is needed")
    return label.otherwise(default)


def classify_set(
    df: DataFrame,
    keys: Sequence[str],
    items: Sequence[str],
    rules: Sequence[tuple[str, SetRule]],
    default: str,
    name: str,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Label each key by its distinct item sets; the first matching rule wins.

    Sets hold distinct catalogue values and are merged map-side, so a hot key costs each task one
    small set, not its rows.
    """
    sets = {i: F.collect_set(i) for i in items}
    return df.groupBy(*keys).agg(set_label(sets, rules, default).alias(name), *extra)


def typed_metrics(
    events: DataFrame,
    keys: Sequence[str],
    event_id: str,
    type_col: str,
    amount: str,
    groups: Mapping[str, Sequence[str]],
    count_name: str = "num_{}",
    sum_name: str = "{}_amount",
    total_count: str = "num_events",
    total_sum: str | None = "total_amount",
) -> DataFrame:
    """Distinct events and summed amount per key, overall and for each group of types.

    Lines are first reduced to (key, event), which makes every distinct count a plain sum: no row
    expansion per distinct expression, and a hot key is spread by event id. Both levels are hash
    aggregates.
    """
    flags, sums = [], []
    for group, values in groups.items():
        hit = F.col(type_col).isin(*values)
        flags.append(F.max(F.when(hit, 1).otherwise(0)).alias(f"__f_{group}"))
        sums.append(F.sum(F.when(hit, F.col(amount)).otherwise(0)).alias(f"__s_{group}"))
    per_event = events.groupBy(*keys, event_id).agg(
        *flags, *sums, F.sum(amount).alias("__total")
    )
    known = F.col(event_id).isNotNull()
    out = [F.count(event_id).alias(total_count)]
    for group in groups:
        flag = F.when(known, F.col(f"__f_{group}")).otherwise(0)
        out.append(F.sum(flag).cast("bigint").alias(count_name.format(group)))
    for group in groups:
        out.append(F.sum(f"__s_{group}").alias(sum_name.format(group)))
    if total_sum is not None:
        out.append(F.sum("__total").alias(total_sum))
    return per_event.groupBy(*keys).agg(*out)


def product_rollup(
    lines: DataFrame,
    product_dim: DataFrame,
    plan_matrix: DataFrame,
    seat_lines: Sequence[str] = ("Support", "Chat", "Talk"),
    level_line: str = "Support",
    premium: str = "%Premier%",
    excluded: str = "%Talk Partner%",
    premium_level: int = 5,
    seat_floor: int = 1000,
) -> DataFrame:
    """Revenue lines -> (date, account, product line) -> (date, account).

    ``lines``: mrr_date, crm_account_id, product_line, product_offering, product_plan,
    base_product_plan, productrateplancharge_id, baseplan_quantity, net_arr.
    The level per line comes first, so that plan averages weigh seats; accounts then take the maximum
    over lines. The first level keeps only numbers and BOOLEANs, which lets it stay a hash aggregate.
    """
    paid = lines.filter(
        F.col("crm_account_id").isNotNull()
        & ~F.col("product_offering").like(excluded)
        & (F.col("net_arr") > 0)
    ).withColumn("__plan", F.coalesce("base_product_plan", "product_plan"))
    known = lookup(
        paid,
        product_dim,
        "productrateplancharge_id",
        ["product_type_derived", "enterpriselicense_ind"],
        how="inner",
    )
    levelled = lookup(known, plan_matrix, [("__plan", "product_plan")], ["plan_type"])

    line, seats = F.col("product_line"), F.col("baseplan_quantity")
    offering = F.col("product_offering")
    on_level = line == level_line
    enterprise = on_level & offering.like("%Enterprise%")
    kind = (
        F.when(offering.like("%Answer%"), "Answer Bot")
        .when(F.col("product_type_derived") == "Addon", "Add-on")
        .otherwise(line)
    )
    # Lines of one product line have at most three kinds, so three flags count them.
    kinds = [kind == "Answer Bot", kind == "Add-on", ~kind.isin("Answer Bot", "Add-on")]

    def seat_sum(condition: Column) -> Column:
        return F.sum(F.when(condition, seats).otherwise(0))

    per_line = levelled.groupBy("mrr_date", "crm_account_id", "product_line").agg(
        F.max(F.col("enterpriselicense_ind") == "Y").alias("__ela"),
        F.max(offering.like(premium)).alias("__premium"),
        sum(F.max(F.when(k, 1).otherwise(0)) for k in kinds).alias("__kinds"),
        F.max(F.when(line.isNotNull(), 1).otherwise(0)).alias("__base"),
        seat_sum(line.isin(*seat_lines)).alias("__seats"),
        seat_sum(on_level).alias("__level_seats"),
        seat_sum(enterprise).alias("__enterprise_seats"),
        F.max(F.when(on_level, F.col("plan_type")).otherwise(0)).alias("__max_level"),
        weighted_level("plan_type", "baseplan_quantity", on_level).alias("__avg_level"),
    )
    ela = F.max("__ela")
    forced = ela | F.max("__premium")

    def floored(col: str) -> Column:
        return license_floor(F.max(col), ela, seat_floor)

    return per_line.groupBy("mrr_date", "crm_account_id").agg(
        distinct_list("product_line").alias("product_combo"),
        F.sum("__base").alias("base_product_count"),
        F.sum("__kinds").alias("all_product_count"),
        floored("__seats").alias("paid_agents"),
        floored("__level_seats").alias("paid_support_agents"),
        floored("__enterprise_seats").alias("paid_support_enterprise_agents"),
        F.when(forced, premium_level).otherwise(F.max("__max_level")).alias("max_support_plan"),
        F.when(forced, premium_level).otherwise(F.max("__avg_level")).alias("avg_support_plan"),
    )


def trailing_sum(
    df: DataFrame,
    key: str,
    date: str,
    sums: Mapping[str, Column],
    as_of: Column,
    months: int = 12,
) -> DataFrame:
    """Sums per key over the months up to ``as_of``; the date filter reaches the scan.

    The bound is compared with the bare column (not with a cast of it), so Parquet can skip row
    groups; a timestamp passes from the first instant of the bounding day.
    """
    recent = df.filter(F.col(date) >= F.add_months(as_of, -months))
    return recent.groupBy(key).agg(*[F.sum(expr).alias(n) for n, expr in sums.items()])


def engagement_score(df: DataFrame, products: Sequence[str]) -> DataFrame:
    """Paid, activated-and-paid and engaged product counts from 0/1 columns.

    Reads ``is_paying_<p>``, ``is_activated_<p>`` and ``is_engaged_<p>``. One missing engaged
    flag makes the account 'Not Engaged' with count 0.
    """

    def on(kind: str, product: str) -> Column:
        return F.coalesce(F.col(f"is_{kind}_{product}"), F.lit(0))

    zero = F.lit(0)
    paid = sum((on("paying", p) for p in products), zero)
    both = [(on("activated", p) == 1) & (on("paying", p) == 1) for p in products]
    active = sum((F.when(b, 1).otherwise(0) for b in both), zero)
    engaged = sum((F.col(f"is_engaged_{p}") for p in products), zero)
    return df.withColumns(
        {
            "core_products_paid": paid,
            "core_products_activated": active,
            "num_engaged_products": F.when(
                engaged.between(0, len(products)), engaged
            ).otherwise(0),
            "engaged_flag": F.when(engaged >= 1, "Engaged").otherwise("Not Engaged"),
        }
    )


def preaggregate_join(
    df: DataFrame,
    feature: DataFrame,
    on: Keys,
    aggregates: Sequence[Column],
    how: str = "left",
) -> DataFrame:
    """Reduce a many-row feature to the join grain, then join; both use the same exchange."""
    keys = [r for _, r in key_pairs(on)]
    return lookup(df, feature.groupBy(*keys).agg(*aggregates), on, how=how)
