"""URL filters: nested host rules as intervals of reversed-host keys, met by a sorted sweep.

``www.example.com`` becomes ``com.example.www.``; a rule's host then covers the keys from ``com.example.``
up to ``com.example/`` (the next character after the dot). Intervals of hosts nest or lie apart. Where an
interval starts or ends, the stack of active rules changes, and between two such borders it stays. The
sweep sorts borders and URLs together; each URL takes the stack of the last border before it. The
sorted rows are dealt out by ranges, and what is active where a range begins comes from the ranges
before it, so neither a hot host nor a single URL in many rows lands in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wintide.llm.shared import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def rule_borders(rules: DataFrame) -> DataFrame:
    """``key`` and ``stack`` (rules active from this key on) of every border of the rules' intervals."""
    listed = (
        rules.select(
            F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
        )
        .where("host <> ''")
        .distinct()
        .withColumn("rule", F.concat("host", "path"))
    )
    # the first three fields order the rules: the longer, the longer host, then a block
    entry = F.struct(
        F.length("rule").alias("size"),
        F.length("host").alias("host_size"),
        (F.col("verdict") == "block").alias("blocks"),
        "rule",
        "path",
        "verdict",
    )
    by_key = listed.groupBy(host_key(F.col("host")).alias("outer")).agg(F.collect_list(entry).alias("own"))
    labels = F.split(F.col("outer"), r"\.")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(labels) - 1),
        lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")),
    )
    chains = by_key.select(F.col("outer").alias("key"), F.explode(prefixes).alias("outer"))
    around = chains.join(by_key, "outer").groupBy("key").agg(
        F.flatten(F.collect_list("own")).alias("inside"),
        F.flatten(F.collect_list(F.when(F.col("outer") != F.col("key"), F.col("own")))).alias("outside"),
    )
    ends = F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/"))
    borders = F.array(
        F.struct(F.col("key").alias("key"), F.col("inside").alias("stack")),
        F.struct(ends.alias("key"), F.col("outside").alias("stack")),
    )
    return around.select(F.inline(borders))


def judge_urls(
    pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", otherwise: str = "allow"
) -> DataFrame:
    """Host, path, rule and verdict of every row.

    ``rules`` has ``host``, ``path`` (null: empty) and ``verdict`` (allow or block); a rule fits its host
    and all subdomains if the path starts with its own. The longest rule (host and path together) wins,
    then the one with the longer host, then a block; rules without a host fit nothing. A null url or one
    without ``://`` has an empty host and path. Where no rule fits, ``rule`` is null and the verdict is
    ``otherwise``. Repeated rows and null keys keep their rows; other columns do not matter.
    """
    urls = pages.select(
        F.col(key).alias("id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path")
    ).fillna("", ["host", "path"])
    borders = rule_borders(rules)
    rows = urls.select(host_key(F.col("host")).alias("key"), "id", "host", "path", F.lit(1).alias("turn"))
    swept = rows.unionByName(borders.withColumn("turn", F.lit(0)), allowMissingColumns=True)
    # the staged range numbers stay the same whatever is run again
    dealt = staged(
        swept.repartitionByRange("key", "turn", "id").withColumn("range", F.spark_partition_id()), "url-sweep"
    )
    last = dealt.groupBy("range").agg(
        F.max_by(F.struct("stack"), F.when(F.col("turn") == 0, F.col("key"))).alias("last")
    )
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    carried = last.select("range", F.last("last", ignorenulls=True).over(before).alias("carried"))
    so_far = Window.partitionBy("range").orderBy("key", "turn").rowsBetween(Window.unboundedPreceding, 0)
    active = F.last(F.when(F.col("turn") == 0, F.struct("stack")), ignorenulls=True).over(so_far)
    met = dealt.withColumn("active", active).where("turn = 1").join(carried, "range", "left")
    stack = F.coalesce("active", "carried").getField("stack")
    best = F.array_max(F.filter(stack, lambda rule: F.startswith(F.col("path"), rule.getField("path"))))
    return met.withColumn("best", best).select(
        F.col("id").alias(key),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"),
    )
