"""Document fingerprints by consistent weighted sampling.

A text's terms are its words, weighted by how often they occur. For each of the samples, a term draws
from its own hash r and c, both Gamma(2, 1), and b, uniform. With t = floor(ln w / r + b), the term's
value is c / exp(r (t - b + 1)), and the term with the smallest value is sampled along with its t. Two
texts sample the same (term, t) with a probability equal to their generalised Jaccard similarity, the
sum of the smaller weights over the sum of the larger ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 48
SPACES = r"[\x20\x09-\x0D]+"
KNOTS = 32
TAG_BITS = 20


def _uniform(hashed: Column, shift: int, bits: int) -> Column:
    low = F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit((1 << bits) - 1))
    return (low + F.lit(0.5)) * F.lit(2.0**-bits)


def draw_samples(terms: DataFrame, samples: int, by: tuple[str, ...], weights: tuple[str, ...]) -> DataFrame:
    """For each text and sample, the code of the term with the smallest value, for every kind of weight.

    ``terms`` has the text's key columns, ``term`` (a hash) and weights; a weight of 0 or null takes no
    part. A code orders the terms of its sample: the value's logarithm above, a tag of (term, t) below.
    """
    logs = [F.ln(F.col(w)).alias(w) for w in weights]  # null for 0
    number = F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("sample")
    drawn = terms.select(*by, "term", *logs).select(
        *by,
        *weights,
        "term",
        number,
    )
    drawn = drawn.select(
        *by,
        *weights,
        "sample",
        F.xxhash64("term", 2 * F.col("sample")).alias("one"),
        F.xxhash64("term", 2 * F.col("sample") + 1).alias("two"),
    )
    one, two = F.col("one"), F.col("two")
    drawn = drawn.select(
        *by,
        *weights,
        "sample",
        "one",
        (-F.ln(_uniform(one, 0, 21) * _uniform(one, 21, 21))).alias("r"),
        _uniform(one, 42, 22).alias("b"),
        F.ln(-F.ln(_uniform(two, 0, 31) * _uniform(two, 31, 31))).alias("log_c"),
    )
    steps = [F.floor(F.col(w) / F.col("r") + F.col("b")).alias(w) for w in weights]
    drawn = drawn.select(*by, "sample", "one", "r", "b", "log_c", *steps)
    codes = []
    for w in weights:
        log_value = F.col("log_c") - F.col("r") * (F.col(w) - F.col("b") + F.lit(1.0))
        tag = F.shiftright("one", 9).bitwiseXOR(F.col(w) * F.lit(7919)).bitwiseAND(F.lit((1 << TAG_BITS) - 1))
        code = F.shiftleft((log_value * F.lit(float(1 << 28))).cast("bigint"), TAG_BITS).bitwiseOR(tag)
        codes.append(F.min(code).alias(w))
    return drawn.groupBy(*by, "sample").agg(*codes)


def _cells(rows: DataFrame, cells: int) -> Column:
    """Number of the interval of ids that a row lies in; higher ids have higher numbers, null has -1.

    The knots are quantiles of all ids, found by Spark; between two knots the cells are equally wide.
    """
    shares = [k / KNOTS for k in range(KNOTS + 1)]
    found = rows.select(F.percentile_approx("id", shares, 10_000).alias("q")).first()["q"]
    knots = sorted(set(found or [0]))
    wide = max(1, math.ceil(cells / len(knots)))

    def leaf(n: int) -> Column:
        low, high = knots[n], knots[n + 1] if n + 1 < len(knots) else knots[n] + 1
        share = (F.col("id") - F.lit(low)).cast("double") * F.lit(wide / (high - low))
        return F.lit((n + 1) * wide) + F.least(F.greatest(F.floor(share), F.lit(0)), F.lit(wide - 1))

    def tree(first: int, stop: int) -> Column:
        if stop - first == 1:
            return leaf(first)
        mid = (first + stop) // 2
        return F.when(F.col("id") < F.lit(knots[mid]), tree(first, mid)).otherwise(tree(mid, stop))

    return F.when(F.col("id").isNull(), F.lit(-1).cast("bigint")).otherwise(tree(0, len(knots)).cast("bigint"))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows in descending id order, each with the text of the one after it; the last has the first's.

    Columns ``cell``, ``place`` (within the cell), ``id``, ``text``, ``next_text`` and ``ahead``: a cell's
    rows are followed by a copy, marked ``ahead``, of the row that comes after them. Equal ids go by
    their texts; null ids come last. Texts are shuffled once, by cell.
    """
    spark = docs.sparkSession
    width = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cell = _cells(rows, 2 * width)
    tops = rows.select("id", cell.alias("cell")).groupBy("cell").agg(F.max("id").alias("top"))
    by_cell, all_cells = Window.orderBy("cell"), Window.orderBy("cell").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    owners = tops.select(
        "top", F.coalesce(F.lead("cell").over(by_cell), F.first("cell").over(all_cells)).alias("owner")
    )
    # one row for each cell, and there are as many cells as the shuffle width asks for
    marked = rows.withColumn("cell", cell).join(F.broadcast(owners), F.col("id").eqNullSafe(F.col("top")), "left")
    copies = F.array(
        F.struct(F.col("cell").alias("cell"), F.lit(False).alias("ahead")),
        F.struct(F.col("owner").alias("cell"), F.lit(True).alias("ahead")),
    )
    dealt = (
        marked.select("id", "text", F.inline(F.filter(copies, lambda c: c.getField("cell").isNotNull())))
        .repartition(width, "cell")
    )
    order = Window.partitionBy("cell").orderBy("ahead", F.desc_nulls_last("id"), "text")
    return dealt.select(
        "cell",
        F.row_number().over(order).alias("place"),
        "id",
        "text",
        F.lead("text").over(order).alias("next_text"),
        "ahead",
    )


def edited_text(text: Column, following: Column) -> Column:
    """The last third of the code points replaced by the first as many of the following text."""
    n = F.char_length(text)
    cut = F.floor(n / 3).cast("int")
    return F.concat(F.substr(text, F.lit(1), n - cut), F.substr(following, F.lit(1), cut))


def _tag_of(kind: str, mask: Column):
    return lambda x: x.getField(kind).bitwiseAND(mask)


def likeness(a: Column, b: Column) -> Column:
    same = F.aggregate(
        F.zip_with(a, b, lambda x, y: F.when(x.eqNullSafe(y), 1).otherwise(0)), F.lit(0), lambda s, x: s + x
    )
    return same / F.size(a)


def fingerprint_documents(
    docs: DataFrame, samples: int = SAMPLES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likenesses.

    One row for each row. A null text is empty; a text without words has an empty place in every sample,
    so two such texts are alike (1) and unlike any other (0). A table of one row is its own next.
    Equal ids are ordered by text, null ids come last; other columns do not matter.
    """
    placed = with_next(docs, key, text).withColumn(
        "edited", F.when(~F.col("ahead"), edited_text(F.col("text"), F.col("next_text")))
    )
    # a row without a term carries what is known of the text itself, so that texts are shuffled once
    facts = ("id", "ahead", "n_chars", "edited_sha256")
    known = F.struct(
        F.col("id"),
        F.col("ahead"),
        F.char_length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
    )
    unknown = F.lit(None).cast("struct<id:bigint,ahead:boolean,n_chars:bigint,edited_sha256:string>")
    parts = F.array(
        F.struct(F.lit(0).alias("own"), F.lit(None).cast("string").alias("body"), known.alias("known")),
        F.struct(F.lit(1).alias("own"), F.col("text").alias("body"), unknown.alias("known")),
        F.struct(F.lit(0).alias("own"), F.col("edited").alias("body"), unknown.alias("known")),
    )
    by = ("cell", "place", "known")
    words = F.when(F.col("known").isNull(), F.split("body", SPACES)).otherwise(F.array(F.lit(None).cast("string")))
    terms = (
        placed.select("cell", "place", F.inline(parts))
        .select(*by, "own", F.explode(words).alias("word"))
        .where("word is null or word <> ''")
        .groupBy(*by, F.when(F.col("word").isNotNull(), F.xxhash64("word")).alias("term"))
        .agg(
            F.sum(F.when(F.col("word").isNotNull(), F.col("own"))).alias("own"),
            F.sum(F.when(F.col("word").isNotNull(), 1 - F.col("own"))).alias("edited"),
        )
    )
    mask = F.lit((1 << TAG_BITS) - 1)
    drawn_only = F.when(F.col("known").isNull(), F.struct("sample", "own", "edited"))
    drawn = (
        draw_samples(terms, samples, by, ("own", "edited"))
        .groupBy("cell", "place")
        .agg(F.array_sort(F.collect_list(drawn_only)).alias("drawn"), F.max("known").alias("known"))
        .select("cell", "place", "drawn", *[F.col("known")[c].alias(c) for c in facts])
    )
    none = F.array_repeat(F.lit(None).cast("bigint"), samples)

    def signature(kind: str) -> Column:
        return F.when(F.size("drawn") > 0, F.transform("drawn", _tag_of(kind, mask))).otherwise(none)

    joined = drawn.select("cell", "place", *facts, signature("own").alias("sig"), signature("edited").alias("edited_sig"))
    after = F.lead("sig").over(Window.partitionBy("cell").orderBy("place"))
    shown = lambda sig: F.array_join(
        F.transform(sig, lambda x: F.coalesce(F.lpad(F.lower(F.hex(x)), 5, "0"), F.lit("-----"))), ""
    )
    return (
        joined.withColumn("after", after)
        .where("not ahead")
        .select(
            F.col("id").alias(key),
            "n_chars",
            "edited_sha256",
            shown(F.col("sig")).alias("fingerprint"),
            shown(F.col("edited_sig")).alias("edited_fingerprint"),
            likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
            likeness(F.col("sig"), F.col("after")).alias("near_next"),
        )
    )
