"""Secret scans over a trigram inverted index.

Each rule's regex yields a Boolean query: alternatives, each a set of trigrams that any match of it
must contain. The index holds postings of the queries' trigrams; an aggregation intersects them into the
documents that satisfy an alternative, and only there the regex runs. A rule with an alternative that
has no trigram, such as a run of hexadecimal digits, is run over every text.
"""

from __future__ import annotations

from re import _constants as op
from re import _parser as parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_ALTERNATIVES = 64
GAP = None
REDACTED = "[secret]"


class Rule(NamedTuple):
    """``pattern`` as Java and Python both read it; a match counts if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# Fixed values. The last two patterns hold their least lengths: a shorter run has no match inside either.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)


def _joined(left: list, right: list) -> list:
    if left and right and left[-1] is not GAP and right[0] is not GAP:
        return [*left[:-1], left[-1] + right[0], *right[1:]]
    return [*left, *right]


def _alternatives(parsed) -> list[list]:
    """Ways to match: lists of literal strings with gaps. Too many ways become a gap."""
    ways: list[list] = [[]]
    for kind, value in parsed:
        if kind is op.LITERAL:
            found = [[chr(value)]]
        elif kind is op.IN and len(value) <= 3 and all(k is op.LITERAL for k, _ in value):
            found = [[chr(c)] for _, c in value]
        elif kind is op.SUBPATTERN:
            found = _alternatives(value[-1])
        elif kind is op.BRANCH:
            found = [way for branch in value[1] for way in _alternatives(branch)]
        elif kind is op.MAX_REPEAT and 1 <= value[0] <= 4:
            found = [[]]
            for _ in range(value[0]):
                found = [_joined(a, b) for a in found for b in _alternatives(value[2])][: MOST_ALTERNATIVES + 1]
            found = [[*way, GAP] for way in found] if value[1] != value[0] else found
        elif kind is op.AT:
            found = [[]]
        else:
            found = [[GAP]]
        if len(found) * len(ways) > MOST_ALTERNATIVES:
            found = [[GAP]]
        ways = [_joined(a, b) for a in ways for b in found]
    return ways


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of trigrams (lower case), one of which every match contains; None if any could do without."""
    found = set()
    for way in _alternatives(parser.parse(pattern)):
        texts = [text.lower() for text in way if text is not GAP]
        found.add(frozenset(text[k : k + 3] for text in texts for k in range(len(text) - 2)))
    least = [a for a in found if not any(b < a for b in found)]
    return None if frozenset() in found else sorted(least, key=sorted)


def postings(docs: DataFrame, trigrams: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverted index over ``trigrams``: a row (trigram's number, key) for each text that contains it."""
    lowered = docs.select(F.col(key).alias("key"), F.lower(F.col(text)).alias("lowered"))
    held = F.array_compact(F.array(*[F.when(F.contains("lowered", F.lit(t)), n) for n, t in enumerate(trigrams)]))
    return lowered.select(F.explode(held).alias("trigram"), "key")


def candidates(index: DataFrame, trigrams: list[str], queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """``key`` and a flag for each rule: whether some alternative's trigrams all list the key."""
    number = {t: n for n, t in enumerate(trigrams)}
    masks = {}
    for alternatives in queries.values():
        for alternative in alternatives:
            bits = {number[t]: 1 << k for k, t in enumerate(sorted(alternative)[:62])}
            bit = F.coalesce(*[F.when(F.col("trigram") == n, F.lit(b).cast("bigint")) for n, b in bits.items()])
            masks[alternative] = (F.bit_or(bit), sum(bits.values()))
    names = {alternative: f"mask{n}" for n, alternative in enumerate(masks)}
    met = index.groupBy("key").agg(*[mask.alias(names[a]) for a, (mask, _) in masks.items()])
    flags = []
    for kind, alternatives in queries.items():
        full = F.lit(False)
        for a in alternatives:
            full = full | F.coalesce(F.col(names[a]) == masks[a][1], F.lit(False))
        flags.append(full.alias(f"may_{kind}"))
    some = F.lit(False)
    for kind in queries:
        some = some | F.col(f"may_{kind}")
    return met.select("key", *flags).where(some)


def match_spans(text: Column, rule: Rule, order: int) -> Column:
    """(start, order, end) of the rule's matches, leftmost first; code points, end exclusive.

    Each search begins where the match before it ended and takes the characters in between along, so
    offsets are sums of lengths.
    """
    pattern = F.lit(rf"(?s)\G(.*?)({rule.pattern})")
    whole, match = F.regexp_extract_all(text, pattern, F.lit(0)), F.regexp_extract_all(text, pattern, F.lit(2))
    judged = F.regexp_extract_all(text, pattern, F.lit(2 + rule.group)) if rule.group else match
    empty = F.expr("cast(array() as array<struct<start:int,`order`:int,end:int>>)")

    def step(state: Column, found: Column) -> Column:
        end = state.getField("at") + F.char_length(found.getField("whole"))
        span = F.struct(
            (end - F.char_length(found.getField("match"))).alias("start"), F.lit(order).alias("order"), end.alias("end")
        )
        counts = F.char_length(found.getField("judged")) >= rule.least
        spans = F.when(counts, F.concat(state.getField("spans"), F.array(span))).otherwise(state.getField("spans"))
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(
        F.arrays_zip(whole.alias("whole"), match.alias("match"), judged.alias("judged")),
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        step,
        lambda state: state.getField("spans"),
    )


def with_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``row`` (all columns of the input), ``text`` (null made empty) and ``parts``, the spans of each rule."""
    source = docs.select(
        F.struct("*").alias("row"), F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: q for kind, q in queries.items() if q is not None}
    rows = source
    if indexed:
        trigrams = sorted({t for q in indexed.values() for a in q for t in a})
        may = candidates(postings(source, trigrams, "key"), trigrams, indexed).withColumnRenamed("key", "listed")
        rows = source.join(may, source["key"].eqNullSafe(may["listed"]), "left")
    none = F.expr("cast(array() as array<struct<start:int,`order`:int,end:int>>)")
    found = []
    for order, rule in enumerate(rules):
        wanted = F.col(f"may_{rule.kind}") if rule.kind in indexed else F.rlike("text", F.lit(rule.pattern))
        found.append(F.when(wanted, match_spans(F.col("text"), rule, order)).otherwise(none))
    return rows.select("row", "text", F.array(*found).alias("parts"))


def find_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All secrets of every whole text: a count for each kind and ``found``, spans in order.

    ``found`` is an array of (start, order, end), sorted; ``order`` numbers the rules. One row for each
    row; a null text is empty and has no secrets, a null or repeated key shares its postings with all rows
    of that key, which only makes more candidates. Other columns do not matter.
    """
    rows = with_secrets(docs.select(key, text), rules, key, text)
    counts = [F.size(F.col("parts")[n]).cast("bigint").alias(f"n_{rule.kind}") for n, rule in enumerate(rules)]
    return rows.select(F.col("row")[key].alias(key), *counts, F.array_sort(F.flatten("parts")).alias("found"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns, with every secret in ``text`` replaced by ``REDACTED``; overlapping ones once.

    A column ``n_chars``, if there is one, counts the new text's code points. A null text stays null.
    """
    rows = with_secrets(docs, rules, key, text).select("row", "text", F.array_sort(F.flatten("parts")).alias("found"))

    def step(state: Column, span: Column) -> Column:
        at, start, end = state.getField("at"), span.getField("start"), span.getField("end")
        added = F.concat(state.getField("out"), F.substr("text", at + 1, start - at), F.lit(REDACTED))
        return F.when(
            start >= at, F.struct(end.alias("at"), added.alias("out"))
        ).otherwise(F.struct(F.greatest(at, end).alias("at"), state.getField("out").alias("out")))

    cut = F.aggregate(
        "found",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda state: F.concat(state.getField("out"), F.substr("text", state.getField("at") + 1)),
    )
    clean = F.when(F.size("found") > 0, cut).otherwise(F.col("row")[text])
    ready = rows.select("row", clean.alias("clean"))
    columns = []
    for field in docs.schema.fields:
        value = F.col("row")[field.name]
        if field.name == text:
            value = F.col("clean")
        elif field.name == "n_chars":
            value = F.char_length("clean").cast(field.dataType)
        columns.append(value.alias(field.name))
    return ready.select(*columns)


def spans_text(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*[F.lit(rule.kind) for rule in rules])
    shown = F.transform(
        found,
        lambda s: F.concat_ws(
            ":",
            F.get(kinds, s.getField("order")),
            s.getField("start").cast("string"),
            s.getField("end").cast("string"),
        ),
    )
    return F.array_join(shown, ",")
