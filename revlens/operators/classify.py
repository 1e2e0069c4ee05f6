"""Reference-data lookups and keyword-rule classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rules per CASE expression; further rules follow in further expressions.
RULES_PER_CASE = 100
# Rules that are tried one after the other; more are for operators.rule_index.
MOST_RULES = 5_000


def map_lookup(
    df: DataFrame,
    mapping: DataFrame,
    on: str,
    defaults: Mapping[str, object],
) -> DataFrame:
    """Left join a (unique-keyed) mapping table; unmatched rows get ``defaults``.

    No hint: Spark broadcasts the mapping when its bytes are under the session's
    threshold, so the large side is not shuffled, and else plans a shuffle join
    that AQE can split.
    """
    m = mapping.select(on, *[F.col(c).alias(f"__m_{c}") for c in defaults])
    joined = df.join(m, on=on, how="left")
    out = [F.col(c) for c in df.columns]
    out += [F.coalesce(F.col(f"__m_{c}"), F.lit(v)).alias(c) for c, v in defaults.items()]
    return joined.select(*out)


def classify_by_rules(
    df: DataFrame,
    text: Column,
    rules: DataFrame,
    out_col: str = "subcategory",
    default: str = "Uncategorized",
    label: str = "subcategory",
    pattern: str = "keyword_pattern",
    priority: str = "priority",
    rules_per_case: int = RULES_PER_CASE,
) -> DataFrame:
    """Label each row with its best-matching regex rule.

    A rule matches when its pattern occurs anywhere in ``text`` (unanchored
    regex search). Among matching rules the highest ``priority`` wins (null
    last), then the alphabetically first label; rows with no match get
    ``default``.

    The ordered rules (reference data) become CASE WHEN ... RLIKE expressions of
    ``rules_per_case`` rules each, the first that matches counts: no join, no
    shuffle, patterns compiled once per task, rows judged one by one. The work is
    rows times rules: more than ``MOST_RULES`` raise ValueError, and
    ``rule_index.classify_by_rule_index`` gives the same result for them.
    """
    order = [F.col(priority).desc_nulls_last(), F.col(label).asc(), F.col(pattern).asc()]
    ordered = rules.select(label, pattern, priority).orderBy(*order).limit(MOST_RULES + 1).collect()
    if len(ordered) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules: use classify_by_rule_index")
    cases = first_match(text, [(r[pattern], F.lit(r[label])) for r in ordered], rules_per_case)
    return df.withColumn(out_col, F.coalesce(*cases, F.lit(default)))


def first_match(text: Column, values: Sequence[tuple[str, Column]], rules_per_case: int = RULES_PER_CASE) -> list[Column]:
    """CASE expressions whose coalesce is the value of the first pattern in ``text``."""
    cases = []
    for at in range(0, len(values), rules_per_case):
        case = F
        for pattern, value in values[at : at + rules_per_case]:
            case = case.when(text.rlike(pattern), value)
        cases.append(case)
    return cases
