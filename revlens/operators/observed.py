"""Row-local checks collected while a table is written (Q1, Q3, Q5, Q6).

``observe`` puts a check's counts on rows that flow to a sink anyway, so nulls,
negative and unaccepted values are known when the write ends, without reading the
table again. Uniqueness and foreign keys need a shuffle and stay checks of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from revlens import functions as RF
from revlens.operators.quality import Check

ROW_LOCAL = ("not_null", "non_negative", "accepted_values")


def _unaccepted(check: Check) -> Column:
    c = F.col(check.column)
    return F.when(c.isNotNull() & ~c.isin(list(check.values)), c)


class ObservedChecks:
    """Row-local ``checks`` of one table, counted by the first action that reads
    ``attach(df)`` to its end. Other kinds of checks are ignored."""

    def __init__(self, checks: Sequence[Check]):
        self.checks = [ch for ch in checks if ch.kind in ROW_LOCAL]
        self.observation = Observation()

    def attach(self, df: DataFrame) -> DataFrame:
        metrics = [F.count(F.lit(1)).alias("rows")]
        for i, ch in enumerate(self.checks):
            c = F.col(ch.column)
            if ch.kind == "not_null":
                metrics.append(RF.count_if(c.isNull()).alias(f"n{i}"))
            elif ch.kind == "non_negative":
                metrics.append(RF.count_if(c < 0).alias(f"n{i}"))
            else:  # distinct values: none, one (least = most), or more than these tell
                bad = _unaccepted(ch)
                metrics += [F.count(bad).alias(f"n{i}"), F.min(bad).alias(f"least{i}"), F.max(bad).alias(f"most{i}")]
        return df.observe(self.observation, *metrics)

    @property
    def rows(self) -> int:
        """Rows that flowed by; waits for the action. Where a stage ran twice because
        an executor was lost, rows may be counted twice: compare with the table."""
        return self.observation.get["rows"]

    def failures(self) -> list[int | None]:
        """Failures per check, as ``run_checks`` counts them; None for several distinct
        unaccepted values, whose number only a count over the table tells."""
        seen, out = self.observation.get, []
        for i, ch in enumerate(self.checks):
            n = seen[f"n{i}"] or 0
            if ch.kind == "accepted_values" and n:
                n = 1 if seen[f"least{i}"] == seen[f"most{i}"] else None
            out.append(n)
        return out
