"""A warehouse build whose writes collect the row-local column tests."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.observed import ROW_LOCAL, ObservedChecks
from revlens.operators.quality import run_checks
from revlens.plans.checks import INPUTS, model_checks, suite_models
from revlens.plans.warehouse import SHARED_MODELS, Warehouse


class ObservedWarehouse(Warehouse):
    """``Warehouse`` in table mode; every model, input and step that has row-local tests
    carries them along to the write that reads it."""

    def __init__(self, *args, **kw):
        super().__init__(*args, **{"materialize": "table", **kw})
        if self.materialize != "table":
            raise ValueError("tests are observed on writes: materialize='table'")
        self.seen: dict[str, ObservedChecks] = {}
        for name, attribute in INPUTS.items():
            setattr(self, attribute, self.observed(name, getattr(self, attribute)))

    def observed(self, name: str, df: DataFrame) -> DataFrame:
        checks = [ch for ch in model_checks(None, name) if ch.kind in ROW_LOCAL]
        if not checks or name in self.seen:  # the first plan is the one that a write reads
            return df
        self.seen[name] = ObservedChecks(checks)
        return self.seen[name].attach(df)

    def _keep(self, name: str, df: DataFrame, partition_by: tuple = ()) -> DataFrame:
        if name in SHARED_MODELS:
            return super()._keep(name, self.observed(name, df), partition_by)
        return df

    def test_results(self) -> DataFrame:
        """(model, check, column, failures) of every test, after ``build``.

        Row-local tests come from the writes. A model is read only for uniqueness and
        foreign keys, for the number of several unaccepted values, and whole if its
        write counted other rows than it holds (a stage that ran twice).
        """
        out, known = None, []
        for name in suite_models():
            table = getattr(self, INPUTS[name]) if name in INPUTS else self.table(name)
            checks = model_checks(self, name)
            seen = self.seen.get(name)
            failures: dict[int, int | None] = {}
            if seen and (name not in self._written or seen.rows == table.count()):  # a count of footers
                local = [i for i, ch in enumerate(checks) if ch.kind in ROW_LOCAL]
                failures = dict(zip(local, seen.failures()))
            known += [(name, checks[i].kind, checks[i].column, n) for i, n in failures.items() if n is not None]
            rest = [ch for i, ch in enumerate(checks) if failures.get(i) is None]
            if rest:
                part = run_checks(table, rest).select(F.lit(name).alias("model"), "check", "column", "failures")
                out = part if out is None else out.unionByName(part)
        rows = self.spark.createDataFrame(known, "model string, check string, column string, failures long")
        return rows if out is None else rows.unionByName(out)


def _observed_model(name: str):
    make = Warehouse.__dict__[name].func
    if name in SHARED_MODELS:  # observed where they are written
        return make
    return lambda self: self.observed(name, make(self))


for _name in suite_models():
    if _name not in INPUTS:
        _property = cached_property(_observed_model(_name))
        _property.__set_name__(ObservedWarehouse, _name)
        setattr(ObservedWarehouse, _name, _property)
