"""Checks observed on writes against checks that read the tables."""

import pytest
from pyspark.sql import functions as F

from revlens.operators.observed import ObservedChecks
from revlens.operators.quality import Check, run_checks
from revlens.plans.checks import run_suite
from revlens.plans.observed import ObservedWarehouse
from revlens.sources.fixtures import Inputs
from tests.conftest import SF_SMALL

CHECKS = [
    Check("not_null", "a"), Check("non_negative", "a"), Check("accepted_values", "b", values=["x", "y"]), Check("not_null", "b"),
    Check("unique", "a"), Check("accepted_values", "c", values=[1]),
]


def table(spark, rows):
    return spark.createDataFrame(rows, "a int, b string, c int")


@pytest.mark.parametrize("rows", [
    [], [(1, "x", 1), (None, None, None)], [(-1, "z", 2), (-2, "z", 1), (3, "y", 2)], [(1, "p", 3), (1, "q", 4), (2, "p", 3)],
])
def test_counts_of_a_write(spark, tmpdir_path, rows):
    df, seen = table(spark, rows), ObservedChecks(CHECKS)
    seen.attach(df).write.parquet(f"{tmpdir_path}/t")
    want = [r["failures"] for r in run_checks(df, seen.checks).collect()]
    assert seen.rows == len(rows) == spark.read.parquet(f"{tmpdir_path}/t").count()
    for got, n in zip(seen.failures(), want):
        assert got == n or got is None and n > 1


def test_whole_suite_equals_reading_the_tables(spark, tmpdir_path):
    i = Inputs(spark, SF_SMALL)
    wh = ObservedWarehouse(i.reviews(), i.products(), i.mapping(), i.rules(), output_root=f"{tmpdir_path}/marts")
    wh.build(threads=3)
    key = lambda df: sorted(map(tuple, df.select("model", "check", "column", "failures").collect()))
    got = wh.test_results()
    assert key(got) == key(run_suite(wh)) and got.count() == 99
    # only uniqueness, foreign keys and columns with several unaccepted values read tables
    plan = got._jdf.queryExecution().executedPlan().toString()
    for model in ("dim_categories", "mart_category_performance", "fct_reviews_monthly"):
        assert f"{tmpdir_path}/marts/{model}" not in plan
    assert f"{tmpdir_path}/marts/fct_reviews" in plan


def test_a_write_that_counted_rows_twice_is_read_again(spark, tmpdir_path, monkeypatch):
    i = Inputs(spark, SF_SMALL)
    wh = ObservedWarehouse(i.reviews(), i.products(), i.mapping(), i.rules(), output_root=f"{tmpdir_path}/marts")
    wh.build(threads=3)
    want = sorted(map(tuple, wh.test_results().collect()))
    seen = wh.seen["dim_categories"]
    monkeypatch.setattr(ObservedChecks, "rows", property(lambda s: -1 if s is seen else s.observation.get["rows"]))
    monkeypatch.setattr(ObservedChecks, "failures", lambda s: [5] * len(s.checks) if s is seen else FAILURES(s))
    assert sorted(map(tuple, wh.test_results().collect())) == want


FAILURES = ObservedChecks.failures


def test_needs_table_mode(spark):
    i = Inputs(spark, SF_SMALL)
    with pytest.raises(ValueError):
        ObservedWarehouse(i.reviews(), i.products(), i.mapping(), i.rules(), materialize="ephemeral")
    assert F is not None
