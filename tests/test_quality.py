"""Quality checks on a table with planted failures (FIXTURES.md FX6)."""

from revlens.operators import quality as Q

FX6 = [
    # id, fk, bucket, rating, n
    ("a", "p1", "x", 1, 1),
    (None, "p1", "x", 2, 2),      # null id
    ("b", "p1", "x", 3, 3),
    ("b", "p2", "y", 4, 4),       # duplicated id
    ("c", "p9", "x", 5, 5),       # fk without parent
    ("d", None, "x", 1, 6),       # null fk passes
    ("e", "p1", "z", 2, 7),       # bucket outside its list
    ("f", "p1", None, 3, 8),      # null bucket passes
    ("g", "p2", "y", 4, -1),      # negative
    ("h", "p2", "y", 5, None),    # null n passes
]
SCHEMA = "id string, fk string, bucket string, rating int, n bigint"


def fx6(spark):
    return spark.createDataFrame(FX6, SCHEMA)


def parents(spark):
    return spark.createDataFrame([("p1",), ("p2",), ("p2",)], "pid string")


def test_each_check_finds_one_failure(spark):
    df = fx6(spark)
    assert Q.check_not_null(df, "id").count() == 1
    dup = Q.check_unique(df, "id").collect()
    assert [(r.unique_field, r.n_records) for r in dup] == [("b", 2)]
    bad = Q.check_accepted_values(df, "bucket", ["x", "y"]).collect()
    assert [(r.value_field, r.n_records) for r in bad] == [("z", 1)]
    orphans = Q.check_relationship(df, "fk", parents(spark), "pid").collect()
    assert [r.id for r in orphans] == ["c"]
    assert [r.id for r in Q.check_non_negative(df, "n").collect()] == ["g"]


def test_numeric_accepted_values(spark):
    df = fx6(spark)
    assert Q.check_accepted_values(df, "rating", [1, 2, 3, 4, 5]).count() == 0
    assert Q.check_accepted_values(df, "rating", [1, 2, 3]).count() == 2


def test_run_checks_reports_whole_suite(spark):
    df = fx6(spark)
    checks = [
        Q.Check("not_null", "id"),
        Q.Check("unique", "id"),
        Q.Check("accepted_values", "bucket", values=["x", "y"]),
        Q.Check("relationship", "fk", parent=parents(spark), parent_field="pid"),
        Q.Check("non_negative", "n"),
        Q.Check("not_null", "rating"),
    ]
    got = [(r.check, r.column, r.failures) for r in Q.run_checks(df, checks).collect()]
    assert got == [
        ("not_null", "id", 1),
        ("unique", "id", 1),
        ("accepted_values", "bucket", 1),
        ("relationship", "fk", 1),
        ("non_negative", "n", 1),
        ("not_null", "rating", 0),
    ]


def test_warehouse_suite_covers_every_model(spark):
    from revlens.plans.checks import SUITE, run_suite
    from revlens.plans.queries import warehouse
    from tests.conftest import SF_SMALL

    assert len(SUITE) == 99
    rows = run_suite(warehouse(spark, SF_SMALL)).collect()
    assert len(rows) == 99
    failing = {(r.model, r.check, r.column) for r in rows if r.failures}
    # the fixture plants null product ids and uses its own category groups
    assert failing == {("raw_products", "not_null", "parent_asin"), ("stg_products", "accepted_values", "category_group")}
