"""The point-in-time join against DuckDB's range join."""

import datetime as dt
import random

import duckdb
import pytest

from revlens.operators.asof import as_of_join

DAY = dt.datetime(2020, 1, 1)


def history(seed=3):
    """Versions without overlaps, some with gaps, some open; one with a null key."""
    r, out = random.Random(seed), []
    for k in ["a", "b", "c", "hot", "hot2"]:
        t = r.randint(-5, 30)
        for i in range(0 if k == "c" else 12):
            end = t + r.randint(1, 25)
            out.append((k, f"{k}{i}", DAY + dt.timedelta(days=t), None if i == 11 else DAY + dt.timedelta(days=end)))
            t = end + (r.random() < 0.3) * 3
    out.append((None, "null", DAY, None))
    return out


def facts(n, seed=4):
    """A third of the facts on one key, half of these at one instant; null keys and times."""
    r, out = random.Random(seed), []
    for i in range(n):
        k = r.choices(["a", "b", "c", "hot", "hot2", None, "none"], [1, 1, 1, 4, 3, 2, 1])[0]
        day = 60 if k == "hot" and r.random() < 0.5 else r.randint(-10, 300)
        out.append((i // 2, k, None if r.random() < 0.05 else DAY + dt.timedelta(days=day, hours=r.choice([0, 0, 7]))))
    return out


@pytest.mark.parametrize("rows_per_range", [7, 40, 10**6])
def test_equals_a_range_join(spark, rows_per_range):
    f = spark.createDataFrame(facts(900), "i long, k string, happened timestamp_ntz").repartition(4)
    v = spark.createDataFrame(history(), "k string, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    got = as_of_join(f, v, "k", "happened", ["name", "valid_from"], rows_per_range=rows_per_range)
    con = duckdb.connect()
    con.execute("create table f(i bigint, k varchar, happened timestamp); create table v(k varchar, name varchar, valid_from timestamp, valid_to timestamp)")
    con.executemany("insert into f values (?, ?, ?)", facts(900))
    con.executemany("insert into v values (?, ?, ?, ?)", history())
    want = con.sql(
        "select i, f.k, happened, name, valid_from from f left join v on f.k = v.k and happened >= valid_from and (valid_to is null or happened < valid_to)"
    )
    assert got.columns == want.columns
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want.fetchall()))


def test_empty_sides_and_clashing_names(spark):
    f = spark.createDataFrame([("a", DAY, "own", 1)], "k string, t timestamp_ntz, name string, part int")
    v = spark.createDataFrame([], "k string, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    assert [tuple(r) for r in as_of_join(f, v, "k", "t", ["name"]).collect()] == [("a", DAY, 1, None)]
    assert as_of_join(f.limit(0), v, "k", "t", ["name"]).count() == 0


def test_versions_that_begin_at_once(spark):
    rows = [("a", "ended", DAY, DAY), ("a", "open", DAY, None)]
    v = spark.createDataFrame(rows, "k string, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    f = spark.createDataFrame([("a", DAY)], "k string, t timestamp_ntz")
    assert as_of_join(f, v, "k", "t", ["name"]).first()["name"] == "open"


def test_no_pairs_in_the_plan(spark):
    f = spark.createDataFrame(facts(50), "i long, k string, happened timestamp_ntz")
    v = spark.createDataFrame(history(), "k string, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    plan = as_of_join(f, v, "k", "happened", ["name"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
