"""Property tests: operators against brute-force models on generated inputs.

Spark runs are batched — each example is a whole generated table — so a
handful of examples covers thousands of rows.
"""

import datetime as dt
import hashlib
import math
import os

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revlens import functions as RF
from revlens.operators.dedupe import keep_best
from revlens.operators.scd2 import scd2_apply
from revlens.operators.skew import split_hot_join
from revlens.sources.sampling import sample_n

# REVLENS_PROPERTY_EXAMPLES raises the number of generated tables for a deeper run
SETTINGS = settings(
    max_examples=int(os.environ.get("REVLENS_PROPERTY_EXAMPLES", "8")),
    deadline=None,
    suppress_health_check=list(HealthCheck),
)

finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)
halves = st.integers(-200000, 200000).map(lambda i: i / 8)  # many exact .5 / .25 / .125 cases


@SETTINGS
@given(st.lists(st.one_of(finite, halves), min_size=50, max_size=300), st.integers(0, 3))
def test_round_half_away_matches_duckdb(spark, values, digits):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(RF.round_half_away("x", digits)).collect()]
    con = duckdb.connect()
    con.execute("create table t(i int, x double)")
    con.executemany("insert into t values (?, ?)", list(enumerate(values)))
    want = [r[0] for r in con.execute(f"select round(x, {digits}) from t order by i").fetchall()]
    assert got == want


price_text = st.text(alphabet="0123456789._-+eEdDfF $,", min_size=0, max_size=8)


@SETTINGS
@given(st.lists(price_text, min_size=30, max_size=120))
def test_parse_price_matches_duckdb(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, p string")
    got = [r[0] for r in df.orderBy("i").select(RF.parse_price("p")).collect()]
    con = duckdb.connect()
    for t, g in zip(texts, got):
        want = None if t in ("None", "") else con.execute("select try_cast(? as double)", [t]).fetchall()[0][0]
        if want is not None and math.isnan(want):
            assert g is not None and math.isnan(g), t
        else:
            assert g == want, (t, g, want)


rows_kv = st.lists(
    st.tuples(st.sampled_from("abcd"), st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5)),
              st.integers(0, 5), st.text(alphabet="xyz", max_size=2)),
    min_size=1, max_size=80,
)


@SETTINGS
@given(rows_kv)
def test_keep_best_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, k2 int, length int, votes int, tb string")
    out = keep_best(df, ["k", "k2"], [F.col("length").desc_nulls_last(), F.col("votes").desc_nulls_last()], tiebreak=["tb"])
    got = sorted(tuple(r) for r in out.collect())
    best = {}
    for r in rows:
        key = (r[0], r[1])
        rank = (-(r[2] if r[2] is not None else -math.inf), -r[3], r[4])
        if key not in best or rank < best[key][0]:
            best[key] = (rank, r)
    want = sorted((v[1] for v in best.values()), key=str)
    # order + tiebreak cover every column, so the kept row is fully determined
    assert sorted(got, key=str) == want


loads = st.lists(
    st.dictionaries(st.sampled_from(["a", "b", "c", "d", "e"]),
                    st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 2)), max_size=5),
    min_size=1, max_size=4,
)


def scd2_model(batches):
    """Brute-force type-2 history: list of (key, value, other, valid_from, valid_to)."""
    hist = []
    for t, load in enumerate(batches):
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(days=t)
        open_rows = {h[0]: i for i, h in enumerate(hist) if h[4] is None}
        for key, (val, other) in load.items():
            if key in open_rows:
                i = open_rows[key]
                if hist[i][1] != val:  # null-safe: None == None
                    hist[i] = hist[i][:4] + (ts,)
                    hist.append((key, val, other, ts, None))
            else:
                hist.append((key, val, other, ts, None))
    return sorted(hist, key=str)


@SETTINGS
@given(loads)
def test_scd2_matches_brute_force(spark, batches):
    history = None
    for t, load in enumerate(batches):
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(days=t)
        cur = spark.createDataFrame([(k, v, o) for k, (v, o) in load.items()], "id string, val string, other int")
        history = scd2_apply(history, cur, "id", ["val"], ts)
        history = spark.createDataFrame(history.collect(), history.schema)  # keep test plans small
    got = sorted(((r.id, r.val, r.other, r.valid_from, r.valid_to) for r in history.collect()), key=str)
    model = scd2_model(batches)
    # 'other' is untracked: the open version keeps the value of the load that opened it
    assert [(k, v, f, to) for k, v, _, f, to in got] == [(k, v, f, to) for k, v, _, f, to in model]


@SETTINGS
@given(st.lists(st.sampled_from(["h", "h", "h", "a", "b", "c", None]), min_size=1, max_size=200),
       st.integers(1, 20))
def test_split_hot_join_equals_plain_join(spark, keys, per_split):
    fact = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int")
    dim = spark.createDataFrame([("h", 1), ("a", 2), ("z", 3)], "k string, d int")
    for how in ("left", "inner", "left_anti"):
        want = sorted(map(tuple, fact.join(dim, "k", how).collect()), key=str)
        got = sorted(map(tuple, split_hot_join(fact, dim, "k", how, rows_per_split=per_split).collect()), key=str)
        assert got == want, how


@SETTINGS
@given(st.sets(st.text(alphabet="abcdef0123", min_size=1, max_size=6), min_size=1, max_size=150),
       st.integers(1, 40), st.integers(0, 99))
def test_sample_n_is_the_smallest_hashes(spark, keys, n, seed):
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = sorted(r.k for r in sample_n(df, n, seed, "k").collect())
    want = sorted(sorted(keys, key=lambda k: (hashlib.md5(f"{seed}{k}".encode()).hexdigest(), k))[:n])
    assert got == want
