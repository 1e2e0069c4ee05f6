"""The literal index against trying every rule on every text."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revlens.functions.patterns import mandatory_literals
from revlens.operators import rule_index
from revlens.operators.rule_index import classify_by_rule_index, rule_grams

RULES = "subcategory string, keyword_pattern string, priority int"


@pytest.mark.parametrize("pattern, want", [
    ("hair mask|scalp", [("hair mask", True), ("scalp", True)]),
    ("ab+cd", [("ab", False)]), ("ab*cd", [("cd", False)]), ("a?bc", [("bc", False)]), ("abc{2}de", [("ab", False)]),
    ("x.yzw", [("yzw", False)]), ("^start|end$", [("start", False), ("end", False)]),
    (r"a\.b", [("a.b", True)]), (r"\bword\b", [("word", False)]), ("pre(a|b)suffix", [("suffix", False)]),
    ("[ab]cd", [("cd", False)]), ("[]x]yz", [("yz", False)]), ("(?:x|y)zz", [("zz", False)]), ("ab+?cc", [("ab", False)]),
    (".*", None), ("a?", None), ("abc|", None), ("(?i)abc", None), (r"\x41bc", None), (r"\Qa.b\E", None), ("[a[b]]c", None),
    ("(a|b)", None), ("", None), (None, None), ("a(b", None), ("a[b", None), ("*a", None), ("a{", None), ("abc\\", None),
])
def test_mandatory_literals(pattern, want):
    assert mandatory_literals(pattern) == want


_ATOM = st.sampled_from(["a", "b", "ab", "ba", ".", "a+", "b*", "a?", "(a|b)", "(?:ab)", "[ab]", "[^a]", r"\.", r"\w", "a{2}", "^", "$", " "])


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(_ATOM, max_size=5).map("".join), min_size=1, max_size=3).map("|".join), st.lists(st.text("ab. ", max_size=12), max_size=20))
def test_a_match_holds_a_literal(pattern, texts):
    found = mandatory_literals(pattern)
    for text in texts:
        if found is not None and re.search(pattern, text):
            assert any(literal in text for literal, _ in found)
        if found and all(exact for _, exact in found):
            assert bool(re.search(pattern, text)) == any(literal in text for literal, _ in found)


def brute(rows, rules):
    out = []
    for i, text in rows:
        hits = [r for r in rules if text is not None and r[0] is not None and r[1] is not None and re.search(r[1], text)]
        hits.sort(key=lambda r: (r[2] is None, -(r[2] or 0), r[0], r[1]))
        out.append((i, hits[0][0] if hits else "Uncategorized"))
    return sorted(out, key=str)


def check(spark, rows, rules):
    df = spark.createDataFrame([(i, t, "own") for i, t in rows], "i int, text string, subcategory string").repartition(3)
    got = classify_by_rule_index(df, F.col("text"), spark.createDataFrame(rules, RULES))
    assert got.columns == ["i", "text", "subcategory"]
    assert sorted(((r["i"], r["subcategory"]) for r in got.collect()), key=str) == brute(rows, rules)


def test_many_rules(spark):
    r = random.Random(2)
    words = ["".join(r.choices("abcdefgh", k=r.randint(1, 9))) for _ in range(1500)]
    rules = [(f"L{i % 400}", "|".join(r.sample(words, r.randint(1, 3))), r.choice([None, 0, 1, 2, 50])) for i in range(2500)]
    rules += [("wild", w[:2] + "." + w[3:], 40) for w in words if len(w) > 6][:200]
    rows = [(i, " ".join(r.choices(words, k=r.randint(0, 30)))) for i in range(150)]
    check(spark, rows, rules)


def test_odd_rows_and_rules(spark):
    same = "a text that a third of the rows repeat, with token42"
    rows = [(i, same) for i in range(40)] + [(50, None), (51, ""), (52, "x" * 20_000 + " needle"), (53, "Ünïcode 😀 emoji"), (54, "line\nbreak here"), (55, "9%")]
    rules = [
        ("t", "token[0-9]+", 5), ("t2", "token[0-9]+", 5), ("n", "needle", 1), ("e", "😀 emo", 2), ("b", "line.break", 3), ("c", "k h", None),
        ("dup", "needle", 1), ("dup", "needle", 1), (None, "token", 99), ("x", None, 99), ("any digit", "[0-9]%?$", 0), ("A space", "^$", 7), ("A", "^$", 7),
    ]
    check(spark, rows, rules)
    check(spark, rows, [])
    check(spark, [], rules)


def test_too_many_rules_without_literals(spark, monkeypatch):
    monkeypatch.setattr(rule_index, "MOST_UNINDEXED", 2)
    rules = spark.createDataFrame([(f"l{i}", f"[{i}]+", 1) for i in range(3)], RULES)
    with pytest.raises(ValueError, match="without a mandatory literal"):
        classify_by_rule_index(spark.createDataFrame([("a",)], "t string"), F.col("t"), rules)


def test_rules_are_looked_up_not_tried(spark):
    rules = [(f"l{i}", f"literal{i}|other{i}", 1) for i in range(300)]
    df = spark.createDataFrame([("has literal7 in it",)], "t string")
    plan = classify_by_rule_index(df, F.col("t"), spark.createDataFrame(rules, RULES))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("RLIKE") <= 4 and "literal7" not in plan  # a column's pattern, not a chain of constants


def test_a_literal_gives_its_rarest_gram(spark):
    rules = spark.createDataFrame([("r1", "l", "hair mask", 1.0), ("r2", "l", "hair dye", 1.0), ("r3", "l", "hair oil|a.", 1.0)], "rule string, label string, pattern string, priority double")
    rows = rule_grams(rules).collect()
    assert len(rows) == 4 and all(r["gram"] is not None for r in rows)
    assert {(r["literal"], r["exact"], r["size"]) for r in rows} == {("hair mask", True, 8), ("hair dye", True, 8), ("hair oil", True, 8), ("a", False, 1)}


def test_rules_of_one_pattern_are_one_candidate(spark, monkeypatch):
    kept = {}
    monkeypatch.setattr(rule_index, "materialize", lambda df, name, **kw: kept.setdefault(name.rsplit("-", 1)[0], df.cache()))
    rules = [(f"l{i:03}", "hair mask|sc.lp", i % 7) for i in range(300)] + [(f"m{i:03}", f"hair mask|only{i}", 2) for i in range(50)] + [("n", "[0-9]", i) for i in range(9)]
    rows = [(0, "a hair mask"), (1, "the scalp"), (2, "only7 and more"), (3, "7"), (4, "none")]
    check(spark, rows, rules)
    index = kept["rule-index"].collect()
    assert sorted(r["literal"] for r in index if r["gram"] is not None) == sorted(["hair mask", "sc", *[f"only{i}" for i in range(50)]])
    assert len(index) == 53


def test_grams_of_long_texts(monkeypatch):
    text = "".join(random.Random(1).choices("abc😀 ", k=500))
    whole = {n: {int(h) for g in rule_index.gram_hashes(text, [n]) for h in g} for n in rule_index.GRAMS}
    monkeypatch.setattr(rule_index, "_CHARACTERS", 7)
    for n, want in whole.items():
        assert {int(h) for g in rule_index.gram_hashes(text, [n]) for h in g} == want
        assert len(want) == len({text[i : i + n] for i in range(len(text) - n + 1)})
