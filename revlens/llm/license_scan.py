"""License scan: exact set-similarity join of text blocks with license templates.

Method: a template is a set of words, ordered by how many documents of the corpus
hold each, the rarest first. A block that contains at least ``threshold`` of a
template's n words, i.e. need = ceil(threshold * n), must hold one of its first
n - need + 1: its prefix. Blocks are lines, and for notices wrapped over lines every
run of as many consecutive words as the template's text has, across line ends.

Lines with fewer words than need are out (length), as are those whose first common
word stands too far back for need words to follow (positional); the others are counted
exactly. Runs are looked at only around a prefix word near a line end (a run within a
line holds no more than the line), where its neighbourhood has need words. Only
DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import keyed

#: License notices and their labels.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("all-rights-reserved", "All rights reserved."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
)
#: The contract's phrases and labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
THRESHOLD = 0.8
_NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_NO_WORD_IN_LINE = r"[\x00-\x09\x0B-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: str) -> list[str]:
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def template_matches(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """did, tid, line (from 0), template (its number), containment for every block of a text
    that holds at least ``threshold`` of a template's distinct words; ``line`` is the line
    itself, or that of a prefix word next to which a run across line ends matches best.

    Words as in the scan; templates without words match nothing. Rows with equal doc_id and
    text give their lines once. ``templates`` is a short list, it goes into the plan.
    """
    sets = [sorted(set(words_of(t))) for _, t in templates]
    vocabulary = sorted({w for s in sets for w in s})
    base = keyed(docs).select("did", "tid", F.concat(F.lit(" "), F.regexp_replace(F.lower("text"), _NO_WORD_IN_LINE, " "), F.lit(" ")).alias("text"))
    # the global order: documents that hold each word of the templates (one row of counts)
    flat = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
    counts = base.select(flat.alias("flat")).agg(*(F.count_if(F.col("flat").contains(f" {w} ")).alias(f"n{i}") for i, w in enumerate(vocabulary))).first()
    frequency = {w: counts[i] for i, w in enumerate(vocabulary)}
    ordered = [sorted(s, key=lambda w: (frequency[w], w)) for s in sets]
    needs = [math.ceil(threshold * len(s) - 1e-9) for s in sets]
    prefix = sorted({w for s, need in zip(ordered, needs) if s for w in s[: len(s) - need + 1]})
    least = min((n for n, s in zip(needs, sets) if s), default=1)
    index = docs.sparkSession.createDataFrame(
        [(w, t, p, len(s), need) for t, (s, need) in enumerate(zip(ordered, needs)) for p, w in enumerate(s)],
        "word string, template int, place int, size int, need int",
    )
    lines = base.select("did", "tid", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    lines = lines.where(F.col("text").rlike(r"(?:^| )(?:" + "|".join(prefix) + r")(?: |$)")).select("did", "tid", "line", F.array_distinct(F.filter(F.split("text", " "), lambda w: w != "")).alias("words"))
    lines = lines.where((F.size("words") >= least) & F.arrays_overlap("words", F.lit(prefix))).distinct()
    found = lines.select("did", "tid", "line", F.size("words").alias("n"), F.explode("words").alias("word")).join(F.broadcast(index), "word")
    found = found.where("n >= need").groupBy("did", "tid", "line", "template", "size", "need").agg(F.count("*").alias("common"), F.min("place").alias("place"))
    found = found.where((F.col("place") <= F.col("size") - F.col("need")) & (F.col("common") >= F.col("need")))
    whole = found.select("did", "tid", "line", "template", (F.col("common") / F.col("size")).alias("containment"))
    anchors = docs.sparkSession.createDataFrame(
        [(w, t, s, len(words_of(templates[t][1])), need) for t, (s, need) in enumerate(zip(ordered, needs)) for w in s[: len(s) - need + 1]],
        "word string, template int, set array<string>, span int, need int",
    )
    wrapped = _wrapped(base, prefix, max((len(words_of(t)) for _, t in templates), default=1), anchors)
    return whole.unionByName(wrapped).groupBy("did", "tid", "line", "template").agg(F.max("containment").alias("containment"))


def _wrapped(base: DataFrame, prefix: list[str], reach: int, anchors: DataFrame) -> DataFrame:
    """did, tid, line, template, containment where a run of a template's number of words matches.

    Every run with a prefix word lies in the ``reach`` words to either side of it; those
    that stand in one line are left to the match of lines.
    """
    some = base.where(F.col("text").contains("\n") & F.col("text").rlike(r"[ \n](?:" + "|".join(prefix) + r")[ \n]")).distinct()
    words = F.flatten(F.transform(F.split("text", "\n"), lambda x, i: F.transform(F.filter(F.split(x, " "), lambda w: w != ""), lambda w: F.struct(w.alias("word"), i.alias("line")))))
    some = some.select("did", "tid", words.alias("words")).select("did", "tid", "words", F.size("words").alias("n"))
    at = F.filter(F.sequence(F.lit(1), "n"), lambda i: F.element_at("words", i)["word"].isin(prefix))
    low, high = lambda i: F.greatest(i - (reach - 1), F.lit(1)), lambda i: F.least(i + (reach - 1), F.col("n"))
    at = F.filter(at, lambda i: F.element_at("words", low(i))["line"] < F.element_at("words", high(i))["line"])
    near = F.transform(at, lambda i: F.struct(
        F.element_at("words", i)["line"].alias("line"), F.element_at("words", i)["word"].alias("word"),
        F.slice("words", low(i), high(i) - low(i) + 1)["word"].alias("near"),
    ))
    near = some.where("n > 0").select("did", "tid", F.explode(near).alias("x")).select("did", "tid", "x.*").join(F.broadcast(anchors), "word")
    near = near.where(F.size(F.array_intersect("near", "set")) >= F.col("need"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("near") - F.col("span") + 1, F.lit(1)))
    common = F.array_max(F.transform(starts, lambda i: F.size(F.array_intersect(F.slice("near", i, F.col("span")), "set"))))
    return near.withColumn("common", common).where("common >= need").select("did", "tid", "line", "template", (F.col("common") / F.size("set")).alias("containment"))


def _phrases(flat: Column) -> Column:
    """Per phrase: label, n, first and last word of its places; ``flat`` has each word between its own two spaces."""
    out = []
    for phrase, label in PHRASES:
        p = " " + phrase.replace(" ", "  ") + " "
        n = ((F.char_length(flat) - F.char_length(F.replace(flat, F.lit(p), F.lit("")))) / len(p)).cast("long")
        first = F.instr(flat, p) - 1
        last = F.char_length(flat) - F.instr(F.reverse(flat), p[::-1]) + 1 - len(p)

        def word(at: Column) -> Column:
            before = F.substring(flat, F.lit(1), at)
            return ((F.char_length(before) - F.char_length(F.replace(before, F.lit(" "), F.lit("")))) / 2).cast("long")

        out.append(F.struct(F.lit(label).alias("label"), n.alias("n"), word(first).alias("first"), word(last).alias("last")))
    return F.filter(F.array(*out), lambda x: x["n"] > 0)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row: doc_id, n_words, phrases (array of label, n, first, last), lines (array
    of line, label, containment of the templates found there, best first).

    Null text is empty: no words, no phrases, no lines. Words are runs of characters other
    than ASCII signs, controls and space; A-Z is folded. Rows are told apart by doc_id and
    text only where equal ones share their lines.
    """
    label = F.element_at(F.lit([x for x, _ in templates]), F.col("template") + 1)
    found = template_matches(docs, templates, threshold).groupBy("did", "tid").agg(
        F.sort_array(F.collect_list(F.struct("containment", "line", label.alias("label"))), asc=False).alias("lines")
    )
    one = F.trim(F.regexp_replace("text", _NO_WORD, " "))
    base = keyed(docs).withColumn("one", F.lower(one))
    flat = F.concat(F.lit(" "), F.replace(F.col("one"), F.lit(" "), F.lit("  ")), F.lit(" "))
    # ends of every phrase; other texts need no look
    phrases = F.when(F.col("one").contains(" license"), _phrases(flat)).otherwise(F.array().cast("array<struct<label:string,n:bigint,first:bigint,last:bigint>>"))
    n_words = F.when(F.col("one") == "", F.lit(0)).otherwise(F.char_length("one") - F.char_length(F.replace(F.col("one"), F.lit(" "), F.lit(""))) + 1)
    thin = base.select("doc_id", "did", "tid", n_words.cast("long").alias("n_words"), phrases.alias("phrases"))
    out = thin.join(found, ["did", "tid"], "left")
    return out.select("doc_id", "n_words", "phrases", F.coalesce("lines", F.array().cast("array<struct<containment:double,line:int,label:string>>")).alias("lines"))


def op6_license_scans(docs: DataFrame) -> DataFrame:
    """score: 1 for a phrase, else the best containment of a template in a line or a run across line ends, else 0."""
    found = scan_licenses(docs)
    labels = F.transform("phrases", lambda p: p["label"])
    more = F.transform("lines", lambda x: x["label"])
    join = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return found.select(
        "doc_id", "n_words", F.aggregate("phrases", F.lit(0).cast("long"), lambda a, p: a + p["n"]).alias("n_base"),
        F.array_min(F.transform("phrases", lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform("phrases", lambda p: p["last"])).alias("last_word"),
        join(labels).alias("base_labels"), join(F.concat(labels, more)).alias("labels"),
        F.when(F.size("phrases") > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.transform("lines", lambda x: x["containment"])), F.lit(0.0))).alias("score"),
    )


ORACLE = rf"""
with templates(label, tw) as (values
  {', '.join("('" + label + "', [" + ', '.join("'" + w + "'" for w in sorted(set(words_of(t)))) + "])" for label, t in TEMPLATES)}
), phrases(label, p) as (values {', '.join("('" + label + "', [" + ', '.join("'" + w + "'" for w in p.split()) + "])" for p, label in PHRASES)}
), docs as (
  select row_number() over () as rid, doc_id, lower(coalesce(text, '')) as t,
    list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents
), places as (
  select rid, label, i - 1 as spot from (select rid, w, label, p, unnest(range(1, len(w) - len(p) + 2)) as i from docs, phrases where len(w) >= len(p))
  where w[i : i + len(p) - 1] = p
), lines as (
  select rid, list_distinct(list_filter(regexp_split_to_array(line, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) as lw
  from (select rid, unnest(string_split(t, chr(10))) as line from docs)
), hits as (
  select rid, label, len(list_intersect(lw, tw)) / len(tw)::double as c from lines, templates where len(list_intersect(lw, tw)) / len(tw)::double >= {THRESHOLD} - 1e-9
), base as (
  select rid, count(*) as n, min(spot) as lo, max(spot) as hi, array_to_string(list_sort(list(distinct label)), ',') as labels from places group by rid
), found as (
  select rid, array_to_string(list_sort(list(distinct label)), ',') as labels from (select rid, label from places union all select rid, label from hits) group by rid
), best as (select rid, max(c) as c from hits group by rid)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(b.n, 0)::bigint as n_base, b.lo::bigint as first_word, b.hi::bigint as last_word,
  coalesce(b.labels, '') as base_labels, coalesce(f.labels, '') as labels, case when b.n > 0 then 1.0 else coalesce(x.c, 0.0) end::double as score
from docs d left join base b using (rid) left join found f using (rid) left join best x using (rid)
"""
