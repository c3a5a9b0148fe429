"""Licences: base phrases and all detections against plain Python, known texts, long texts."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from mlspark.llm import licenses as X
from mlspark.llm import spans

GAP = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
RULES = X.all_rules()
KNOWN = {
    "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0-or-later",
    "SPDX-License-Identifier: MIT": "mit",
    "license = \"BSD-3-Clause\"": "bsd-3-clause",
    "This work is licensed under the GNU General Public License, version 3.": "gpl,gpl-3.0",
    "Released under the MIT License.": "mit",
    "Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.": "apache,apache-2.0",
    "see http://www.apache.org/licenses/LICENSE-2.0 for it": "apache-2.0",
    "GNU Lesser General Public License v2.1": "gpl,lgpl-2.1",
    "under the GPLv3": "gpl-3.0",
    "Creative Commons Attribution-ShareAlike 4.0": "cc-by-sa-4.0",
    "CC BY-NC 3.0": "cc-by-nc-3.0",
    "dedicated: this work is released into the public domain": "public-domain",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": "mit",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:": "bsd",
    "Er kam mit der Lizenz nach Hause": "",
    "driving license and a mit general hospital": "",
}


def words(text):
    return re.findall(GAP, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    w = words(text)
    at = sorted((i, label) for p, label in PHRASES.items() for i in range(len(w)) if tuple(w[i : i + len(p)]) == p)
    labels = ",".join(sorted({label for _, label in at}))
    return len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, labels


def plain(text):
    """All detections, each compared with each other one."""
    form = f" {' '.join(words(text))} "
    found = []
    for i, r in enumerate(RULES):
        for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", form):
            a = form[: m.start()].count(" ") - 1
            found.append((a, a + m.group().count(" "), r.kind, i, r.label))
    found.sort(key=lambda d: (d[0], -d[1], *d[2:]))
    kept = [
        d
        for i, d in enumerate(found)
        if not any(e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2] and (e[:3] != d[:3] or j < i) for j, e in enumerate(found) if j != i)
    ]
    return found, kept


def expected(text):
    found, kept = plain(text)
    labels = {d[4] for d in kept} | set(base(text)[4].split(",")) - {""}
    return (*base(text), ",".join(sorted(labels)), max((X.WEIGHTS[d[2]] for d in kept), default=0.0))


def texts():
    rng = random.Random(6)
    parts = [*KNOWN, "mit", "MIT", "License", "license,", "Apache", "General Public", "GNU", "version 2", "or any later version", "é", "漢字", "K", "İ", "MIT\n\n# License", "x_y", "BSD", "v2", "2.0", "gpl"]
    out = [None, "", " .,- ", "mit license mit license", "apache mit license license", "GENERAL public\nLICENSE", *KNOWN]
    out += [rng.choice([" ", "\n", ", "]).join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(150)]
    return list(enumerate(out))


def test_query_equals_plain_python(spark):
    rows = texts() + [(3, "mit license"), (None, "Apache License")]
    docs = spark.createDataFrame([(i, t, "kept out", 0.5) for i, t in rows], "doc_id long, text string, labels string, score double")
    got = [tuple(r) for r in X.report(X.scan(docs)).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(((i, *expected(t)) for i, t in rows), key=key)


def test_known_texts(spark):
    docs = spark.createDataFrame(list(enumerate(KNOWN)), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in X.report(X.scan(docs)).collect()}
    assert [got[i] for i in range(len(KNOWN))] == list(KNOWN.values())


def test_rules_are_gated_by_words_they_need():
    assert len(RULES) > 300 and len({(r.kind, r.label, r.pattern) for r in RULES}) == len(RULES)
    def shared(m):
        """The words of all branches of a group; none if it may be skipped or must not follow."""
        if m[3] or m[1] == "?!":
            return ""
        return f" {' '.join(set.intersection(*[set(re.findall('[a-z0-9]+', branch)) for branch in m[2].split('|')]))} "

    for r in RULES:
        always, before = re.sub(r"\.\{[^}]*\}\??", " ", r.pattern), None
        while always != before:
            before, always = always, re.sub(r"\((\?[:!])?([^()]*)\)(\??)", shared, always)
        assert set(r.words) <= set(re.findall("[a-z0-9]+", always)), r


def test_work_grows_with_the_matches(spark):
    def took(n):
        docs = spark.createDataFrame([(1, "mit license, GPL version 3. " * n)], "doc_id long, text string")
        start = time.time()
        row = X.report(X.scan(docs)).first()
        assert row["n_base"] == n and row["last_word"] == 5 * (n - 1) and row["labels"] == "gpl-3.0,mit"
        return time.time() - start

    took(10)
    assert took(100_000) < 60


def test_running_sums(spark):
    rng = random.Random(0)
    rows = [([rng.randrange(9) for _ in range(n)],) for n in (0, 1, 2, 3, 63, 64, 65, 1000)]
    df = spark.createDataFrame(rows, "v array<int>")
    for r in df.select("v", spans.running(F.col("v"), lambda a, b: a + b).alias("s")).collect():
        assert r["s"] == [sum(r["v"][: i + 1]) for i in range(len(r["v"]))]


def test_native_plan_and_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out = X.report(X.scan(docs))
    assert out.collect() == []
    shown = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|from_json", shown)


@pytest.mark.parametrize("kind", range(len(X.KINDS)))
def test_every_kind_has_rules(kind):
    assert any(r.kind == kind for r in RULES)
