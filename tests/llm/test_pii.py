"""Personal data: base spans against plain Python, trees as columns."""

import hashlib
import random
import re

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from mlspark.llm import pii as P

# the rules as they are stated
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def passes(kind, hit):
    d = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    return {"email": True, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def base(text):
    spans = [
        (m.start(), k, m.end(), kind)
        for k, (kind, rule) in enumerate(RULES.items())
        for m in re.finditer(rule, text or "")
        if passes(kind, m.group())
    ]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans)]


def texts():
    rng = random.Random(0)
    parts = [
        "a@b.c", "x.y+z@mail.example.com", "a@b", "@c.d", "a@b.c_d@e.f", "a@@b.c", "é@ü.de", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "01.002.3.255",
        "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111112", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "+1 (555) 555-0100", "+49 30 1234567", "+1", "++12 345 678 9012",
        "+12345678901234567890", " ", "  ", "\n", ".", "-", "word", "😀", "漢", "12", "tel: ", "030 1234567", "name (at) host (dot) org", "fe80::1:2:3:4", "99999999999999999999.1.1.1",
    ]
    out = [None, "", "plain words only", "a." * 30_000, "9" * 50_000, "x" * 50_000 + "@y.z"]
    out += [rng.choice(["", " ", ","]).join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(400)]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts()] + [(2, "plain words only", "x")], "doc_id long, text string, spans string")
    return P.detect(docs, 500).collect()


def test_base_spans_equal_the_rules(found):
    rows = dict(texts())
    assert len(found) == len(rows) + 1
    for r in found:
        want = base(rows[r["doc_id"]])
        assert [r[f"n_{k}"] for k in RULES] == [sum(s.startswith(f"{k}:") for s in want) for k in RULES]
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()


def test_base_spans_stay_among_all_spans(found):
    rows = dict(texts())
    for r in found:
        spans = [s for s in r["spans"].split(",") if s]
        want = base(rows[r["doc_id"]])
        assert [s for s in spans if s.split(":")[0] in RULES] == want
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)
        taken = [tuple(map(int, s.split(":")[1:])) for s in want]
        for s in spans:
            kind, a, b = s.split(":")
            if kind not in RULES:
                assert not any(int(a) < y and x < int(b) for x, y in taken)


def test_trees_as_columns_give_the_fitted_probabilities(spark):
    rng = random.Random(2)
    rows = [tuple([float(rng.randrange(5)) for _ in P.FEATURES]) for _ in range(400)]
    df = spark.createDataFrame([(*r, float(r[0] + r[3] > 4)) for r in rows], [*P.FEATURES, "label"])
    data = VectorAssembler(inputCols=P.FEATURES, outputCol="vector").transform(df)
    model = GBTClassifier(featuresCol="vector", maxIter=4, maxDepth=3, seed=1).fit(data)
    boosted = P.Boosted([(w, t.toDebugString) for w, t in zip(model.treeWeights, model.trees)], [0.5] * 3)
    out = model.transform(data).select("probability", boosted.score(F.array(*P.FEATURES)).alias("mine")).collect()
    assert all(r["probability"][1] == pytest.approx(r["mine"], abs=1e-9) for r in out)


def planted():
    """Spelled-out data next to plain numbers, in contexts as the base spans have them."""
    rng = random.Random(11)
    words = "the of and house river small green after walked seldom paper window".split()
    prose = lambda n: " ".join(rng.choices(words, k=n))
    number = lambda n: "".join(rng.choices("0123456789", k=n))
    rows = []
    for i in range(240):
        name = f"{rng.choice(words)}.{rng.choice(words)}"
        rows.append((i, rng.choice([
            f"{prose(6)} write to {name}@mail.example.com {prose(3)}",
            f"{prose(5)} call +49 {number(3)} {number(4)} {number(3)} {prose(3)}",
            f"{prose(5)} host 10.{rng.randrange(256)}.{rng.randrange(256)}.7 {prose(3)}",
        ])))
    rows += [(1000 + i, f"{prose(8)}. {prose(30)}") for i in range(200)]
    spelled = {2000: "write to anna.small (at) mail dot example dot org after", 2001: "walked. write to paul [at] river (dot) com the"}
    clean = {3000: "the house in 1987-1988 and 12 345 678 people", 3001: "walked at noon. Then the river", 3002: "seldom 12:30:45:10 after", 3003: "paper 20240115 window"}
    return rows + list(spelled.items()) + list(clean.items()), spelled, clean


def test_spelled_out_data_is_added_and_plain_numbers_are_not(spark):
    rows, spelled, clean = planted()
    out = {r["doc_id"]: r["spans"] for r in P.detect(spark.createDataFrame(rows, "doc_id long, text string"), 2000).collect()}
    for i, text in spelled.items():
        kind, a, b = (out[i].split(",")[0] or "none:0:0").split(":")
        assert kind == "spelled" and "at" in text[int(a) : int(b)] and text[int(a) : int(b)].endswith(("org", "com"))
    assert {i: out[i] for i in clean} == dict.fromkeys(clean, "")


def test_long_texts(spark):
    """No stack overflow, and no work that grows with the square of the matches, which would take hours here."""
    rows = ["dot x@" + "a." * 1000 + "a", "x@" + "a." * 100_000, "a at " + "b dot " * 100_000, "4" * 1_000_000, "a@b.c " * 100_000, "1.2.3.4 " * 50_000, "+49 30 1234567, " * 20_000]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in P.find(docs, P.Boosted([], [])).collect()}
    assert [out[i]["n_email"] for i in range(6)] == [1, 1, 0, 0, 100_000, 0] and out[5]["n_ip"] == 50_000
    assert out[4]["spans"].endswith("email:599994:599999")


def test_thresholds():
    assert P.threshold([(0.9, 1), (0.8, 1), (0.7, 0), (0.6, 1)], 0.75) == 0.6
    assert P.threshold([(0.9, 1), (0.8, 0), (0.8, 1)], 0.95) == 0.9
    assert P.threshold([(0.9, 0)], 0.95) == 2.0 == P.threshold([], 0.95)


def test_thresholds_of_a_table_are_those_of_a_list(spark):
    rng = random.Random(4)
    rows = [(4 + i % 2, round(s := rng.random(), 2), int(rng.random() < 0.6 + s / 2)) for i in range(3000)]
    got = P.thresholds(spark.createDataFrame(rows, "kind int, score double, label int"), 0.97)
    assert got == [P.threshold([(s, y) for k, s, y in rows if k == 4 + g], 0.97) for g in range(3)]
    assert got[0] < 1 and got[2] == 2.0


def test_cases_of_all_texts_are_fitted(spark):
    """22,000 false and 11,000 true cases: none is left out."""
    made = P.cases(spark.range(22_000).selectExpr("id doc_id", "if(id % 2 = 0, 'walked to the river', concat('write a', id, '@b.org now')) text"))
    assert {r["label"]: r["count"] for r in made.groupBy("label").count().collect()} == {0: 22_000, 1: 11_000}


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(texts()[:20], "doc_id long, text string")
    plan = P.find(docs, P.Boosted([(1.0, "t\n If (feature 0 <= 0.5)\n  Predict: 0.1\n Else (feature 0 > 0.5)\n  Predict: -0.1")], [0.5] * 3))
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", shown)
    assert P.detect(docs.limit(0)).collect() == []
