"""Quality rules: base counts against plain Python, the verdict on planted junk."""

import random
import re
from collections import Counter

import pytest

from mlspark.llm import quality_rules as Q

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    failed = len(words) < 50 or 100 * len(inside) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed)


def prose(rng, n):
    return " ".join("".join(rng.choices("aeioulnrst", k=rng.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(0)
    texts = [None, "", " \n\t", "one", "a b a b a b", "x\ny\nx \nx\n\n", "é ü 漢 \x0b w\x1c#$|", "to " * 30_000]
    texts += [prose(rng, 120) for _ in range(60)]
    texts += [" ".join(w + rng.choice(["$$$", "%%%", "&&&"]) for w in prose(rng, 120).split()) for _ in range(12)]
    texts += [texts[20], texts[20]]
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def judged(spark, rows):
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, kept int")
    labels = spark.createDataFrame([(i, int(i < 68)) for i in range(8, 60, 2)] + [(None, 1), (9, None)], "doc_id long, quality int")
    return {r["doc_id"]: r for r in Q.judge(docs, labels).collect()}


def test_base_counts(rows, judged):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for i, text in rows:
        assert tuple(judged[i][n] for n in names) == plain(text), repr(text)[:80]


def test_clean_stays_and_junk_goes(judged):
    assert all(judged[i]["kept"] for i in range(8, 68))
    assert not any(judged[i]["kept"] for i in range(68, 80))
    assert not any(judged[i]["kept"] for i in range(8))
    assert judged[80]["score"] == judged[81]["score"] == judged[20]["score"]


def test_score_does_not_depend_on_partitions(spark, rows, judged):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(i, 1) for i in range(8, 60, 2)], "doc_id long, quality int")
    for r in Q.judge(docs, labels).collect():
        assert (r["score"], r["kept"]) == (judged[r["doc_id"]]["score"], judged[r["doc_id"]]["kept"])


def test_filter_keeps_whole_rows(spark, rows, judged):
    docs = spark.createDataFrame([(i, t, f"s{i}") for i, t in rows], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, 1) for i in range(8, 60, 2)], "doc_id long, quality int")
    kept = {r["doc_id"]: r for r in Q.keep_good(docs, labels).collect()}
    assert set(kept) == {i for i, _ in rows if judged[i]["kept"]}
    assert all(kept[i]["source"] == f"s{i}" and kept[i]["text"] == t for i, t in rows if i in kept)


def test_without_labels_and_without_rows(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    docs = spark.createDataFrame([(1, "a b c " * 5), (2, " ".join(f"w{i}" for i in range(60)))], "doc_id long, text string")
    assert {r["doc_id"]: (r["kept"], r["score"]) for r in Q.judge(docs, none).collect()} == {1: (False, 0.0), 2: (True, 0.0)}
    assert Q.judge(docs.limit(0), none).collect() == []


def test_windows_of_many_distinct_words():
    import numpy as np

    codes = np.array([5, 6, 7, 1 << 22, 5, 6, 7, 9])
    assert Q.repeated_words(codes) == 6 == Q.repeated_words(codes % (1 << 20))


def test_every_good_document_is_counted(spark):
    from pyspark.sql import functions as F

    docs = spark.range(21_000).select(F.col("id").alias("doc_id"), F.lit("abcdefg").alias("text"))
    labels = docs.filter("doc_id >= 500").select("doc_id", F.lit(1).alias("quality"))
    counts = Q.bucket_counts(docs, Q.trusted_ids(labels)).agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted")).first()
    assert (counts["raw"], counts["trusted"]) == (4 * 21_000, 4 * 20_500)


def test_a_small_trusted_share_is_not_junk_by_chance(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    for usual in (100, 600, 1200, 3000):
        good = rng.poisson(usual / 600, 2000)
        counts = [(i, usual, int(n)) for i, n in enumerate(good)] + [(9999, 60_000_000, 100_000)]
        ratios = Q.log_ratios(spark.createDataFrame(counts, "bucket long, raw long, trusted long"))
        assert ratios[:2000].mean() / Q.UNIT > Q.THRESHOLD / 2
