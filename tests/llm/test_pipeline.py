"""The pipeline: each stage's decisions on planted documents, and the result against the stages applied by hand."""

import random
from collections import defaultdict

import pytest

import corpus_pipeline
from mlspark.llm import near_dedup, packing
from mlspark.llm.catalog import QUERIES

BAD = ["zorgath", "mulkrin", "vexplod"]
SYLLABLES = ["an", "the", "ti", "on", "er", "in", "re", "st", "ha", "ou"]


def prose(rng, n):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(4)
    docs, kinds, labels = [], {}, []
    for i in range(700):
        words = prose(rng, rng.randint(60, 200))
        kind = ["clean", "toxic", "clean", "junk", "secret", "clean", "clean"][i % 7]
        if kind == "toxic":
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        elif kind == "junk":
            words = [w + rng.choice(["$$$", "%%%", "&&&"]) for w in words]
        elif kind == "secret":
            words.insert(9, 'token = "%s"' % "".join(rng.choices("0123456789abcdef", k=40)))
        kinds[i] = kind
        docs.append((i, " ".join(words), "en", f"s{i % 3}", 1, "extra"))
        if i % 3:
            labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    clean = [i for i in kinds if kinds[i] == "clean"]
    for k, i in enumerate(clean[:30]):  # exact and near copies
        words = docs[i][1].split()
        if k % 2:
            words[5] = "changed"
        docs.append((1000 + k, " ".join(words), "en", "s0", 1, "extra"))
        kinds[1000 + k] = "copy"
    docs += [(2000, None, None, None, None, None), (2001, "", "en", "s0", 0, "extra"), (None, " ".join(prose(rng, 80)), "en", "s0", 1, "extra"), docs[2]]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, _key string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([*labels, (None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, kinds


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    path, _ = folder
    out, docs = [], spark.read.parquet(f"{path}/documents.parquet")
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        place = str(tmp_path_factory.mktemp("stage"))
        stage(spark, docs, path).write.mode("overwrite").parquet(place)
        docs = spark.read.parquet(place)
        out.append(docs)
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_in_order_return_the_columns_of_documents(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "near-dedup", "secret scans", "packing"]
    for docs in stages[1:5]:
        assert docs.columns == stages[0].columns


def test_toxic_and_junk_go_and_clean_stays(stages, folder):
    _, kinds = folder
    after_toxic, after_rules = ids(stages[1]), ids(stages[2])
    toxic = {i for i, k in kinds.items() if k == "toxic"}
    others = set(kinds) - toxic
    assert len(toxic - after_toxic) >= 0.95 * len(toxic) and len(others & after_toxic) >= 0.98 * len(others)
    junk = {i for i, k in kinds.items() if k == "junk"}
    assert not junk & after_rules and after_rules == after_toxic - junk - {2000, 2001}


def test_one_of_each_group_stays(stages, folder):
    _, kinds = folder
    before, after = ids(stages[2]), ids(stages[3])
    assert stages[3].count() == len(after)
    clean = [i for i in kinds if kinds[i] == "clean"]
    copies = {1000 + k for k in range(30) if clean[k] in before}
    assert after == before - copies


def test_secrets_are_masked(stages, folder):
    _, kinds = folder
    texts = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    for r in stages[4].collect():
        assert ("[SECRET]" in r["text"]) == (kinds.get(r["doc_id"]) == "secret")
        assert r["n_chars"] == len(r["text"])
        if kinds.get(r["doc_id"]) != "secret":
            assert r["text"] == texts[r["doc_id"]]


def test_packing_holds_every_id(stages):
    pieces = defaultdict(int)
    for r in stages[5].collect():
        pieces[r["doc_id"]] += r["length"]
    assert dict(pieces) == {r["doc_id"]: len(packing.encode(r["text"], "byte_bpe_50k.tiktoken")) for r in stages[4].collect()}


def test_run_gives_the_last_stage(spark, folder, stages):
    path, _ = folder
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["start"], r["length"], r["ids_crc32"]) for r in corpus_pipeline.run(spark, path).collect())
    want = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["start"], r["length"], r["ids_crc32"]) for r in stages[5].collect())
    assert got == want


def test_empty_documents(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).count() == 0


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 11))
    assert corpus_pipeline.ORACLE_SQL is None and near_dedup.SIMILARITY == 0.8


def test_secrets_are_fitted_on_all_texts(spark, monkeypatch):
    """Each of 900 words is in three of 2,700 texts; 2,000 of them would not show all."""
    import corpus_pipeline

    letters = "abcdefghij"
    docs = spark.createDataFrame([(i, "word" + "".join(letters[int(c)] for c in f"{i // 3:03d}")) for i in range(2700)], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(corpus_pipeline.secrets, "redact", lambda docs, forest: seen.append(forest) or docs)
    corpus_pipeline.mask_secrets(spark, docs, "")
    assert len(seen[0].words) == 900
