"""Registered queries of this subpackage: each operator over its whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mlspark.llm import licenses, near_dedup, neighbours, packing, pieces, pii, quality_classifier, quality_rules, repeats, secrets, toxicity, variants, warc
from mlspark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return register


@query("op1_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


@query("op2_pii")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_warc_revisits", warc.ORACLE_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.resolve(warc.page_records(table(spark, sf_dir, "pages")))


@query("op5_quality_rules")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_piece_nbest")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"))


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_secret_scan")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.fit(docs))


@query("op10_nearest_neighbours")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(repeats.find(repeats.plant(table(spark, sf_dir, "documents"))))


@query("op12_license_scan")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(licenses.scan(table(spark, sf_dir, "documents")))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    occurrences = variants.perturbed(variants.occurrences(table(spark, sf_dir, "documents")))
    return variants.group(variants.counts(occurrences))
