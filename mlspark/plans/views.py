"""Derived tables the registered queries share, as DataFrames and as SQL text for the checker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mlspark.session import ship, utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("item_id"), "l_quantity")
    return (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey)
        .groupBy("user_id", "item_id")
        .agg(F.ceil(F.avg("l_quantity") / 10).cast("int").alias("rating"))
    )


RATINGS = """ratings AS (
  SELECT o_custkey AS user_id, l_partkey AS item_id, CAST(ceil(avg(l_quantity) / 10) AS INT) AS rating
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2)"""


def is_test(user: str = "user_id", item: str = "item_id"):
    return (F.col(user) * 31 + F.col(item) * 17) % 5 == 0


SPLIT = RATINGS + """,
train AS (SELECT * FROM ratings WHERE (user_id * 31 + item_id * 17) % 5 <> 0),
test AS (SELECT * FROM ratings WHERE (user_id * 31 + item_id * 17) % 5 = 0)"""


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = ratings(spark, sf_dir)
    return rows.filter(~is_test()), rows.filter(is_test())


def item_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, term, tf) of the words of name, type and brand."""
    text = F.lower(F.concat_ws(" ", "p_name", "p_type", "p_brand"))
    return (
        table(spark, sf_dir, "part")
        .select(F.col("p_partkey").alias("item_id"), F.explode(F.regexp_extract_all(text, F.lit("([a-z0-9]{2,})"))).alias("term"))
        .groupBy("item_id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


ITEM_TERMS = """item_terms AS (
  SELECT item_id, term, count(*) AS tf FROM (
    SELECT p_partkey AS item_id,
           unnest(regexp_extract_all(lower(p_name || ' ' || p_type || ' ' || p_brand), '[a-z0-9]{2,}')) AS term FROM part)
  GROUP BY 1, 2)"""


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (series, calendar day): a series is bounded by the calendar, not by the data."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").cast("date").alias("day"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value"))
    )


DAILY = """daily_sales AS (
  SELECT o_orderpriority AS series_id, CAST(o_orderdate AS DATE) AS day,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders GROUP BY 1, 2)"""


def monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.col("o_orderpriority").alias("series_id"),
            F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"),
        )
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("value"))
    )


MONTHLY = """monthly_sales AS (
  SELECT o_orderpriority AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS value
  FROM orders GROUP BY 1, 2)"""


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_id"),
        F.col("l_extendedprice").alias("score"),
        F.col("l_quantity").alias("playtime"),
    )


PLAYS = """plays AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_id, l_extendedprice AS score, l_quantity AS playtime
  FROM lineitem)"""


def event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "value")


ERRORS = """errors AS (
  SELECT user_id, event_id, value,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS idx FROM events)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary label with a score in steps of 1/1000."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic", "quality")
    capped = F.least(F.col("n_chars"), F.lit(20000))
    return labels.join(docs, "doc_id").select(
        "doc_id",
        F.col("toxic").alias("label"),
        "quality",
        ((capped - capped % 20).cast("double") / F.lit(20000.0).cast("double")).alias("score"),
    )


SCORED = """scored AS (
  SELECT l.doc_id, toxic AS label, quality,
         CAST(least(n_chars, 20000) - least(n_chars, 20000) % 20 AS DOUBLE) / CAST(20000 AS DOUBLE) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


def trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("treatment"),
        F.col("c_acctbal").alias("score"),
        F.col("c_mktsegment").alias("segment"),
        F.col("o_totalprice").alias("outcome"),
    )


TRIAL = """trial AS (
  SELECT o_orderkey AS row_id, CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INT) AS treatment,
         c_acctbal AS score, c_mktsegment AS segment, o_totalprice AS outcome
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def churn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer: months between first and last order, mean price, segment, whether gone."""
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        (F.max(month) - F.min(month)).alias("tenure"),
        F.round(F.avg("o_totalprice"), 2).alias("monthly_charges"),
        F.count(F.lit(1)).alias("n_orders"),
        (F.max("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz")).cast("int").alias("churn"),
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("contract"), "c_acctbal")
    return customer.join(orders, "c_custkey")


CHURN = """churn AS (
  SELECT c_custkey, c_mktsegment AS contract, c_acctbal, tenure, monthly_charges, n_orders, churn FROM customer JOIN (
    SELECT o_custkey, max(year(o_orderdate) * 12 + month(o_orderdate)) - min(year(o_orderdate) * 12 + month(o_orderdate)) AS tenure,
           round(avg(o_totalprice), 2) AS monthly_charges, count(*) AS n_orders, CAST(max(o_orderdate) < TIMESTAMP '2001-01-01' AS INT) AS churn
    FROM orders GROUP BY 1) ON c_custkey = o_custkey)"""
