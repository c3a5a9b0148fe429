"""Cleaning, scalar functions and reshaping on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from mlspark.catalog import query
from mlspark.functions import columns as C
from mlspark.functions import text as X
from mlspark.operators import clean, reshape
from mlspark.plans.views import PLAYS, plays, table


def charges(spark, sf):
    """Account balances as text, with unreadable entries."""
    raw = F.when(F.col("c_custkey") % 7 == 0, F.lit(" ")).when(F.col("c_custkey") % 11 == 0, F.lit("n/a"))
    return table(spark, sf, "customer").select("c_custkey", raw.otherwise(F.col("c_acctbal").cast("string")).alias("charges"))


@query(
    "C1_to_numeric_coerce",
    "SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 THEN c_acctbal END AS charges FROM customer",
)
def c1(spark, sf):
    return clean.to_numeric_coerce(charges(spark, sf), ["charges"])


@query(
    "C2_drop_missing",
    "SELECT c_custkey, c_acctbal AS charges FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0",
)
def c2(spark, sf):
    return clean.drop_missing(clean.to_numeric_coerce(charges(spark, sf), ["charges"]), ["charges"])


@query("C3_drop_columns", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def c3(spark, sf):
    return clean.drop_columns(table(spark, sf, "customer"), "c_name")


@query(
    "C4_map_values",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS closed FROM orders",
)
def c4(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", C.map_values("o_orderstatus", {"F": 1, "O": 0}).alias("closed"))


@query(
    "C5_all_equal_flag",
    """SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'N' AND l_linestatus = 'N' AS INT) AS all_no,
              CAST(l_returnflag = 'A' AND upper(l_returnflag) = 'A' AS INT) AS all_a FROM lineitem""",
)
def c5(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        C.all_equal_flag(["l_returnflag", "l_linestatus"], "N").alias("all_no"),
        C.all_equal_flag(["l_returnflag", F.upper("l_returnflag")], "A").alias("all_a"),
    )


# fixed values: tenure groups
TENURE_BINS = [0, 12, 36, 60, 72]
TENURE_LABELS = ["new_customer", "mid_term_customer", "long_term_customer", "loyal_customer"]


@query(
    "C6_cut",
    """SELECT p_partkey, CASE WHEN m < 0 THEN NULL WHEN m < 12 THEN 'new_customer' WHEN m < 36 THEN 'mid_term_customer'
                             WHEN m < 60 THEN 'long_term_customer' WHEN m < 72 THEN 'loyal_customer' END AS tenure_group
       FROM (SELECT p_partkey, p_size * 2 - 6 AS m FROM part)""",
)
def c6(spark, sf):
    months = F.col("p_size") * 2 - 6
    return table(spark, sf, "part").select("p_partkey", C.cut(months, TENURE_BINS, TENURE_LABELS).alias("tenure_group"))


@query(
    "C7_one_hot",
    """SELECT c_custkey, CAST(c_mktsegment = 'BUILDING' AS INT) AS "c_mktsegment_BUILDING",
              CAST(c_mktsegment = 'FURNITURE' AS INT) AS "c_mktsegment_FURNITURE",
              CAST(c_mktsegment = 'HOUSEHOLD' AS INT) AS "c_mktsegment_HOUSEHOLD",
              CAST(c_mktsegment = 'MACHINERY' AS INT) AS "c_mktsegment_MACHINERY" FROM customer""",
)
def c7(spark, sf):
    return clean.one_hot(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"], drop_first=True)


@query(
    "C8_dates",
    """SELECT event_id, CAST(ts AS DATE) AS day, make_date(year(ts), month(ts), 1) AS month FROM events""",
)
def c8(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select(
        "event_id",
        C.epoch_ms_to_date(F.unix_millis(ts)).alias("day"),
        C.year_month_to_date(F.year(ts), F.month(ts)).alias("month"),
    )


@query(
    "C9_safe_ratio",
    "WITH " + PLAYS + """
    SELECT order_id, line_id, score / CASE WHEN playtime - 20 = 0 THEN 1 ELSE playtime - 20 END AS score_per_minute FROM plays""",
)
def c9(spark, sf):
    return plays(spark, sf).select("order_id", "line_id", C.safe_ratio("score", F.col("playtime") - 20).alias("score_per_minute"))


@query(
    "C10_rule_flags",
    "WITH " + PLAYS + """
    SELECT order_id, line_id,
      concat_ws(',', CASE WHEN playtime < 10 AND score > 20000 THEN 'short' END, CASE WHEN score > 90000 THEN 'high' END) AS fired,
      CASE WHEN (playtime < 10 AND score > 20000) OR score > 90000 THEN -1 ELSE 1 END AS anomaly_prediction FROM plays""",
)
def c10(spark, sf):
    rules = {"short": (F.col("playtime") < 10) & (F.col("score") > 20000), "high": F.col("score") > 90000}
    flagged = clean.rule_flags(plays(spark, sf), rules)
    return flagged.select("order_id", "line_id", F.array_join("fired_rules", ",").alias("fired"), "anomaly_prediction")


@query("C11_require_columns", "SELECT s_suppkey, s_acctbal FROM supplier")
def c11(spark, sf):
    supplier = clean.require_columns(table(spark, sf, "supplier"), ["s_suppkey", "s_acctbal"])
    return supplier.select("s_suppkey", "s_acctbal")


@query(
    "C12_validate_rows",
    """SELECT c_custkey, concat_ws(',', CASE WHEN NOT length(c_mktsegment) BETWEEN 1 AND 9 THEN 'name_length' END,
                                        CASE WHEN NOT c_acctbal >= 0 THEN 'balance' END) AS reasons FROM customer
       WHERE length(c_mktsegment) NOT BETWEEN 1 AND 9 OR c_acctbal < 0
       UNION ALL SELECT c_custkey, '' FROM customer WHERE length(c_mktsegment) BETWEEN 1 AND 9 AND c_acctbal >= 0""",
)
def c12(spark, sf):
    rules = {"name_length": F.length("c_mktsegment").between(1, 9), "balance": F.col("c_acctbal") >= 0}
    good, bad = clean.validate_rows(table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), rules)
    return good.select("c_custkey", F.lit("").alias("reasons")).unionByName(
        bad.select("c_custkey", F.array_join("reasons", ",").alias("reasons"))
    )


@query(
    "C13_clip_round",
    "SELECT s_suppkey, CASE WHEN s_acctbal - 3000 < 0 THEN 0 ELSE s_acctbal - 3000 END AS clipped, round(s_acctbal / 7, 2) AS rounded FROM supplier",
)
def c13(spark, sf):
    return table(spark, sf, "supplier").select(
        "s_suppkey", C.clip_lower(F.col("s_acctbal") - 3000, 0.0).alias("clipped"), F.round(F.col("s_acctbal") / 7, 2).alias("rounded")
    )


@query(
    "C14_impute",
    """WITH gaps AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice END AS price,
                            CASE WHEN o_orderkey % 6 <> 0 THEN o_orderstatus END AS status,
                            CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS priority FROM orders)
       SELECT o_orderkey, round(coalesce(price, (SELECT avg(price) FROM gaps)), 4) AS price,
              coalesce(status, (SELECT status FROM gaps WHERE status IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS status,
              coalesce(priority, 'unknown') AS priority FROM gaps""",
)
def c14(spark, sf):
    key = F.col("o_orderkey")
    gaps = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(key % 10 != 0, F.col("o_totalprice")).alias("price"),
        F.when(key % 6 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(key % 4 != 0, F.col("o_orderpriority")).alias("priority"),
    )
    filled = clean.impute(gaps, mean=["price"], mode=["status"], constant={"priority": "unknown"})
    return filled.withColumn("price", F.round("price", 4))


@query(
    "C15_resample_monthly",
    """WITH thin AS (SELECT o_orderpriority AS series_id, o_orderdate AS ts, o_totalprice AS value FROM orders WHERE month(o_orderdate) % 3 <> 0),
       m AS (SELECT series_id, CAST(date_trunc('month', ts) AS DATE) AS month, avg(value) AS value FROM thin GROUP BY 1, 2),
       cal AS (SELECT series_id, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM m GROUP BY 1)
       SELECT c.series_id, c.month, round(last_value(m.value IGNORE NULLS) OVER (PARTITION BY c.series_id ORDER BY c.month), 4) AS value
       FROM cal c LEFT JOIN m ON c.series_id = m.series_id AND c.month = m.month""",
)
def c15(spark, sf):
    thin = table(spark, sf, "orders").filter(F.month("o_orderdate") % 3 != 0).select(
        F.col("o_orderpriority").alias("series_id"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("value")
    )
    return clean.resample_monthly(thin, "series_id", "ts", "value").withColumn("value", F.round("value", 4))


NORMALIZED = r"lower(regexp_replace(regexp_replace({}, 'https?://[-_a-zA-Z0-9./]+', '', 'g'), '[0-9]+', '0', 'g'))"


@query(
    "C16_normalize_text",
    "SELECT page_id, " + NORMALIZED.format("url || ' ' || html") + " AS clean FROM pages",
)
def c16(spark, sf):
    page = F.concat_ws(" ", "url", "html")
    return table(spark, sf, "pages").select("page_id", X.normalize_text(page).alias("clean"))


@query(
    "C17_tokenize",
    r"""SELECT doc_id, CAST(len(w) AS BIGINT) AS n_tokens, md5(array_to_string(w, ' ')) AS tokens_md5 FROM (
          SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), lambda x: length(x) >= 2 AND NOT (
            CASE lang """
    + " ".join(
        f"WHEN '{k}' THEN list_contains([" + ", ".join(f"'{w}'" for w in v.split()) + "], x)" for k, v in X.STOP_WORDS.items()
    )
    + " ELSE false END)) AS w FROM documents)",
)
def c17(spark, sf):
    tokens = table(spark, sf, "documents").select(
        "doc_id", X.tokenize("text", 2, X.stop_words_for("lang")).alias("w")
    )
    return tokens.select(
        "doc_id", F.size("w").cast("long").alias("n_tokens"), F.md5(F.array_join("w", " ").cast("binary")).alias("tokens_md5")
    )


@query(
    "C18_format_srt_timestamp",
    """SELECT event_id, printf('%02d:%02d:%02d,%03d', CAST(floor(s / 3600) AS BIGINT), CAST(floor((s % 3600) / 60) AS BIGINT), s % 60, ms) AS stamp
       FROM (SELECT event_id, CAST(floor(value * 100) AS BIGINT) AS s,
                    CAST(floor((value * 100 - floor(value * 100)) * 1000) AS BIGINT) AS ms FROM events)""",
)
def c18(spark, sf):
    return table(spark, sf, "events").select("event_id", C.srt_timestamp(F.col("value") * 100).alias("stamp"))


@query(
    "C19_truncate_at_stop_words",
    """WITH a AS (SELECT conv_id, turn, CASE WHEN contains(text, ' la') THEN trim(split_part(text, ' la', 1)) ELSE text END AS t FROM conversations),
            b AS (SELECT conv_id, turn, CASE WHEN contains(t, ' the') THEN trim(split_part(t, ' the', 1)) ELSE t END AS t FROM a)
       SELECT conv_id, turn, CASE WHEN contains(t, ' und') THEN trim(split_part(t, ' und', 1)) ELSE t END AS answer FROM b""",
)
def c19(spark, sf):
    cut = C.truncate_at_words("text", [" la", " the", " und"])
    return table(spark, sf, "conversations").select("conv_id", "turn", cut.alias("answer"))


@query(
    "C20_any_label_contains",
    """SELECT doc_id, contains(lang, 'e') OR contains(source, 'cat') OR contains(source, 'e') AS has_label FROM documents""",
)
def c20(spark, sf):
    labels = F.array(
        F.struct(F.col("lang").alias("label"), F.lit(0.9).alias("score")),
        F.struct(F.col("source").alias("label"), F.lit(0.1).alias("score")),
    )
    return table(spark, sf, "documents").select("doc_id", C.any_label_contains(labels, "e").alias("has_label"))


@query(
    "C21_argmax_label",
    """SELECT vec_id, CASE list_position(embedding[1:4], list_max(embedding[1:4])) WHEN 1 THEN 'anger' WHEN 2 THEN 'fear'
                      WHEN 3 THEN 'joy' ELSE 'sadness' END AS emotion,
              CAST(list_position(embedding, list_max(embedding)) - 1 AS INT) AS best FROM embeddings""",
)
def c21(spark, sf):
    names = ["anger", "fear", "joy", "sadness"]
    return table(spark, sf, "embeddings").select(
        "vec_id", C.argmax_label(F.slice("embedding", 1, 4), names).alias("emotion"), C.argmax("embedding").alias("best")
    )


@query(
    "C22_confidence_filter",
    """SELECT l_orderkey, l_linenumber, printf('ID:%d %s %.2f', l_linenumber, l_returnflag, l_quantity / 50) AS caption
       FROM lineitem WHERE l_quantity / 50 >= 0.55""",
)
def c22(spark, sf):
    confidence = F.col("l_quantity") / 50
    return table(spark, sf, "lineitem").filter(confidence >= 0.55).select(
        "l_orderkey", "l_linenumber", F.format_string("ID:%d %s %.2f", "l_linenumber", "l_returnflag", confidence).alias("caption")
    )


@query(
    "C23_inverse_scale",
    """WITH p AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
       SELECT o_orderkey, round((o_totalprice - lo) / (hi - lo), 6) AS scaled, round(o_totalprice, 2) AS restored FROM orders, p""",
)
def c23(spark, sf):
    orders = table(spark, sf, "orders")
    low, high = (orders.select(f("o_totalprice")).scalar() for f in (F.min, F.max))
    scaled = orders.select("o_orderkey", ((F.col("o_totalprice") - low) / (high - low)).alias("scaled"))
    return scaled.select(
        "o_orderkey", F.round("scaled", 6).alias("scaled"), F.round(C.inverse_minmax("scaled", low, high), 2).alias("restored")
    )


@query(
    "R1_pivot_matrix",
    """SELECT c_mktsegment, avg(CASE WHEN o_orderstatus = 'F' THEN 1000 * o_orderkey END) AS "F",
              avg(CASE WHEN o_orderstatus = 'O' THEN 1000 * o_orderkey END) AS "O",
              avg(CASE WHEN o_orderstatus = 'P' THEN 1000 * o_orderkey END) AS "P"
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def r1(spark, sf):
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    rows = table(spark, sf, "orders").join(customer, "o_custkey").withColumn("v", F.col("o_orderkey") * 1000)
    return reshape.pivot_matrix(rows, "c_mktsegment", "o_orderstatus", "v", ["F", "O", "P"])


@query(
    "R2_metrics_table",
    """SELECT l_returnflag AS dataset, max(l_extendedprice) FILTER (l_linestatus = 'O') AS "O",
              max(l_extendedprice) FILTER (l_linestatus = 'F') AS "F" FROM lineitem WHERE l_returnflag IN ('R', 'N') GROUP BY 1""",
)
def r2(spark, sf):
    long = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("dataset"), F.col("l_linestatus").alias("model")).agg(
        F.max("l_extendedprice").alias("value")
    )
    return reshape.metrics_table(long, "dataset", "model", "value", ["R", "N"], ["O", "F"])


@query(
    "R3_genre_string",
    """SELECT p_partkey, concat_ws(' ', CASE WHEN p_size > 25 THEN 'big' END, CASE WHEN p_type = 'PROMO' THEN 'promo' END,
                                        CASE WHEN p_name LIKE 'red%' THEN 'red' END) AS genres FROM part""",
)
def r3(spark, sf):
    flags = table(spark, sf, "part").select(
        "p_partkey",
        (F.col("p_size") > 25).cast("int").alias("big"),
        (F.col("p_type") == "PROMO").cast("int").alias("promo"),
        F.col("p_name").startswith("red").cast("int").alias("red"),
    )
    return flags.select("p_partkey", C.flag_names(["big", "promo", "red"]).alias("genres"))


@query(
    "R4_bow_rows",
    r"""SELECT doc_id, term, count(*) AS tf FROM (
          SELECT doc_id, unnest(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), lambda x: length(x) >= 2)) AS term FROM documents)
        GROUP BY 1, 2""",
)
def r4(spark, sf):
    tokens = table(spark, sf, "documents").select("doc_id", X.tokenize("text").alias("tokens"))
    return reshape.bag_of_words(tokens, "doc_id", "tokens")
