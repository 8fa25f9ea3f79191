"""The ledger's entities from order tables: records are orders, lots their lines, issuers the customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotloom.functions.classify import bucket
from lotloom.session import table, tasks

#: Lines of a task. Lots and records are dealt by the record's key to as many tasks as the lines need, so that a task holds
#: no more on larger tables; joins and groups by that key keep the deal.
TASK_LINES = 50_000


def _dealt(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Order lines and orders, dealt alike."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    n = tasks(lines, TASK_LINES)
    return lines.repartition(n, "l_orderkey"), orders.repartition(n, "o_orderkey")


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = _dealt(spark, sf_dir)
    rows = lines.join(orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    start, end = F.col("o_orderdate").cast("date"), F.when(F.col("l_linestatus") == "O", F.col("l_shipdate").cast("date"))
    return rows.select(
        F.col("l_orderkey").alias("processing_log_id"), F.col("l_linenumber").alias("row_order"), F.col("l_quantity").cast("bigint").alias("shares"), F.col("l_partkey").alias("distinctive_from"),
        (F.col("l_partkey") + F.col("l_quantity").cast("bigint") - F.when(F.col("l_suppkey") % 10 == 0, 0).otherwise(1)).alias("distinctive_to"), F.col("l_returnflag").alias("security_type"), start.alias("lockin_date_from"),
        end.alias("lockin_date_to"), F.when(F.col("l_linestatus") == "O", "LOCKED").otherwise("FREE").alias("status"), bucket(start, end).alias("bucket"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the totals of their lots and a shareholding split by return flag."""
    _, orders = _dealt(spark, sf_dir)
    sums = lots(spark, sf_dir).groupBy("processing_log_id").agg(
        F.sum("shares").alias("computed_total"), F.sum(F.when(F.col("status") == "LOCKED", F.col("shares")).otherwise(0)).alias("locked_total"), F.sum(F.when(F.col("status") == "FREE", F.col("shares")).otherwise(0)).alias("free_total"),
        *(F.sum(F.when(F.col("security_type") == f, F.col("shares")).otherwise(0)).alias(f"shp_{n}_shares") for f, n in (("A", "promoter"), ("N", "public"), ("R", "others"))),
    )
    exchange = F.when(F.col("o_custkey") % 2 == 0, "BSE").otherwise("NSE")
    state = F.when(F.col("o_orderstatus") == "F", "FINALIZED").when(F.col("o_orderstatus") == "O", "VALIDATING").otherwise("NEW")
    name = F.when(F.col("o_custkey") % 2 == 0, F.format_string("%d-CUST-Annexure-I.pdf", "o_custkey")).otherwise(F.format_string("CUST%d-CML%d.pdf", "o_custkey", "o_orderkey"))
    rows = orders.select(F.col("o_orderkey").alias("id"), exchange.alias("exchange"), F.concat(exchange, F.lit(":"), F.col("o_custkey").cast("string")).alias("unique_symbol"), name.alias("file_name"), state.alias("status"), F.col("o_orderdate").alias("processed_at"), F.lit(None).cast("timestamp_ntz").alias("updated_at"), F.col("o_totalprice").cast("bigint").alias("price"))
    return rows.join(sums, F.col("id") == F.col("processing_log_id"), "left").drop("processing_log_id").withColumn("shp_total_shares", F.col("shp_promoter_shares") + F.col("shp_public_shares") + F.col("shp_others_shares"))


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    even = F.col("c_custkey") % 2 == 0
    return table(spark, sf_dir, "customer").select(F.when(even, key).alias("bse_script_code"), F.when(~even, key).alias("nse_symbol"), F.col("c_name").alias("company_name"), F.col("c_mktsegment").alias("ipo_name"), F.col("c_acctbal").cast("bigint").alias("post_issue_shares"))


# The same entities as SQL, to be put before a query.
LOTS_SQL = """lots AS (SELECT l_orderkey AS processing_log_id, l_linenumber AS row_order, l_quantity::BIGINT AS shares, l_partkey AS distinctive_from,
    l_partkey + l_quantity::BIGINT - CASE WHEN l_suppkey % 10 = 0 THEN 0 ELSE 1 END AS distinctive_to, l_returnflag AS security_type, o_orderdate::DATE AS lockin_date_from,
    CASE WHEN l_linestatus = 'O' THEN l_shipdate::DATE END AS lockin_date_to, CASE WHEN l_linestatus = 'O' THEN 'LOCKED' ELSE 'FREE' END AS status,
    CASE WHEN l_linestatus <> 'O' THEN 'free' ELSE CASE WHEN l_shipdate::DATE - o_orderdate::DATE >= 1095 THEN '3_year_plus' WHEN l_shipdate::DATE - o_orderdate::DATE >= 730 THEN '2_year_plus'
        WHEN l_shipdate::DATE - o_orderdate::DATE >= 365 THEN '1_year_plus' WHEN l_shipdate::DATE - o_orderdate::DATE >= 105 THEN '1_year_minus' WHEN l_shipdate::DATE - o_orderdate::DATE >= 45 THEN 'anchor_90'
        WHEN l_shipdate::DATE - o_orderdate::DATE >= 0 THEN 'anchor_30' ELSE 'free' END END AS bucket
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
LOG_SQL = """log AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 2 = 0 THEN 'BSE' ELSE 'NSE' END AS exchange, CASE WHEN o_custkey % 2 = 0 THEN 'BSE' ELSE 'NSE' END || ':' || o_custkey AS unique_symbol,
    CASE WHEN o_custkey % 2 = 0 THEN o_custkey || '-CUST-Annexure-I.pdf' ELSE 'CUST' || o_custkey || '-CML' || o_orderkey || '.pdf' END AS file_name,
    CASE o_orderstatus WHEN 'F' THEN 'FINALIZED' WHEN 'O' THEN 'VALIDATING' ELSE 'NEW' END AS status, o_orderdate AS processed_at, s.* EXCLUDE (processing_log_id), shp_promoter_shares + shp_public_shares + shp_others_shares AS shp_total_shares
    FROM orders LEFT JOIN (SELECT processing_log_id, sum(shares)::BIGINT AS computed_total, sum(CASE WHEN status = 'LOCKED' THEN shares ELSE 0 END)::BIGINT AS locked_total, sum(CASE WHEN status = 'FREE' THEN shares ELSE 0 END)::BIGINT AS free_total,
        sum(CASE WHEN security_type = 'A' THEN shares ELSE 0 END)::BIGINT AS shp_promoter_shares, sum(CASE WHEN security_type = 'N' THEN shares ELSE 0 END)::BIGINT AS shp_public_shares,
        sum(CASE WHEN security_type = 'R' THEN shares ELSE 0 END)::BIGINT AS shp_others_shares FROM lots GROUP BY 1) s ON o_orderkey = s.processing_log_id)"""
MASTER_SQL = """master AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey::VARCHAR END AS bse_script_code, CASE WHEN c_custkey % 2 <> 0 THEN c_custkey::VARCHAR END AS nse_symbol, c_name AS company_name, c_mktsegment AS ipo_name FROM customer)"""
