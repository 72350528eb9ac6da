"""The shared inputs of the queries, once as DataFrames and once as SQL text.

Each splits a whole table into what is stored and what arrives, by dates or other column values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.functions.timing import ntz
from tableloom.plans.publish import Publisher
from tableloom.session import scratch_database

T0, T1, T2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def publisher(spark: SparkSession) -> Publisher:
    return Publisher(spark, scratch_database(spark))


# Orders: stored up to the end of 1999; the batch restates 1999 and adds what came later.
def orders_loaded(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").where(F.col("o_orderdate") < ntz("2000-01-01"))


def orders_arriving(spark, sf) -> DataFrame:
    return (
        table(spark, sf, "orders")
        .where(F.col("o_orderdate") >= ntz("1999-01-01"))
        .withColumn("o_orderstatus", F.lit("U"))
        .withColumn("o_totalprice", F.col("o_totalprice") + 100)
    )


LOADED = "loaded AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')"
ARRIVING = """arriving AS (
  SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 100 AS o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')"""
MERGED = """merged AS (
  SELECT * FROM arriving
  UNION ALL
  SELECT * FROM loaded WHERE o_orderkey NOT IN (SELECT o_orderkey FROM arriving))"""
ORDERS = f"WITH {LOADED}, {ARRIVING}"
ORDERS_MERGED = f"{ORDERS}, {MERGED}"

# Whole cents, so that sums do not depend on the order of addition.
CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"


def cents(name: str = "o_totalprice"):
    return F.round(F.col(name) * 100).cast("bigint")


CUSTOMER_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


# Customers: at T1 accounts that were overdrawn join, large furniture accounts leave, and others change.
def customers_t0(spark, sf) -> DataFrame:
    return table(spark, sf, "customer").where("c_acctbal >= -500").select(*CUSTOMER_COLUMNS)


def customers_t1(spark, sf) -> DataFrame:
    balance = F.col("c_acctbal")
    return (
        table(spark, sf, "customer")
        .where(~((F.col("c_mktsegment") == "FURNITURE") & (balance > 5000)))
        .withColumn("c_nationkey", F.when(balance < 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey")))
        .withColumn("c_mktsegment", F.when((balance >= 1000) & (balance < 3000), "CHANGED").otherwise(F.col("c_mktsegment")))
        .select(*CUSTOMER_COLUMNS)
    )


CUSTOMERS = """t0 AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal >= -500),
t1 AS (
  SELECT c_custkey, c_name, c_acctbal,
         CASE WHEN c_acctbal < 0 THEN c_nationkey + 100 ELSE c_nationkey END AS c_nationkey,
         CASE WHEN c_acctbal >= 1000 AND c_acctbal < 3000 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE NOT (c_mktsegment = 'FURNITURE' AND c_acctbal > 5000))"""
