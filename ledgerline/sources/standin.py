"""Campaign and transaction tables derived from the order and event tables.

The derivation is plain SQL that Spark and other engines read alike. The join
side is chosen by Catalyst from its size; AQE splits hot customers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

CAMPAIGN_COLUMNS_SQL = """
SELECT o_orderkey AS row_id,
  CAST(18 + o_custkey % 78 AS INT) AS age,
  CASE WHEN o_orderkey % 97 = 0 THEN 'unknown' ELSE lower(c_mktsegment) END AS job,
  CASE o_orderkey % 5 WHEN 0 THEN 'divorced' WHEN 1 THEN 'single' ELSE 'married' END AS marital,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'primary' WHEN '3-MEDIUM' THEN 'tertiary'
       WHEN '4-NOT SPECIFIED' THEN 'unknown' ELSE 'secondary' END AS education,
  CASE WHEN o_custkey % 50 = 0 THEN 'yes' ELSE 'no' END AS in_default,
  CAST(floor(c_acctbal * 1.5) AS INT) AS balance,
  CASE WHEN o_orderkey % 9 < 5 THEN 'yes' ELSE 'no' END AS housing,
  CASE WHEN c_nationkey % 6 = 0 THEN 'yes' ELSE 'no' END AS loan,
  CASE o_orderkey % 3 WHEN 0 THEN 'cellular' WHEN 1 THEN 'telephone' ELSE 'unknown' END AS contact,
  CAST(day(o_orderdate) AS INT) AS day,
  CASE month(o_orderdate) WHEN 1 THEN 'jan' WHEN 2 THEN 'feb' WHEN 3 THEN 'mar' WHEN 4 THEN 'apr'
       WHEN 5 THEN 'may' WHEN 6 THEN 'jun' WHEN 7 THEN 'jul' WHEN 8 THEN 'aug' WHEN 9 THEN 'sep'
       WHEN 10 THEN 'oct' WHEN 11 THEN 'nov' ELSE 'dec' END AS month,
  CAST(floor(o_totalprice / 100) AS INT) AS duration,
  CAST(1 + o_orderkey % 7 AS INT) AS campaign,
  CAST(CASE WHEN o_custkey % 4 <> 0 THEN -1 ELSE 1 + o_orderkey % 300 END AS INT) AS pdays,
  CAST(CASE WHEN o_custkey % 4 <> 0 THEN 0 ELSE 1 + o_orderkey % 5 END AS INT) AS previous,
  CASE WHEN o_custkey % 4 <> 0 THEN 'unknown' WHEN o_orderkey % 3 = 0 THEN 'success'
       WHEN o_orderkey % 3 = 1 THEN 'failure' ELSE 'other' END AS poutcome,
  CASE WHEN (o_orderstatus = 'F' AND o_totalprice > 380000)
         OR (o_custkey % 4 = 0 AND o_orderkey % 3 = 0 AND o_orderstatus <> 'O')
       THEN 'yes' ELSE 'no' END AS y
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

# Sector lookup for the derived jobs; machinery and unknown have no sector.
STANDIN_SECTORS = (
    ("automobile", "industry"), ("building", "industry"),
    ("furniture", "services"), ("household", "other"),
)


def campaign_from(spark: SparkSession, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Raw campaign rows of orders, a table or a stream, and the customer table."""
    return spark.sql(CAMPAIGN_COLUMNS_SQL, orders=orders, customer=customer).withColumnRenamed("in_default", "default")


def campaign(spark: SparkSession, folder: str) -> DataFrame:
    """Raw campaign table with a ``row_id`` key in front."""
    return campaign_from(
        spark, spark.read.parquet(f"{folder}/orders.parquet"), spark.read.parquet(f"{folder}/customer.parquet"))


def order_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The order table read as a stream of files; the braces make the path a glob."""
    schema = spark.read.parquet(f"{folder}/orders.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/{{orders}}.parquet")


def contacts(spark: SparkSession, folder: str) -> DataFrame:
    """Each order as a dated contact with a client."""
    day = F.col("o_orderdate").cast("date")
    return spark.read.parquet(f"{folder}/orders.parquet").select(
        F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("client_id"), day.alias("contact_date"),
        F.col("o_totalprice").alias("amount"), F.year(day).alias("year"), F.month(day).alias("month"))


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Each customer as a client with job and balance."""
    return spark.read.parquet(f"{folder}/customer.parquet").select(
        F.col("c_custkey").alias("client_id"), F.lower("c_mktsegment").alias("job"), F.col("c_acctbal").alias("balance"))


def as_transactions(events: DataFrame) -> DataFrame:
    """Event rows in the transaction schema; works on batch and stream alike."""
    return events.select(
        F.col("event_id").cast("string").alias("txn_id"),
        F.col("user_id").cast("string").alias("account_id"),
        F.col("event_type").alias("job"),
        F.col("value").alias("amount"),
        F.lit("EUR").alias("currency"),
        F.col("ts").cast("timestamp").alias("txn_time"),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return as_transactions(spark.read.parquet(f"{folder}/events.parquet"))
