"""The funnel tables played by the generic test tables.

Customers stand for the lender's customers, orders for sales and leads (one
lead per order), events for marketing touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import CONVERTED, NOT_CONVERTED, percent
from sluice.operators.joins import attach_lookup
from sluice.sources.tables import read_parquet


def crm(spark: SparkSession, folder: str) -> DataFrame:
    return read_parquet(spark, folder, "customer").select(
        F.col("c_custkey").alias("Customer_ID"), F.col("c_mktsegment").alias("Profession"),
        F.col("c_acctbal").alias("Account_Balance"))


def people(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with where they live.  Nations and regions are fixed, tiny tables."""
    places = (read_parquet(spark, folder, "nation")
              .join(read_parquet(spark, folder, "region"), F.expr("n_regionkey = r_regionkey")))
    return (read_parquet(spark, folder, "customer")
            .join(places, F.expr("c_nationkey = n_nationkey"))
            .select(F.col("c_custkey").alias("Customer_ID"),
                    F.col("c_mktsegment").alias("Profession"),
                    F.col("c_acctbal").alias("Account_Balance"),
                    F.col("n_name").alias("City"), F.col("r_name").alias("Location")))


def external(spark: SparkSession, folder: str) -> DataFrame:
    return people(spark, folder).select("Customer_ID", "City", "Location")


def marketing(spark: SparkSession, folder: str) -> DataFrame:
    """One row per touched customer; touches are counted before they are shuffled."""
    kind, n = F.col("event_type"), F.count(F.lit(1))
    return (read_parquet(spark, folder, "events").groupBy(F.col("user_id").alias("Customer_ID"))
            .agg(n.alias("Touches"),
                 percent(F.count_if(kind == "view"), n).alias("Email_Open_Rate(%)"),
                 percent(F.count_if(kind == "click"), n)
                 .alias("Click-Through_Rate_on_open_email_(%)"),
                 F.max("event_type").alias("Device_Type")))


def _status() -> Column:
    return F.when(F.col("o_orderstatus") == "F", CONVERTED).otherwise(NOT_CONVERTED)


def sales(spark: SparkSession, folder: str) -> DataFrame:
    return read_parquet(spark, folder, "orders").select(
        F.col("o_custkey").alias("Customer_ID"), F.col("o_orderkey").alias("Order_ID"),
        F.col("o_totalprice").alias("Sale_Amount"), F.col("o_orderpriority").alias("Lead_Source"),
        F.col("o_orderdate").alias("Start_Date"), _status().alias("Conversion_Status"))


def leads(spark: SparkSession, folder: str) -> DataFrame:
    """One row per lead with its customer's data."""
    return lead_details(spark, folder, sales(spark, folder)).drop("Start_Date")


def lead_details(spark: SparkSession, folder: str, orders: DataFrame) -> DataFrame:
    """Attach customer data to leads, batch or stream."""
    joined = attach_lookup(orders.withColumnRenamed("Order_ID", "Lead_ID"),
                           people(spark, folder), "Customer_ID", how="inner")
    rest = [c for c in joined.columns if c not in ("Lead_ID", "Customer_ID")]
    return joined.select("Lead_ID", "Customer_ID", *rest)


def rule_score(balance: str = "Account_Balance") -> Column:
    """A fixed score in [0, 1] for queries that must not depend on a model."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0),
                                          (F.col(balance) + 1000.0) / F.lit(11000.0)))
