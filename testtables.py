"""Transactions derived from the TPC-H-like test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.contracts import TRANSACTION_SCHEMA
from ledgerlake.sources import scratch_path

# Which transaction type stands for an order priority.
TYPE_OF_PRIORITY = {
    "1-URGENT": "TRANSFER",
    "2-HIGH": "CASH_OUT",
    "3-MEDIUM": "PAYMENT",
    "4-NOT SPECIFIED": "CASH_IN",
    "5-LOW": "DEBIT",
}


def _every(n: int) -> Column:
    return F.col("txn_id") % n == 0


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions, some of them twice.

    Column ``txn_id`` and the contract's columns. Every 97th order appears as an
    exact copy; every 106th once more with amount 0 in place of null. The copies
    are added after the join, so both tables are read once.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")

    mapping = F.lit(None).cast("string")
    for priority, name in TYPE_OF_PRIORITY.items():
        mapping = F.when(F.col("o_orderpriority") == priority, name).otherwise(mapping)

    price, balance = F.col("price"), F.col("balance")
    broke = F.col("customer") % 10 == 0
    fee = 1 + (F.col("txn_id") % 5) * F.lit(0.0085)
    named = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("txn_id"),
        F.col("o_custkey").alias("customer"),
        F.col("o_totalprice").alias("price"),
        F.abs("c_acctbal").alias("balance"),
        mapping.alias("type"),
    )
    copies = F.array_compact(
        F.array(F.lit("original"), F.when(_every(97), "copy"), F.when(_every(106), "zeroed"))
    )
    amount = F.when(F.col("copy") == "zeroed", F.lit(0.0)).when(~_every(53), price)
    return named.withColumn("copy", F.explode(copies)).select(
        "txn_id",
        (F.col("txn_id") % 744 + 1).cast("int").alias("step"),
        "type",
        amount.alias("amount"),
        F.concat(F.lit("C"), "customer").alias("nameOrig"),
        F.when(broke, F.lit(0.0)).otherwise(price + balance).alias("oldbalanceOrg"),
        F.when(broke, F.lit(0.0)).otherwise(price + balance - price * fee).alias("newbalanceOrig"),
        F.concat(
            F.when(F.col("type") == "PAYMENT", "M").otherwise("C"), F.col("txn_id") % 1000
        ).alias("nameDest"),
        F.when(~_every(59), balance).alias("oldbalanceDest"),
        F.when(~_every(59), balance + price).alias("newbalanceDest"),
        _every(775).cast("int").alias("isFraud"),
        ((price > 490000) & (F.col("type") == "TRANSFER")).cast("int").alias("isFlaggedFraud"),
    )


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`transactions` with null and invalid types and negative amounts."""
    stray = F.when(_every(199), "REFUND").when(_every(197), "cash-in").otherwise(F.col("type"))
    return transactions(spark, sf_dir).withColumns(
        {
            "type": F.when(~_every(211), stray),
            "amount": F.when(_every(193), -F.col("amount")).otherwise(F.col("amount")),
        }
    )


def write_transactions_csv(
    spark: SparkSession, sf_dir: str, part: int | None = None, parts: int = 2
) -> str:
    """Store :func:`transactions` as CSV files with a header; return the path.

    ``part`` takes the transactions of one of ``parts`` deliveries; copies of a
    transaction lie in the same one.
    """
    path = scratch_path(spark, "csv")
    columns = TRANSACTION_SCHEMA.fieldNames()
    rows = transactions(spark, sf_dir)
    if part is not None:
        rows = rows.where(F.col("txn_id") % parts == part)
    rows.select(*columns).write.option("header", True).csv(path)
    return path
