"""The procurement star (purchases, sales, purchase_prices, vendor_invoice)
derived from the TPC-H-style test tables (FIXTURES.md §2).

Every view is a lazy DataFrame over the parquet scans, so filters and
column pruning reach the files.  Money is DECIMAL so sums are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dec(c, p: int, s: int):
    return (F.col(c) if isinstance(c, str) else c).cast(T.DecimalType(p, s))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass
class Star:
    purchases: DataFrame
    sales: DataFrame
    purchase_prices: DataFrame
    vendor_invoice: DataFrame


def supplier_count(spark: SparkSession, sf_dir: str) -> int:
    # Parquet row counts come from file footers; no data is scanned.
    return read_table(spark, sf_dir, "supplier").count()


def purchases(spark: SparkSession, sf_dir: str, ns: int) -> DataFrame:
    li = (read_table(spark, sf_dir, "lineitem")
          .where(F.col("l_linestatus") == "F")
          .select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate"))
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    # Line items stay narrow until the last join, which brings the texts: no shuffle carries
    # those for each line, and a part's lines end up together, so that sums by brand shrink
    # in the tasks that read them.
    named = part.join(supp, (part.p_partkey % F.lit(ns)) == supp.s_suppkey)
    j = (li.join(orders, li.l_orderkey == orders.o_orderkey)
         .join(named, li.l_partkey == named.p_partkey))
    zero_price = (F.col("l_partkey") % 23) == 0
    price = F.when(zero_price, dec(F.lit(0), 14, 4)).otherwise(
        dec(dec("p_retailprice", 8, 2) * dec(F.lit("0.7"), 2, 1), 14, 4))
    return j.select(
        F.concat(F.col("l_linenumber").cast("string"), F.lit("_"),
                 F.col("l_partkey").cast("string")).alias("InventoryId"),
        F.col("l_linenumber").alias("Store"),
        F.col("l_partkey").alias("Brand"),
        F.when((F.col("p_partkey") % 7) == 0, F.concat("p_name", F.lit("  ")))
         .otherwise(F.col("p_name")).alias("Description"),
        (F.col("p_size") * 50).cast("string").alias("Size"),
        (F.col("l_partkey") % F.lit(ns)).alias("VendorNumber"),
        F.when((F.col("l_partkey") % 3) == 0, F.concat("s_name", F.lit("   ")))
         .otherwise(F.col("s_name")).alias("VendorName"),
        F.col("l_orderkey").alias("PONumber"),
        F.to_date("o_orderdate").alias("PODate"),
        F.to_date("l_shipdate").alias("ReceivingDate"),
        price.alias("PurchasePrice"),
        F.col("l_quantity").cast("bigint").alias("Quantity"),
        dec(price * dec("l_quantity", 4, 0), 14, 4).alias("Dollars"),
    )


def sales(spark: SparkSession, sf_dir: str, ns: int) -> DataFrame:
    li = (read_table(spark, sf_dir, "lineitem")
          .where((F.col("l_linestatus") == "O") & ((F.col("l_partkey") % 11) != 0))
          .select("l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_shipdate"))
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    j = li.join(part, li.l_partkey == part.p_partkey)
    price = dec(dec("p_retailprice", 8, 2) * (F.lit(1) - dec("l_discount", 4, 2)), 14, 4)
    return j.select(
        F.concat(F.col("l_linenumber").cast("string"), F.lit("_"),
                 F.col("l_partkey").cast("string")).alias("InventoryId"),
        F.col("l_linenumber").alias("Store"),
        F.col("l_partkey").alias("Brand"),
        (F.col("l_partkey") % F.lit(ns)).alias("VendorNo"),
        F.col("l_quantity").cast("bigint").alias("SalesQuantity"),
        price.alias("SalesPrice"),
        dec(dec("l_quantity", 4, 0) * price, 14, 4).alias("SalesDollars"),
        F.to_date("l_shipdate").alias("SalesDate"),
        dec(dec("l_quantity", 4, 0) * dec("l_tax", 4, 2), 14, 4).alias("ExciseTax"),
    )


def purchase_prices(spark: SparkSession, sf_dir: str, ns: int) -> DataFrame:
    part = read_table(spark, sf_dir, "part").where((F.col("p_partkey") % 13) != 0)
    return part.select(
        F.col("p_partkey").alias("Brand"),
        F.col("p_name").alias("Description"),
        dec("p_retailprice", 14, 4).alias("Price"),
        F.when((F.col("p_partkey") % 29) == 0, F.lit("Unknown"))
         .otherwise((F.col("p_size") * 50).cast("string")).alias("Volume"),
        F.when((F.col("p_partkey") % 19) == 0, F.lit(-1).cast("bigint"))
         .otherwise(F.col("p_partkey") % F.lit(ns)).alias("VendorNumber"),
        dec(dec("p_retailprice", 8, 2) * dec(F.lit("0.68"), 3, 2), 14, 4).alias("PurchasePrice"),
    )


def vendor_invoice(purch: DataFrame) -> DataFrame:
    return (purch.where((F.col("VendorNumber") % 10) != 7)
            .groupBy("VendorNumber", "PONumber")
            .agg(F.min("ReceivingDate").alias("InvoiceDate"),
                 F.sum("Quantity").alias("Quantity"),
                 F.sum("Dollars").alias("Dollars"))
            .withColumn("Freight", dec(F.col("Dollars") * dec(F.lit("0.005"), 4, 3), 18, 6)))


def load_star(spark: SparkSession, sf_dir: str) -> Star:
    ns = supplier_count(spark, sf_dir)
    p = purchases(spark, sf_dir, ns)
    return Star(purchases=p, sales=sales(spark, sf_dir, ns),
                purchase_prices=purchase_prices(spark, sf_dir, ns),
                vendor_invoice=vendor_invoice(p))
