"""Ledger tables derived from the driver's test tables, on the Spark side.

``harness/oracle_views.py`` states the same views as SQL for the oracle.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.schemas import LEDGER_COLUMNS
from ledgermill.sources.tables import LedgerTables

MONEY = "decimal(18,2)"


def merchant_id(custkey: str) -> Column:
    return F.concat(F.lit("6354"), F.lpad(F.col(custkey).cast("string"), 12, "0"))


class Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    @cached_property
    def iso(self) -> DataFrame:
        kinds = (
            F.when(F.col("n_regionkey") % 4 == 0, "MID").when(F.col("n_regionkey") % 4 == 1, "Gateway")
            .when(F.col("n_regionkey") % 4 == 2, "MID").otherwise("3rd Party")
        )
        return self.read("nation").select(
            (F.col("n_nationkey").cast("int") + 1).alias("id"), F.col("n_name").alias("iso"),
            kinds.alias("referral_type"),
            F.when(F.col("n_nationkey") % 7 == 0, 0).otherwise(1).alias("is_active"),
        )

    @cached_property
    def sic_codes(self) -> DataFrame:
        return self.read("part").select(
            (5000 + F.col("p_size")).cast("string").alias("sic_code"),
            F.concat(F.lit("Industry "), F.col("p_size").cast("string")).alias("description"),
        ).distinct()

    @cached_property
    def merchants(self) -> DataFrame:
        k = F.col("c_custkey")
        split = "decimal(5,2)"

        def text(c: Column) -> Column:
            return c.cast("string")

        return self.read("customer").join(self.iso, F.col("id") == F.col("c_nationkey") + 1).select(
            merchant_id("c_custkey").alias("mid"), F.col("c_name").alias("dba"),
            F.when(k % 29 == 0, F.lit(None)).when(k % 31 == 0, "")
            .otherwise(F.concat(F.lit("Corp "), text(k % 97))).alias("corporation"),
            "iso", F.col("referral_type").alias("iso_referral_type"),
            text(5001 + k % 60).alias("sic_code"),
            F.concat(F.lit("Industry "), text(1 + k % 60)).alias("sic_description"),
            F.make_date(F.lit(1994), (1 + k % 12).cast("int"), (1 + k % 28).cast("int")).alias("approval_date"),
            F.when(k % 11 == 0, F.make_date(F.lit(2001), (1 + k % 12).cast("int"), F.lit(1))).alias("closed_date"),
            F.when(k % 11 == 0, 0).otherwise(1).alias("is_active"),
            F.when(k % 3 == 0, 1).otherwise(0).alias("is_referred"),
            F.when(k % 3 == 0, F.concat(F.lit("Agent "), text(k % 10))).alias("agent1_name"),
            F.when(k % 3 == 0, (10 + 5 * (k % 5)).cast(split)).alias("agent1_split"),
            F.when(k % 6 == 0, F.concat(F.lit("Agent "), text((k + 3) % 10))).alias("agent2_name"),
            F.when(k % 6 == 0, (5 * (k % 4)).cast(split)).alias("agent2_split"),
        )

    @cached_property
    def revenue(self) -> DataFrame:
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        discount, tax = (F.col(c).cast("decimal(4,2)") for c in ("l_discount", "l_tax"))
        base = (
            self.read("lineitem")
            .join(self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .groupBy(F.trunc("o_orderdate", "month").alias("date"), "o_custkey")
            .agg(
                F.sum(price).cast(MONEY).alias("volume"),
                F.round(F.sum(price * discount), 2).cast(MONEY).alias("total_residual"),
                F.round(F.sum(price * (discount - tax)), 2).cast(MONEY).alias("house_residual"),
                F.max("l_shipdate").alias("updated_at"),
            )
            .withColumn("mid", merchant_id("o_custkey"))
        )
        house = F.col("house_residual")
        percent = F.lit(Decimal("0.01"))
        referred = F.col("is_referred") == 1

        def payout(i: int) -> Column:
            return F.round(house * F.col(f"agent{i}_split") * percent, 2).cast(MONEY)

        return (
            base.join(self.merchants, "mid")
            .withColumn("agent1_percentage", F.col("agent1_split"))
            .withColumn("agent2_percentage", F.col("agent2_split"))
            .withColumn("agent1_payout", F.when(referred, payout(1)))
            .withColumn(
                "agent2_payout",
                F.when(referred & (F.col("agent2_split") != 0) & (house != 0), payout(2)),
            )
            .withColumn("updated_by", F.lit("import"))
            .select(*LEDGER_COLUMNS)
        )

    @cached_property
    def adjustments(self) -> DataFrame:
        n = F.col("s_suppkey") % 80
        return self.read("supplier").select(
            F.col("s_suppkey").alias("id"), (F.col("s_nationkey").cast("int") + 1).alias("iso_id"),
            F.make_date((1995 + F.floor(n / 12)).cast("int"), (1 + n % 12).cast("int"), F.lit(1)).alias("date"),
            F.col("s_acctbal").cast(MONEY).alias("adjustment_price"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        return (
            self.revenue.groupBy("iso", "date").agg(F.sum("house_residual").alias("house"))
            .join(self.iso.filter("id % 4 <> 0").select("id", "iso"), "iso")
            .select(
                F.col("id").alias("iso_id"), "date",
                F.round(F.col("house") * F.lit(Decimal("0.98")), 2).cast(MONEY).alias("bank_amount"),
            )
        )

    @cached_property
    def tables(self) -> LedgerTables:
        return LedgerTables(
            revenue=self.revenue, merchants=self.merchants, iso=self.iso,
            adjustments=self.adjustments, payments=self.payments, sic_codes=self.sic_codes,
        )
