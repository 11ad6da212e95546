"""Sales models: staging, joins and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.functions import exprs
from tablekit.operators import agg, cols, join, merge

# Labels per payment method and sale status; both spellings of a cancelled sale count.
PAYMENT_TYPES = {"Card": "Credit/Debit Card", "UPI": "Digital Wallet", "NetBanking": "Bank Transfer"}
STATUS = {
    "completed": "Processing Closed",
    "pending": "Processing Opened",
    "canceled": "Processing Aborted",
    "cancelled": "Processing Aborted",
}


def payment_type(col: str) -> Column:
    return cols.case_map(col, PAYMENT_TYPES, "Other")


def status(col: str) -> Column:
    return cols.case_map(col, STATUS, "Failed")


def stage_time(df: DataFrame, ts: str, date: str, time: str) -> DataFrame:
    """Split a timestamp into date and time of day."""
    return df.select(
        *[c for c in df.columns if c != ts], exprs.date_of(ts).alias(date), exprs.time_of(ts).alias(time)
    )


def by_city_status(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return agg.sum_count(
        join.inner(orders, customers, ["customer_id"]),
        ["city", "order_status"],
        {"total_amount": "amount"},
        {"total_orders": "order_id"},
    )


def _totals(count: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias(count),
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum("sale_amount").alias("total_sales_amount"),
    ]


def by_city(products: DataFrame, sales: DataFrame) -> DataFrame:
    """Per city and product.

    Sales are added up per city and product id before the join, so the join moves one row
    per pair and not every sale.
    """
    partial = sales.groupBy("city", "product_id").agg(*_totals("total_sales"))
    named = join.inner(partial, products.select("product_id", "product_name"), ["product_id"])
    return named.groupBy("city", "product_id", "product_name").agg(
        *[F.sum(c).alias(c) for c in ("total_sales", "total_quantity_sold", "total_sales_amount")]
    )


def by_customer(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_name").agg(*_totals("total_orders"))


def daily(sales: DataFrame) -> DataFrame:
    return sales.groupBy("sale_date").agg(*_totals("total_orders"))


def by_date(target: DataFrame | None, sales: DataFrame) -> DataFrame:
    """Daily totals; later runs add the days after the newest one."""
    if target is None:
        return daily(sales)
    fresh = merge.newer_than_target(target, sales, "sale_date")
    return target.unionByName(daily(fresh))


def by_payment(sales: DataFrame, methods: DataFrame) -> DataFrame:
    """Label and looked-up description, added up per method before the lookup."""
    partial = sales.groupBy("payment_method").agg(*_totals("total_orders"))
    described = join.broadcast(partial, methods, ["payment_method"], "left")
    totals = ("total_orders", "total_quantity_sold", "total_sales_amount")
    return described.groupBy(
        payment_type("payment_method").alias("payment_type"), F.col("description").alias("payment_method_description")
    ).agg(*[F.sum(c).alias(c) for c in totals])


def by_product(products: DataFrame, sales: DataFrame) -> DataFrame:
    """Per product; brand separates rows without being shown."""
    partial = sales.groupBy("product_id").agg(*_totals("n")).drop("n")
    keys = ["product_id", "product_name", "category", "brand"]
    joined = join.inner(partial, products.select(*keys), ["product_id"])
    totals = ("total_quantity_sold", "total_sales_amount")
    return joined.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in totals]).drop("brand")


def products_joined(sales: DataFrame, products: DataFrame) -> DataFrame:
    return join.inner(sales, products, ["product_id"])


def completed(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Sales whose status label is closed, with their product."""
    return join.filter_after(sales, products, ["product_id"], status("sale_status") == "Processing Closed")


def completed_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return join.filter_after(orders, customers, ["customer_id"], F.col("order_status") == "completed")


def customer_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return join.inner(orders, customers, ["customer_id"])


def products_incremental(target: DataFrame | None, products: DataFrame) -> DataFrame:
    """Products merged on their id; later runs take only newer ``created_at``."""
    chosen = products.select("product_id", "product_name", "category", "created_at")
    if target is not None:
        chosen = chosen.filter(F.col("product_id").isNotNull())
    return merge.incremental_model(target, chosen, "merge", ["product_id"], "created_at", ["created_at", "product_name"])
