"""Business statistics and local-currency payments by cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citypulse.functions.dates import age_on, month_key, month_label
from citypulse.functions.people import age_band
from citypulse.functions.values import cell_id_text
from citypulse.operators.lookup import map_column
from citypulse.operators.shape import drop_columns, lower_columns, sum_or_zero
from citypulse.schemas import PAYMENT_HEADERS

# Result columns of the business statistics, before lower-casing and renaming.
BUSINESS_COLUMNS = [
    "QID50",
    "BS_YR_MON",
    "SIC_CD_LV4",
    "SIC_FST_CLSFY_ITM_NM",
    "SIC_SCND_CLSFY_ITM_NM",
    "SHOP_CNT",
    "OP_CNT",
    "NEW_OPN_CNT",
    "RUN_OUT_CNT",
    "TOT_SALE_AMT",
    "TOT_SALES_AMT0_CNT",
    "TOT_SALES_AMT5_CNT",
]
BUSINESS_RENAMES = {"qid50": "grid_id", "bs_yr_mon": "std_ym", "tot_sales_amt5_cnt": "tot_sales_amt5m_cnt"}
PRIVATE_COLUMNS = ["pay_no", "home_address", "merchant_address"]


def business_stats(stats: DataFrame, industries: DataFrame) -> DataFrame:
    """Statistics with the industry's names; rows of an unknown industry are left out."""
    joined = stats.join(industries, stats["SIC_CD_LV4"] == industries["SIC_CD"])
    shaped = lower_columns(joined.select(*[F.col(c) for c in BUSINESS_COLUMNS]), BUSINESS_RENAMES)
    return shaped.withColumns(
        {"grid_id": cell_id_text(F.col("grid_id")), "std_ym": F.col("std_ym").cast("string")}
    )


def rename_payment_file(payments: DataFrame) -> DataFrame:
    """Names of this library instead of the headers in a payment file."""
    return payments.withColumnsRenamed(PAYMENT_HEADERS)


def payments_by_cell(payments: DataFrame, merchant_cells: DataFrame) -> DataFrame:
    """Payments and amount by cell, industry and month; rows with a missing key are left out.

    ``payments(pay_no, pay_date, merchant, ind_type, amount)``, ``merchant_cells(merchant, grid_id)``.
    Sums are taken per merchant before the lookup and per cell after it: a merchant with a
    third of all payments reaches the join as one row per industry and month.
    """
    month = month_key(F.to_date("pay_date"))
    per_merchant = (
        payments.select("pay_no", "merchant", "ind_type", "amount", month.alias("std_ym"))
        .na.drop(subset=["merchant", "ind_type", "std_ym"])
        .groupBy("merchant", "ind_type", "std_ym")
        .agg(F.count("pay_no").alias("pay_cnt"), sum_or_zero("amount").alias("pay_amt"))
    )
    return (
        map_column(per_merchant, "merchant", merchant_cells, "merchant", "grid_id", "grid_id")
        .na.drop(subset=["grid_id"])
        .groupBy("grid_id", "std_ym", "ind_type")
        .agg(F.sum("pay_cnt").alias("pay_cnt"), F.sum("pay_amt").alias("pay_amt"))
        .withColumn("grid_id", F.col("grid_id").cast("string"))
    )


def payments_with_age(payments: DataFrame, merchant_cells: DataFrame, left_closed: bool = False) -> DataFrame:
    """Every payment with its cell, month, payer age and age band, without private columns.

    Days that are not a date (``yyyy-MM-dd`` for payments, ``yyyyMMdd`` for births) become NULL.
    """
    dated = payments.withColumns(
        {
            "pay_date": F.try_to_date(F.col("pay_date").cast("string"), "yyyy-MM-dd"),
            "birth": F.try_to_date(F.col("birth").cast("string"), "yyyyMMdd"),
        }
    )
    placed = map_column(dated, "merchant", merchant_cells, "merchant", "grid_id", "grid_id", split_hot=True)
    aged = placed.withColumns(
        {
            "pay_month": month_label(F.col("pay_date")),
            "std_ym": month_key(F.col("pay_date")),
            "age": age_on(F.col("pay_date"), F.col("birth")),
            "grid_id": F.col("grid_id").cast("string"),
        }
    )
    banded = aged.withColumn("age_band", age_band(F.col("age"), left_closed))
    return drop_columns(banded, PRIVATE_COLUMNS)
