"""Schemas, type constants and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Numeric tiers.
#
# Pipeline tier: exact decimals at 4 places so that sums never depend on the
# order in which partitions are combined (float sums would).
# Table tier: the column types of the published ``sales_data`` /
# ``customer_summary`` tables (rounded to 2 places when rows enter them).
# ---------------------------------------------------------------------------
PRICE = T.DecimalType(12, 4)
AMOUNT = T.DecimalType(18, 4)
TOTAL = T.DecimalType(38, 4)  # sums of pipeline-tier amounts

TABLE_PRICE = T.DecimalType(10, 2)
TABLE_AMOUNT = T.DecimalType(12, 2)
TABLE_TOTAL = T.DecimalType(38, 2)  # sums of table-tier amounts

# Raw transaction lines, as they arrive (names as in the source file).
RAW_SCHEMA = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType(), True),
        T.StructField("StockCode", T.StringType(), True),
        T.StructField("Description", T.StringType(), True),
        T.StructField("Quantity", T.IntegerType(), True),
        T.StructField("InvoiceDate", T.TimestampNTZType(), True),
        T.StructField("UnitPrice", PRICE, True),
        T.StructField("CustomerID", T.StringType(), True),
        T.StructField("Country", T.StringType(), True),
    ]
)
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# Columns the cleaning stage appends, in order.
DERIVED_COLUMNS = [
    "Return_Qty",
    "Sale_Qty",
    "Paid_UnitPrice",
    "Is_Free_Item",
    "Revenue",
    "Net_Revenue",
    "Total_Items",
]
CLEAN_COLUMNS = RAW_COLUMNS + DERIVED_COLUMNS

# ``sales_data`` table: lower-case names, table-tier types.
SALES_SCHEMA = T.StructType(
    [
        T.StructField("invoiceno", T.StringType(), True),
        T.StructField("stockcode", T.StringType(), True),
        T.StructField("description", T.StringType(), True),
        T.StructField("quantity", T.IntegerType(), True),
        T.StructField("invoicedate", T.TimestampNTZType(), True),
        T.StructField("unitprice", TABLE_PRICE, True),
        T.StructField("customerid", T.StringType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("return_qty", T.IntegerType(), True),
        T.StructField("sale_qty", T.IntegerType(), True),
        T.StructField("paid_unitprice", TABLE_PRICE, True),
        T.StructField("is_free_item", T.StringType(), True),
        T.StructField("revenue", TABLE_AMOUNT, True),
        T.StructField("net_revenue", TABLE_AMOUNT, True),
        T.StructField("total_items", T.IntegerType(), True),
    ]
)

# ``customer_summary`` table: lower-case names, table-tier types.
SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("customerid", T.StringType(), False),
        T.StructField("total_purchases", T.IntegerType(), True),
        T.StructField("total_net_revenue", TABLE_AMOUNT, True),
        T.StructField("total_sale_qty", T.IntegerType(), True),
        T.StructField("total_return_qty", T.IntegerType(), True),
        T.StructField("avg_order_value", TABLE_AMOUNT, True),
        T.StructField("recencydays", T.IntegerType(), True),
        T.StructField("return_rate", T.DecimalType(10, 6), True),
        T.StructField("net_qty", T.IntegerType(), True),
        T.StructField("purchase_frequency_monthly", T.DecimalType(10, 2), True),
        T.StructField("customer_value", T.StringType(), True),
    ]
)

# Declared text lengths of the two tables (fixed values).
SALES_LENGTHS = {"invoiceno": 20, "stockcode": 50, "customerid": 20, "country": 100, "is_free_item": 3}
SUMMARY_LENGTHS = {"customerid": 20, "customer_value": 20}

# Column order of the pipeline's customer summary (source-file names).
SUMMARY_COLUMNS = [
    "CustomerID",
    "Total_Purchases",
    "Total_Net_Revenue",
    "Total_Sale_Qty",
    "Total_Return_Qty",
    "Avg_Order_Value",
    "RecencyDays",
    "Return_Rate",
    "Net_Qty",
    "Purchase_Frequency_Monthly",
    "Customer_Value",
]

# ---------------------------------------------------------------------------
# Fixed values that must match the analysed application exactly.
# ---------------------------------------------------------------------------
UNKNOWN_PRODUCT = "Unknown Product"
UNKNOWN_CUSTOMER = "Unknown"
UNSPECIFIED_COUNTRY = "Unspecified"
NON_PRODUCT_CODES = ("S", "D", "BANK CHARGES", "CRUK", "M", "AMAZONFEE")
FREE_YES = "Yes"
FREE_NO = "No"
VALUE_POSITIVE = "Positive"
VALUE_NEGATIVE = "Negative"
QUARTILE_LABELS = ("Bronze", "Silver", "Gold", "Platinum")
# Spend thresholds (inclusive lower bounds) and their segment labels.
SPEND_SEGMENTS = (
    (1000, "VIP (>$1K)"),
    (500, "Premium ($500-$1K)"),
    (100, "Regular ($100-$500)"),
)
SPEND_SEGMENT_OTHER = "Small (<$100)"
DAY_ABBREVIATIONS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")  # 0 = Sunday
QUICK_RANGE_DAYS = {"30d": 30, "quarter": 90, "year": 365}
SUSPICIOUS_BEFORE = "2010-11-01 00:00:00"
COMPLETENESS_OK_PCT = 80.0

# Cleaned lines as written by the pipeline (source-file names, pipeline tier).
CLEAN_SCHEMA = T.StructType(
    list(RAW_SCHEMA.fields)
    + [
        T.StructField("Return_Qty", T.IntegerType(), True),
        T.StructField("Sale_Qty", T.IntegerType(), True),
        T.StructField("Paid_UnitPrice", PRICE, True),
        T.StructField("Is_Free_Item", T.StringType(), True),
        T.StructField("Revenue", AMOUNT, True),
        T.StructField("Net_Revenue", AMOUNT, True),
        T.StructField("Total_Items", T.IntegerType(), True),
    ]
)

# Customer summary as written by the pipeline (pipeline tier).
PIPELINE_SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("CustomerID", T.StringType(), True),
        T.StructField("Total_Purchases", T.LongType(), True),
        T.StructField("Total_Net_Revenue", TOTAL, True),
        T.StructField("Total_Sale_Qty", T.LongType(), True),
        T.StructField("Total_Return_Qty", T.LongType(), True),
        T.StructField("Avg_Order_Value", T.DoubleType(), True),
        T.StructField("RecencyDays", T.IntegerType(), True),
        T.StructField("Return_Rate", T.DoubleType(), True),
        T.StructField("Net_Qty", T.LongType(), True),
        T.StructField("Purchase_Frequency_Monthly", T.DoubleType(), True),
        T.StructField("Customer_Value", T.StringType(), True),
    ]
)
