"""DuckDB oracle SQL for every registered query.

Each statement starts from the driver's pre-registered tables and rebuilds
the same inputs as the Spark side with plain SQL: the fixture mapping, the
cleaning chain and the ``sales_data`` load. The CTE blocks below are shared
text; ``q(...)`` prefixes a final SELECT with the blocks it needs.
"""

from __future__ import annotations

RAW = """
raw_lines AS (
  SELECT
    CAST(l.l_orderkey AS VARCHAR) AS InvoiceNo,
    CASE l.l_partkey % 200 WHEN 7 THEN 'AMAZONFEE' WHEN 11 THEN 'M' WHEN 13 THEN 'BANK CHARGES'
         ELSE CAST(l.l_partkey AS VARCHAR) END AS StockCode,
    CASE WHEN l.l_partkey % 50 = 3 THEN NULL ELSE p.p_name END AS Description,
    CAST(CASE WHEN l.l_linenumber = 7 AND l.l_partkey % 4 = 0 THEN 0
              WHEN l.l_returnflag = 'R' OR o.o_custkey % 103 = 7
                   OR (l.l_partkey % 10 = 9 AND l.l_returnflag = 'A') THEN -CAST(l.l_quantity AS INTEGER)
              ELSE CAST(l.l_quantity AS INTEGER) END AS INTEGER) AS Quantity,
    o.o_orderdate + CAST(l.l_orderkey % 12 + CASE WHEN o.o_orderdate >= TIMESTAMP '2001-07-25 00:00:00'
                                                  THEN 0 ELSE 11 END AS INTEGER) * INTERVAL 1 HOUR AS InvoiceDate,
    CAST(CAST(CASE WHEN l.l_partkey % 97 = 0 THEN 0.0
                   WHEN l.l_partkey % 89 = 0 OR o.o_custkey % 101 = 5 THEN -p.p_retailprice
                   ELSE p.p_retailprice END AS DECIMAL(10,2)) AS DECIMAL(12,4)) AS UnitPrice,
    CASE WHEN o.o_custkey % 10 = 0 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS CustomerID,
    CASE n.n_nationkey WHEN 0 THEN 'United Kingdom' WHEN 22 THEN '' WHEN 23 THEN NULL
         WHEN 24 THEN 'Unspecified' ELSE n.n_name END AS Country,
    l.l_orderkey AS okey
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
raw AS (
  SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country FROM raw_lines
  UNION ALL
  SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country FROM raw_lines
  WHERE okey % 50 = 0
)"""

FILLED = """
filled AS (
  SELECT InvoiceNo, StockCode, COALESCE(Description, 'Unknown Product') AS Description, Quantity,
         InvoiceDate, UnitPrice, COALESCE(CustomerID, 'Unknown') AS CustomerID, Country
  FROM raw
),
dedup AS (SELECT DISTINCT * FROM filled)"""

CLEAN = """
priced AS (
  SELECT *,
         CAST(CASE WHEN Quantity < 0 THEN -Quantity ELSE 0 END AS INTEGER) AS Return_Qty,
         CAST(CASE WHEN Quantity > 0 THEN Quantity ELSE 0 END AS INTEGER) AS Sale_Qty,
         CAST(CASE WHEN UnitPrice > 0 THEN UnitPrice ELSE 0 END AS DECIMAL(12,4)) AS Paid_UnitPrice,
         CASE WHEN UnitPrice = 0 THEN 'Yes' ELSE 'No' END AS Is_Free_Item
  FROM dedup WHERE UnitPrice >= 0
),
clean AS (
  SELECT *,
         CAST(Sale_Qty * Paid_UnitPrice AS DECIMAL(18,4)) AS Revenue,
         CAST((Sale_Qty - Return_Qty) * Paid_UnitPrice AS DECIMAL(18,4)) AS Net_Revenue,
         CAST(Sale_Qty + Return_Qty AS INTEGER) AS Total_Items
  FROM priced
)"""

SALES = """
keyed AS (
  SELECT *, row_number() OVER (PARTITION BY InvoiceNo, StockCode, CustomerID
                               ORDER BY Description NULLS FIRST, Quantity NULLS FIRST, InvoiceDate NULLS FIRST,
                                        UnitPrice NULLS FIRST, Country NULLS FIRST) AS rn
  FROM clean
),
sales AS (
  SELECT InvoiceNo AS invoiceno, StockCode AS stockcode, Description AS description, Quantity AS quantity,
         InvoiceDate AS invoicedate, CAST(UnitPrice AS DECIMAL(10,2)) AS unitprice, CustomerID AS customerid,
         Country AS country, Return_Qty AS return_qty, Sale_Qty AS sale_qty,
         CAST(Paid_UnitPrice AS DECIMAL(10,2)) AS paid_unitprice, Is_Free_Item AS is_free_item,
         CAST(Revenue AS DECIMAL(12,2)) AS revenue, CAST(Net_Revenue AS DECIMAL(12,2)) AS net_revenue,
         Total_Items AS total_items
  FROM keyed WHERE rn = 1
)"""

LEVELS = {"raw": [RAW], "filled": [RAW, FILLED], "clean": [RAW, FILLED, CLEAN],
          "sales": [RAW, FILLED, CLEAN, SALES]}


def q(level: str, body: str, extra: str = "") -> str:
    """``WITH <blocks up to level>[, extra] <body>``."""
    blocks = ",".join(LEVELS[level])
    if extra:
        blocks += "," + extra
    return f"WITH {blocks}\n{body}"


ORACLES: dict[str, str] = {}


def oracle(name: str, level: str, body: str, extra: str = "") -> None:
    ORACLES[name] = q(level, body, extra)


# --- minimum slice ------------------------------------------------------------
oracle("sk1_raw_transactions", "raw", "SELECT * FROM raw")
oracle("p_clean_transactions", "clean", "SELECT * FROM clean")
oracle("sk3_sales_table", "sales", "SELECT * FROM sales")
oracle("a23_monthly_positive", "sales", """
SELECT CAST(date_trunc('month', invoicedate) AS TIMESTAMP) AS month,
       CAST(SUM(net_revenue) AS DECIMAL(38,2)) AS monthly_revenue
FROM sales WHERE net_revenue > 0
GROUP BY 1 ORDER BY 1""")

# Parameters shared with tillpoint.plans.registry.
COUNTRY = "United Kingdom"
PRODUCTS = "('blue anvil', 'hot rod', 'small widget')"
NOW = "TIMESTAMP '2026-01-01 00:00:00'"
EARLY = "TIMESTAMP '2010-11-01 00:00:00'"
RUN_ID = "20260101_000000"

M2 = "DECIMAL(38,2)"
M4 = "DECIMAL(38,4)"


def mean(x: str, cond: str | None = None) -> str:
    v = f"CASE WHEN {cond} THEN {x} END" if cond else x
    return f"(CAST(SUM({v}) AS DOUBLE) / CAST(NULLIF(COUNT({v}), 0) AS DOUBLE))"


def ratio(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / CAST(NULLIF({d}, 0) AS DOUBLE))"


def safe_ratio(n: str, d: str) -> str:
    return f"(CASE WHEN {d} > 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)"


MONTH = "CAST(date_trunc('month', invoicedate) AS TIMESTAMP)"
DEDUP_ORDER = "Description NULLS FIRST, Quantity NULLS FIRST, InvoiceDate NULLS FIRST, UnitPrice NULLS FIRST, Country NULLS FIRST"
ALL_RAW = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"

# quick range 'year' and its previous period, anchored at the latest line
WINDOW = f"""
qb AS (SELECT MAX(invoicedate) AS hi FROM sales),
qw AS (SELECT hi - INTERVAL 365 DAY AS s, hi AS e FROM qb),
qp AS (SELECT s, e, CAST(date_diff('second', s, e) // 86400 AS BIGINT) AS n FROM qw),
qpp AS (SELECT s, e, n, s - n * INTERVAL 1 DAY AS ps, s - INTERVAL 1 DAY AS pe FROM qp)"""

DOMAIN = """
dom AS (SELECT DISTINCT CustomerID FROM filled)"""

CUSTOMER_AGG = f"""
cagg AS (
  SELECT CustomerID, COUNT(DISTINCT InvoiceNo) AS tp, CAST(SUM(Net_Revenue) AS {M4}) AS tnr,
         CAST(SUM(Sale_Qty) AS BIGINT) AS tsq, CAST(SUM(Return_Qty) AS BIGINT) AS trq, MAX(InvoiceDate) AS lp
  FROM clean GROUP BY CustomerID
),
cbase AS (
  SELECT d.CustomerID, COALESCE(tp, 0) AS Total_Purchases, CAST(COALESCE(tnr, 0) AS {M4}) AS Total_Net_Revenue,
         COALESCE(tsq, 0) AS Total_Sale_Qty, COALESCE(trq, 0) AS Total_Return_Qty, lp AS Last_Purchase
  FROM dom d LEFT JOIN cagg a ON d.CustomerID = a.CustomerID
),
canchor AS (SELECT MAX(InvoiceDate) AS mx FROM clean),
csum AS (
  SELECT CustomerID, Total_Purchases, Total_Net_Revenue, Total_Sale_Qty, Total_Return_Qty,
         {ratio('Total_Net_Revenue', 'Total_Purchases')} AS Avg_Order_Value,
         CAST(date_diff('second', Last_Purchase, mx) // 86400 AS INTEGER) AS RecencyDays,
         {ratio('Total_Return_Qty', 'Total_Sale_Qty')} AS Return_Rate,
         Total_Sale_Qty - Total_Return_Qty AS Net_Qty,
         CAST(Total_Purchases AS DOUBLE)
           / ((CAST(CAST(date_diff('second', Last_Purchase, mx) // 86400 AS INTEGER) AS DOUBLE) + CAST(1 AS DOUBLE))
              / CAST(30 AS DOUBLE)) AS Purchase_Frequency_Monthly,
         CASE WHEN Total_Net_Revenue > 0 THEN 'Positive' ELSE 'Negative' END AS Customer_Value
  FROM cbase, canchor
  WHERE CustomerID <> 'Unknown'
),
ctable AS (
  -- doubles enter the table through their shortest decimal text (the CSV
  -- interchange), then round half away from zero
  SELECT CustomerID AS customerid, CAST(Total_Purchases AS INTEGER) AS total_purchases,
         CAST(Total_Net_Revenue AS DECIMAL(12,2)) AS total_net_revenue,
         CAST(Total_Sale_Qty AS INTEGER) AS total_sale_qty, CAST(Total_Return_Qty AS INTEGER) AS total_return_qty,
         CAST(CAST(Avg_Order_Value AS VARCHAR) AS DECIMAL(12,2)) AS avg_order_value, RecencyDays AS recencydays,
         CAST(CAST(Return_Rate AS VARCHAR) AS DECIMAL(10,6)) AS return_rate, CAST(Net_Qty AS INTEGER) AS net_qty,
         CAST(CAST(Purchase_Frequency_Monthly AS VARCHAR) AS DECIMAL(10,2)) AS purchase_frequency_monthly,
         Customer_Value AS customer_value
  FROM csum
)"""

PRODUCT_AGG = f"""
prev AS (SELECT StockCode, CAST(SUM(Net_Revenue) AS {M4}) AS Net_Revenue FROM clean
         WHERE StockCode IS NOT NULL GROUP BY StockCode),
preal AS (SELECT * FROM prev WHERE StockCode NOT IN ('S', 'D', 'BANK CHARGES', 'CRUK', 'M', 'AMAZONFEE'))"""

GROUPS = f"""
grp AS (SELECT {ALL_RAW}, COUNT(*) AS n FROM filled GROUP BY ALL)"""

# --- sources / sinks -------------------------------------------------------------
oracle("sk3_summary_table", "clean", "SELECT * FROM ctable", DOMAIN + "," + CUSTOMER_AGG)
oracle("sk3_key_check", "clean", """
SELECT CAST(COUNT(*) AS BIGINT) AS total_rows, COUNT(DISTINCT customerid) AS unique_keys,
       (SELECT COUNT(*) FROM (SELECT customerid FROM ctable WHERE customerid IS NOT NULL
                              GROUP BY customerid HAVING COUNT(*) > 1)) AS repeated_keys,
       COUNT(*) FILTER (WHERE customerid IS NULL) AS null_keys
FROM ctable""", DOMAIN + "," + CUSTOMER_AGG)
oracle("sk6_sql_top_countries", "sales", f"""
SELECT country, CAST(SUM(net_revenue) AS {M2}) AS revenue FROM sales
WHERE net_revenue > 0 AND country IS NOT NULL AND country <> 'Unspecified'
GROUP BY country ORDER BY revenue DESC, country LIMIT 8""")
oracle("sk9_export_rows", "sales", f"""
SELECT * FROM sales WHERE country = '{COUNTRY}'
  AND invoicedate BETWEEN TIMESTAMP '1998-01-01 00:00:00' AND TIMESTAMP '1999-12-31 00:00:00'
ORDER BY invoicedate DESC""")

# --- projections -----------------------------------------------------------------
oracle("p1_fill_missing", "filled", "SELECT * FROM filled")
oracle("p2_p3_text_load", "raw", "SELECT * FROM raw")
oracle("p10_lowercase_columns", "clean", """
SELECT InvoiceNo AS invoiceno, StockCode AS stockcode, Description AS description, Quantity AS quantity,
       InvoiceDate AS invoicedate, UnitPrice AS unitprice, CustomerID AS customerid, Country AS country,
       Return_Qty AS return_qty, Sale_Qty AS sale_qty, Paid_UnitPrice AS paid_unitprice,
       Is_Free_Item AS is_free_item, Revenue AS revenue, Net_Revenue AS net_revenue, Total_Items AS total_items
FROM clean""")
oracle("p11_composite_keys", "sales", """
SELECT invoiceno, stockcode, customerid, invoiceno || '-' || stockcode || '-' || customerid AS line_key FROM sales""")
oracle("p12_product_labels", "sales", "SELECT DISTINCT description, substring(description, 1, 30) AS label FROM sales")

# --- filters ---------------------------------------------------------------------
oracle("f2_country_lines", "sales", f"SELECT * FROM sales WHERE country = '{COUNTRY}'")
oracle("f3_date_range_lines", "sales", """
SELECT * FROM sales
WHERE invoicedate BETWEEN TIMESTAMP '1998-01-01 00:00:00' AND TIMESTAMP '1999-12-31 00:00:00'""")
oracle("f6_known_country_lines", "sales",
       "SELECT * FROM sales WHERE country IS NOT NULL AND country <> 'Unspecified'")
oracle("f7_nonblank_country_lines", "sales", "SELECT * FROM sales WHERE country IS NOT NULL AND country <> ''")
oracle("f8_positive_revenue_lines", "sales", "SELECT * FROM sales WHERE net_revenue > 0")
oracle("f9_lines_with_items", "sales", "SELECT * FROM sales WHERE total_items > 0")
oracle("f10_lines_with_sales", "sales", "SELECT * FROM sales WHERE sale_qty > 0")
oracle("f14_positive_customers", "clean", "SELECT * FROM ctable WHERE total_net_revenue > 0",
       DOMAIN + "," + CUSTOMER_AGG)
oracle("f4_selected_product_lines", "sales", f"SELECT * FROM sales WHERE description IN {PRODUCTS}")
oracle("f11_non_product_lines", "clean",
       "SELECT * FROM clean WHERE StockCode IN ('S', 'D', 'BANK CHARGES', 'CRUK', 'M', 'AMAZONFEE')")
oracle("f12_code_lookup", "clean", "SELECT * FROM clean WHERE StockCode = 'M'")
QUICK_ROWS = """
qr AS (
  SELECT o.option, CASE WHEN o.days IS NULL THEN b.lo ELSE b.hi - o.days * INTERVAL 1 DAY END AS start_date,
         b.hi AS end_date
  FROM (SELECT MIN(invoicedate) AS lo, MAX(invoicedate) AS hi FROM sales) b,
       (VALUES ('30d', 30), ('quarter', 90), ('year', 365), ('all', NULL)) o(option, days)
)"""
oracle("f15_quick_ranges", "sales", "SELECT option, start_date, end_date FROM qr", QUICK_ROWS)
oracle("f16_previous_periods", "sales", """
SELECT option, CAST(date_diff('second', start_date, end_date) // 86400 AS BIGINT) AS days,
       start_date - (date_diff('second', start_date, end_date) // 86400) * INTERVAL 1 DAY AS prev_start,
       start_date - INTERVAL 1 DAY AS prev_end
FROM qr""", QUICK_ROWS)

# --- dedup and quality ---------------------------------------------------------------
oracle("d1_exact_dedup", "filled", "SELECT * FROM dedup")
oracle("d2_key_dedup", "clean", """
SELECT InvoiceNo AS invoiceno, StockCode AS stockcode, Description AS description, Quantity AS quantity,
       InvoiceDate AS invoicedate, UnitPrice AS unitprice, CustomerID AS customerid, Country AS country,
       Return_Qty AS return_qty, Sale_Qty AS sale_qty, Paid_UnitPrice AS paid_unitprice,
       Is_Free_Item AS is_free_item, Revenue AS revenue, Net_Revenue AS net_revenue, Total_Items AS total_items
FROM keyed WHERE rn = 1""", SALES.split("sales AS")[0].rstrip().rstrip(","))
oracle("d3_duplicate_profile", "filled", f"""
SELECT CAST(SUM(n) AS BIGINT) AS total_rows, CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows,
       COUNT(*) AS unique_rows, {ratio('SUM(n - 1) * 100', 'SUM(n)')} AS removed_pct
FROM grp""", GROUPS)
oracle("d4_duplicate_rows", "filled", f"""
SELECT {ALL_RAW} FROM grp, range(2, n + 1) t(copy) WHERE n > 1""", GROUPS)
oracle("d4_duplicate_sample", "filled", f"""
SELECT {ALL_RAW} FROM grp, range(2, n + 1) t(copy) WHERE n > 1
ORDER BY InvoiceNo NULLS FIRST, StockCode NULLS FIRST, Description NULLS FIRST, Quantity NULLS FIRST,
         InvoiceDate NULLS FIRST, UnitPrice NULLS FIRST, CustomerID NULLS FIRST, Country NULLS FIRST
LIMIT 10""", GROUPS)
oracle("d5_top_duplicated_products", "filled", """
SELECT StockCode, CAST(SUM(n - 1) AS BIGINT) AS duplicates FROM grp WHERE n > 1 AND StockCode IS NOT NULL
GROUP BY StockCode ORDER BY duplicates DESC, StockCode LIMIT 10""", GROUPS)
oracle("d5_top_duplicated_invoices", "filled", """
SELECT InvoiceNo, CAST(SUM(n - 1) AS BIGINT) AS duplicates FROM grp WHERE n > 1 AND InvoiceNo IS NOT NULL
GROUP BY InvoiceNo ORDER BY duplicates DESC, InvoiceNo LIMIT 10""", GROUPS)


def _missing(src: str) -> str:
    cols = ALL_RAW.split(", ")
    parts = [f"SELECT {i} AS position, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS missing, "
             f"{ratio(f'COUNT(*) FILTER (WHERE {c} IS NULL) * 100', 'COUNT(*)')} AS missing_pct FROM {src}"
             for i, c in enumerate(cols)]
    return "\nUNION ALL\n".join(parts)


oracle("d6_missing_raw", "raw", _missing("raw"))
oracle("d6_missing_filled", "filled", _missing("filled"))
oracle("d7_date_checks", "filled", f"""
SELECT MIN(InvoiceDate) AS earliest, MAX(InvoiceDate) AS latest,
       COUNT(*) FILTER (WHERE InvoiceDate > {NOW}) AS future_dates,
       COUNT(*) FILTER (WHERE InvoiceDate < {EARLY}) AS suspicious_dates
FROM dedup""")
oracle("d8_value_checks", "filled", """
SELECT COUNT(*) FILTER (WHERE Quantity < 0) AS negative_quantity, COUNT(*) FILTER (WHERE Quantity = 0) AS zero_quantity,
       COUNT(*) FILTER (WHERE UnitPrice < 0) AS negative_price, COUNT(*) FILTER (WHERE UnitPrice = 0) AS zero_price
FROM dedup""")
oracle("d9_unit_totals", "filled", """
SELECT CAST(SUM(CASE WHEN Quantity > 0 THEN Quantity ELSE 0 END) AS BIGINT) AS total_sold,
       CAST(SUM(CASE WHEN Quantity < 0 THEN -Quantity ELSE 0 END) AS BIGINT) AS total_returned
FROM dedup""")
oracle("d10_price_filter_profile", "filled", """
SELECT COUNT(*) AS rows_before, COUNT(*) FILTER (WHERE UnitPrice >= 0) AS rows_after,
       COUNT(*) - COUNT(*) FILTER (WHERE UnitPrice >= 0) AS rows_dropped
FROM dedup""")
oracle("d11_paid_free_counts", "clean", """
SELECT COUNT(*) FILTER (WHERE Paid_UnitPrice > 0) AS paid_items, COUNT(*) FILTER (WHERE Is_Free_Item = 'Yes') AS free_items
FROM clean""")
oracle("d12_shape", "clean", "SELECT COUNT(*) AS rows, 15 AS columns FROM clean")
oracle("d13_key_check", "sales", """
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT invoiceno || '-' || stockcode || '-' || customerid) AS unique_rows
FROM sales""")
oracle("d14_load_check", "sales", f"""
SELECT s.sales_count, c.customer_count, {ratio('s.sales_count', 'c.customer_count')} AS lines_per_customer
FROM (SELECT COUNT(*) AS sales_count FROM sales) s, (SELECT COUNT(*) AS customer_count FROM ctable) c""",
       DOMAIN + "," + CUSTOMER_AGG)

# --- products ------------------------------------------------------------------------
oracle("a1_product_revenue", "clean", "SELECT * FROM prev ORDER BY Net_Revenue DESC, StockCode", PRODUCT_AGG)
oracle("a1_worst_products", "clean", "SELECT * FROM prev ORDER BY Net_Revenue ASC, StockCode LIMIT 20", PRODUCT_AGG)
oracle("a3_non_product_revenue", "clean", """
SELECT * FROM prev WHERE StockCode IN ('S', 'D', 'BANK CHARGES', 'CRUK', 'M', 'AMAZONFEE')
ORDER BY Net_Revenue DESC, StockCode""", PRODUCT_AGG)
oracle("a4_top_profitable", "clean",
       "SELECT * FROM preal WHERE Net_Revenue > 0 ORDER BY Net_Revenue DESC, StockCode LIMIT 10", PRODUCT_AGG)
oracle("a4_top_losses", "clean",
       "SELECT * FROM preal WHERE Net_Revenue < 0 ORDER BY Net_Revenue ASC, StockCode LIMIT 10", PRODUCT_AGG)
oracle("a4_top_losses_script_order", "clean",
       "SELECT * FROM preal WHERE Net_Revenue < 0 ORDER BY Net_Revenue DESC, StockCode LIMIT 10", PRODUCT_AGG)
oracle("a4_product_counts", "clean", """
SELECT COUNT(*) FILTER (WHERE Net_Revenue > 0) AS profitable, COUNT(*) FILTER (WHERE Net_Revenue < 0) AS loss
FROM preal""", PRODUCT_AGG)

# --- customers ---------------------------------------------------------------------------
oracle("a2_customer_revenue", "clean", f"""
SELECT d.CustomerID, CAST(COALESCE(r.v, 0) AS {M4}) AS Net_Revenue
FROM dom d LEFT JOIN (SELECT CustomerID, SUM(Net_Revenue) AS v FROM clean GROUP BY CustomerID) r
  ON d.CustomerID = r.CustomerID""", DOMAIN)
oracle("a5_purchases_per_customer", "clean", """
SELECT d.CustomerID, COALESCE(r.v, 0) AS Purchases
FROM dom d LEFT JOIN (SELECT CustomerID, COUNT(DISTINCT InvoiceNo) AS v FROM clean GROUP BY CustomerID) r
  ON d.CustomerID = r.CustomerID""", DOMAIN)
oracle("a6_customer_base", "clean", "SELECT * FROM cbase", DOMAIN + "," + CUSTOMER_AGG)
oracle("a12_customer_summary", "clean", "SELECT * FROM csum", DOMAIN + "," + CUSTOMER_AGG)

RFM = f"""
rfm AS (
  SELECT country, customerid, COUNT(*) AS frequency, CAST(COALESCE(SUM(net_revenue), 0) AS {M2}) AS monetary,
         MAX(invoicedate) AS last_purchase
  FROM sales GROUP BY country, customerid
)"""
oracle("a29_rfm_base", "sales", "SELECT * FROM rfm", RFM)
oracle("a30_quartile_segments", "sales", f"""
SELECT g.country, l.segment_order, l.segment, COUNT(j.seg) AS customer_count,
       {mean('j.monetary')} AS avg_monetary
FROM (SELECT DISTINCT country FROM rfm) g
CROSS JOIN (VALUES (0, 'Bronze'), (1, 'Silver'), (2, 'Gold'), (3, 'Platinum')) l(segment_order, segment)
LEFT JOIN j ON j.country IS NOT DISTINCT FROM g.country AND j.seg = l.segment_order
GROUP BY g.country, l.segment_order, l.segment""", RFM + """,
cuts AS (SELECT country, quantile_cont(CAST(monetary AS DOUBLE), [0.25, 0.5, 0.75]) AS q FROM rfm GROUP BY country),
j AS (
  SELECT r.country, r.monetary,
         CASE WHEN CAST(r.monetary AS DOUBLE) <= c.q[1] THEN 0 WHEN CAST(r.monetary AS DOUBLE) <= c.q[2] THEN 1
              WHEN CAST(r.monetary AS DOUBLE) <= c.q[3] THEN 2 ELSE 3 END AS seg
  FROM rfm r JOIN cuts c ON r.country IS NOT DISTINCT FROM c.country
)""")
oracle("a39_spend_segments", "clean", f"""
SELECT CASE WHEN total_net_revenue >= 1000 THEN 'VIP (>$1K)'
            WHEN total_net_revenue >= 500 THEN 'Premium ($500-$1K)'
            WHEN total_net_revenue >= 100 THEN 'Regular ($100-$500)'
            ELSE 'Small (<$100)' END AS customer_segment,
       COUNT(*) AS customer_count, CAST(SUM(total_net_revenue) AS {M2}) AS segment_revenue,
       {mean('total_net_revenue')} AS avg_revenue_per_customer
FROM ctable WHERE total_net_revenue > 0
GROUP BY 1 ORDER BY segment_revenue DESC, customer_segment""", DOMAIN + "," + CUSTOMER_AGG)

# --- KPIs ---------------------------------------------------------------------------------
oracle("a13_pipeline_summary", "clean", f"""
SELECT b.total_rows, b.total_revenue, b.net_revenue, s.total_customers, s.top_customer_revenue,
       p.profitable AS profitable_products, p.loss AS loss_products
FROM (SELECT COUNT(*) AS total_rows, CAST(SUM(Revenue) AS {M4}) AS total_revenue,
             CAST(SUM(Net_Revenue) AS {M4}) AS net_revenue FROM clean) b,
     (SELECT COUNT(*) AS total_customers, MAX(Total_Net_Revenue) AS top_customer_revenue FROM csum) s,
     (SELECT COUNT(*) FILTER (WHERE Net_Revenue > 0) AS profitable,
             COUNT(*) FILTER (WHERE Net_Revenue < 0) AS loss FROM preal) p""",
       DOMAIN + "," + CUSTOMER_AGG + "," + PRODUCT_AGG)
oracle("a14_date_bounds", "sales", "SELECT MIN(invoicedate) AS min_date, MAX(invoicedate) AS max_date FROM sales")
oracle("a15_data_period", "sales", """
SELECT first_sale, last_sale, CAST(date_diff('second', first_sale, last_sale) // 86400 AS BIGINT) AS period_days,
       date_diff('second', first_sale, last_sale) AS period_seconds
FROM (SELECT MIN(invoicedate) AS first_sale, MAX(invoicedate) AS last_sale FROM sales)""")
oracle("a16_countries", "sales",
       "SELECT DISTINCT country FROM sales WHERE country IS NOT NULL AND country <> '' ORDER BY country")
oracle("a16_products", "sales",
       "SELECT DISTINCT description FROM sales WHERE description IS NOT NULL AND description <> '' ORDER BY description")


def _kpi_sql(ranged: bool) -> tuple[str, str]:
    if ranged:
        src = """kx AS (SELECT sales.*, (invoicedate BETWEEN s AND e) AS cur, (invoicedate BETWEEN ps AND pe) AS prv, n
                        FROM sales, qpp WHERE invoicedate BETWEEN s AND e OR invoicedate BETWEEN ps AND pe)"""
    else:
        src = "kx AS (SELECT sales.*, TRUE AS cur, FALSE AS prv, CAST(0 AS BIGINT) AS n FROM sales)"
    agg = f"""
kagg AS (
  SELECT country,
         CAST(COALESCE(SUM(CASE WHEN cur THEN net_revenue END), 0) AS {M2}) AS total_revenue,
         COUNT(*) FILTER (WHERE cur) AS total_transactions,
         COALESCE({mean('net_revenue', 'cur')}, CAST(0 AS DOUBLE)) AS avg_order,
         COUNT(DISTINCT CASE WHEN cur THEN customerid END) AS total_customers,
         COALESCE(CAST(SUM(CASE WHEN cur THEN sale_qty END) AS BIGINT), 0) AS total_qty,
         COALESCE(CAST(SUM(CASE WHEN cur THEN return_qty END) AS BIGINT), 0) AS return_qty,
         COALESCE({mean('total_items', 'cur')}, CAST(0 AS DOUBLE)) AS avg_items_exact,
         COUNT(DISTINCT CASE WHEN prv THEN CAST(invoicedate AS DATE) END) AS days_with_data,
         COUNT(*) FILTER (WHERE prv) AS prev_records,
         CAST(COALESCE(SUM(CASE WHEN prv THEN net_revenue END), 0) AS {M2}) AS prev_revenue,
         MAX(n) AS expected_days
  FROM kx GROUP BY country
),
kder AS (
  SELECT *, {safe_ratio('return_qty', 'total_qty')} * CAST(100 AS DOUBLE) AS return_rate,
         round_even(avg_items_exact, 0) AS avg_items,
         {safe_ratio('total_revenue', 'total_customers')} AS revenue_per_customer,
         {safe_ratio('days_with_data', 'expected_days')} * CAST(100 AS DOUBLE) AS data_completeness,
         CASE WHEN prev_revenue > 0 THEN (CAST(total_revenue AS DOUBLE) - CAST(prev_revenue AS DOUBLE))
              / CAST(prev_revenue AS DOUBLE) * CAST(100 AS DOUBLE) END AS growth_pct
  FROM kagg
),
kpis AS (
  SELECT *, CASE WHEN prev_revenue <= 0 THEN 'na' WHEN data_completeness < 80 THEN 'partial' ELSE 'ok' END AS growth_status,
         CASE WHEN growth_pct >= 0 THEN 'up' WHEN growth_pct < 0 THEN 'down' END AS growth_trend
  FROM kder
)"""
    return src, agg


_src, _agg = _kpi_sql(True)
oracle("a17_kpi_block", "sales", "SELECT * FROM kpis", WINDOW + "," + _src + "," + _agg)
_src0, _agg0 = _kpi_sql(False)
oracle("a17_kpi_block_all_dates", "sales", "SELECT * FROM kpis", _src0 + "," + _agg0)
oracle("a20_kpi_cards", "sales", """
SELECT country,
       '$' || format('{:,.0f}', CAST(total_revenue AS DOUBLE)) AS revenue_card,
       format('{:,}', total_transactions) AS transactions_card,
       '$' || format('{:,.0f}', avg_order) AS avg_order_card,
       format('{:,}', total_customers) AS customers_card,
       format('{:.1f}', return_rate) || '%' AS return_rate_card,
       format('{:.1f}', avg_items) AS items_card,
       CASE WHEN growth_status = 'na' THEN 'N/A'
            WHEN growth_status = 'partial' THEN format('{:+.1f}', growth_pct) || '%*'
            ELSE format('{:+.1f}', growth_pct) || '%' END AS growth_card,
       '$' || format('{:,.0f}', revenue_per_customer) AS revenue_per_customer_card
FROM kpis""", WINDOW + "," + _src + "," + _agg)
oracle("p13_formatted_metrics", "sales", f"""
SELECT metric, value, format,
       CASE WHEN value IS NULL THEN '0'
            WHEN format = 'currency' THEN '$' || format('{{:,.2f}}', value)
            WHEN format = 'count' THEN format('{{:,}}', CAST(trunc(value) AS BIGINT))
            WHEN format = 'percent' THEN format('{{:.1f}}', value) || '%'
            ELSE format('{{:.2f}}', value) END AS display
FROM (
  SELECT 'total_net_revenue' AS metric, CAST(SUM(net_revenue) AS DOUBLE) AS value, 'currency' AS format FROM sales
  UNION ALL SELECT 'unique_products', CAST(COUNT(DISTINCT stockcode) AS DOUBLE), 'count' FROM sales
  UNION ALL SELECT 'return_pct', {ratio('SUM(return_qty) * 100', 'SUM(sale_qty)')}, 'percent' FROM sales
  UNION ALL SELECT 'revenue_per_customer', {ratio('SUM(net_revenue)', 'COUNT(DISTINCT customerid)')}, 'other'
            FROM sales
)""")
oracle("a38_financial_summary", "sales", f"""
SELECT CAST(SUM(revenue) AS {M2}) AS total_revenue, CAST(SUM(net_revenue) AS {M2}) AS total_net_revenue,
       CAST(SUM(sale_qty) AS BIGINT) AS total_items_sold, CAST(SUM(return_qty) AS BIGINT) AS total_items_returned,
       COUNT(DISTINCT customerid) AS unique_customers, COUNT(DISTINCT stockcode) AS unique_products
FROM sales""")

REPORT_ONE = f"""
r1 AS (
  SELECT CAST(SUM(CASE WHEN net_revenue > 0 THEN net_revenue END) AS DOUBLE) AS rev,
         {mean('net_revenue', 'net_revenue > 0')} AS aov,
         CAST(COUNT(DISTINCT customerid) AS DOUBLE) AS cust,
         CAST(COUNT(*) FILTER (WHERE total_items > 0) AS DOUBLE) AS lines
  FROM sales
),
rl AS (
  SELECT 0 AS position, 'Total Revenue' AS metric, rev AS value, 'currency' AS format FROM r1
  UNION ALL SELECT 1, 'Avg Order Value', aov, 'currency' FROM r1
  UNION ALL SELECT 2, 'Total Customers', cust, 'count' FROM r1
  UNION ALL SELECT 3, 'Total Transactions', lines, 'count' FROM r1
)"""
oracle("a40_report_kpis", "sales", f"""
SELECT position, metric, value,
       CASE WHEN value IS NULL THEN '0'
            WHEN format = 'currency' THEN '$' || format('{{:,.2f}}', value)
            WHEN format = 'count' THEN format('{{:,}}', CAST(trunc(value) AS BIGINT)) END AS display,
       format, '{RUN_ID}' AS run_timestamp
FROM rl""", REPORT_ONE)

NOTEBOOK_ONE = f"""
n1 AS (
  SELECT SUM(CASE WHEN net_revenue > 0 THEN net_revenue END) AS rev,
         {mean('net_revenue', 'net_revenue > 0')} AS aov,
         COUNT(DISTINCT customerid) AS cust, COUNT(*) AS lines,
         SUM(sale_qty) AS sold, SUM(return_qty) AS returned,
         MIN(invoicedate) AS lo, MAX(invoicedate) AS hi,
         MIN(CASE WHEN net_revenue > 0 THEN invoicedate END) AS pos_lo,
         MAX(CASE WHEN net_revenue > 0 THEN invoicedate END) AS pos_hi,
         {mean('total_items', 'total_items > 0')} AS items
  FROM sales
),
n2 AS (
  SELECT CAST(rev AS DOUBLE) AS rev, aov, CAST(cust AS DOUBLE) AS cust, CAST(lines AS DOUBLE) AS lines,
         CASE WHEN sold > 0 THEN CAST(returned * 100 AS DOUBLE) / CAST(sold AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS rr,
         CAST(date_diff('second', lo, hi) // 86400 + 1 AS DOUBLE) AS period,
         CAST(rev AS DOUBLE) / CAST(NULLIF(date_diff('second', pos_lo, pos_hi) // 86400 + 1, 0) AS DOUBLE) AS daily,
         items
  FROM n1
),
nl AS (
  SELECT 0 AS position, 'Total Revenue' AS metric, rev AS value, 'currency' AS format FROM n2
  UNION ALL SELECT 1, 'Avg Order Value', aov, 'currency' FROM n2
  UNION ALL SELECT 2, 'Total Customers', cust, 'count' FROM n2
  UNION ALL SELECT 3, 'Total Transactions', lines, 'count' FROM n2
  UNION ALL SELECT 4, 'Return Rate', rr, 'percent' FROM n2
  UNION ALL SELECT 5, 'Data Period', period, 'days' FROM n2
  UNION ALL SELECT 6, 'Avg Daily Revenue', daily, 'currency' FROM n2
  UNION ALL SELECT 7, 'Items per Transaction', items, 'decimal' FROM n2
),
nv AS (SELECT position, metric, COALESCE(value, CAST(0 AS DOUBLE)) AS value, format FROM nl)"""
oracle("a41_notebook_kpis", "sales", """
SELECT position, metric, value,
       CASE WHEN format = 'currency' THEN '$' || format('{:,.2f}', value)
            WHEN format = 'count' THEN format('{:,.0f}', value)
            WHEN format = 'percent' THEN format('{:.1f}', value) || '%'
            WHEN format = 'days' THEN CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR) || ' days'
            WHEN format = 'decimal' THEN format('{:.1f}', value) END AS display,
       format
FROM nv""", NOTEBOOK_ONE)

# --- trends -----------------------------------------------------------------------------------
MONTHLY_ALL = f"""
mall AS (SELECT country, {MONTH} AS month, CAST(COALESCE(SUM(net_revenue), 0) AS {M2}) AS revenue
         FROM sales GROUP BY 1, 2)"""
MONTHLY_CUR = f"""
mcur AS (SELECT country, {MONTH} AS month, CAST(COALESCE(SUM(net_revenue), 0) AS {M2}) AS revenue
         FROM sales, qw WHERE invoicedate BETWEEN s AND e GROUP BY 1, 2)"""


def _compare(shift: str) -> str:
    return f"""
SELECT c.country, c.month, c.revenue, strftime(c.month, '%b %y') AS month_label,
       c.month - ({shift}) * INTERVAL 1 MONTH AS compare_month, b.revenue AS compare_revenue
FROM mcur c, qw LEFT JOIN mall b
  ON c.country IS NOT DISTINCT FROM b.country AND b.month = c.month - ({shift}) * INTERVAL 1 MONTH"""


oracle("a21_monthly_yoy", "sales", _compare("12"), WINDOW + "," + MONTHLY_ALL + "," + MONTHLY_CUR)
oracle("a21_monthly_prev", "sales",
       _compare("(year(e) * 12 + month(e)) - (year(s) * 12 + month(s)) + 1"),
       WINDOW + "," + MONTHLY_ALL + "," + MONTHLY_CUR)
oracle("a22_monthly_revenue", "sales",
       "SELECT country, month, revenue, strftime(month, '%b %y') AS month_label FROM mall", MONTHLY_ALL)
MONTHLY_SALES = f"""
ms AS (SELECT {MONTH} AS month, CAST(SUM(net_revenue) AS {M2}) AS monthly_revenue, COUNT(*) AS transactions,
              CAST(SUM(sale_qty) AS BIGINT) AS items_sold
       FROM sales WHERE net_revenue > 0 GROUP BY 1)"""
oracle("a24_monthly_sales", "sales", "SELECT * FROM ms ORDER BY month", MONTHLY_SALES)
oracle("a25_peak_month", "sales", """
SELECT month AS peak_month, monthly_revenue AS peak_revenue, strftime(month, '%b %Y') AS peak_label
FROM ms ORDER BY monthly_revenue DESC, month LIMIT 1""", MONTHLY_SALES)
oracle("a26_sales_by_weekday", "sales", f"""
SELECT country, CAST(dayofweek(invoicedate) AS INTEGER) AS day_num, strftime(invoicedate, '%a') AS day_name,
       CAST(COALESCE(SUM(net_revenue), 0) AS {M2}) AS revenue, COUNT(*) AS transactions
FROM sales GROUP BY 1, 2, 3""")
oracle("a27_hour_weekday_revenue", "sales", f"""
SELECT country, CAST(dayofweek(invoicedate) AS INTEGER) AS day_num, CAST(hour(invoicedate) AS INTEGER) AS hour,
       CAST(COALESCE(SUM(net_revenue), 0) AS {M2}) AS revenue
FROM sales GROUP BY 1, 2, 3""")
_days = ["sun", "mon", "tue", "wed", "thu", "fri", "sat"]
oracle("a28_hour_weekday_heatmap", "sales", "SELECT country, CAST(hour(invoicedate) AS INTEGER) AS hour, "
       + ", ".join(f"CAST(COALESCE(SUM(CASE WHEN dayofweek(invoicedate) = {i} THEN net_revenue END), 0) AS {M2}) AS {d}"
                   for i, d in enumerate(_days))
       + " FROM sales GROUP BY 1, 2")

# --- rankings ------------------------------------------------------------------------------------
oracle("a31_country_revenue", "sales", f"""
SELECT country, CAST(COALESCE(SUM(net_revenue), 0) AS {M2}) AS revenue, COUNT(DISTINCT customerid) AS customers
FROM sales WHERE country IS NOT NULL AND country <> 'Unspecified'
GROUP BY country ORDER BY revenue DESC, country""")
PRODUCT_TOTALS = f"""
pt AS (SELECT country, description, CAST(COALESCE(SUM(net_revenue), 0) AS {M2}) AS revenue, COUNT(*) AS transactions
       FROM sales WHERE description IS NOT NULL GROUP BY country, description)"""
oracle("a32_top_products", "sales", """
SELECT country, description, revenue, transactions, rank, substring(description, 1, 30) AS label
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY country ORDER BY revenue DESC, description) AS INTEGER) AS rank
      FROM pt) WHERE rank <= 10""", PRODUCT_TOTALS)
oracle("a33_selected_products", "sales", f"""
SELECT country, description, revenue, transactions, substring(description, 1, 30) AS label
FROM pt WHERE description IN {PRODUCTS}""", PRODUCT_TOTALS)
oracle("a34_top_products_by_volume", "sales", f"""
SELECT description, COUNT(*) AS transactions, CAST(SUM(sale_qty) AS BIGINT) AS total_quantity,
       CAST(SUM(net_revenue) AS {M2}) AS total_revenue, {mean('unitprice')} AS avg_price
FROM sales WHERE sale_qty > 0 GROUP BY description HAVING SUM(sale_qty) > 100
ORDER BY total_revenue DESC, description LIMIT 10""")
oracle("a35_top_countries_positive", "sales", f"""
SELECT country, CAST(SUM(net_revenue) AS {M2}) AS revenue FROM sales
WHERE net_revenue > 0 AND country IS NOT NULL AND country <> 'Unspecified'
GROUP BY country ORDER BY revenue DESC, country LIMIT 8""")
oracle("a36_top_countries_all", "sales", f"""
SELECT country, CAST(SUM(net_revenue) AS {M2}) AS revenue FROM sales
WHERE country IS NOT NULL AND country <> 'Unspecified'
GROUP BY country ORDER BY revenue DESC, country LIMIT 8""")
oracle("a37_countries_by_lines", "sales", """
SELECT country, COUNT(*) AS transactions FROM sales GROUP BY country
ORDER BY transactions DESC, country NULLS FIRST LIMIT 10""")

# --- tables in versions, checked loads, footers, file order, long lists ------------------------------
CSV_RAW = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, NULLIF(Country, '') AS Country"
oracle("sk1_csv_read", "raw", f"SELECT {CSV_RAW} FROM raw")
_bad = {"(line)": "i % 83 = 5", "InvoiceNo": "FALSE", "StockCode": "FALSE", "Description": "FALSE", "Quantity": "i % 97 = 1",
        "InvoiceDate": "i % 89 < 2", "UnitPrice": "i % 97 < 2", "CustomerID": "FALSE", "Country": "FALSE"}
oracle("sk1_load_report", "raw", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {w if c == '(line)' else f'({w}) AND i % 83 <> 5'}) AS bad_values "
    "FROM (SELECT CAST(InvoiceNo AS BIGINT) AS i FROM raw)" for c, w in _bad.items()))
oracle("sk2_cleaned_csv", "clean", ORACLES["p10_lowercase_columns"].rpartition("SELECT InvoiceNo")[2].join(["SELECT InvoiceNo", ""])
       .replace("Country AS country", "NULLIF(Country, '') AS country"))
oracle("sk4_load_counts", "sales", """
SELECT CASE WHEN CAST(invoiceno AS BIGINT) % 2 = 0 THEN 'even' ELSE 'odd' END AS load_id, COUNT(*) AS rows FROM sales GROUP BY 1""")
oracle("sk5_replaced_table", "sales", "SELECT * FROM sales WHERE net_revenue > 0")
oracle("sk9_export_files", "sales", f"""
SELECT *, row_number() OVER (ORDER BY invoicedate DESC NULLS FIRST, invoiceno, stockcode, customerid) AS position
FROM sales WHERE country = '{COUNTRY}'
  AND invoicedate BETWEEN TIMESTAMP '1998-01-01 00:00:00' AND TIMESTAMP '1999-12-31 00:00:00'""")
oracle("f4_long_code_list", "sales", """
SELECT * FROM sales WHERE TRY_CAST(stockcode AS BIGINT) BETWEEN 0 AND 199999 AND TRY_CAST(stockcode AS BIGINT) % 2 = 0""")
_reverse = ", ".join(f"{c} DESC NULLS LAST" for c in ("Description", "Quantity", "InvoiceDate", "UnitPrice", "Country"))
oracle("d2_first_in_file", "clean", ORACLES["p10_lowercase_columns"].rpartition("SELECT InvoiceNo")[2].join(["SELECT InvoiceNo", ""])
       .replace("FROM clean", "FROM backwards WHERE rn = 1"), f"""
backwards AS (SELECT *, row_number() OVER (PARTITION BY InvoiceNo, StockCode, CustomerID ORDER BY {_reverse}) AS rn FROM clean)""")
oracle("d7_table_date_checks", "sales", f"""
SELECT MIN(invoicedate) AS earliest, MAX(invoicedate) AS latest, COUNT(*) FILTER (WHERE invoicedate > {NOW}) AS future_dates,
       COUNT(*) FILTER (WHERE invoicedate < {EARLY}) AS suspicious_dates FROM sales""")
oracle("a14_footer_bounds", "sales", "SELECT MIN(invoicedate) AS min_date, MAX(invoicedate) AS max_date, COUNT(*) AS lines FROM sales")

# --- the daily rollup: the same panels for bounds at midnight ------------------------------------------
DAYS = """
qw AS (SELECT TIMESTAMP '1998-01-01 00:00:00' AS s, TIMESTAMP '1998-12-31 00:00:00' AS e),
qpp AS (SELECT s, e, CAST(364 AS BIGINT) AS n, s - 364 * INTERVAL 1 DAY AS ps, s - INTERVAL 1 DAY AS pe FROM qw)"""
IN_DAYS = "invoicedate BETWEEN TIMESTAMP '1998-01-01 00:00:00' AND TIMESTAMP '1998-12-31 00:00:00'"
oracle("a17_rollup_kpis", "sales", "SELECT * FROM kpis", DAYS + "," + _src + "," + _agg)
oracle("a21_rollup_yoy", "sales", _compare("12"), DAYS + "," + MONTHLY_ALL + "," + MONTHLY_CUR)
ORACLES["a22_rollup_monthly"] = ORACLES["a22_monthly_revenue"]
ORACLES["a24_rollup_monthly_sales"] = ORACLES["a24_monthly_sales"]
for _name in ("a26_sales_by_weekday", "a27_hour_weekday_revenue"):
    _new = {"a26_sales_by_weekday": "a26_rollup_weekday", "a27_hour_weekday_revenue": "a27_rollup_hours"}[_name]
    _head, _, _tail = ORACLES[_name].rpartition("FROM sales")
    ORACLES[_new] = f"{_head}FROM sales WHERE {IN_DAYS}{_tail}"
ORACLES["a28_rollup_heatmap"] = ORACLES["a28_hour_weekday_heatmap"]
