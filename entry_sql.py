"""ANSI SQL that DuckDB runs on the same tables, one text per registered query.

The common table expressions below restate the warehouse: staged rows, dimensions and facts.
DuckDB divides decimals as doubles, so every division rounds to ten digits before it rounds to
the money type; that equals exact division for these value ranges.
"""

from __future__ import annotations


def _div(a: str, b: str, dtype: str) -> str:
    return f"CAST(CAST(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) AS DECIMAL(38,10)) AS {dtype})"


def _try_div(a: str, b: str, dtype: str) -> str:
    return f"TRY_CAST(CAST(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) AS DECIMAL(38,10)) AS {dtype})"


def _avg(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / count({column})"


def _dbl(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


M = "DECIMAL(12,2)"

STAGED_SALES = f"""
staged_sales AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   CAST(l_extendedprice AS {M})) AS stg_sales_id,
         concat_ws('-', l_orderkey, l_linenumber) AS sale_num,
         CAST(o_orderdate AS DATE) AS date_parsed,
         CAST(l_partkey AS VARCHAR) AS ed_id, l_partkey, l_suppkey,
         o_orderpriority AS chnl,
         CAST(l_quantity AS DECIMAL(10,2)) AS tqty,
         {_div(f"CAST(l_extendedprice AS {M})", "CAST(l_quantity AS DECIMAL(10,2))", M)} AS uprice,
         CASE l_returnflag WHEN 'A' THEN 'USD' WHEN 'R' THEN 'EUR' ELSE 'GBP' END AS curr,
         CAST(nullif(l_discount, 0) AS DECIMAL(5,4)) AS dscnt,
         p_size * 100 AS pd,
         CAST(p_retailprice AS {M}) AS bc,
         CAST(l_tax * 100 AS DECIMAL(3,1)) AS vscr,
         p_type AS typ
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""

DIMS = """
time_dim AS (
  SELECT CAST(d AS DATE) AS full_date,
         CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS time_key,
         CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_number,
         strftime(d, '%B') AS month_name, CAST(quarter(d) AS INTEGER) AS quarter_number,
         'Q' || quarter(d) AS quarter_name
  FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31', INTERVAL 1 DAY) AS t(d)
),
lead_supplier AS (SELECT l_partkey AS p_partkey, min(l_suppkey) AS vendor_key FROM lineitem GROUP BY 1),
product AS (
  SELECT p_partkey AS product_key, CAST(p_partkey AS VARCHAR) AS edition_id, p_name AS product_title,
         CAST(substr(p_brand, 7) AS BIGINT) AS author_key, coalesce(vendor_key, -1) AS vendor_key
  FROM part LEFT JOIN lead_supplier USING (p_partkey) WHERE p_size > 1
  UNION ALL SELECT -1, 'Unknown', 'Unknown', -1, -1
),
author AS (
  SELECT CAST(substr(p_brand, 7) AS BIGINT) AS author_key, p_brand AS author_id,
         'Author ' || substr(p_brand, 7) AS author_name, min(p_type) AS primary_genre
  FROM part GROUP BY p_brand
  UNION ALL SELECT -1, 'Unknown', 'Unknown', 'Unknown'
),
dc AS (
  SELECT CAST(n_nationkey AS BIGINT) AS dc_key, n_name AS station_code, n_name || ' DC' AS station_name,
         r_name AS station_region
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT -1, 'Unknown', 'Unknown', 'Unknown'
),
vendor AS (
  SELECT s_suppkey AS vendor_key, 'V' || s_suppkey AS vendor_id, s_name AS vendor_name FROM supplier
  UNION ALL SELECT -1, 'Unknown', 'Unknown'
),
channel AS (
  SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS channel_key,
         o_orderpriority AS channel_code, substr(o_orderpriority, 3) AS channel_name,
         CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'Online' ELSE 'Physical' END AS channel_type
  FROM orders
  UNION ALL SELECT -1, 'Unknown', 'Unknown', 'Unknown'
),
product_type AS (
  SELECT min(p_partkey) AS product_type_key, p_type AS product_type_name,
         CASE WHEN p_type = 'ECONOMY' THEN 'N' ELSE 'Y' END AS is_physical
  FROM part GROUP BY p_type
  UNION ALL SELECT -1, 'Unknown', 'N'
),
currency AS (
  SELECT * FROM (VALUES (1000, 'GBP'), (1001, 'USD'), (1002, 'EUR')) AS t(currency_key, currency_code)
),
center_map AS (
  SELECT s_suppkey AS l_suppkey, CAST(n_nationkey AS BIGINT) AS dc_key
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

FACT_SALES = f"""{STAGED_SALES},
{DIMS},
priced AS (
  SELECT s.*, t.time_key,
         coalesce(p.product_key, -1) AS product_key, coalesce(p.author_key, -1) AS author_key,
         coalesce(p.vendor_key, -1) AS vendor_key, coalesce(c.channel_key, -1) AS channel_key,
         coalesce(k.product_type_key, -1) AS product_type_key,
         CAST(coalesce(m.currency_key, -1) AS BIGINT) AS currency_key,
         coalesce(z.dc_key, -1) AS dc_key,
         CAST(s.uprice * CAST(CASE s.curr WHEN 'USD' THEN 0.79 WHEN 'EUR' THEN 0.85 ELSE 1 END
              AS DECIMAL(12,6)) AS {M}) AS unit_price_gbp,
         {_div("s.bc", "s.pd", M)} AS unit_cost_gbp
  FROM staged_sales s
  JOIN time_dim t ON t.full_date = s.date_parsed
  LEFT JOIN product p ON p.edition_id = s.ed_id AND p.product_key <> -1
  LEFT JOIN channel c ON c.channel_code = s.chnl
  LEFT JOIN product_type k ON upper(k.product_type_name) = upper(s.typ)
  LEFT JOIN currency m ON m.currency_code = s.curr
  LEFT JOIN center_map z ON z.l_suppkey = s.l_suppkey
),
gross AS (
  SELECT *, CAST(unit_price_gbp * tqty AS {M}) AS gross_amount_gbp,
         CAST(unit_cost_gbp * tqty AS {M}) AS total_cost_gbp
  FROM priced
),
discounted AS (
  SELECT *, CAST(gross_amount_gbp * coalesce(dscnt, CAST(0 AS DECIMAL(5,4))) AS {M}) AS discount_amount_gbp
  FROM gross
),
net AS (SELECT *, CAST(gross_amount_gbp - discount_amount_gbp AS {M}) AS net_amount_gbp FROM discounted),
profit AS (SELECT *, CAST(net_amount_gbp - total_cost_gbp AS {M}) AS gross_profit_gbp FROM net),
measured AS (
  SELECT *, CASE WHEN net_amount_gbp > 0
                 THEN {_try_div("gross_profit_gbp * 100", "net_amount_gbp", "DECIMAL(5,2)")}
                 ELSE 0 END AS gross_margin_pct
  FROM profit
),
tagged AS (
  SELECT *, CASE WHEN gross_margin_pct IS NULL THEN 'OVERFLOW_GROSS_MARGIN_PCT'
                 WHEN NOT tqty > 0 THEN 'CK_SALES_QTY_POSITIVE'
                 WHEN NOT unit_price_gbp > 0 THEN 'CK_SALES_PRICE_POSITIVE'
                 WHEN NOT dscnt BETWEEN 0 AND 0.25 THEN 'CK_SALES_DISCOUNT' END AS failed
  FROM measured
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY sale_num ORDER BY date_parsed, stg_sales_id) AS rn
  FROM tagged WHERE failed IS NULL
),
fact_sales AS (
  SELECT time_key, product_key, author_key, dc_key, vendor_key, channel_key, product_type_key,
         currency_key, sale_num AS sale_number, tqty AS quantity_sold,
         uprice AS unit_price_original, unit_price_gbp, dscnt AS discount_rate, discount_amount_gbp,
         gross_amount_gbp, net_amount_gbp, CAST(pd AS BIGINT) AS print_run_qty,
         bc AS binding_cost_gbp, unit_cost_gbp, total_cost_gbp, gross_profit_gbp, gross_margin_pct,
         vscr AS vendor_score, stg_sales_id AS source_record_id
  FROM numbered WHERE rn = 1
)"""

STAGED_DAILY = f"""
staged_daily AS (
  SELECT concat_ws('|', CAST(CAST(l_shipdate AS DATE) AS VARCHAR), n_name, p_type) AS stg_daily_id,
         CAST(l_shipdate AS DATE) AS date_parsed, n_name AS stn_code, p_type AS typ,
         CAST(sum(p_size) * 5 AS BIGINT) AS pd, sum(CAST(p_retailprice AS {M})) AS bc,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS us,
         CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) END), 0) AS BIGINT) AS rv,
         sum(CAST(l_extendedprice AS {M})) AS rev,
         CAST(min(l_tax) * 100 + 10 AS DECIMAL(4,1)) AS tmp,
         CAST(min(l_linenumber) * 10 AS INTEGER) AS hmd,
         CAST(max(l_discount) * 100 AS DECIMAL(3,1)) AS vscr
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey
  GROUP BY CAST(l_shipdate AS DATE), n_name, p_type
)"""

FACT_DAILY = f"""{STAGED_DAILY},
{DIMS},
bridge AS (
  SELECT n_name AS station_code, min(s_suppkey) AS vendor_key
  FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name
),
costed AS (
  SELECT s.*, t.time_key, d.dc_key, b.vendor_key, k.product_type_key,
         TRY_CAST(s.bc AS {M}) AS binding_cost_gbp, TRY_CAST(s.rev AS {M}) AS revenue_gbp,
         {_try_div("s.bc", "s.pd", "DECIMAL(12,4)")} AS unit_binding_cost,
         {_try_div("s.us * 100", "s.pd", "DECIMAL(5,2)")} AS print_run_utilization,
         CASE WHEN s.us > 0 THEN {_try_div("s.rv * 100", "s.us", "DECIMAL(5,2)")} ELSE 0 END AS return_rate_pct
  FROM staged_daily s
  JOIN time_dim t ON t.full_date = s.date_parsed
  JOIN dc d ON d.station_code = s.stn_code
  JOIN bridge b ON b.station_code = s.stn_code
  JOIN product_type k ON upper(k.product_type_name) = upper(s.typ)
),
sold AS (SELECT *, TRY_CAST(unit_binding_cost * us AS {M}) AS cost_of_goods_sold FROM costed),
earned AS (SELECT *, TRY_CAST(rev - cost_of_goods_sold AS {M}) AS gross_profit_gbp FROM sold),
judged AS (
  SELECT *, CASE WHEN rev > 0 THEN {_try_div("gross_profit_gbp * 100", "rev", "DECIMAL(5,2)")} ELSE 0 END
         AS gross_margin_pct
  FROM earned
),
tagged_daily AS (
  SELECT *, CASE WHEN binding_cost_gbp IS NULL THEN 'OVERFLOW_BINDING_COST_GBP'
                 WHEN revenue_gbp IS NULL THEN 'OVERFLOW_REVENUE_GBP'
                 WHEN print_run_utilization IS NULL THEN 'OVERFLOW_PRINT_RUN_UTILIZATION'
                 WHEN return_rate_pct IS NULL THEN 'OVERFLOW_RETURN_RATE_PCT'
                 WHEN gross_margin_pct IS NULL THEN 'OVERFLOW_GROSS_MARGIN_PCT' END AS failed
  FROM judged
),
fact_daily AS (
  SELECT time_key, dc_key, vendor_key, product_type_key, pd AS print_run_qty, binding_cost_gbp,
         us AS units_sold, rv AS returns_qty, us - rv AS net_units, revenue_gbp, unit_binding_cost,
         cost_of_goods_sold, gross_profit_gbp, gross_margin_pct, print_run_utilization,
         return_rate_pct, tmp AS temperature_celsius, hmd AS humidity_pct, vscr AS vendor_score,
         stg_daily_id AS source_record_id
  FROM tagged_daily WHERE failed IS NULL
)"""

_SALES_COLUMNS = """time_key, product_key, author_key, dc_key, vendor_key, channel_key,
  product_type_key, currency_key, sale_number, print_run_qty, source_record_id"""
_SALES_MONEY = _dbl(
    "quantity_sold", "unit_price_original", "unit_price_gbp", "discount_rate", "discount_amount_gbp",
    "gross_amount_gbp", "net_amount_gbp", "binding_cost_gbp", "unit_cost_gbp", "total_cost_gbp",
    "gross_profit_gbp", "gross_margin_pct", "vendor_score",
)
_DAILY_MONEY = _dbl(
    "binding_cost_gbp", "revenue_gbp", "unit_binding_cost", "cost_of_goods_sold", "gross_profit_gbp",
    "gross_margin_pct", "print_run_utilization", "return_rate_pct", "temperature_celsius", "vendor_score",
)


def _sum(column: str, name: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) AS {name}"


CALENDAR = """
span AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
days AS (
  SELECT CAST(d AS DATE) AS full_date
  FROM (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM span)
),
parts AS (
  SELECT full_date, CAST(year(full_date) AS INTEGER) AS y, CAST(month(full_date) AS INTEGER) AS m,
         CAST(day(full_date) AS INTEGER) AS dom, CAST(isodow(full_date) AS INTEGER) AS dow,
         CAST(quarter(full_date) AS INTEGER) AS q, last_day(full_date) AS month_last
  FROM days
),
named AS (
  SELECT *, CASE WHEN m = 1 AND dom = 1 THEN 'New Year''s Day'
                 WHEN m = 12 AND dom = 25 THEN 'Christmas Day'
                 WHEN m = 12 AND dom = 26 THEN 'Boxing Day'
                 WHEN m = 5 AND dow = 1 AND dom <= 7 THEN 'Early May Bank Holiday'
                 WHEN m = 5 AND dow = 1 AND dom >= 25 THEN 'Spring Bank Holiday'
                 WHEN m = 8 AND dow = 1 AND dom >= 25 THEN 'Summer Bank Holiday' END AS holiday,
         CASE WHEN m >= 4 THEN m - 3 ELSE m + 9 END AS fm
  FROM parts
),
cal AS (
  SELECT y * 10000 + m * 100 + dom AS time_key, full_date, dow AS day_of_week,
         strftime(full_date, '%A') AS day_of_week_name, dom AS day_of_month,
         CAST(dayofyear(full_date) AS INTEGER) AS day_of_year,
         CAST(week(full_date) AS INTEGER) AS week_of_year, m AS month_number,
         strftime(full_date, '%B') AS month_name, strftime(full_date, '%b') AS month_abbr,
         q AS quarter_number, 'Q' || q AS quarter_name, y AS year,
         CASE WHEN m >= 4 THEN y + 1 ELSE y END AS fiscal_year,
         CAST(ceil(fm / 3.0) AS INTEGER) AS fiscal_quarter, fm AS fiscal_month,
         CASE WHEN dow >= 6 THEN 'Y' ELSE 'N' END AS is_weekend,
         CASE WHEN holiday IS NULL THEN 'N' ELSE 'Y' END AS is_uk_holiday, holiday AS uk_holiday_name,
         CASE WHEN dom = 1 THEN 'Y' ELSE 'N' END AS is_month_start,
         CASE WHEN full_date = month_last THEN 'Y' ELSE 'N' END AS is_month_end,
         CASE WHEN dom = 1 AND m IN (1, 4, 7, 10) THEN 'Y' ELSE 'N' END AS is_quarter_start,
         CASE WHEN full_date = month_last AND m IN (3, 6, 9, 12) THEN 'Y' ELSE 'N' END AS is_quarter_end,
         CASE WHEN m = 1 AND dom = 1 THEN 'Y' ELSE 'N' END AS is_year_start,
         CASE WHEN m = 12 AND dom = 31 THEN 'Y' ELSE 'N' END AS is_year_end,
         CAST(date_trunc('week', full_date) AS DATE) AS week_start_date,
         CAST(date_trunc('week', full_date) + INTERVAL 6 DAY AS DATE) AS week_end_date,
         strftime(full_date, '%b') || ' ' || y AS month_year_name,
         'Q' || q || ' ' || y AS quarter_year_name,
         CAST(day(month_last) AS INTEGER) AS days_in_month,
         CASE WHEN m IN (3, 4, 5) THEN 'Spring' WHEN m IN (6, 7, 8) THEN 'Summer'
              WHEN m IN (9, 10, 11) THEN 'Autumn' ELSE 'Winter' END AS season
  FROM named
)"""

VERDICTS = f"""WITH {STAGED_SALES}
SELECT CASE WHEN bad = '' THEN 'VALID' ELSE 'INVALID' END AS validation_status,
       nullif(bad, '') AS validation_errors, count(*) AS n_rows
FROM (SELECT concat_ws('; ', CASE WHEN dscnt IS NULL THEN 'dscnt missing' END,
             CASE WHEN year(date_parsed) < 1996 THEN 'date not readable' END) AS bad FROM staged_sales)
GROUP BY 1, 2"""

Q1 = f"""WITH {FACT_SALES},
sold AS (
  SELECT p.edition_id, p.product_title, d.station_region, sum(net_amount_gbp) AS total_revenue,
         sum(total_cost_gbp) AS total_cost, sum(gross_profit_gbp) AS total_profit,
         {_avg("gross_margin_pct")} AS avg_margin_pct, count(DISTINCT f.time_key) AS days_sold
  FROM fact_sales f JOIN time_dim t USING (time_key) JOIN product p USING (product_key)
       JOIN dc d USING (dc_key)
  WHERE t.full_date >= DATE '2000-08-01'
  GROUP BY p.edition_id, p.product_title, d.station_region
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY station_region
         ORDER BY avg_margin_pct DESC NULLS FIRST, edition_id, product_title) AS INTEGER) AS rank_in_region
  FROM sold
)
SELECT station_region, edition_id, product_title, {_dbl("total_revenue", "total_cost", "total_profit")},
       avg_margin_pct, days_sold, rank_in_region
FROM ranked WHERE rank_in_region <= 5"""

Q2 = f"""WITH {FACT_SALES}
SELECT author_id, author_name, primary_genre, count(DISTINCT edition_id) AS number_of_editions,
       {_sum("net_amount_gbp", "total_revenue")}, {_sum("gross_profit_gbp", "total_profit")},
       CAST(sum(net_amount_gbp) AS DOUBLE) / count(DISTINCT edition_id) AS revenue_per_edition,
       CAST(sum(gross_profit_gbp) AS DOUBLE) / count(DISTINCT edition_id) AS profit_per_edition,
       {_avg("gross_margin_pct")} AS avg_margin_pct, {_sum("quantity_sold", "total_units_sold")}
FROM fact_sales f JOIN time_dim t USING (time_key)
     JOIN author a ON a.author_key = f.author_key JOIN product p ON p.product_key = f.product_key
WHERE t.full_date >= DATE '2000-08-01'
GROUP BY author_id, author_name, primary_genre"""

Q3_BASE = f"""WITH {FACT_SALES},
metrics AS (
  SELECT channel_name, channel_type, year, quarter_name, count(*) AS transaction_count,
         sum(quantity_sold) AS total_units, sum(net_amount_gbp) AS net_revenue,
         sum(discount_amount_gbp) AS total_discounts, sum(gross_profit_gbp) AS total_profit,
         {_avg("gross_margin_pct")} AS avg_margin_pct, {_avg("discount_rate")} * 100 AS avg_discount_pct
  FROM fact_sales JOIN channel USING (channel_key) JOIN time_dim USING (time_key)
  WHERE year >= 2000
  GROUP BY channel_code, channel_name, channel_type, year, quarter_name
)"""

Q3 = f"""{Q3_BASE}
SELECT channel_name, channel_type, year || ' ' || quarter_name AS period, transaction_count,
       {_dbl("total_units", "net_revenue", "total_discounts", "total_profit")}, avg_margin_pct,
       avg_discount_pct, CAST(net_revenue AS DOUBLE) / transaction_count AS revenue_per_transaction,
       CAST(net_revenue AS DOUBLE) / nullif(CAST(total_discounts AS DOUBLE), 0) AS revenue_per_discount
FROM metrics"""

Q4 = f"""WITH {FACT_SALES}
SELECT product_type_name, is_physical, year, count(*) AS transaction_count,
       {_sum("quantity_sold", "total_units")}, {_sum("net_amount_gbp", "total_revenue")},
       {_sum("total_cost_gbp", "total_cost")}, {_sum("gross_profit_gbp", "total_profit")},
       {_avg("gross_margin_pct")} AS avg_margin_pct,
       CAST(sum(net_amount_gbp) AS DOUBLE) / CAST(sum(quantity_sold) AS DOUBLE) AS revenue_per_unit,
       CAST(sum(gross_profit_gbp) AS DOUBLE) / CAST(sum(quantity_sold) AS DOUBLE) AS profit_per_unit
FROM fact_sales JOIN product_type USING (product_type_key) JOIN time_dim USING (time_key)
WHERE year >= 1999
GROUP BY product_type_name, is_physical, year"""

Q5_BASE = f"""WITH {FACT_SALES},
monthly AS (
  SELECT year, month_number, year || ' ' || month_name AS month, sum(net_amount_gbp) AS revenue,
         sum(total_cost_gbp) AS cost, sum(gross_profit_gbp) AS profit,
         {_avg("gross_margin_pct")} AS margin_pct
  FROM fact_sales JOIN time_dim USING (time_key) WHERE year >= 2000
  GROUP BY year, month_number, month_name
),
lagged AS (
  SELECT *, lag(revenue) OVER w AS prev_revenue, lag(profit) OVER w AS prev_profit
  FROM monthly WINDOW w AS (ORDER BY year, month_number)
),
grown AS (
  SELECT *, CAST(revenue - prev_revenue AS DOUBLE) / nullif(CAST(prev_revenue AS DOUBLE), 0) * 100 AS revenue_growth_pct,
         CAST(profit - prev_profit AS DOUBLE) / nullif(CAST(prev_profit AS DOUBLE), 0) * 100 AS profit_growth_pct,
         CASE WHEN revenue > prev_revenue THEN '↑' WHEN revenue < prev_revenue THEN '↓' ELSE '→' END AS trend
  FROM lagged
)"""

Q5 = f"""{Q5_BASE}
SELECT year, month_number, month, {_dbl("revenue", "cost", "profit")}, margin_pct, revenue_growth_pct,
       profit_growth_pct, trend FROM grown"""

Q6_BASE = f"""WITH {FACT_SALES},
centers AS (
  SELECT station_code, station_name, station_region, count(*) AS transaction_count,
         sum(quantity_sold) AS total_units, sum(net_amount_gbp) AS total_revenue,
         sum(gross_profit_gbp) AS total_profit, {_avg("gross_margin_pct")} AS avg_margin_pct
  FROM fact_sales JOIN dc USING (dc_key) JOIN time_dim USING (time_key)
  WHERE full_date >= DATE '2000-08-01'
  GROUP BY station_code, station_name, station_region
)"""

Q6 = f"""{Q6_BASE}
SELECT station_code, station_name, station_region, transaction_count,
       {_dbl("total_units", "total_revenue", "total_profit")}, avg_margin_pct,
       CAST(rank() OVER (ORDER BY total_profit DESC NULLS FIRST) AS INTEGER) AS profit_rank,
       CAST(total_revenue AS DOUBLE) / transaction_count AS revenue_per_transaction
FROM centers"""


def _money_text(x: str) -> str:
    return f"""CASE WHEN CAST({x} AS DECIMAL(28,2)) < 0 THEN '-' ELSE '' END || '£' ||
       format('{{:,}}', CAST(trunc(abs(CAST({x} AS DECIMAL(28,2)))) AS BIGINT)) || '.' ||
       right('0' || CAST(CAST(abs(CAST({x} AS DECIMAL(28,2))) * 100 AS BIGINT) % 100 AS VARCHAR), 2)"""


def _two(x: str) -> str:
    """Two decimals of a double, by way of ten."""
    return f"CAST(CAST(CAST({x} AS DECIMAL(38,10)) AS DECIMAL(28,2)) AS VARCHAR)"


def _pct_text(x: str) -> str:
    return f"coalesce({_two(x)}, '') || '%'"


Q7 = f"""{Q5_BASE}
SELECT month AS "Month", {_money_text("revenue")} AS "Revenue", {_money_text("cost")} AS "Cost",
       {_money_text("profit")} AS "Profit", {_pct_text("margin_pct")} AS "Margin %",
       {_pct_text("revenue_growth_pct")} AS "Revenue Growth %",
       {_pct_text("profit_growth_pct")} AS "Profit Growth %", trend AS "Trend"
FROM grown"""

Q7_CHANNELS = f"""{Q3_BASE}
SELECT channel_name AS "Channel", channel_type AS "Type", year || ' ' || quarter_name AS "Period",
       transaction_count AS "Transactions", CAST(total_units AS DOUBLE) AS "Units Sold",
       {_money_text("net_revenue")} AS "Net Revenue", {_money_text("total_discounts")} AS "Total Discounts",
       {_money_text("total_profit")} AS "Gross Profit", {_pct_text("avg_margin_pct")} AS "Avg Margin %",
       {_pct_text("avg_discount_pct")} AS "Avg Discount %",
       {_money_text("CAST(CAST(net_revenue AS DOUBLE) / transaction_count AS DECIMAL(38,10))")} AS "Revenue per Transaction",
       {_two("CAST(net_revenue AS DOUBLE) / nullif(CAST(total_discounts AS DOUBLE), 0)")} AS "Revenue per £ Discount"
FROM metrics"""

M1 = f"""WITH {FACT_SALES}
SELECT year, month_number, month_name, edition_id, product_title, channel_name, product_type_name,
       count(*) AS transaction_count, {_sum("quantity_sold", "total_quantity")},
       {_sum("net_amount_gbp", "total_revenue_gbp")}, {_sum("total_cost_gbp", "total_cost_gbp")},
       {_sum("gross_profit_gbp", "total_profit_gbp")}, {_avg("gross_margin_pct")} AS avg_margin_pct,
       CAST(sum(discount_rate) AS DOUBLE) / nullif(count(discount_rate), 0) AS avg_discount_rate
FROM fact_sales JOIN time_dim USING (time_key) JOIN product USING (product_key)
     JOIN channel USING (channel_key) JOIN product_type USING (product_type_key)
GROUP BY year, month_number, month_name, edition_id, product_title, channel_name, product_type_name"""

M2 = f"""WITH {FACT_DAILY}
SELECT full_date, year, month_number, station_code, station_name, station_region, product_type_name,
       CAST(sum(units_sold) AS BIGINT) AS total_units_sold, CAST(sum(returns_qty) AS BIGINT) AS total_returns,
       CAST(sum(net_units) AS BIGINT) AS net_units, {_sum("revenue_gbp", "total_revenue_gbp")},
       {_sum("gross_profit_gbp", "total_profit_gbp")}, {_avg("return_rate_pct")} AS avg_return_rate,
       {_avg("print_run_utilization")} AS avg_utilization, {_avg("vendor_score")} AS avg_vendor_score,
       {_avg("temperature_celsius")} AS avg_temperature, {_avg("humidity_pct")} AS avg_humidity
FROM fact_daily JOIN time_dim USING (time_key) JOIN dc USING (dc_key) JOIN product_type USING (product_type_key)
GROUP BY full_date, year, month_number, station_code, station_name, station_region, product_type_name"""

M3 = f"""WITH {FACT_SALES}
SELECT year, quarter_number, quarter_name, author_id, author_name, primary_genre, station_region,
       count(*) AS transaction_count, {_sum("quantity_sold", "total_quantity")},
       {_sum("net_amount_gbp", "total_revenue_gbp")}, {_sum("total_cost_gbp", "total_cost_gbp")},
       {_sum("gross_profit_gbp", "total_profit_gbp")}, {_avg("gross_margin_pct")} AS avg_margin_pct,
       CAST(sum(net_amount_gbp) AS DOUBLE) / count(DISTINCT edition_id) AS revenue_per_edition
FROM fact_sales f JOIN time_dim USING (time_key) JOIN author a ON a.author_key = f.author_key
     JOIN product p ON p.product_key = f.product_key JOIN dc USING (dc_key)
GROUP BY year, quarter_number, quarter_name, author_id, author_name, primary_genre, station_region"""

M4_BASE = f"""WITH {FACT_DAILY},
rolled AS (
  SELECT year, quarter_number, vendor_id, vendor_name, count(*) AS operation_days,
         CAST(sum(print_run_qty) AS BIGINT) AS total_print_run,
         {_sum("binding_cost_gbp", "total_binding_cost")}, {_avg("unit_binding_cost")} AS avg_unit_cost,
         {_avg("vendor_score")} AS avg_vendor_score,
         CASE WHEN count(unit_binding_cost) = 1 THEN 0.0
              ELSE stddev_samp(CAST(unit_binding_cost AS DOUBLE)) END AS cost_stddev
  FROM fact_daily JOIN time_dim USING (time_key) JOIN vendor USING (vendor_key)
  GROUP BY year, quarter_number, vendor_id, vendor_name
)"""

M4 = f"""{M4_BASE}
SELECT year, quarter_number, vendor_id, vendor_name, operation_days, total_print_run, total_binding_cost,
       avg_unit_cost, avg_vendor_score, round(CAST(cost_stddev AS DOUBLE), 6) AS cost_stddev,
       round(cost_stddev / nullif(avg_unit_cost, 0) * 100, 6) AS cost_variance_pct
FROM rolled"""

M5 = f"""WITH {FACT_SALES}
SELECT year, month_number, channel_code, channel_name, channel_type, product_type_name,
       count(*) AS transaction_count, {_sum("quantity_sold", "total_quantity")},
       {_sum("gross_amount_gbp", "gross_revenue_gbp")}, {_sum("discount_amount_gbp", "total_discount_gbp")},
       {_sum("net_amount_gbp", "net_revenue_gbp")}, {_sum("gross_profit_gbp", "total_profit_gbp")},
       {_avg("gross_margin_pct")} AS avg_margin_pct,
       CAST(sum(discount_rate) AS DOUBLE) / nullif(count(discount_rate), 0) AS avg_discount_rate,
       CAST(sum(net_amount_gbp) AS DOUBLE) / count(*) AS avg_transaction_value
FROM fact_sales JOIN time_dim USING (time_key) JOIN channel USING (channel_key)
     JOIN product_type USING (product_type_key)
GROUP BY year, month_number, channel_code, channel_name, channel_type, product_type_name"""

FINDINGS = """WITH texts AS (
  SELECT CASE WHEN l_discount > 0 THEN l_discount END AS dscnt, l_quantity AS tqty,
         l_extendedprice - 5000 AS margin, l_returnflag AS flag, l_linestatus AS status FROM lineitem
),
counts AS (
  SELECT count(*) AS total, count(*) FILTER (WHERE dscnt IS NULL) AS numeric_dscnt,
         count(*) FILTER (WHERE tqty IS NULL) AS numeric_tqty,
         count(*) FILTER (WHERE margin < 0) AS positive_margin,
         count(*) FILTER (WHERE dscnt < 0.02 OR dscnt > 0.08) AS range_dscnt,
         count(*) FILTER (WHERE tqty < 1 OR tqty > 45) AS range_tqty,
         count(*) FILTER (WHERE flag NOT IN ('A', 'N')) AS category_flag,
         count(*) FILTER (WHERE status <> 'O') AS date_stamp
  FROM texts
),
found AS (
  SELECT total, 'numeric:Dscnt' AS validation_rule, 'WARNING' AS severity, numeric_dscnt AS bad,
         'Dscnt: ' || numeric_dscnt || ' cells without a number' AS details FROM counts
  UNION ALL SELECT total, 'numeric:TQty', 'WARNING', numeric_tqty,
         'TQty: ' || numeric_tqty || ' cells without a number' FROM counts
  UNION ALL SELECT total, 'positive:Margin', 'ERROR', positive_margin,
         'Margin: ' || positive_margin || ' values below zero' FROM counts
  UNION ALL SELECT total, 'range:Dscnt', 'WARNING', range_dscnt,
         'Dscnt: ' || range_dscnt || ' values not between 0.02 and 0.08' FROM counts
  UNION ALL SELECT total, 'range:TQty', 'WARNING', range_tqty,
         'TQty: ' || range_tqty || ' values not between 1 and 45' FROM counts
  UNION ALL SELECT total, 'category:Flag', 'ERROR', category_flag,
         'Flag: ' || category_flag || ' values that are none of A, N' FROM counts
  UNION ALL SELECT total, 'date:DateStamp', 'WARNING', date_stamp,
         'DateStamp: ' || date_stamp || ' dates in no known format' FROM counts
)
SELECT 'raw_sales' AS source_table, validation_rule, severity, total AS total_records,
       total - bad AS valid_records, bad AS invalid_records,
       CASE WHEN bad > 0 THEN details END AS error_details FROM found"""

VIOLATIONS = f"""WITH {FACT_SALES},
counts AS (
  SELECT count(*) AS total, count(*) FILTER (WHERE NOT quantity_sold > 0) AS a,
         count(*) FILTER (WHERE NOT unit_price_gbp > 0) AS b,
         count(*) FILTER (WHERE NOT discount_rate BETWEEN 0 AND 0.25) AS c,
         count(*) FILTER (WHERE discount_rate IS NULL) AS d,
         count(*) FILTER (WHERE net_amount_gbp IS NULL) AS e,
         count(*) FILTER (WHERE quantity_sold > 40) AS f,
         count(*) FILTER (WHERE discount_rate >= 0.05) AS g
  FROM fact_sales
)
SELECT 'ck_sales_qty_positive' AS constraint_name, total AS total_records, a AS invalid_records FROM counts
UNION ALL SELECT 'ck_sales_price_positive', total, b FROM counts
UNION ALL SELECT 'ck_sales_discount', total, c FROM counts
UNION ALL SELECT 'nn_discount_rate', total, d FROM counts
UNION ALL SELECT 'nn_net_amount_gbp', total, e FROM counts
UNION ALL SELECT 'ck_quantity_small', total, f FROM counts
UNION ALL SELECT 'ck_discount_small', total, g FROM counts"""

HISTORY = """WITH daily AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS effective_date, arg_max(o_orderstatus, o_orderkey) AS o_orderstatus
  FROM orders GROUP BY 1, 2
),
marked AS (
  SELECT *, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY effective_date) AS before FROM daily
),
changes AS (SELECT * FROM marked WHERE before IS NULL OR before <> o_orderstatus)
SELECT o_custkey, o_orderstatus, effective_date,
       CAST(lead(effective_date) OVER w - INTERVAL 1 DAY AS DATE) AS expiry_date,
       CASE WHEN lead(effective_date) OVER w IS NULL THEN 'Y' ELSE 'N' END AS is_current,
       CAST(row_number() OVER w AS INTEGER) AS record_version
FROM changes WINDOW w AS (PARTITION BY o_custkey ORDER BY effective_date)"""

_TWO_YEARS = "make_date(year(CAST(o_orderdate AS DATE)) + year(CAST(o_orderdate AS DATE)) % 2, 12, 31)"
LATE = HISTORY.replace("CAST(o_orderdate AS DATE) AS effective_date", f"{_TWO_YEARS} AS effective_date").replace(
    "arg_max(o_orderstatus, o_orderkey)", "arg_max(o_orderstatus, {'d': CAST(o_orderdate AS DATE), 'k': o_orderkey})"
)

MERGE = """WITH ordered AS (
  SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders
),
opening AS (
  SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s FROM ordered
  WHERE day <= DATE '1998-06-30' GROUP BY 1
),
closing AS (
  SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s FROM ordered
  WHERE day <= DATE '2000-12-31' GROUP BY 1
)
SELECT o.o_custkey, o.s AS o_orderstatus, DATE '1998-06-30' AS effective_date,
       CASE WHEN o.s <> c.s THEN DATE '2000-12-30' END AS expiry_date,
       CASE WHEN o.s <> c.s THEN 'N' ELSE 'Y' END AS is_current, CAST(1 AS INTEGER) AS record_version
FROM opening o LEFT JOIN closing c USING (o_custkey)
UNION ALL
SELECT c.o_custkey, c.s, DATE '2000-12-31', CAST(NULL AS DATE), 'Y',
       CAST(CASE WHEN o.s IS NULL THEN 1 ELSE 2 END AS INTEGER)
FROM closing c LEFT JOIN opening o USING (o_custkey) WHERE o.s IS NULL OR o.s <> c.s"""

META = """meta AS (
  SELECT n_name, n_nationkey, r_name, s_suppkey, s_name, s_acctbal, p_partkey, p_name, p_type, p_brand
  FROM part LEFT JOIN (
    SELECT DISTINCT l_partkey, s_suppkey, s_name, s_acctbal, n_name, n_nationkey, r_name
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
         JOIN region ON n_regionkey = r_regionkey
  ) ON l_partkey = p_partkey
)"""
_FIRST_VERSION = """DATE '1998-06-30' AS effective_date, CAST(NULL AS DATE) AS expiry_date, 'Y' AS is_current,
       CAST(1 AS INTEGER) AS record_version"""

RATES = f"""WITH {STAGED_SALES},
base AS (
  SELECT *, isodow(date_parsed) >= 6 AS weekend FROM staged_sales
),
rates AS (
  SELECT curr, date_parsed,
         CAST(CAST(CAST(sum(tqty) AS DOUBLE) / CAST(sum(tqty) + count(*) AS DOUBLE) AS DECIMAL(38,10)) AS DECIMAL(12,6)) AS rate
  FROM base WHERE curr <> 'GBP' AND NOT weekend GROUP BY 1, 2
),
priced AS (
  SELECT b.curr, b.date_parsed, b.uprice,
         coalesce(r.rate, CAST(CASE b.curr WHEN 'USD' THEN 0.79 WHEN 'EUR' THEN 0.85 ELSE 1 END AS DECIMAL(12,6))) AS rate
  FROM base b LEFT JOIN rates r ON r.curr = b.curr AND r.date_parsed = b.date_parsed
)
SELECT curr, strftime(date_parsed, '%Y-%m') AS month, count(*) AS n_rows, {_sum("rate", "sum_rate")},
       CAST(sum(CAST(uprice * rate AS {M})) AS DOUBLE) AS sum_price_gbp
FROM priced GROUP BY 1, 2"""

FORECAST = f"""WITH {FACT_SALES},
quarterly AS (
  SELECT product_type_name, year * 4 + quarter_number - 1 AS qi, CAST(sum(net_amount_gbp) AS DOUBLE) AS revenue
  FROM fact_sales JOIN time_dim USING (time_key) JOIN product_type USING (product_type_key)
  GROUP BY product_type_name, year, quarter_number
),
fitted AS (
  SELECT product_type_name, count(*) AS quarters, max(qi) + 1 AS upcoming, regr_slope(revenue, qi) AS slope,
         avg(qi) AS mean_x, avg(revenue) AS mean_y
  FROM quarterly GROUP BY product_type_name
)
SELECT product_type_name, quarters, CAST(upcoming // 4 AS INTEGER) AS next_year,
       CAST(upcoming % 4 + 1 AS INTEGER) AS next_quarter, round(slope, 2) AS slope,
       round(mean_y + slope * (upcoming - mean_x), 2) AS forecast
FROM fitted"""

REJECTED = f"""WITH {FACT_SALES},
refused AS (
  SELECT stg_sales_id, sale_num, date_parsed,
         CASE WHEN product_key = -1 THEN 'UNKNOWN_PRODUCT' ELSE failed END AS reject_reason
  FROM tagged
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY sale_num, reject_reason IS NULL
         ORDER BY date_parsed, stg_sales_id) AS place FROM refused
),
outcomes AS (
  SELECT stg_sales_id, sale_num, CASE WHEN reject_reason IS NULL AND place > 1 THEN 'DUPLICATE'
         ELSE reject_reason END AS reject_reason FROM ranked
)"""

LOADED = f"""WITH {STAGED_SALES},
{DIMS},
priced AS (
  SELECT s.*, CAST(s.uprice * CAST(CASE s.curr WHEN 'USD' THEN 0.79 WHEN 'EUR' THEN 0.85 ELSE 1 END AS DECIMAL(12,6)) AS {M}) AS p,
         {_div("s.bc", "s.pd", M)} AS c FROM staged_sales s
),
gross AS (SELECT *, CAST(p * tqty AS {M}) AS g, CAST(c * tqty AS {M}) AS cost FROM priced),
net AS (SELECT *, CAST(g - CAST(g * coalesce(dscnt, CAST(0 AS DECIMAL(5,4))) AS {M}) AS {M}) AS net FROM gross),
judged AS (
  SELECT *, net > 0 AND {_try_div("(net - cost) * 100", "net", "DECIMAL(5,2)")} IS NULL AS lost FROM net
),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY sale_num ORDER BY date_parsed) AS rn FROM judged
  WHERE NOT lost AND tqty > 0 AND p > 0 AND coalesce(dscnt <= 0.25, true)
)"""

# daily rows by supplier, under the product type names they are delivered with
LOADED_DAILY = f"""supplied AS (
  SELECT CAST(l_shipdate AS DATE) AS date_parsed, p_type IN ('STANDARD', 'SMALL', 'MEDIUM') AS typed,
         CAST(sum(p_size) * 5 AS BIGINT) AS pd, sum(CAST(p_retailprice AS {M})) AS bc,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS us,
         CAST(coalesce(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) END), 0) AS BIGINT) AS rv,
         sum(CAST(l_extendedprice AS {M})) AS rev
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY CAST(l_shipdate AS DATE), l_suppkey, p_type
),
costed AS (
  SELECT *, {_try_div("bc", "pd", "DECIMAL(12,4)")} AS unit_cost, {_try_div("us * 100", "pd", "DECIMAL(5,2)")} AS used,
         CASE WHEN us > 0 THEN {_try_div("rv * 100", "us", "DECIMAL(5,2)")} ELSE 0 END AS returned FROM supplied
),
earned AS (SELECT *, TRY_CAST(rev - TRY_CAST(unit_cost * us AS {M}) AS {M}) AS profit FROM costed),
outcomes AS (
  SELECT *, CASE WHEN NOT typed THEN 'NO_PRODUCT_TYPE' WHEN used IS NULL THEN 'OVERFLOW_PRINT_RUN_UTILIZATION'
    WHEN returned IS NULL THEN 'OVERFLOW_RETURN_RATE_PCT'
    WHEN rev > 0 AND {_try_div("profit * 100", "rev", "DECIMAL(5,2)")} IS NULL THEN 'OVERFLOW_GROSS_MARGIN_PCT' ELSE 'LOADED' END AS outcome
  FROM earned
)"""

AUTHOR_FEATURES = f"""SELECT author_id, {_sum("quantity_sold", "units")}, {_sum("net_amount_gbp", "revenue")}, {_sum("gross_profit_gbp", "profit")},
       coalesce({_avg("gross_margin_pct")}, 0) AS margin, coalesce({_avg("discount_rate")}, 0) AS discount
FROM fact_sales JOIN author USING (author_key) WHERE author_key <> -1 GROUP BY author_id"""


def kmeans(k: int, rounds: int) -> str:
    """Farthest-point starts and Lloyd rounds written out one by one, over features in millionths of a deviation."""
    used = ["units", "revenue", "profit", "margin", "discount"]

    def apart(other: str) -> str:
        return " + ".join(f"(CAST(p.x{i} AS DOUBLE) - {other}.x{i}) * (CAST(p.x{i} AS DOUBLE) - {other}.x{i})" for i in range(len(used)))

    grid = ", ".join(f"CAST(round(coalesce(({c} - (SELECT avg({c}) FROM features)) / nullif((SELECT stddev_samp({c}) FROM features), 0) * 1000000, 0)) AS BIGINT) AS x{i}" for i, c in enumerate(used))
    xs = [f"x{i}" for i in range(len(used))]
    parts = [FACT_SALES, f"features AS MATERIALIZED ({AUTHOR_FEATURES})", f"points AS MATERIALIZED (SELECT *, {grid} FROM features)"]
    parts.append(f"mean AS (SELECT {', '.join(f'0 AS {x}' for x in xs)})")
    for j in range(k):
        known = [f"start{i}" for i in range(j)] or ["mean"]
        far = f"least({', '.join(map(apart, known))})" if j > 1 else apart(known[0])
        columns = ", ".join(f"CAST(p.{x} AS DOUBLE) AS {x}" for x in xs)
        parts.append(f"start{j} AS MATERIALIZED (SELECT {columns} FROM points p, {', '.join(known)} ORDER BY {far} DESC, author_id LIMIT 1)")
    parts.append("centre0 AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT CAST({j} AS INTEGER) AS segment, * FROM start{j}" for j in range(k)) + ")")
    for r in range(rounds + 1):
        parts.append(f"""assigned{r} AS MATERIALIZED (
  SELECT p.*, c.segment FROM points p, centre{r} c
  QUALIFY row_number() OVER (PARTITION BY author_id ORDER BY {apart("c")}, c.segment) = 1)""")
        means = ", ".join(f"coalesce(CAST(sum(a.{x}) AS DOUBLE) / count(a.{x}), any_value(c.{x})) AS {x}" for x in xs)
        parts.append(f"centre{r + 1} AS MATERIALIZED (SELECT c.segment, {means} FROM centre{r} c LEFT JOIN assigned{r} a USING (segment) GROUP BY c.segment)")
    return "WITH " + ",\n".join(parts) + f"\nSELECT author_id, {', '.join(used)}, segment FROM assigned{rounds}"


ORACLES: dict[str, str] = {
    "q1_top_editions_by_region": Q1,
    "q2_author_roi": Q2,
    "q3_channel_efficiency": Q3,
    "q4_product_type_profitability": Q4,
    "q5_monthly_trend": Q5,
    "q6_dc_ranking": Q6,
    "q7_formatted_report": Q7,
    "q7_formatted_channels": Q7_CHANNELS,
    "m1_monthly_sales_summary": M1,
    "m2_daily_dc_performance": M2,
    "m3_quarterly_author_profit": M3,
    "m4_vendor_cost_analysis": M4,
    "m5_channel_performance": M5,
    "m6_rollup_refresh": M5,
    "m6_rollup_refresh_months": M5,
    "m6_delta_monthly_sales": M1,
    "m6_delta_daily_dc": M2,
    "m6_delta_vendor_cost": M4,
    "m6_delta_channel": M5,
    "calendar_dim": f"WITH {CALENDAR} SELECT * FROM cal",
    "calendar_report": f"""WITH {CALENDAR}
SELECT 'Total Records' AS metric, CAST(count(*) AS VARCHAR) AS value FROM cal
UNION ALL SELECT 'Date Range', strftime(min(full_date), '%Y-%m-%d') || ' to ' || strftime(max(full_date), '%Y-%m-%d') FROM cal
UNION ALL SELECT 'Weekends', CAST(count(*) AS VARCHAR) FROM cal WHERE is_weekend = 'Y'
UNION ALL SELECT 'UK Holidays', CAST(count(*) AS VARCHAR) FROM cal WHERE is_uk_holiday = 'Y'
UNION ALL SELECT 'Fiscal Years', CAST(count(DISTINCT fiscal_year) AS VARCHAR) FROM cal""",
    "calendar_easter": """WITH y AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders FROM orders GROUP BY 1
),
moon AS (SELECT *, (19 * (year % 19) + 24) % 30 AS d FROM y),
gauss AS (SELECT *, (2 * (year % 4) + 4 * (year % 7) + 6 * d + 5) % 7 AS e FROM moon)
SELECT year, CAST(make_date(year, 3, 22) + CAST(d + e AS INTEGER) AS DATE) AS easter_sunday, n_orders FROM gauss""",
    "parse_dates_multi_format": """SELECT o_orderkey,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN CAST(o_orderdate AS DATE) END AS date_parsed,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'yyyy-MM-dd' WHEN '2-HIGH' THEN 'dd-MM-yyyy'
       WHEN '3-MEDIUM' THEN 'yyyy/MM/dd' ELSE '' END AS date_format
FROM orders""",
    "extract_metadata": """SELECT 'raw_sales' AS source, count(*) AS total_rows, CAST(11 AS INTEGER) AS n_columns FROM lineitem
UNION ALL SELECT 'raw_daily', count(*), CAST(6 AS INTEGER) FROM orders""",
    "staging_roundtrip": f"""WITH {STAGED_SALES}
SELECT strftime(date_parsed, '%Y-%m') AS month, 'VALID' AS validation_status, 'N' AS processed_flag,
       count(*) AS n_rows, {_sum("tqty", "quantity")}, {_sum("uprice", "price")}, count(dscnt) AS discounted
FROM staged_sales GROUP BY 1""",
    "archive_split": f"""WITH {FACT_SALES},
flagged AS (
  SELECT s.date_parsed, s.tqty, f.source_record_id IS NOT NULL AS done
  FROM staged_sales s LEFT JOIN fact_sales f ON f.source_record_id = s.stg_sales_id
)
SELECT CASE WHEN done THEN 'ARCHIVE' ELSE 'STAGING' END AS part, CAST(year(date_parsed) AS INTEGER) AS year,
       count(*) AS n_rows, {_sum("tqty", "quantity")}
FROM flagged WHERE NOT done OR year(date_parsed) >= 1998 GROUP BY 1, 2""",
    "archived_total": f"""SELECT a.n + b.n AS n_rows FROM
(WITH {FACT_SALES} SELECT count(*) AS n FROM fact_sales) a, (WITH {FACT_DAILY} SELECT count(*) AS n FROM fact_daily) b""",
    "unprocessed_rows": f"""WITH {FACT_SALES}
SELECT stg_sales_id, sale_num FROM staged_sales s
WHERE NOT EXISTS (SELECT 1 FROM fact_sales f WHERE f.source_record_id = s.stg_sales_id)""",
    "quality_findings": FINDINGS,
    "row_verdicts": VERDICTS,
    "duplicate_keys": f"""WITH {STAGED_SALES}
SELECT sale_num, count(*) AS n_rows FROM staged_sales GROUP BY 1 HAVING count(*) > 1""",
    "orphan_keys": """SELECT l_partkey, count(*) AS n_rows FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 1) GROUP BY 1""",
    "constraint_violations": VIOLATIONS,
    "daily_violations": f"""WITH {STAGED_DAILY}
SELECT c.name AS constraint_name, total_records, c.bad AS invalid_records FROM (
  SELECT count(*) AS total_records, unnest([
    {{'name': 'ck_daily_print_run', 'bad': count(*) FILTER (pd < 0)}}, {{'name': 'ck_daily_units_sold', 'bad': count(*) FILTER (us < 0)}},
    {{'name': 'ck_daily_revenue', 'bad': count(*) FILTER (rev < 0)}}, {{'name': 'ck_daily_temp', 'bad': count(*) FILTER (tmp * 5 > 60)}},
    {{'name': 'ck_daily_humidity', 'bad': count(*) FILTER (hmd * 2 > 100)}},
    {{'name': 'ck_daily_vendor_score', 'bad': count(*) FILTER (vscr + 1 > 10)}}
  ]) AS c FROM staged_daily
)""",
    "dimension_violations": f"""WITH {DIMS},
scored AS (SELECT DISTINCT s_suppkey, abs(s_acctbal) / 1000 AS score FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem))
SELECT 'vendor' AS dimension, 'ck_current' AS constraint_name, count(*) AS total_records, CAST(0 AS BIGINT) AS invalid_records FROM scored
UNION ALL SELECT 'vendor', 'ck_dim_vendor_score', count(*), count(*) FILTER (score > 10) FROM scored
UNION ALL SELECT 'product', 'ck_current', count(*), count(*) FILTER (NOT author_key < 20) FROM product
UNION ALL SELECT 'product_type', 'ck_physical', count(*), count(*) FILTER (is_physical NOT IN ('Y', 'N')) FROM product_type
UNION ALL SELECT 'currency', 'ck_base', 4, 0
UNION ALL SELECT 'time', 'ck_dim_time_dow', count(*), 0 FROM time_dim
UNION ALL SELECT 'time', 'ck_dim_time_month', count(*), count(*) FILTER (month_number = 12) FROM time_dim
UNION ALL SELECT 'time', 'ck_dim_time_quarter', count(*), 0 FROM time_dim""",
    "discount_imputed": f"""WITH {STAGED_SALES},
means AS (
  SELECT chnl, CAST(CAST(CAST(CAST(sum(dscnt) AS DOUBLE) / count(dscnt) AS DECIMAL(38,10)) AS DECIMAL(5,4)) AS DOUBLE)
         AS discount_imputed
  FROM staged_sales GROUP BY 1
)
SELECT stg_sales_id, chnl, discount_imputed FROM staged_sales JOIN means USING (chnl) WHERE dscnt IS NULL""",
    "first_valid_sales": f"""WITH {STAGED_SALES}
SELECT sale_num, stg_sales_id FROM (SELECT *, row_number() OVER (PARTITION BY sale_num
       ORDER BY date_parsed, stg_sales_id) AS rn FROM staged_sales) WHERE rn = 1""",
    "first_valid_existing": f"""WITH {STAGED_SALES},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY sale_num ORDER BY date_parsed, stg_sales_id) AS rn,
         sale_num IN (SELECT sale_num FROM staged_sales WHERE year(date_parsed) = 1995) AS there
  FROM staged_sales
)
SELECT CASE WHEN rn = 1 AND NOT there THEN 'KEPT' ELSE 'DUPLICATE' END AS outcome,
       CAST(year(date_parsed) AS INTEGER) AS year, count(*) AS n_rows FROM placed GROUP BY 1, 2""",
    "surrogate_keys": """SELECT 99999 + row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS order_key,
       o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders""",
    "fact_key_density": f"""WITH {FACT_SALES}
SELECT CAST(100000 AS BIGINT) AS first_key, 99999 + count(*) AS last_key, count(*) AS n_keys FROM fact_sales""",
    "scd2_history": HISTORY,
    "scd2_late": LATE,
    "scd2_merge": f"""SELECT 999 + row_number() OVER (ORDER BY effective_date, o_custkey) AS customer_key, * FROM ({MERGE})""",
    "dim_author": f"""WITH {META}
SELECT p_brand AS author_id, 'Author' AS first_name, substr(p_brand, 7) AS last_name,
       'Author ' || substr(p_brand, 7) AS full_name, 'UK' AS country, min(p_type) AS primary_genre, {_FIRST_VERSION}
FROM meta GROUP BY p_brand""",
    "dim_vendor": f"""WITH {META}
SELECT DISTINCT 'V' || s_suppkey AS vendor_id, s_name AS vendor_name,
       CAST(CAST(CAST(abs(s_acctbal) / 1000 AS DECIMAL(38,10)) AS DECIMAL(3,1)) AS DOUBLE) AS vendor_score,
       'Paper' AS service_type_1, 'A' AS service_quality_1, CAST(NULL AS VARCHAR) AS service_type_2,
       CAST(NULL AS VARCHAR) AS service_quality_2, {_FIRST_VERSION}
FROM meta WHERE s_suppkey IS NOT NULL""",
    "dim_dc": f"""WITH {META}
SELECT DISTINCT n_name AS station_code, n_name || ' DC' AS station_name, r_name AS station_region,
       'UK' AS station_country, 'MGR' || n_nationkey AS manager_id,
       '1 High Street, E' || n_nationkey || ' 8ZA' AS station_address, 'E' || n_nationkey || ' 8ZA' AS postcode,
       {_FIRST_VERSION}
FROM meta WHERE n_name IS NOT NULL""",
    "dim_product": f"""WITH {META}
SELECT CAST(p_partkey AS VARCHAR) AS edition_id, p_name AS product_title, p_type AS product_category,
       'EN' AS product_language, p_brand AS author_id, min('V' || s_suppkey) AS vendor_id,
       DATE '1998-06-30' AS effective_date, 'Y' AS is_current, CAST(1 AS INTEGER) AS record_version
FROM meta GROUP BY p_partkey, p_name, p_type, p_brand""",
    "station_vendor": f"WITH {META} SELECT DISTINCT n_name AS station_code, 'V' || s_suppkey AS vendor_id FROM meta WHERE s_suppkey IS NOT NULL",
    "fact_sales": f"WITH {FACT_SALES} SELECT {_SALES_COLUMNS}, {_SALES_MONEY} FROM fact_sales",
    "fact_sales_rejected": f"{REJECTED} SELECT * FROM outcomes WHERE reject_reason IS NOT NULL",
    "fact_daily": f"""WITH {FACT_DAILY}
SELECT time_key, (SELECT min(product_key) FROM product WHERE product_key <> -1) AS product_key, dc_key, vendor_key,
       product_type_key, print_run_qty, units_sold, returns_qty, net_units,
       humidity_pct, source_record_id, {_DAILY_MONEY} FROM fact_daily""",
    "fact_daily_rejected": f"""WITH {FACT_DAILY}
SELECT stg_daily_id, failed AS reject_reason FROM tagged_daily WHERE failed IS NOT NULL""",
    "fact_sink_months": f"""WITH {FACT_SALES}
SELECT CAST(time_key // 100 AS INTEGER) AS year_month, count(*) AS n_rows, {_sum("net_amount_gbp", "net")}
FROM fact_sales WHERE time_key // 10000 <> 1999 OR quantity_sold > 25 GROUP BY 1""",
    "fact_sales_first_center": f"""WITH {FACT_SALES}
SELECT (SELECT min(dc_key) FROM dc WHERE dc_key <> -1) AS dc_key, count(*) AS n_rows, {_sum("net_amount_gbp", "net")}
FROM fact_sales""",
    "seed_codes": """WITH sold AS (
  SELECT 'CH00' || substr(o_orderpriority, 1, 1) AS channel_code,
         CASE l_returnflag WHEN 'A' THEN 'HRD' WHEN 'R' THEN 'PBK' ELSE 'EBK' END AS product_type_code,
         count(*) AS n_rows, CAST(sum(l_quantity) AS DOUBLE) AS quantity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
),
channel(channel_key, channel_code, channel_name, channel_type) AS (
  VALUES (1000::BIGINT, 'CH001', 'Amazon', 'Online'), (1001, 'CH002', 'Barnes & Noble', 'Online'), (1002, 'CH003', 'In_Store', 'Physical')
),
kind(product_type_key, product_type_code, product_type_name, is_physical) AS (
  VALUES (1000::BIGINT, 'HRD', 'Hardcover', 'Y'), (1001, 'PBK', 'Paperback', 'Y'), (1002, 'EBK', 'e-Book', 'N')
)
SELECT * FROM sold LEFT JOIN channel USING (channel_code) LEFT JOIN kind USING (product_type_code)""",
    "incremental_load": f"""{LOADED}
SELECT CAST(year(date_parsed) * 100 + month(date_parsed) AS INTEGER) AS year_month, count(*) AS n_rows, count(*) AS n_sales,
       {_sum("net", "net")}, count(*) FILTER (p_size > 25 AND date_parsed < DATE '1998-07-01') AS unknown_editions
FROM kept JOIN part ON p_partkey = l_partkey WHERE rn = 1 GROUP BY 1""",
    "incremental_daily": f"""WITH {LOADED_DAILY}
SELECT CASE WHEN outcome = 'LOADED' THEN CAST(year(date_parsed) * 100 + month(date_parsed) AS INTEGER) END AS year_month, outcome,
       count(*) AS n_rows, CAST(sum(rev) FILTER (outcome = 'LOADED') AS DOUBLE) AS revenue,
       CAST(sum(us - rv) FILTER (outcome = 'LOADED') AS DOUBLE) AS units
FROM outcomes GROUP BY 1, 2""",
    "key_index": """WITH lines AS (
  SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS day FROM lineitem
), early AS (SELECT DISTINCT l_orderkey, l_linenumber, true AS known FROM lines WHERE day < DATE '1998-07-01')
SELECT strftime(day, '%Y-%m') AS month, count(*) FILTER (known) AS n_known, count(*) FILTER (known IS NULL) AS n_new
FROM lines LEFT JOIN early USING (l_orderkey, l_linenumber) GROUP BY 1""",
    "archived_load": f"""{LOADED},
{LOADED_DAILY},
loaded AS (
  SELECT 'raw_sales' AS source, coalesce(rn = 1, false) AS taken FROM staged_sales s LEFT JOIN kept k USING (stg_sales_id)
  UNION ALL SELECT 'raw_daily', outcome = 'LOADED' FROM outcomes
)
SELECT source, 'VALID' AS status, CASE WHEN taken THEN 'Y' ELSE 'N' END AS flag, count(*) AS n_rows, count(*) AS n_ids
FROM loaded GROUP BY ALL""",
    "load_log": f"""{LOADED},
{LOADED_DAILY},
sd AS (SELECT date_parsed < DATE '1998-07-01' AS early, count(*) AS n, count(*) FILTER (outcome = 'LOADED') AS kept FROM outcomes GROUP BY 1),
m AS (
  SELECT p_size <= 25 AS early, count(*) AS n FROM (SELECT DISTINCT p_partkey, p_size, l_suppkey FROM part LEFT JOIN lineitem ON p_partkey = l_partkey)
  GROUP BY 1
),
s AS (SELECT date_parsed < DATE '1998-07-01' AS early, count(*) AS n FROM staged_sales GROUP BY 1),
k AS (SELECT date_parsed < DATE '1998-07-01' AS early, count(*) AS n FROM kept WHERE rn = 1 GROUP BY 1),
b(batch_id, batch_name, early) AS (VALUES (1::BIGINT, 'FULL_LOAD', true), (2, 'INCREMENTAL_LOAD', false), (3, 'INCREMENTAL_LOAD', NULL)),
steps AS (
  SELECT batch_id, batch_name, '-' AS step, coalesce(k.n, 0) + coalesce(sd.kept, 0) AS records_processed FROM b LEFT JOIN k USING (early) LEFT JOIN sd USING (early)
  UNION ALL SELECT batch_id, batch_name, 'load fact_sales', n FROM b JOIN k USING (early)
  UNION ALL SELECT batch_id, batch_name, 'load fact_daily', kept FROM b JOIN sd USING (early)
  UNION ALL SELECT batch_id, batch_name, 'stage raw_daily', n FROM b JOIN sd USING (early)
  UNION ALL SELECT batch_id, batch_name, 'dimensions', CASE WHEN early IS NULL THEN 0 ELSE 1 END FROM b
  UNION ALL SELECT batch_id, batch_name, 'stage raw_meta', n FROM b JOIN m USING (early)
  UNION ALL SELECT batch_id, batch_name, 'stage raw_sales', n FROM b JOIN s USING (early)
)
SELECT batch_id, batch_name, step, 'COMPLETED' AS status, CAST(records_processed AS BIGINT) AS records_processed FROM steps""",
    "load_summary": f"""{REJECTED}
SELECT coalesce(reject_reason, 'LOADED') AS outcome, count(*) AS n_rows FROM outcomes GROUP BY 1""",
    "exchange_rate_lookup": RATES,
    "correlations": f"""WITH {FACT_SALES},
made AS (
  SELECT channel_key, corr(CAST(discount_rate AS DOUBLE), CAST(gross_margin_pct AS DOUBLE)) AS a,
         corr(CAST(quantity_sold AS DOUBLE), CAST(net_amount_gbp AS DOUBLE)) AS b
  FROM fact_sales GROUP BY 1
)
SELECT channel_key, 'discount_rate' AS left_measure, 'gross_margin_pct' AS right_measure, round(a, 6) AS correlation FROM made
UNION ALL SELECT channel_key, 'quantity_sold', 'net_amount_gbp', round(b, 6) FROM made""",
    "outliers": f"""WITH {FACT_SALES},
figures AS (
  SELECT product_type_key, {_avg("net_amount_gbp")} AS centre, stddev_samp(CAST(net_amount_gbp AS DOUBLE)) AS spread
  FROM fact_sales GROUP BY 1
),
scored AS (
  SELECT sale_number, product_type_key, CAST(net_amount_gbp AS DOUBLE) AS net_amount_gbp,
         (CAST(net_amount_gbp AS DOUBLE) - centre) / spread AS score
  FROM fact_sales JOIN figures USING (product_type_key)
)
SELECT sale_number, product_type_key, net_amount_gbp, round(score, 4) AS score FROM scored WHERE abs(score) > 2""",
    "outliers_iqr": f"""WITH {FACT_SALES},
figures AS (
  SELECT product_type_key, CAST(quantile_disc(gross_margin_pct, 0.25) AS DOUBLE) AS lo,
         CAST(quantile_disc(gross_margin_pct, 0.75) AS DOUBLE) AS hi FROM fact_sales GROUP BY 1
),
scored AS (
  SELECT sale_number, product_type_key, CAST(gross_margin_pct AS DOUBLE) AS gross_margin_pct,
         greatest(lo - CAST(gross_margin_pct AS DOUBLE), CAST(gross_margin_pct AS DOUBLE) - hi) / nullif(hi - lo, 0) AS score
  FROM fact_sales JOIN figures USING (product_type_key)
)
SELECT * FROM scored WHERE score > 1.5""",
    "author_features": f"WITH {FACT_SALES}\n{AUTHOR_FEATURES}",
    "kmeans_segments": kmeans(4, 20),
    "exchange_rates_loaded": """WITH given AS (
  SELECT CASE left(o_orderpriority, 1) WHEN '1' THEN 'USD' WHEN '2' THEN 'EUR' WHEN '3' THEN 'GBP' ELSE 'XXX' END AS from_code,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS day,
         (CAST(o_totalprice AS DECIMAL(12,2)) - 30000) * 3 AS rate, o_orderkey % 2 AS turn FROM orders
), tagged AS (
  SELECT *, CASE WHEN from_code = 'XXX' THEN 'UNKNOWN_FROM_CURRENCY' WHEN day IS NULL THEN 'NO_DATE'
                 WHEN rate >= 1000000 THEN 'RATE_DOES_NOT_FIT' WHEN rate <= 0 THEN 'RATE_NOT_POSITIVE' END AS reason
  FROM given
), stored AS (
  SELECT from_code, day, arg_max(rate, {'turn': turn, 'rate': rate}) AS rate FROM tagged WHERE reason IS NULL GROUP BY 1, 2
)
SELECT 'STORED' AS outcome, from_code, CAST(year(day) AS INTEGER) AS year, count(*) AS n_rows, CAST(sum(rate) AS DOUBLE) AS total
FROM stored GROUP BY ALL
UNION ALL SELECT reason, from_code, CAST(year(day) AS INTEGER), count(*), CAST(sum(rate) AS DOUBLE)
FROM tagged WHERE reason IS NOT NULL GROUP BY ALL""",
    "staging_emptied": f"""WITH {STAGED_SALES}
SELECT strftime(date_parsed, '%Y-%m') AS month, count(*) AS n_rows, count(*) AS n_ids, true AS ids_go_on, 'COMPLETED' AS emptied
FROM staged_sales WHERE date_parsed >= DATE '1998-07-01' GROUP BY 1""",
    "audit_columns": f"""SELECT is_current, record_version, count(*) AS n_rows, count(*) AS n_made, count(*) FILTER (is_current = 'N') AS n_changed
FROM ({MERGE}) GROUP BY 1, 2""",
    "trend_forecast": FORECAST,
    "dc_percentile": f"""{Q6_BASE},
placed AS (
  SELECT *, CAST(rank() OVER (ORDER BY total_profit DESC) AS INTEGER) AS profit_rank,
         percent_rank() OVER (ORDER BY total_profit) AS profit_percentile FROM centers
)
SELECT station_code, station_region, {_dbl("total_profit")}, profit_rank, profit_percentile,
       profit_percentile <= 0.2 AS consolidation_candidate FROM placed""",
    "vendor_trend": f"""{M4_BASE},
lagged AS (
  SELECT *, lag(avg_unit_cost) OVER (PARTITION BY vendor_id ORDER BY year, quarter_number) AS prev_unit_cost FROM rolled
)
SELECT vendor_id, vendor_name, year, quarter_number, avg_unit_cost, prev_unit_cost,
       (avg_unit_cost - prev_unit_cost) / nullif(prev_unit_cost, 0) * 100 AS unit_cost_growth_pct FROM lagged""",
    "stream_daily": """WITH days AS (
  SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total
  FROM events GROUP BY 1, 2
)
SELECT * FROM days""",
    "stream_daily_late": """WITH parts AS (
  SELECT CAST(ts AS DATE) AS day, ts, event_type, CAST(value AS DECIMAL(12,2)) AS value, event_id % 4 AS part FROM events
), ends AS (SELECT part, max(ts) AS newest FROM parts GROUP BY 1),
closed AS (SELECT part, max(newest) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 DAY AS upto FROM ends)
SELECT day, event_type, CASE WHEN upto IS NOT NULL AND CAST(day + INTERVAL 1 DAY AS TIMESTAMP) <= upto THEN 'late' ELSE 'in time' END AS outcome,
       count(*) AS n_rows, CAST(sum(value) AS DOUBLE) AS total
FROM parts JOIN closed USING (part) GROUP BY ALL""",
    "stream_unique": "SELECT DISTINCT user_id FROM events",
}
