"""The same questions as ``spark_queries`` in SQL that DuckDB runs over the same tables."""

from __future__ import annotations


def _money(expression: str) -> str:
    return f"CAST(SUM(CAST({expression} AS DECIMAL(18,2))) AS DOUBLE)"


def _average(expression: str) -> str:
    return f"{_money(expression)} / COUNT({expression})"


def _crc32(name: str) -> str:
    """CRC-32 of ASCII text, folded bit by bit; NULL for NULL."""
    bits = "[0::BIGINT,0,0,0,0,0,0,0]"
    step = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END"
    codes = f"list_transform(range(1, length({name}) + 1), lambda i: ascii(substr({name}, i, 1))::BIGINT)"
    folded = f"list_reduce(list_prepend(xor(c, b), {bits}), lambda x, y: {step})"
    start = "4294967295::BIGINT"
    return f"CAST(xor(list_reduce(list_prepend({start}, {codes}), lambda c, b: {folded}), {start}) AS BIGINT)"


def _week(day: str, mode: str) -> str:
    year = f"isoyear({day})" if mode == "iso" else f"year({day})"
    return f"{year} AS week_year, weekofyear({day}) AS week_no"


_PRICES = """
    SELECT date, product, price FROM (
        SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS product, o_totalprice AS price,
               ROW_NUMBER() OVER (PARTITION BY o_orderdate, o_orderpriority ORDER BY o_orderkey) AS rn
        FROM orders)
    WHERE rn = 1"""
_MONTHLY = f"""
    SELECT date_trunc('month', l_shipdate) + INTERVAL 12 MONTH AS month_start, {_money('l_extendedprice')} AS monthly_value
    FROM lineitem
    WHERE l_returnflag = 'R' AND l_linestatus = 'F'
    GROUP BY 1"""


def _weekly_fact(mode: str) -> str:
    return f"""
WITH prices AS ({_PRICES}),
urgent AS (SELECT *, {_week('date', mode)} FROM prices WHERE product LIKE '%URGENT%'),
stock AS (
    SELECT {_week('l_shipdate', mode)}, l_linestatus AS area, {_money('l_quantity')} AS total_stock
    FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O' GROUP BY 1, 2, 3),
monthly AS ({_MONTHLY})
SELECT date, product, area, price, total_stock, COALESCE(monthly_value, 0.0) AS monthly_value
FROM urgent JOIN stock USING (week_year, week_no)
LEFT JOIN monthly ON date_trunc('month', date) = month_start"""


_SILVER = """
silver_prices AS (
    SELECT date, price AS price_usd_per_gal,
           CASE product WHEN '5-LOW' THEN 'Regular Gasoline' WHEN '4-NOT SPECIFIED' THEN 'Crude Oil'
                ELSE product || ' No 2 Diesel' END AS product_name
    FROM (""" + _PRICES + """)),
silver_stocks AS (
    SELECT CAST(l_shipdate AS DATE) AS date, l_quantity AS volume,
           CASE l_returnflag WHEN 'N' THEN 'Distillate Fuel Oil' WHEN 'A' THEN 'Crude Oil'
                ELSE 'Finished Motor Blend' END AS product_name,
           CASE WHEN l_discount > 0.02 THEN 'Ending Stocks' ELSE 'Refinery Inputs' END AS process_name,
           CASE l_linestatus WHEN 'O' THEN 'U.S.' ELSE 'PADD 1' END AS area
    FROM lineitem),
silver_movements AS (
    SELECT date_trunc('month', l_shipdate) + INTERVAL 12 MONTH AS month_start, l_extendedprice AS volume,
           CASE l_returnflag WHEN 'N' THEN 'Distillate Fuel Oil' ELSE 'Residual Fuel Oil' END AS product_name,
           CASE l_linestatus WHEN 'O' THEN 'U.S.' ELSE 'X' END AS country_code,
           CASE WHEN l_tax <= 0.04 THEN 'Net Imports' ELSE 'Exports' END AS description
    FROM lineitem)"""


def _market(mode: str, silver: str = _SILVER) -> str:
    return f"""{silver},
stock AS (
    SELECT {_week('date', mode)}, area, {_money('volume')} AS total_stock_k_barrels
    FROM silver_stocks
    WHERE process_name = 'Ending Stocks' AND area = 'U.S.' AND product_name LIKE '%Distillate Fuel Oil%'
    GROUP BY 1, 2, 3),
flow AS (
    SELECT month_start, {_money('volume')} AS monthly_net_imports_k_bpd
    FROM silver_movements
    WHERE country_code = 'U.S.' AND product_name LIKE '%Distillate Fuel Oil%' AND description LIKE '%Net Imports%'
    GROUP BY 1),
price AS (SELECT *, {_week('date', mode)} FROM silver_prices WHERE product_name LIKE '%No 2 Diesel%'),
market AS (
    SELECT date, product_name, area, price_usd_per_gal, total_stock_k_barrels,
           COALESCE(monthly_net_imports_k_bpd, 0.0) AS monthly_net_imports_k_bpd
    FROM price JOIN stock USING (week_year, week_no)
    LEFT JOIN flow ON date_trunc('month', date) = month_start)"""


_PRODUCT_CLASS = """
    CASE WHEN product_name LIKE '%Crude%' THEN 'Crude Oil'
         WHEN product_name LIKE '%Diesel%' OR product_name LIKE '%Distillate%' THEN 'Distillate Fuel'
         WHEN product_name LIKE '%Gasoline%' OR product_name LIKE '%Blend%' THEN 'Gasoline'
         ELSE 'Other Petroleum Product' END"""
_PRODUCT_NAMES = """
    SELECT product_name FROM silver_prices UNION SELECT product_name FROM silver_stocks
    UNION SELECT product_name FROM silver_movements"""
_AREA_NAMES = "SELECT area AS area_name FROM silver_stocks UNION SELECT country_code FROM silver_movements"


def _gold_fact(mode: str, silver: str = _SILVER) -> str:
    return f"""
WITH {_market(mode, silver)},
products AS (SELECT product_name, {_crc32('product_name')} AS product_id FROM ({_PRODUCT_NAMES})),
areas AS (SELECT area_name, {_crc32('area_name')} AS area_id FROM ({_AREA_NAMES}))
SELECT date, product_id, area_id, price_usd_per_gal, total_stock_k_barrels, monthly_net_imports_k_bpd
FROM market LEFT JOIN products USING (product_name) LEFT JOIN areas ON area = area_name"""


def _dates(source: str) -> str:
    return f"""
SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       CAST(quarter(date) AS INTEGER) AS quarter, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
       CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week
FROM ({source})"""


_ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
_UPSERTED = """
SELECT o_orderkey, o_custkey, o_orderstatus,
       CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderpriority, CAST(o_orderdate AS DATE) AS order_day
FROM orders"""


def _top(partition: str, n: int) -> str:
    return f"""
SELECT {_ORDER_COLUMNS} FROM (
    SELECT *, ROW_NUMBER() OVER ({partition} ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders)
WHERE rn <= {n}"""


ORACLES: dict[str, str] = {
    "survivor_store": """
        WITH arrived AS (
            SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, o_orderdate,
                   CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
            FROM orders WHERE o_orderkey % 5 > 1 OR (o_orderkey % 5 = 0 AND o_orderstatus = 'F'))
        SELECT * FROM arrived
        QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """,
    "weekly_fact": _weekly_fact("calendar"),
    "weekly_fact_iso": _weekly_fact("iso"),
    "fact_keys": f"""
WITH fact AS ({_weekly_fact('iso')}),
products AS (SELECT n, {_crc32('n')} AS product_id FROM (SELECT DISTINCT o_orderpriority AS n FROM orders)),
areas AS (SELECT n, {_crc32('n')} AS area_id FROM (SELECT DISTINCT l_linestatus AS n FROM lineitem))
SELECT date, price, total_stock, monthly_value, product_id, area_id
FROM fact LEFT JOIN products ON product = products.n LEFT JOIN areas ON area = areas.n""",
    "inner_week": f"""
WITH stock AS (
    SELECT {_week('l_shipdate', 'iso')}, l_linestatus, {_money('l_quantity')} AS total_stock
    FROM lineitem GROUP BY 1, 2, 3),
priced AS (
    SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS product, o_totalprice AS price, o_orderkey,
           {_week('o_orderdate', 'iso')}
    FROM orders)
SELECT date, product, price, o_orderkey, l_linestatus, total_stock
FROM priced JOIN stock USING (week_year, week_no)""",
    "left_fill": f"""
WITH monthly AS ({_MONTHLY})
SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS product, o_totalprice AS price, o_orderkey,
       COALESCE(monthly_value, 0.0) AS monthly_value, month_start IS NOT NULL AS has_macro
FROM orders LEFT JOIN monthly ON date_trunc('month', o_orderdate) = month_start""",
    "weekly_sum": f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS week_year, CAST(weekofyear(l_shipdate) AS INTEGER) AS week_no,
       l_linestatus, {_money('l_quantity')} AS total_stock
FROM lineitem GROUP BY 1, 2, 3""",
    "monthly_sum": f"""
SELECT strftime(l_shipdate, '%Y-%m') AS month, l_linestatus, {_money('l_extendedprice')} AS monthly_value
FROM lineitem GROUP BY 1, 2""",
    "dedup_latest": """
SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                 l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn
    FROM lineitem)
WHERE rn = 1""",
    "distinct_on_key": """
SELECT DISTINCT ON (o_custkey) * FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey""",
    "latest_n": f"SELECT {_ORDER_COLUMNS} FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 52",
    "latest_n_per_series": _top("PARTITION BY o_orderpriority", 104),
    "facet_filter": """
SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F'""",
    "quarantine_valid": "SELECT * FROM customer WHERE c_acctbal >= 0",
    "quarantine_bad": """
SELECT *, 'Negative Balance' AS error_reason FROM customer WHERE c_acctbal < 0 OR c_acctbal IS NULL""",
    "quality_counts": """
SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE c_acctbal >= 0) AS valid_rows,
       COUNT(*) FILTER (WHERE NOT COALESCE(c_acctbal >= 0, FALSE)) AS bad_rows,
       COUNT(*) FILTER (WHERE NOT COALESCE(c_acctbal >= 0, FALSE)) / COUNT(*) AS bad_share
FROM customer""",
    "quarantine_share": """
SELECT * FROM (
    SELECT c_nationkey, COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE c_acctbal >= 0) AS valid_rows,
           COUNT(*) FILTER (WHERE c_acctbal < 0) AS bad_rows,
           COUNT(*) FILTER (WHERE c_acctbal < 0) / COUNT(*) AS bad_share
    FROM customer GROUP BY 1)
WHERE bad_share > 0.05""",
    "first_failed_rule": """
SELECT error_reason, COUNT(*) AS n_rows FROM (
    SELECT CASE WHEN l_returnflag = 'R' THEN 'Returned' WHEN l_quantity < 10 THEN 'Small Lot'
                WHEN l_discount > 0 AND l_extendedprice / l_quantity > 1000 THEN NULL
                ELSE 'Cheap or Unpriced' END AS error_reason
    FROM lineitem)
WHERE error_reason IS NOT NULL GROUP BY 1""",
    "typed_parse": """
SELECT l_orderkey, l_linenumber,
       TRY_CAST(CASE l_returnflag WHEN 'A' THEN format('{:,.2f}', l_extendedprice)
                                  WHEN 'R' THEN CAST(l_extendedprice AS VARCHAR) || ' USD'
                                  ELSE CAST(l_extendedprice AS VARCHAR) END AS DOUBLE) AS amount,
       CAST(try_strptime(CASE l_linestatus WHEN 'F' THEN strftime(l_shipdate, '%d.%m.%Y')
                                           ELSE strftime(l_shipdate, '%Y-%m-%d') END, '%Y-%m-%d') AS DATE) AS ship_day
FROM lineitem""",
    "explode_nested": """
SELECT CAST(l_shipdate AS DATE) AS date, value, l_returnflag AS product_name, process_name,
       l_linestatus AS area, CAST(l_linenumber AS VARCHAR) AS snapshot
FROM (
    SELECT *, l_quantity - 5 AS value, CASE WHEN l_tax <= 0.07 THEN 'Ending Stocks' END AS process_name FROM lineitem
    UNION ALL SELECT *, l_extendedprice, 'Net Imports' FROM lineitem
    UNION ALL SELECT *, l_discount, 'Refinery Inputs' FROM lineitem
    UNION ALL SELECT *, l_tax, 'Exports' FROM lineitem)""",
    "month_date": """
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m') || '-01' AS DATE) AS month_date FROM orders""",
    "clean_price_feed": """
SELECT date, price_usd_per_gal, product_name, process_name,
       CASE WHEN price_usd_per_gal > 0 THEN NULL ELSE 'Invalid or Null Price' END AS error_reason
FROM (
    SELECT *, ROW_NUMBER() OVER (
        PARTITION BY date, product_name
        ORDER BY load_year DESC, price_usd_per_gal DESC NULLS LAST, process_name DESC) AS rn
    FROM (
        SELECT CAST(o_orderdate AS DATE) AS date,
               CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_custkey % 40 = 0 THEN 0 - o_totalprice
                    ELSE o_totalprice END AS price_usd_per_gal,
               o_orderpriority AS product_name, o_orderstatus AS process_name,
               year(o_orderdate) + CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS load_year
        FROM orders))
WHERE rn = 1""",
    "clean_stock_feed": """
SELECT date, volume_k_barrels, product_name, process_name, area,
       CASE WHEN process_name IS NULL THEN 'Undecided Filter' WHEN volume_k_barrels >= 0 THEN NULL
            ELSE 'Negative Volume in Ending Stocks' END AS error_reason
FROM (
    SELECT CAST(l_shipdate AS DATE) AS date, l_quantity - 5 AS volume_k_barrels, l_returnflag AS product_name,
           CASE WHEN l_tax <= 0.07 THEN 'Ending Stocks' END AS process_name, l_linestatus AS area,
           ROW_NUMBER() OVER (
               PARTITION BY l_shipdate, l_returnflag, l_linestatus, l_tax <= 0.07
               ORDER BY l_linenumber DESC, l_quantity DESC) AS rn
    FROM lineitem)
WHERE rn = 1""",
    "clean_movement_feed": """
SELECT month_date, volume_k_barrels_per_day, product_name, country_code, description,
       CASE WHEN volume_k_barrels_per_day IS NULL THEN 'Null Volume Detected' END AS error_reason
FROM (
    SELECT *, ROW_NUMBER() OVER (
        PARTITION BY month_date, product_name, country_code, description
        ORDER BY snapshot DESC, volume_k_barrels_per_day DESC NULLS LAST) AS rn
    FROM (
        SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month_date,
               CASE WHEN l_discount > 0 THEN l_extendedprice END AS volume_k_barrels_per_day,
               l_returnflag AS product_name, l_linestatus AS country_code,
               'Net Imports ' || l_tax AS description, l_linenumber AS snapshot
        FROM lineitem))
WHERE rn = 1""",
    "dim_date": _dates(
        "SELECT CAST(o_orderdate AS DATE) AS date FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem"
    ),
    "dim_product": f"""
SELECT product_name, {_crc32('product_name')} AS product_id,
       CASE WHEN product_name LIKE '%bolt%' THEN 'Fastener'
            WHEN product_name LIKE '%gear%' OR product_name LIKE '%ring%' THEN 'Turning'
            WHEN regexp_matches(product_name, '^[1-5]-') THEN 'Order Class'
            ELSE 'Other' END AS product_category
FROM (SELECT p_name AS product_name FROM part UNION SELECT o_orderpriority FROM orders
      UNION SELECT c_mktsegment FROM customer)""",
    "dim_area": f"""
SELECT area_name, {_crc32('area_name')} AS area_id,
       CASE WHEN area_name IN ('ASIA', 'AFRICA', 'EUROPE') THEN 'Continent'
            WHEN area_name LIKE 'NATION%' THEN 'Nation' ELSE 'Other' END AS area_type
FROM (SELECT n_name AS area_name FROM nation UNION SELECT r_name FROM region)""",
    "distinct_members": """
SELECT o_orderkey AS member FROM orders UNION SELECT l_orderkey FROM lineitem UNION SELECT l_partkey FROM lineitem""",
    "key_collisions": f"""
SELECT CAST(SUM(n) AS BIGINT) AS n_names, COUNT(*) AS n_keys, COUNT(*) FILTER (WHERE n > 1) AS n_shared_keys
FROM (
    SELECT {_crc32('name')} AS id, COUNT(*) AS n
    FROM (SELECT c_name AS name FROM customer UNION SELECT s_name FROM supplier UNION SELECT p_name FROM part)
    GROUP BY 1)""",
    "gold_fact": _gold_fact("iso"),
    "gold_fact_calendar": _gold_fact("calendar"),
    "gold_dim_date": f"WITH {_SILVER} "
    + _dates("SELECT date FROM silver_prices UNION SELECT date FROM silver_stocks"),
    "gold_dim_product": f"""
WITH {_SILVER}
SELECT product_name, {_crc32('product_name')} AS product_id, {_PRODUCT_CLASS} AS product_category
FROM ({_PRODUCT_NAMES})""",
    "gold_dim_area": f"""
WITH {_SILVER}
SELECT area_name, {_crc32('area_name')} AS area_id,
       CASE WHEN area_name = 'U.S.' THEN 'Country' WHEN area_name LIKE 'PADD%' THEN 'PADD District'
            ELSE 'Other/Unknown' END AS area_type
FROM ({_AREA_NAMES})""",
    "star_mart": f"""
WITH {_market('iso')}
SELECT CAST(year(date) AS INTEGER) AS year, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
       {_PRODUCT_CLASS} AS product_category, area AS area_name,
       {_average('price_usd_per_gal')} AS avg_price, {_money('total_stock_k_barrels')} AS total_inv
FROM market
WHERE {_PRODUCT_CLASS} = 'Distillate Fuel'
GROUP BY 1, 2, 3, 4 ORDER BY 1, 2, 3, 4""",
    "upsert_insert_update": _UPSERTED,
    "upsert_idempotent": _UPSERTED,
    "publish_upsert": _UPSERTED,
    "snapshot_landing": """
SELECT o_orderkey,
       CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       CAST(date_trunc('year', o_orderdate) AS DATE) AS load_date
FROM orders""",
    "range_scan": """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-04-01'""",
    "missing_weeks": """
WITH weeks AS (SELECT DISTINCT l_suppkey, CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start FROM lineitem),
spine AS (
    SELECT l_suppkey, CAST(UNNEST(generate_series(
               MIN(week_start), (SELECT MAX(week_start) FROM weeks), INTERVAL 7 DAY)) AS DATE) AS week_start
    FROM weeks GROUP BY l_suppkey)
SELECT l_suppkey, week_start FROM spine ANTI JOIN weeks USING (l_suppkey, week_start)""",
    "lag_corr": f"""
WITH prices AS (
    SELECT o_orderpriority AS product, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
           {_average('o_totalprice')} AS avg_price
    FROM orders GROUP BY 1, 2),
stock AS (
    SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start, {_money('l_quantity')} AS total_stock
    FROM lineitem WHERE l_returnflag = 'N' AND l_linestatus = 'O' GROUP BY 1),
lags AS (SELECT CAST(UNNEST([0, 1, 2]) AS INTEGER) AS lag_weeks)
SELECT product, lag_weeks, COUNT(*) AS n_weeks, ROUND(CORR(avg_price, total_stock), 6) AS correlation
FROM lags, stock JOIN prices ON prices.week_start = stock.week_start + 7 * lag_weeks
GROUP BY 1, 2""",
    "mom_change": f"""
WITH monthly AS (
    SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
           {_money('l_extendedprice')} AS total
    FROM lineitem GROUP BY 1, 2)
SELECT a.l_suppkey, a.month_start, a.total, b.total AS previous, a.total - b.total AS change,
       (a.total - b.total) / b.total AS change_share
FROM monthly a LEFT JOIN monthly b
  ON a.l_suppkey = b.l_suppkey AND b.month_start + INTERVAL 1 MONTH = a.month_start""",
    "annual_rollup": f"""
SELECT CAST(COALESCE(year, 0) AS INTEGER) AS year, CAST(COALESCE(quarter, 0) AS INTEGER) AS quarter,
       CAST(GROUPING(year, quarter) AS BIGINT) AS level, COUNT(*) AS n_rows, {_money('l_quantity')} AS total
FROM (SELECT year(l_shipdate) AS year, quarter(l_shipdate) AS quarter, l_quantity FROM lineitem)
GROUP BY ROLLUP (year, quarter)""",
    "season_dow": f"""
SELECT CAST(quarter(l_shipdate) AS INTEGER) AS quarter, CAST(dayofweek(l_shipdate) + 1 AS INTEGER) AS day_of_week,
       COUNT(*) AS n_rows, {_money('l_quantity')} AS total, {_average('l_quantity')} AS average
FROM lineitem GROUP BY 1, 2""",
    "carry_forward": f"""
WITH prices AS ({_PRICES}), monthly AS ({_MONTHLY})
SELECT date, product, price, monthly_value
FROM (SELECT *, date_trunc('month', date) AS own_month FROM prices
      WHERE day(date) % 3 = 0 OR month(date) % 2 = 0 OR product LIKE '%URGENT%') AS thinned
ASOF LEFT JOIN monthly ON own_month >= month_start""",
}
ORACLES["incremental_clean"] = ORACLES["clean_price_feed"]
ORACLES["quarantine_history"] = """
SELECT c_custkey, c_acctbal, 'Negative Balance' AS error_reason,
       CASE WHEN c_acctbal < -500 THEN '1' ELSE '3' END AS first_batch,
       CASE WHEN c_custkey % 2 = 1 THEN '3' ELSE '2' END AS last_batch
FROM customer WHERE c_acctbal < 0 AND (c_acctbal < -500 OR c_custkey % 2 = 1)"""
ORACLES["rounded_fact"] = """
SELECT date, l_returnflag, CAST(round(total, 3) AS DOUBLE) AS total, CAST(round(total / 10, 0) * 10 AS DOUBLE) AS tens
FROM (
    SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag,
           CAST(SUM(CASE WHEN l_returnflag = 'R' THEN -charge ELSE charge END) AS DECIMAL(28,6)) AS total
    FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(12,2)))
                         * (1 + CAST(l_tax AS DECIMAL(12,2))) AS DECIMAL(20,6)) AS charge FROM lineitem)
    GROUP BY 1, 2)"""

# Of the lines of one key the newest snapshot's largest value stays.
_NEWEST = (
    _SILVER.replace("silver_stocks AS (", "all_stocks AS (")
    .replace("silver_movements AS (", "all_movements AS (")
    .replace("FROM lineitem", ", l_linenumber % 3 + 1 AS snapshot FROM lineitem")
    + """,
silver_stocks AS (
    SELECT * FROM all_stocks WHERE process_name = 'Ending Stocks'
    QUALIFY ROW_NUMBER() OVER (PARTITION BY date, product_name, process_name, area ORDER BY snapshot DESC, volume DESC) = 1),
silver_movements AS (
    SELECT * FROM all_movements
    QUALIFY ROW_NUMBER() OVER (
        PARTITION BY month_start, product_name, country_code, description ORDER BY snapshot DESC, volume DESC) = 1)"""
)
ORACLES["incremental_star"] = _gold_fact("iso", _NEWEST)
ORACLES["served_fact"] = ORACLES["gold_fact"]
# The sum of whole numbers of 2**-37 cents is exact; as text it becomes the nearest double.
ORACLES["wide_sums"] = """
SELECT l_suppkey, CAST(CAST(SUM(CAST(cents AS HUGEINT) * (1::HUGEINT << shift)) AS VARCHAR) AS DOUBLE) / 137438953472.0 AS total,
       COUNT(*) AS n_values
FROM (SELECT l_suppkey, CAST((l_orderkey * 7 + l_linenumber) % 65 AS INTEGER) AS shift,
             CAST(round(l_extendedprice * 100) AS BIGINT) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS cents
      FROM lineitem)
GROUP BY 1"""
ORACLES["state_totals"] = f"""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_suppkey, COUNT(*) AS n_values,
       {_money('l_extendedprice')} AS total, {_average('l_extendedprice')} AS mean,
       MIN(l_extendedprice) AS least, MAX(l_extendedprice) AS greatest
FROM lineitem GROUP BY 1, 2"""
ORACLES["quarantine_segments"] = ORACLES["quarantine_history"]
ORACLES["carry_by_series"] = f"""
WITH monthly AS (
    SELECT o_custkey AS customer, CAST(date_trunc('month', o_orderdate) AS DATE) AS of_month, {_money('o_totalprice')} AS monthly_value
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS date, o_totalprice AS price, monthly_value, of_month
FROM orders ASOF LEFT JOIN monthly ON o_custkey = customer AND CAST(o_orderdate AS DATE) >= of_month"""
ORACLES["registry_keys"] = f"""
SELECT name, CASE WHEN ROW_NUMBER() OVER (PARTITION BY first ORDER BY name) = 1 THEN first
                  ELSE CAST('0x' || substr(md5(name), 1, 15) AS BIGINT) + 4096 END AS key
FROM (SELECT name, {_crc32('name')} % 4096 AS first
      FROM (SELECT c_name AS name FROM customer UNION SELECT s_name FROM supplier UNION SELECT p_name FROM part))"""
ORACLES["clustered_scan"] = """
SELECT CAST(o_orderdate AS DATE) AS date, o_custkey, o_orderkey, o_totalprice FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1998-04-01' AND DATE '1998-06-30'
  AND o_custkey <= (SELECT max(o_custkey) // 3 FROM orders)"""
