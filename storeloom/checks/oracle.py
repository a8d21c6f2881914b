"""SQL statements that give the registered queries' results independently.

They are plain set-based SQL over the same tables: decimal sums instead of
cents, window ranks instead of grouped minima, ``quantile_cont`` instead of
the bucket search, so that agreement means something.
"""

AS_OF = "DATE '2001-08-02'"


def r2(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,6)), 2) AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return r2(f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)")


def pct(cur: str, prev: str) -> str:
    return r2(f"(CAST({cur} AS DOUBLE) - CAST({prev} AS DOUBLE))"
              f" / NULLIF(CAST({prev} AS DOUBLE), 0) * 100")


def money(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


# --- the star schema as clients and purchases ------------------------------

CLEAN_CLIENTS = """
clients AS (
  SELECT c_custkey AS id_client, c_name AS name,
         'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         DATE '1993-01-01' + CAST(c_custkey % 700 AS INTEGER) AS subscription_date,
         n_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

LINES = """
lines AS (
  SELECT l_orderkey, l_partkey, o_custkey, l_orderkey * 10 + l_linenumber AS id_purchase,
         p_type AS product, CAST(p_retailprice AS DECIMAL(12,2)) AS price,
         CAST(l_quantity AS INTEGER) AS quantity, CAST(o_orderdate AS DATE) AS purchase_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

CLEAN_INPUT = f"""{CLEAN_CLIENTS}, {LINES},
purchases AS (
  SELECT id_purchase, o_custkey AS id_client, product, CAST(price AS DECIMAL(18,2)) AS price,
         quantity, purchase_date, CAST(price * quantity AS DECIMAL(18,2)) AS total
  FROM lines)"""

DIRTY_INPUT = f"""{LINES},
customers AS (
  SELECT c_custkey AS k,
         CASE WHEN c_custkey % 11 = 0 THEN '  ' || c_name ELSE c_name END AS name,
         CASE WHEN c_custkey % 97 = 5 THEN 'bad-email'
              WHEN c_custkey % 89 = 7 THEN NULL
              WHEN c_custkey % 83 = 3
                THEN 'Shared' || CAST(c_custkey % 5 AS VARCHAR) || '@Example.com'
              ELSE 'User' || CAST(c_custkey AS VARCHAR) || '@Example.com' END AS email,
         CASE WHEN c_custkey % 79 = 4 THEN 'not-a-date'
              WHEN c_custkey % 71 = 2 THEN '2099-01-01'
              ELSE CAST(DATE '1993-01-01' + CAST(c_custkey % 700 AS INTEGER) AS VARCHAR)
              END AS subscription_date,
         CASE WHEN c_custkey % 13 = 0 THEN n_name || ' ' ELSE n_name END AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
raw_clients AS (
  SELECT CAST(k AS VARCHAR) AS id_client, name, email, subscription_date, country FROM customers
  UNION ALL
  SELECT CAST(k AS VARCHAR), name, email, subscription_date, country FROM customers
  WHERE k % 61 = 1),
priced AS (
  SELECT *, CAST(price + CASE WHEN l_orderkey % 61 = 7 THEN 0.005 ELSE 0 END AS DECIMAL(13,3)) AS exact,
         CAST(purchase_date AS VARCHAR) AS day
  FROM lines),
raw_purchases AS (
  SELECT CAST(id_purchase AS VARCHAR) || CASE WHEN l_orderkey % 31 = 5 THEN '.0' ELSE '' END AS id_purchase,
         CASE WHEN l_orderkey % 67 = 9 THEN CAST(-1 - o_custkey AS VARCHAR)
              WHEN l_orderkey % 29 = 4 THEN CAST(o_custkey AS VARCHAR) || '.0'
              ELSE CAST(o_custkey AS VARCHAR) END AS id_client,
         CASE WHEN l_orderkey % 101 = 3 THEN NULL
              WHEN l_partkey % 17 = 0 THEN ' ' || product ELSE product END AS product,
         CAST(exact AS VARCHAR) AS price,
         CAST(CASE WHEN l_orderkey % 59 = 8 THEN -1 WHEN l_orderkey % 47 = 11 THEN 0
                   ELSE quantity END AS VARCHAR) AS quantity,
         CASE WHEN l_orderkey % 73 = 1 THEN 'bad' WHEN l_orderkey % 43 = 2 THEN '2099-12-31'
              WHEN l_orderkey % 83 = 4 THEN substr(day, 1, 7) WHEN l_orderkey % 89 = 6 THEN substr(day, 1, 4)
              WHEN l_orderkey % 97 = 8 THEN day || ' garbage' ELSE day END AS purchase_date,
         CAST(CAST(exact * quantity + CASE WHEN l_orderkey % 53 = 6 THEN 1 ELSE 0 END
              AS DECIMAL(18,2)) AS VARCHAR) AS total
  FROM priced)"""

EMAIL = r"'^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\n?\z'"



def whole(x: str) -> str:
    """A whole number from text; a number with a fraction is none."""
    number = f"TRY_CAST({x} AS DECIMAL(38,18))"
    return f"CAST(CASE WHEN {number} = trunc({number}) THEN {number} END AS BIGINT)"


def day(x: str) -> str:
    """A date from text that is ``yyyy-MM-dd`` and nothing else."""
    return f"CASE WHEN regexp_full_match(trim({x}), '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN TRY_CAST(trim({x}) AS DATE) END"


CLEANING = f"""
tagged_clients AS (
  SELECT {whole('id_client')} AS id_client, name, email, country,
         {day('subscription_date')} AS d,
         CASE WHEN id_client IS NULL OR name IS NULL OR email IS NULL
                OR subscription_date IS NULL OR country IS NULL THEN 'null_values'
              WHEN {day('subscription_date')} IS NULL THEN 'invalid_dates'
              WHEN NOT regexp_matches(email, {EMAIL}) THEN 'invalid_emails'
              WHEN {whole('id_client')} IS NULL THEN 'invalid_numbers' END AS reason
  FROM raw_clients),
client_ids AS (
  SELECT *, row_number() OVER (PARTITION BY id_client
                               ORDER BY subscription_date, email, name, country) AS rn
  FROM (SELECT id_client, name, email, LEAST(d, {AS_OF}) AS subscription_date, country
        FROM tagged_clients WHERE reason IS NULL)),
client_emails AS (
  SELECT *, row_number() OVER (PARTITION BY email
                               ORDER BY id_client, subscription_date, name, country) AS en
  FROM client_ids WHERE rn = 1),
clean_clients AS (
  SELECT id_client, trim(name) AS name, lower(trim(email)) AS email, subscription_date,
         trim(country) AS country
  FROM client_emails WHERE en = 1),
typed_purchases AS (
  SELECT {whole('id_purchase')} AS id_purchase, {whole('id_client')} AS id_client,
         product, TRY_CAST(price AS DECIMAL(18,6)) AS exact, {whole('quantity')} AS quantity,
         {day('purchase_date')} AS d, TRY_CAST(total AS DECIMAL(18,2)) AS stored,
         (id_purchase IS NULL OR id_client IS NULL OR product IS NULL OR price IS NULL
          OR quantity IS NULL OR purchase_date IS NULL OR total IS NULL) AS has_null
  FROM raw_purchases),
tagged_purchases AS (
  SELECT *, CAST(exact AS DECIMAL(18,2)) AS price,
         CAST(exact * CAST(quantity AS DECIMAL(19,0)) AS DECIMAL(18,2)) AS total,
         CASE WHEN has_null THEN 'null_values' WHEN d IS NULL THEN 'invalid_dates'
              WHEN id_purchase IS NULL OR id_client IS NULL OR exact IS NULL
                OR quantity IS NULL OR stored IS NULL THEN 'invalid_numbers'
              WHEN exact < 0 OR quantity < 0 THEN 'negative_values' END AS reason
  FROM typed_purchases),
owned_purchases AS (
  SELECT id_purchase, id_client, product, price, quantity, LEAST(d, {AS_OF}) AS purchase_date, total
  FROM tagged_purchases
  WHERE reason IS NULL AND id_client IN (SELECT id_client FROM clean_clients)),
clean_purchases AS (
  SELECT id_purchase, id_client, trim(product) AS product, price, quantity, purchase_date, total
  FROM (SELECT *, row_number() OVER (
          PARTITION BY id_purchase
          ORDER BY purchase_date, id_client, product, price, quantity, total) AS rn
        FROM owned_purchases)
  WHERE rn = 1)"""

# Rebinds the mart's inputs to the cleaned tables.
CLEANED_INPUT = """
clients AS (SELECT * FROM clean_clients),
purchases AS (SELECT * FROM clean_purchases)"""

# --- gold ------------------------------------------------------------------

ISO_WEEK = ("CAST(year({m} + 3) AS VARCHAR) || '-W' || "
            "lpad(CAST(weekofyear({m}) AS VARCHAR), 2, '0')")


def _week_start(d: str) -> str:
    return f"CAST(date_trunc('week', {d}) AS DATE)"


_SERIES = f"""{money('SUM(total)')} AS total_revenue, COUNT(id_purchase) AS total_orders,
         COUNT(DISTINCT id_client) AS unique_customers, {big('SUM(quantity)')} AS total_quantity"""

MART = f"""
fact AS (
  SELECT p.*, c.name, c.email, c.country, c.subscription_date,
         {big('year(purchase_date)')} AS purchase_year,
         {big('month(purchase_date)')} AS purchase_month,
         {big('quarter(purchase_date)')} AS purchase_quarter,
         {big('weekofyear(purchase_date)')} AS purchase_week,
         {big('isodow(purchase_date) - 1')} AS purchase_day_of_week,
         dayname(purchase_date) AS purchase_day_name,
         strftime(purchase_date, '%Y-%m') AS year_month,
         {ISO_WEEK.format(m=_week_start('purchase_date'))} AS year_week,
         {big("date_diff('day', c.subscription_date, purchase_date)")} AS customer_tenure_days
  FROM purchases p LEFT JOIN clients c ON p.id_client = c.id_client),
totals AS (
  SELECT id_client, COUNT(id_purchase) AS total_purchases, SUM(total) AS spent,
         {ratio('SUM(total)', 'COUNT(id_purchase)')} AS avg_order_value,
         {money('MIN(total)')} AS min_order_value, {money('MAX(total)')} AS max_order_value,
         {big('SUM(quantity)')} AS total_quantity,
         MIN(purchase_date) AS first_purchase_date, MAX(purchase_date) AS last_purchase_date,
         MIN(name) AS name, MIN(email) AS email, MIN(country) AS country,
         MIN(subscription_date) AS subscription_date
  FROM fact GROUP BY id_client),
recency AS (
  SELECT *, {money('spent')} AS total_spent,
         {big(f"date_diff('day', first_purchase_date, {AS_OF})")} AS customer_lifetime_days,
         {big(f"date_diff('day', last_purchase_date, {AS_OF})")} AS days_since_last_purchase,
         {r2(f"total_purchases / GREATEST(date_diff('day', first_purchase_date, {AS_OF}) / 30.0::DOUBLE, 1.0::DOUBLE)")}
           AS purchase_frequency_per_month
  FROM totals),
kpis AS (
  SELECT *, days_since_last_purchase <= 90 AS is_active,
         total_spent > (SELECT quantile_cont(total_spent, 0.5) FROM recency) AS is_high_value
  FROM recency),
product_totals AS (
  SELECT product, {big('SUM(quantity)')} AS total_quantity_sold,
         {money('SUM(total)')} AS total_revenue, {ratio('SUM(price)', 'COUNT(price)')} AS avg_price,
         {money('MIN(price)')} AS min_price, {money('MAX(price)')} AS max_price,
         COUNT(id_purchase) AS total_orders, COUNT(DISTINCT id_client) AS unique_customers,
         {ratio('SUM(quantity)', 'COUNT(id_purchase)')} AS avg_quantity_per_order
  FROM fact GROUP BY product),
product_countries AS (
  SELECT product, string_agg(country, ', ' ORDER BY rn) AS top_countries
  FROM (SELECT product, country,
               row_number() OVER (PARTITION BY product ORDER BY SUM(total) DESC, country) AS rn
        FROM fact WHERE country IS NOT NULL GROUP BY product, country)
  WHERE rn <= 3 GROUP BY product),
products AS (
  SELECT t.*, top_countries FROM product_totals t LEFT JOIN product_countries USING (product)),
country_totals AS (
  SELECT country, {money('SUM(total)')} AS total_revenue,
         COUNT(DISTINCT id_client) AS unique_customers, COUNT(id_purchase) AS total_orders,
         {big('SUM(quantity)')} AS total_quantity,
         {ratio('SUM(total)', 'COUNT(id_purchase)')} AS avg_order_value,
         {ratio('SUM(total)', 'COUNT(DISTINCT id_client)')} AS avg_revenue_per_customer
  FROM fact GROUP BY country),
countries AS (
  SELECT *, {r2('total_revenue / (SELECT CAST(SUM(total) AS DOUBLE) FROM fact) * 100')}
              AS market_share_pct
  FROM country_totals),
daily_totals AS (
  SELECT purchase_date AS date, {_SERIES} FROM purchases GROUP BY purchase_date),
daily_rolling AS (
  SELECT *,
         {ratio('SUM(CAST(total_revenue AS DECIMAL(18,2))) OVER last7', 'COUNT(*) OVER last7')}
           AS revenue_7day_avg,
         {ratio('SUM(total_orders) OVER last7', 'COUNT(*) OVER last7')} AS orders_7day_avg
  FROM daily_totals
  WINDOW last7 AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
daily AS (
  SELECT *, {pct('total_revenue', 'lag(total_revenue) OVER (ORDER BY date)')} AS revenue_growth_pct
  FROM daily_rolling),
weekly_totals AS (
  SELECT w AS week_start, {ISO_WEEK.format(m='w')} AS year_week, total_revenue, total_orders,
         unique_customers, total_quantity, {ratio('total_revenue', 'total_orders')} AS avg_order_value
  FROM (SELECT {_week_start('purchase_date')} AS w, {_SERIES} FROM purchases GROUP BY 1)),
weekly AS (
  SELECT *, {pct('total_revenue', 'lag(total_revenue) OVER (ORDER BY week_start)')}
              AS revenue_growth_pct
  FROM weekly_totals),
monthly_totals AS (
  SELECT m AS month_start, strftime(m, '%Y-%m') AS year_month, total_revenue, total_orders,
         unique_customers, total_quantity,
         {ratio('total_revenue', 'total_orders')} AS avg_order_value,
         {ratio('total_revenue', 'unique_customers')} AS avg_revenue_per_customer
  FROM (SELECT CAST(date_trunc('month', purchase_date) AS DATE) AS m, {_SERIES}
        FROM purchases GROUP BY 1)),
monthly AS (
  SELECT *,
         {pct('total_revenue', 'lag(total_revenue) OVER w')} AS revenue_growth_pct,
         {pct('total_orders', 'lag(total_orders) OVER w')} AS orders_growth_pct,
         {pct('unique_customers', 'lag(unique_customers) OVER w')} AS customers_growth_pct
  FROM monthly_totals WINDOW w AS (ORDER BY month_start))"""

CLEAN = f"WITH {CLEAN_INPUT}, {MART}\n"
DIRTY = f"WITH {DIRTY_INPUT}, {CLEANING}\n"
CLEANED_MART = f"WITH {DIRTY_INPUT}, {CLEANING}, {CLEANED_INPUT}, {MART}\n"

# --- column lists at the checked edge: dates as text, money as double -------

PURCHASE = ("id_purchase, id_client, product, CAST(price AS DOUBLE) AS price, "
            "CAST(quantity AS BIGINT) AS quantity, CAST(purchase_date AS VARCHAR) AS purchase_date, "
            "CAST(total AS DOUBLE) AS total")
CLIENT = ("id_client, name, email, CAST(subscription_date AS VARCHAR) AS subscription_date, country")
JOINED = (f"{PURCHASE}, name, email, country, "
          "CAST(subscription_date AS VARCHAR) AS subscription_date")
CALENDAR = ("purchase_year, purchase_month, purchase_quarter, purchase_week, "
            "purchase_day_of_week, purchase_day_name")
FACT = f"{JOINED}, {CALENDAR}, year_month, year_week, customer_tenure_days"
TOTALS = ("id_client, total_purchases, CAST(spent AS DOUBLE) AS total_spent, avg_order_value, "
          "min_order_value, max_order_value, total_quantity, "
          "CAST(first_purchase_date AS VARCHAR) AS first_purchase_date, "
          "CAST(last_purchase_date AS VARCHAR) AS last_purchase_date, name, email, country, "
          "CAST(subscription_date AS VARCHAR) AS subscription_date")
KPIS = (f"{TOTALS}, customer_lifetime_days, purchase_frequency_per_month, "
        "days_since_last_purchase, is_active, is_high_value")
TOP_CLIENT = ("name, country, total_spent, total_purchases, "
              "CAST(last_purchase_date AS VARCHAR) AS last_purchase_date")
SERIES = "total_revenue, total_orders, unique_customers, total_quantity"
DAILY = (f"CAST(date AS VARCHAR) AS date, {SERIES}, revenue_7day_avg, orders_7day_avg, "
         "revenue_growth_pct")
WEEKLY_TOTALS = f"CAST(week_start AS VARCHAR) AS week_start, year_week, {SERIES}, avg_order_value"
MONTHLY_TOTALS = (f"CAST(month_start AS VARCHAR) AS month_start, year_month, {SERIES}, "
                  "avg_order_value, avg_revenue_per_customer")
MONTHLY = f"{MONTHLY_TOTALS}, revenue_growth_pct, orders_growth_pct, customers_growth_pct"


def long(section: str, source: str, metrics: dict[str, str], kind: str = "DOUBLE") -> str:
    """``(section, metric, value)`` rows of one aggregation."""
    rows = " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{m}' AS metric, CAST({e} AS {kind}) AS value FROM {source}"
        for m, e in metrics.items())
    return rows


def quantile(column: str, p: float) -> str:
    return r2(f"quantile_cont(CAST({column} AS DOUBLE), {p})")


def moments(column: str) -> dict[str, str]:
    return {"mean": ratio(f"SUM({column})", f"COUNT({column})"),
            "std": r2(f"stddev_samp(CAST({column} AS DOUBLE))"),
            "min": f"MIN({column})", "max": f"MAX({column})"}


ORDER_VALUE = long("order_value_distribution", "purchases", {
    **moments("total"), "median": quantile("total", 0.5), "q25": quantile("total", 0.25),
    "q75": quantile("total", 0.75), "q90": quantile("total", 0.9), "q95": quantile("total", 0.95)})
MODE = ("SELECT 'quantity_distribution' AS section, 'mode' AS metric, "
        "CAST(quantity AS DOUBLE) AS value FROM (SELECT quantity, COUNT(*) AS n FROM purchases "
        "GROUP BY quantity ORDER BY n DESC, quantity LIMIT 1)")
QUANTITY = long("quantity_distribution", "purchases", {
    "mean": ratio("SUM(quantity)", "COUNT(quantity)"), "min": "MIN(quantity)",
    "max": "MAX(quantity)", "median": quantile("quantity", 0.5)}) + f" UNION ALL {MODE}"
PRICE = long("price_distribution", "purchases", {
    **moments("price"), "median": quantile("price", 0.5)})
OVERALL = long("overall_metrics", "fact", {
    "total_revenue": "SUM(total)", "total_orders": "COUNT(id_purchase)",
    "total_customers": "COUNT(DISTINCT id_client)", "total_products": "COUNT(DISTINCT product)",
    "total_countries": "COUNT(DISTINCT country)",
    "avg_order_value": ratio("SUM(total)", "COUNT(id_purchase)"),
    "avg_items_per_order": ratio("SUM(quantity)", "COUNT(id_purchase)")})
STATISTICS = " UNION ALL ".join([ORDER_VALUE, QUANTITY, PRICE, OVERALL])

BEST = {
    "top_product_by_revenue":
        "(SELECT product FROM products ORDER BY total_revenue DESC, product LIMIT 1)",
    "top_country_by_revenue":
        "(SELECT country FROM countries ORDER BY total_revenue DESC, country LIMIT 1)",
    "top_client_by_spending":
        "(SELECT name FROM kpis ORDER BY total_spent DESC, id_client LIMIT 1)"}
SUMMARY = " UNION ALL ".join([
    long("fact_table", "fact", {"total_rows": "COUNT(*)", "date_min": "MIN(purchase_date)",
                                "date_max": "MAX(purchase_date)"}, "VARCHAR"),
    long("kpis", "kpis", {"total_clients": "COUNT(*)",
                          "active_clients": "COUNT(*) FILTER (is_active)",
                          "high_value_clients": "COUNT(*) FILTER (is_high_value)"}, "VARCHAR"),
    long("kpis", "products", {"total_products": "COUNT(*)"}, "VARCHAR"),
    long("kpis", "countries", {"total_countries": "COUNT(*)"}, "VARCHAR"),
    long("temporal_aggregations", "daily", {"daily_records": "COUNT(*)"}, "VARCHAR"),
    long("temporal_aggregations", "weekly", {"weekly_records": "COUNT(*)"}, "VARCHAR"),
    long("temporal_aggregations", "monthly", {"monthly_records": "COUNT(*)"}, "VARCHAR"),
    long("top_performers", "(SELECT 1)", BEST, "VARCHAR")])

# --- quality ---------------------------------------------------------------


def dropped(reason: str, table: str) -> str:
    return f"(SELECT COUNT(*) FROM {table} WHERE reason = '{reason}')"


CLIENT_QUALITY = {
    "initial_rows": "(SELECT COUNT(*) FROM raw_clients)",
    "null_values": dropped("null_values", "tagged_clients"),
    "invalid_dates": dropped("invalid_dates", "tagged_clients"),
    "future_dates_fixed": "(SELECT COUNT(*) FROM tagged_clients WHERE d > " + AS_OF
                          + " AND (reason IS NULL OR reason <> 'null_values'))",
    "invalid_emails": dropped("invalid_emails", "tagged_clients"),
    "invalid_numbers": dropped("invalid_numbers", "tagged_clients"),
    "duplicates_removed": "(SELECT COUNT(*) FROM client_ids WHERE rn > 1)"
                          " + (SELECT COUNT(*) FROM client_emails WHERE en > 1)",
    "final_rows": "(SELECT COUNT(*) FROM clean_clients)"}
PURCHASE_QUALITY = {
    "initial_rows": "(SELECT COUNT(*) FROM raw_purchases)",
    "null_values": dropped("null_values", "tagged_purchases"),
    "invalid_dates": dropped("invalid_dates", "tagged_purchases"),
    "future_dates_fixed": "(SELECT COUNT(*) FROM tagged_purchases WHERE d > " + AS_OF
                          + " AND (reason IS NULL OR reason <> 'null_values'))",
    "invalid_numbers": dropped("invalid_numbers", "tagged_purchases"),
    "negative_values": dropped("negative_values", "tagged_purchases"),
    "total_recalculated": "(SELECT COUNT(*) FROM tagged_purchases"
                          " WHERE reason IS NULL AND stored <> total)",
    "orphan_purchases": "(SELECT COUNT(*) FROM tagged_purchases WHERE reason IS NULL"
                        " AND id_client NOT IN (SELECT id_client FROM clean_clients))",
    "duplicates_removed": "(SELECT COUNT(*) FROM owned_purchases)"
                          " - (SELECT COUNT(*) FROM clean_purchases)",
    "final_rows": "(SELECT COUNT(*) FROM clean_purchases)"}
ROWS_IN = "((SELECT COUNT(*) FROM raw_clients) + (SELECT COUNT(*) FROM raw_purchases))"
ROWS_OUT = "((SELECT COUNT(*) FROM clean_clients) + (SELECT COUNT(*) FROM clean_purchases))"
QUALITY_SUMMARY = {"total_input_rows": ROWS_IN, "total_output_rows": ROWS_OUT,
                   "data_quality_score": ratio(f"{ROWS_OUT} * 100", ROWS_IN)}


def waterfall(metrics: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({e} AS BIGINT) AS value" for m, e in metrics.items())


QUALITY_REPORT = " UNION ALL ".join([
    long("clients", "(SELECT 1)", CLIENT_QUALITY),
    long("purchases", "(SELECT 1)", PURCHASE_QUALITY),
    long("summary", "(SELECT 1)", QUALITY_SUMMARY)])

# The purchases after the steps that come before the one being checked.
NO_NULLS = ("FROM raw_purchases WHERE id_purchase IS NOT NULL AND id_client IS NOT NULL "
            "AND product IS NOT NULL AND price IS NOT NULL AND quantity IS NOT NULL "
            "AND purchase_date IS NOT NULL AND total IS NOT NULL")
RAW_PURCHASE = "id_purchase, id_client, product, price, quantity, purchase_date, total"
OWNED = f"id_purchase, {whole('id_client')} AS id_client, product, price, quantity, purchase_date, total"
RAW_CLIENT = "id_client, name, email, subscription_date, country"
NUMBERS = (f"{whole('id_purchase')} AS id_purchase, {whole('id_client')} AS id_client, "
           "product, CAST(TRY_CAST(price AS DECIMAL(18,6)) AS DOUBLE) AS price, "
           "CAST(quantity AS BIGINT) AS quantity, purchase_date, "
           "CAST(TRY_CAST(total AS DECIMAL(18,2)) AS DOUBLE) AS total")
COUNTED = ", ".join(f"COUNT(*) - COUNT({c}) AS {c}" for c in RAW_PURCHASE.split(", "))
COUNTED_CLIENTS = ", ".join(f"COUNT(*) - COUNT({c}) AS {c}" for c in RAW_CLIENT.split(", "))


def record(table: str, key: str, columns: str) -> str:
    parts = " || '|' || ".join(f"COALESCE({c}, '<null>')" for c in columns.split(", "))
    return f"SELECT '{table}' AS table_name, {key} AS key, {parts} AS record FROM raw_{table}"


# --- prediction ------------------------------------------------------------

# All clients with the cleaned purchases: clients that cleaning rejects have none.
FEATURES = f"""
bought AS (
  SELECT id_client, COUNT(id_purchase) AS total_purchases, SUM(total) AS spent,
         CAST(SUM(total) AS DOUBLE) / COUNT(id_purchase) AS avg_order_value,
         {money('MIN(total)')} AS min_order_value, {money('MAX(total)')} AS max_order_value,
         {big('SUM(quantity)')} AS total_quantity,
         MIN(purchase_date) AS first_purchase_date, MAX(purchase_date) AS last_purchase_date
  FROM clean_purchases GROUP BY id_client),
joined AS (
  SELECT c.*, b.* EXCLUDE (id_client) FROM clients c LEFT JOIN bought b ON c.id_client = b.id_client),
features AS (
  SELECT id_client, name, email, CAST(subscription_date AS VARCHAR) AS subscription_date, country,
         COALESCE(total_purchases, 0) AS total_purchases,
         COALESCE({money('spent')}, 0) AS total_spent,
         COALESCE({r2('avg_order_value')}, 0) AS avg_order_value,
         min_order_value, max_order_value,
         COALESCE(total_quantity, 0) AS total_quantity,
         CAST(first_purchase_date AS VARCHAR) AS first_purchase_date,
         CAST(last_purchase_date AS VARCHAR) AS last_purchase_date,
         {big(f"date_diff('day', subscription_date, {AS_OF})")} AS customer_lifetime_days,
         COALESCE({big(f"date_diff('day', last_purchase_date, {AS_OF})")}, 999)
           AS days_since_last_purchase,
         {r2(f"COALESCE(total_purchases, 0) / GREATEST(date_diff('day', subscription_date, {AS_OF}) / 30.0::DOUBLE, 1.0::DOUBLE)")}
           AS purchase_frequency_per_month
  FROM joined)"""

SCORES = """
scores AS (
  SELECT id_client, CAST(id_client % 101 AS DOUBLE) / 100 AS churn_probability,
         total_spent AS predicted_clv FROM kpis),
banded AS (
  SELECT *, CASE WHEN churn_probability > 0 AND churn_probability <= 0.3::DOUBLE THEN 'Low'
                 WHEN churn_probability > 0.3::DOUBLE AND churn_probability <= 0.7::DOUBLE THEN 'Medium'
                 WHEN churn_probability > 0.7::DOUBLE AND churn_probability <= 1 THEN 'High'
                 END AS churn_risk
  FROM scores),
segmented AS (
  SELECT *, CASE
      WHEN churn_probability > 0.7::DOUBLE AND predicted_clv > t THEN 'High Value at Risk'
      WHEN churn_probability < 0.3::DOUBLE AND predicted_clv > t THEN 'Champions'
      WHEN churn_probability > 0.7::DOUBLE AND predicted_clv <= t THEN 'At Risk'
      WHEN churn_probability < 0.3::DOUBLE AND predicted_clv <= t THEN 'Loyal'
      ELSE 'Standard' END AS segment
  FROM banded, (SELECT quantile_cont(predicted_clv, 0.5) AS t FROM banded))"""
CLEAN_FEATURES = f"WITH {CLEAN_CLIENTS}, {DIRTY_INPUT}, {CLEANING}, {FEATURES}\n"
CLEAN_SCORES = f"WITH {CLEAN_INPUT}, {MART}, {SCORES}\n"


def _segment(name: str) -> str:
    return f"COUNT(*) FILTER (segment = '{name}')"


INSIGHTS = {
    "total_customers": "COUNT(*)", "high_value_at_risk": _segment("High Value at Risk"),
    "champions": _segment("Champions"), "at_risk": _segment("At Risk"),
    "loyal": _segment("Loyal"), "standard": _segment("Standard"),
    "avg_churn_probability": "CAST(AVG(churn_probability) AS DECIMAL(38,6))",
    "total_predicted_clv": r2("SUM(predicted_clv)")}


def oracle_sql() -> dict[str, str]:
    return {
        # layers and files
        "scan_csv": DIRTY + f"SELECT {RAW_PURCHASE} FROM raw_purchases",
        "scan_parquet": CLEAN + f"SELECT {CLIENT} FROM clients",
        "scan_json_report": CLEAN + STATISTICS,
        "bronze_ingest": DIRTY + record("clients", "id_client", RAW_CLIENT) + " UNION ALL "
                         + record("purchases", "id_purchase", RAW_PURCHASE),
        "ingest_if_absent": DIRTY + "SELECT 'clients' AS table_name, COUNT(*) AS rows FROM raw_clients"
                            " UNION ALL SELECT 'purchases', COUNT(*) FROM raw_purchases",
        "write_csv": CLEAN + f"SELECT {CLIENT} FROM clients",
        "write_parquet": CLEAN + f"SELECT {FACT} FROM fact",
        "write_json_report": DIRTY + QUALITY_REPORT,
        "refresh_serving": CLEAN + " UNION ALL ".join(
            f"SELECT '{t}' AS \"table\", 'loaded' AS status, COUNT(*) AS rows FROM {s}" for t, s in [
                ("fact_sales", "fact"), ("client_kpis", "kpis"), ("product_analytics", "products"),
                ("country_analytics", "countries"), ("daily_sales", "daily"),
                ("weekly_sales", "weekly"), ("monthly_sales", "monthly")])
            + " UNION ALL SELECT 'no_such_table', 'failed', NULL",
        "nan_to_null": "SELECT event_id, CASE WHEN event_id % 4 IN (0, 1, 2) THEN NULL ELSE value END"
                       " AS value FROM events",
        "run_pipeline": CLEANED_MART + SUMMARY,
        # silver
        "profile_nulls": DIRTY + f"""SELECT * FROM (
            SELECT 'clients' AS table_name, "column", null_count FROM
              (UNPIVOT (SELECT {COUNTED_CLIENTS} FROM raw_clients)
               ON COLUMNS(*) INTO NAME "column" VALUE null_count)
            UNION ALL
            SELECT 'purchases', "column", null_count FROM
              (UNPIVOT (SELECT {COUNTED} FROM raw_purchases)
               ON COLUMNS(*) INTO NAME "column" VALUE null_count)) WHERE null_count > 0""",
        "drop_null_rows": DIRTY + f"SELECT {RAW_PURCHASE} {NO_NULLS}",
        "parse_dates": DIRTY + f"SELECT id_purchase, CAST({day('purchase_date')} AS VARCHAR)"
                       f" AS purchase_date FROM raw_purchases WHERE {day('purchase_date')} IS NOT NULL",
        "cap_future_dates": DIRTY + f"SELECT id_purchase, CAST(LEAST({day('purchase_date')},"
                            f" {AS_OF}) AS VARCHAR) AS purchase_date FROM raw_purchases"
                            f" WHERE {day('purchase_date')} IS NOT NULL",
        "format_dates": CLEAN + "SELECT id_client, strftime(subscription_date, '%Y-%m-%d')"
                        " AS subscription_date FROM clients",
        "validate_email": DIRTY + f"SELECT {RAW_CLIENT} FROM raw_clients"
                          f" WHERE regexp_matches(email, {EMAIL})",
        "dedup_by_key": DIRTY + f"""SELECT {PURCHASE} FROM (
            SELECT *, row_number() OVER (PARTITION BY id_purchase ORDER BY purchase_date, id_client,
                product, price, quantity, total) AS rn
            FROM (SELECT id_purchase, id_client, product, exact AS price, quantity, d AS purchase_date, total
                  FROM tagged_purchases WHERE reason IS NULL)) WHERE rn = 1""",
        "dedup_by_email": DIRTY + f"SELECT {CLIENT} FROM client_emails WHERE en = 1",
        "normalize_strings": DIRTY + "SELECT id_client, trim(name) AS name, lower(trim(email)) AS email,"
                             " subscription_date, trim(country) AS country FROM raw_clients",
        "coerce_numeric": DIRTY + f"SELECT {NUMBERS} FROM raw_purchases",
        "reject_negative": DIRTY + f"SELECT {NUMBERS} FROM raw_purchases"
                           " WHERE CAST(price AS DECIMAL(18,6)) >= 0 AND CAST(quantity AS BIGINT) >= 0",
        "recalc_total": DIRTY + """SELECT id_purchase, price, quantity, total, total_recalculated FROM (
            SELECT id_purchase, CAST(exact AS DOUBLE) AS price, quantity,
                   CAST(CAST(exact * CAST(quantity AS DECIMAL(19,0)) AS DECIMAL(18,2)) AS DOUBLE) AS total,
                   stored <> CAST(exact * CAST(quantity AS DECIMAL(19,0)) AS DECIMAL(18,2)) AS total_recalculated
            FROM typed_purchases)""",
        "orphan_semi_join": DIRTY + f"""SELECT {OWNED} FROM raw_purchases WHERE
            {whole('id_client')} IN (SELECT id_client FROM clean_clients)""",
        "orphan_rejects": DIRTY + f"""SELECT {OWNED} FROM raw_purchases WHERE
            {whole('id_client')} NOT IN (SELECT id_client FROM clean_clients)""",
        "clean_clients": DIRTY + f"SELECT {CLIENT} FROM clean_clients",
        "clean_purchases": DIRTY + f"SELECT {PURCHASE} FROM clean_purchases",
        "quality_clients": DIRTY + waterfall(CLIENT_QUALITY),
        "quality_purchases": DIRTY + waterfall(PURCHASE_QUALITY),
        "quality_report": DIRTY + QUALITY_REPORT,
        # fact
        "fact_join": CLEAN + f"SELECT {JOINED} FROM fact",
        "calendar_attributes": CLEAN + f"SELECT {PURCHASE}, {CALENDAR} FROM fact",
        "period_keys": CLEAN + f"SELECT {PURCHASE}, year_month, year_week FROM fact",
        "customer_tenure": CLEAN + f"SELECT {JOINED}, customer_tenure_days FROM fact",
        "fact_sales": CLEAN + f"SELECT {FACT} FROM fact",
        # clients
        "client_totals": CLEAN + f"SELECT {TOTALS} FROM totals",
        "client_recency_frequency": CLEAN + f"""SELECT {TOTALS}, customer_lifetime_days,
            purchase_frequency_per_month, days_since_last_purchase FROM recency""",
        "client_activity_flag": CLEAN + "SELECT id_client, days_since_last_purchase, is_active FROM kpis",
        "client_high_value_flag": CLEAN + "SELECT id_client, total_spent, is_high_value FROM kpis",
        "client_kpis": CLEAN + f"SELECT {KPIS} FROM kpis",
        # products and countries
        "product_totals": CLEAN + "SELECT * FROM product_totals",
        "product_top_countries": CLEAN + "SELECT * FROM product_countries",
        "product_top_countries_join": CLEAN + "SELECT product, total_revenue, top_countries FROM products",
        "product_analytics": CLEAN + "SELECT * FROM products",
        "country_totals": CLEAN + "SELECT * FROM country_totals",
        "market_share": CLEAN + "SELECT country, total_revenue, market_share_pct FROM countries",
        "country_analytics": CLEAN + "SELECT * FROM countries",
        # series
        "daily_totals": CLEAN + f"SELECT CAST(date AS VARCHAR) AS date, {SERIES} FROM daily_totals",
        "weekly_totals": CLEAN + f"SELECT {WEEKLY_TOTALS} FROM weekly_totals",
        "monthly_totals": CLEAN + f"SELECT {MONTHLY_TOTALS} FROM monthly_totals",
        "rolling_7day": CLEAN + "SELECT CAST(date AS VARCHAR) AS date, revenue_7day_avg,"
                        " orders_7day_avg FROM daily_rolling",
        "daily_growth": CLEAN + "SELECT CAST(date AS VARCHAR) AS date, revenue_growth_pct FROM daily",
        "weekly_growth": CLEAN + "SELECT year_week, revenue_growth_pct FROM weekly",
        "monthly_growth": CLEAN + "SELECT year_month, revenue_growth_pct, orders_growth_pct,"
                          " customers_growth_pct FROM monthly",
        "top_k_per_group": CLEAN + """SELECT country, id_client, total_spent, rank FROM (
            SELECT country, id_client, total_spent, CAST(row_number() OVER (
                PARTITION BY country ORDER BY total_spent DESC, id_client) AS BIGINT) AS rank
            FROM kpis) WHERE rank <= 3""",
        "daily_sales": CLEAN + f"SELECT {DAILY} FROM daily",
        "weekly_sales": CLEAN + f"SELECT {WEEKLY_TOTALS}, revenue_growth_pct FROM weekly",
        "monthly_sales": CLEAN + f"SELECT {MONTHLY} FROM monthly",
        # statistics and summary
        "order_value_distribution": CLEAN + ORDER_VALUE,
        "quantity_distribution": CLEAN + QUANTITY,
        "price_distribution": CLEAN + PRICE,
        "overall_metrics": CLEAN + OVERALL,
        "statistical_distributions": CLEAN + STATISTICS,
        "gold_summary": CLEAN + SUMMARY,
        "gold_flow": CLEAN + SUMMARY,
        # top lists and serving
        "top_products": CLEAN + "SELECT * FROM products ORDER BY total_revenue DESC, product LIMIT 10",
        "countries_by_revenue": CLEAN + "SELECT * FROM countries ORDER BY total_revenue DESC, country",
        "top_clients": CLEAN + f"SELECT {TOP_CLIENT} FROM (SELECT * FROM kpis"
                       " ORDER BY total_spent DESC, id_client LIMIT 10)",
        "recent_days": CLEAN + f"SELECT {DAILY} FROM (SELECT * FROM daily ORDER BY date DESC LIMIT 30)",
        "top_performers": CLEAN + "SELECT " + ", ".join(f"{e} AS {m}" for m, e in BEST.items()),
        "global_kpis": CLEAN + f"""SELECT {money('SUM(CAST(total_revenue AS DECIMAL(18,2)))')}
              AS total_revenue,
            {big('SUM(total_orders)')} AS total_orders, {big('SUM(total_quantity)')} AS total_quantity,
            (SELECT COUNT(*) FROM kpis) AS total_customers,
            {ratio('SUM(CAST(total_revenue AS DECIMAL(18,2)))', 'SUM(total_orders)')} AS avg_order_value
            FROM daily""",
        "temporal_sales": CLEAN + f"""
            SELECT 'daily' AS period, CAST(date AS VARCHAR) AS key, {SERIES}, revenue_growth_pct FROM daily
            UNION ALL SELECT 'weekly', year_week, {SERIES}, revenue_growth_pct FROM weekly
            UNION ALL SELECT 'monthly', year_month, {SERIES}, revenue_growth_pct FROM monthly""",
        "client_distribution": CLEAN + """SELECT COUNT(*) AS total,
            COUNT(*) FILTER (is_active) AS active, COUNT(*) FILTER (NOT is_active) AS inactive,
            COUNT(*) FILTER (is_high_value) AS high_value,
            COUNT(*) FILTER (NOT is_high_value) AS standard_value FROM kpis""",
        "client_overview": CLEAN + f"""SELECT COUNT(*) AS total_clients,
            COUNT(*) FILTER (is_active) AS active_clients,
            {ratio('SUM(spent)', 'COUNT(spent)')} AS avg_lifetime_value,
            {ratio('SUM(CAST(purchase_frequency_per_month AS DECIMAL(18,2)))',
                   'COUNT(purchase_frequency_per_month)')} AS avg_frequency FROM kpis""",
        "serving_lookup": CLEAN + f"SELECT {FACT} FROM fact WHERE id_client = 55",
        # prediction
        "features_join": CLEAN_FEATURES + """SELECT id_client, name, country, total_purchases IS NULL
            AS never_bought, COALESCE(total_quantity, 0) AS total_quantity,
            min_order_value, max_order_value FROM joined""",
        "client_features": CLEAN_FEATURES + """SELECT *,
            CAST(days_since_last_purchase > 90 AS BIGINT) AS is_churned FROM features""",
        "churn_label": CLEAN_FEATURES + """SELECT id_client, days_since_last_purchase,
            CAST(days_since_last_purchase > 90 AS BIGINT) AS is_churned FROM features""",
        "churn_risk_band": CLEAN_SCORES + "SELECT id_client, churn_probability, churn_risk FROM banded",
        "client_segments": CLEAN_SCORES + "SELECT id_client, churn_probability, predicted_clv, segment"
                           " FROM segmented",
        "segment_insights": CLEAN_SCORES + " UNION ALL ".join(
            f"SELECT '{m}' AS metric, CAST({e} AS DOUBLE) AS value FROM segmented"
            for m, e in INSIGHTS.items()),
    }
