"""SQL statements of the customer and basket analyses."""

from storeloom.checks.oracle import AS_OF, CLEAN_INPUT, big, money, r2, ratio

WITH = f"WITH {CLEAN_INPUT},\n"


def share(a: str, b: str) -> str:
    return f"CAST(ROUND(CAST(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0) AS DECIMAL(38,10)), 6) AS DOUBLE)"


CROSS_SELL = WITH + f"""
items AS (SELECT DISTINCT id_client, purchase_date, product FROM purchases),
total AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT id_client, purchase_date FROM items)),
singles AS (SELECT product, COUNT(*) AS n FROM items GROUP BY product),
pairs AS (
  SELECT a.product, b.product AS also_bought, COUNT(*) AS n
  FROM items a JOIN items b USING (id_client, purchase_date) WHERE a.product <> b.product GROUP BY ALL)
SELECT p.product, p.also_bought, p.n AS baskets, {share('p.n', 't.n')} AS support, {share('p.n', 's.n')} AS confidence,
       {share('CAST(p.n AS DOUBLE) * t.n', 'CAST(s.n AS DOUBLE) * o.n')} AS lift
FROM pairs p JOIN singles s ON s.product = p.product JOIN singles o ON o.product = p.also_bought, total t
WHERE p.n >= t.n * CAST(0.02 AS DOUBLE)"""

SPELLS = f"""
days AS (SELECT id_client, purchase_date AS d, COUNT(*) AS orders FROM purchases GROUP BY ALL),
marked AS (
  SELECT *, d - lag(d) OVER (PARTITION BY id_client ORDER BY d) <= 90 AS goes_on FROM days),
numbered AS (
  SELECT *, COUNT(*) FILTER (goes_on IS NOT TRUE) OVER (PARTITION BY id_client ORDER BY d) AS spell FROM marked),
spells AS (
  SELECT id_client, spell, MIN(d) AS start, MAX(d) AS stop, {big('SUM(orders)')} AS orders,
         {AS_OF} - MAX(d) > 90 AS ended
  FROM numbered GROUP BY id_client, spell)"""

RETENTION = WITH + SPELLS + f""",
aged AS (SELECT (stop - start) // 30 AS age, ended FROM spells),
ages AS (SELECT unnest(range(0, (SELECT MAX(age) + 1 FROM aged))) AS age),
counted AS (
  SELECT a.age, (SELECT COUNT(*) FROM aged x WHERE x.age >= a.age) AS at_risk,
         (SELECT COUNT(*) FROM aged x WHERE x.age = a.age AND x.ended) AS ended,
         (SELECT COUNT(*) FROM aged x WHERE x.age = a.age AND NOT x.ended) AS censored
  FROM ages a)
SELECT {big('age')} AS age, at_risk, ended, censored, {share('ended', 'at_risk')} AS hazard,
       CAST(ROUND(CAST((SELECT product(1 - y.ended / y.at_risk) FROM counted y WHERE y.age <= c.age) AS DECIMAL(38,10)), 6)
            AS DOUBLE) AS survival
FROM counted c"""

COHORTS = WITH + f"""
months AS (
  SELECT id_client, date_trunc('month', purchase_date) AS month, COUNT(*) AS orders, SUM(total) AS revenue
  FROM purchases GROUP BY ALL),
firsts AS (SELECT id_client, MIN(month) AS cohort FROM months GROUP BY id_client),
cells AS (
  SELECT f.cohort, datediff('month', f.cohort, m.month) AS age, COUNT(DISTINCT id_client) AS active,
         {big('SUM(m.orders)')} AS orders, SUM(m.revenue) AS revenue
  FROM months m JOIN firsts f USING (id_client) GROUP BY ALL),
sizes AS (SELECT cohort, COUNT(*) AS clients FROM firsts GROUP BY cohort),
grid AS (SELECT cohort, clients, unnest(range(0, datediff('month', cohort, {AS_OF}) + 1)) AS age FROM sizes)
SELECT strftime(g.cohort, '%Y-%m') AS cohort, g.age, g.clients, COALESCE(c.active, 0) AS active,
       {ratio('COALESCE(c.active, 0) * 100', 'g.clients')} AS retention_pct, COALESCE(c.orders, 0) AS orders,
       {money('COALESCE(c.revenue, 0)')} AS revenue
FROM grid g LEFT JOIN cells c USING (cohort, age)"""

RFM = WITH + f"""
totals AS (
  SELECT id_client, {AS_OF} - MAX(purchase_date) AS days_since_last_purchase, COUNT(*) AS total_purchases,
         SUM(total) AS spent
  FROM purchases GROUP BY id_client),
scored AS (
  SELECT *, ntile(5) OVER (ORDER BY days_since_last_purchase DESC, id_client) AS r_score,
         ntile(5) OVER (ORDER BY total_purchases, id_client) AS f_score,
         ntile(5) OVER (ORDER BY spent, id_client) AS m_score FROM totals)
SELECT id_client, days_since_last_purchase, total_purchases, {money('spent')} AS total_spent, r_score, f_score, m_score,
       r_score || '' || f_score || m_score AS rfm, r_score + f_score + m_score AS rfm_total
FROM scored"""

BOX_PLOTS = WITH + f"""
quartiles AS (
  SELECT product, quantile_cont(CAST(total AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(total AS DOUBLE), 0.5) AS q2,
         quantile_cont(CAST(total AS DOUBLE), 0.75) AS q3 FROM purchases GROUP BY product),
fenced AS (
  SELECT p.product, CAST(p.total AS DOUBLE) AS x, q1, q2, q3, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
  FROM purchases p JOIN quartiles USING (product))
SELECT product, COUNT(*) AS n, {r2('MIN(q1)')} AS q1, {r2('MIN(q2)')} AS median, {r2('MIN(q3)')} AS q3,
       MIN(x) FILTER (x BETWEEN low AND high) AS whisker_low, MAX(x) FILTER (x BETWEEN low AND high) AS whisker_high,
       COUNT(*) FILTER (x < low) AS outliers_low, COUNT(*) FILTER (x > high) AS outliers_high
FROM fenced GROUP BY product"""

ANOMALIES = WITH + f"""
daily AS (
  SELECT country, purchase_date AS date, isodow(purchase_date) - 1 AS weekday, CAST(SUM(total) * 100 AS BIGINT) AS cents
  FROM purchases JOIN clients USING (id_client) GROUP BY ALL),
middles AS (SELECT country, weekday, quantile_cont(CAST(cents AS DOUBLE), 0.5) AS middle FROM daily GROUP BY ALL),
centred AS (SELECT *, abs(cents - middle) AS far FROM daily JOIN middles USING (country, weekday)),
spreads AS (SELECT country, weekday, quantile_cont(far, 0.5) AS spread FROM centred GROUP BY ALL),
judged AS (SELECT *, 0.6745::DOUBLE * (cents - middle) / NULLIF(spread, 0) AS score FROM centred JOIN spreads USING (country, weekday))
SELECT country, CAST(date AS VARCHAR) AS date, weekday, CAST(cents / 100 AS DOUBLE) AS revenue, {r2('middle / 100')} AS expected,
       {r2('score')} AS score
FROM judged WHERE CASE WHEN spread = 0 THEN far > 0 ELSE abs(score) > 3.5 END"""

FORECAST = f"WITH RECURSIVE {CLEAN_INPUT}," + f"""
daily AS (
  SELECT country, purchase_date AS date, CAST(SUM(total) AS DOUBLE) AS x
  FROM purchases JOIN clients USING (id_client) GROUP BY ALL),
days AS (
  SELECT country, CAST(unnest(generate_series(MIN(date), {AS_OF}, INTERVAL 1 DAY)) AS DATE) AS date
  FROM daily GROUP BY country),
series AS (
  SELECT country, COALESCE(x, 0) AS x, row_number() OVER (PARTITION BY country ORDER BY date) - 1 AS t
  FROM days LEFT JOIN daily USING (country, date)),
heads AS (
  SELECT country, list(x ORDER BY t) AS xs, list_sum(list(x ORDER BY t)) / COUNT(*) AS level
  FROM series WHERE t < 7 GROUP BY country),
fold AS (
  SELECT country, CAST(len(xs) AS BIGINT) AS t, level,
         list_transform(range(0, 7), lambda i: CASE WHEN i < len(xs) THEN xs[i + 1] - level ELSE 0 END) AS seasons
  FROM heads
  UNION ALL
  SELECT country, t + 1, moved,
         list_transform(range(0, 7), lambda i: CASE WHEN i = t % 7 THEN 0.1::DOUBLE * (x - moved) + 0.9::DOUBLE * seasons[i + 1]
                                               ELSE seasons[i + 1] END)
  FROM (SELECT f.country, f.t, f.seasons, s.x,
               0.2::DOUBLE * (s.x - f.seasons[f.t % 7 + 1]) + 0.8::DOUBLE * f.level AS moved
        FROM fold f JOIN series s ON s.country = f.country AND s.t = f.t)),
ended AS (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY country ORDER BY t DESC) = 1)
SELECT country, CAST({AS_OF} + CAST(ahead + 1 AS INTEGER) AS VARCHAR) AS date, {r2('level + seasons[(t + ahead) % 7 + 1]')} AS forecast,
       {r2('level')} AS level
FROM ended, range(0, 14) r(ahead)"""


def oracle_sql() -> dict[str, str]:
    return {
        "cross_sell": CROSS_SELL,
        "client_spells": WITH + SPELLS + "SELECT id_client, spell, CAST(start AS VARCHAR) AS start,"
                         " CAST(stop AS VARCHAR) AS stop, orders, ended FROM spells",
        "retention_curve": RETENTION,
        "cohort_matrix": COHORTS,
        "rfm_scores": RFM,
        "box_plots": BOX_PLOTS,
        "sales_anomalies": ANOMALIES,
        "revenue_forecast": FORECAST,
    }
