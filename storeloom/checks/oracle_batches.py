"""SQL statements of the queries over batches: a full rebuild from the rows that are valid in the end."""

from storeloom.checks.oracle import CLEAN_INPUT, PURCHASE, big, money

# Batches as row sets; the store after each is the batch and what it did not replace.
BATCHES = f"""WITH {CLEAN_INPUT},
rows AS (
  SELECT *, DATE '1997-06-01' AS early, DATE '1999-09-01' AS middle FROM purchases
  QUALIFY row_number() OVER (PARTITION BY id_purchase
                             ORDER BY purchase_date, id_client, product, price, quantity, total) = 1),
batch1 AS (
  SELECT id_purchase, id_client + CASE WHEN id_purchase % 17 = 6 THEN 1 ELSE 0 END AS id_client, product,
         price * CASE WHEN id_purchase % 17 = 6 THEN 10 ELSE 1 END AS price,
         quantity + CASE WHEN id_purchase % 13 = 5 THEN 1 ELSE 0 END AS quantity,
         purchase_date - CASE WHEN id_purchase % 17 = 6 THEN 400 ELSE 0 END AS purchase_date
  FROM rows WHERE purchase_date < early AND id_purchase % 19 <> 3),
batch2 AS (
  SELECT id_purchase, id_client, product, price, quantity, purchase_date FROM rows
  WHERE (purchase_date >= early - 30 AND purchase_date < middle)
     OR (purchase_date < early AND (id_purchase % 19 = 3 OR id_purchase % 13 = 5))),
batch3 AS (
  SELECT id_purchase, id_client, product, price, quantity, purchase_date FROM rows
  WHERE (purchase_date >= middle OR (purchase_date < early AND id_purchase % 17 = 6)) AND id_purchase % 101 <> 7),
gone AS (SELECT id_purchase FROM rows WHERE id_purchase % 101 = 7),
after2 AS (SELECT * FROM batch2 UNION ALL SELECT * FROM batch1 ANTI JOIN batch2 USING (id_purchase)),
final AS (SELECT * FROM rows WHERE id_purchase % 101 <> 7)
"""


def _report(batch: str, received: str, before: str, deleted: str, mark: str, marks: str) -> str:
    same = "o.id_client = n.id_client AND o.price = n.price AND o.quantity = n.quantity AND o.purchase_date = n.purchase_date"
    return f"""SELECT 'batch-{batch[-1]}' AS batch_id, {received} AS received,
      COUNT(*) FILTER (o.id_purchase IS NULL) AS added, COUNT(*) FILTER (NOT ({same})) AS corrected,
      {deleted} AS deleted, COUNT(*) FILTER ({same}) AS repeated,
      COUNT(*) FILTER (({same}) IS NOT TRUE AND n.purchase_date < {mark}) AS late,
      CAST({marks} AS VARCHAR) AS high_water, CAST(3 AS BIGINT) AS versions
      FROM {batch} n LEFT JOIN {before} o USING (id_purchase)"""


def _top(*tables: str) -> str:
    return "(SELECT MAX(purchase_date) FROM (" + " UNION ALL ".join(f"SELECT purchase_date FROM {t}" for t in tables) + "))"


REPORTS = BATCHES + " UNION ALL ".join([
    _report("batch1", "COUNT(*)", "(SELECT * FROM batch1 WHERE false)", "CAST(0 AS BIGINT)", "DATE '0001-01-01'",
            _top("batch1")),
    _report("batch2", "COUNT(*)", "batch1", "CAST(0 AS BIGINT)", _top("batch1"), _top("batch1", "batch2")),
    _report("batch3", "COUNT(*) + (SELECT COUNT(*) FROM gone)", "after2",
            "(SELECT COUNT(*) FROM gone SEMI JOIN after2 USING (id_purchase))", _top("batch1", "batch2"),
            _top("batch1", "batch2", "batch3"))])

NONE = "CAST(NULL AS VARCHAR)"
GOLD = BATCHES + f"""
SELECT 'clients' AS table_name, CAST(id_client AS VARCHAR) AS key, COUNT(*) AS orders, {big('SUM(quantity)')} AS quantity,
       {money('SUM(total)')} AS revenue, CAST(NULL AS BIGINT) AS customers, {money('MIN(total)')} AS low,
       {money('MAX(total)')} AS high, CAST(MIN(purchase_date) AS VARCHAR) AS first_day,
       CAST(MAX(purchase_date) AS VARCHAR) AS last_day
FROM final GROUP BY id_client
UNION ALL
SELECT 'days', CAST(purchase_date AS VARCHAR), COUNT(*), {big('SUM(quantity)')}, {money('SUM(total)')},
       COUNT(DISTINCT id_client), NULL, NULL, {NONE}, {NONE}
FROM final GROUP BY purchase_date
UNION ALL
SELECT 'products', product || '|' || country, COUNT(*), {big('SUM(quantity)')}, {money('SUM(total)')},
       COUNT(DISTINCT id_client), {money('MIN(price)')}, {money('MAX(price)')}, {NONE}, {NONE}
FROM final JOIN clients USING (id_client) GROUP BY product, country"""


def oracle_sql() -> dict[str, str]:
    return {
        "incremental_gold": GOLD,
        "incremental_batches": REPORTS,
        "monthly_partitions": BATCHES + f"SELECT {PURCHASE} FROM final"
                              " WHERE purchase_date BETWEEN DATE '1997-03-01' AND DATE '1997-08-31'",
    }
