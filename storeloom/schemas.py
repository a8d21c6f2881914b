"""Fixed schemas of the layers; no layer boundary infers types."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
# A source price, before the total is rounded.
PRICE = T.DecimalType(18, 6)

# The column and table names of the layers.

CLIENT_COLUMNS = ["id_client", "name", "email", "subscription_date", "country"]
PURCHASE_COLUMNS = ["id_purchase", "id_client", "product", "price", "quantity",
                    "purchase_date", "total"]


def _strings(names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Bronze keeps the source text as it is.
BRONZE = {"clients": _strings(CLIENT_COLUMNS), "purchases": _strings(PURCHASE_COLUMNS)}

SILVER = {
    "clients": T.StructType([
        T.StructField("id_client", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("subscription_date", T.DateType()),
        T.StructField("country", T.StringType()),
    ]),
    "purchases": T.StructType([
        T.StructField("id_purchase", T.LongType()),
        T.StructField("id_client", T.LongType()),
        T.StructField("product", T.StringType()),
        T.StructField("price", MONEY),
        T.StructField("quantity", T.LongType()),
        T.StructField("purchase_date", T.DateType()),
        T.StructField("total", MONEY),
    ]),
}

GOLD_TABLES = ["fact_sales", "client_kpis", "product_analytics", "country_analytics",
               "daily_sales", "weekly_sales", "monthly_sales"]
