"""Clients and purchases derived from the star-schema test tables.

The clean form feeds gold, serving and prediction. The dirty form is the same
data with faults placed by modulus, as text, and feeds the silver layer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from storeloom.schemas import CLIENT_COLUMNS, MONEY, PURCHASE_COLUMNS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation")
    customer = _table(spark, sf_dir, "customer")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    subscribed = F.date_add(F.lit("1993-01-01").cast("date"),
                            (F.col("c_custkey") % 700).cast("int"))
    return joined.withColumn("subscribed", subscribed)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders")
    part = _table(spark, sf_dir, "part")
    return (lineitem
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .select("l_orderkey", "l_partkey", "o_custkey",
                    (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_purchase"),
                    F.col("p_type").alias("product"),
                    F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
                    F.col("l_quantity").cast("int").alias("quantity"),
                    F.col("o_orderdate").cast("date").alias("purchase_date")))


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir).select(
        F.col("c_custkey").alias("id_client"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("user"), F.col("c_custkey").cast("string"),
                 F.lit("@example.com")).alias("email"),
        F.col("subscribed").alias("subscription_date"),
        F.col("n_name").alias("country"))


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(
        "id_purchase",
        F.col("o_custkey").alias("id_client"),
        "product",
        F.col("price").cast(MONEY).alias("price"),
        "quantity",
        "purchase_date",
        (F.col("price") * F.col("quantity")).cast(MONEY).alias("total"))


def _first_rule(rules: list[tuple[Column, Column]], otherwise: Column) -> Column:
    out = None
    for condition, value in rules:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(otherwise)


def _as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in columns])


def dirty_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _customers(spark, sf_dir)
    key = F.col("c_custkey")
    name = F.when(key % 11 == 0, F.concat(F.lit("  "), F.col("c_name"))).otherwise(F.col("c_name"))
    email = _first_rule(
        [(key % 97 == 5, F.lit("bad-email")),
         (key % 89 == 7, F.lit(None).cast("string")),
         (key % 83 == 3, F.concat(F.lit("Shared"), (key % 5).cast("string"),
                                  F.lit("@Example.com")))],
        F.concat(F.lit("User"), key.cast("string"), F.lit("@Example.com")))
    subscribed = _first_rule(
        [(key % 79 == 4, F.lit("not-a-date")), (key % 71 == 2, F.lit("2099-01-01"))],
        F.col("subscribed").cast("string"))
    country = F.when(key % 13 == 0, F.concat(F.col("n_name"), F.lit(" "))).otherwise(F.col("n_name"))
    # The second copy of some rows, from the same scan.
    copies = F.when(key % 61 == 1, F.sequence(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    once = raw.select(key.alias("id_client"), name.alias("name"), email.alias("email"),
                      subscribed.alias("subscription_date"), country.alias("country"),
                      copies.alias("copies"))
    return _as_text(once.withColumn("copy", F.explode("copies")), CLIENT_COLUMNS)


def dirty_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _lines(spark, sf_dir)
    order = F.col("l_orderkey")
    # Some prices have a third digit, and their totals are rounded only after the product.
    price = (F.col("price").cast("decimal(13,3)")
             + F.when(order % 61 == 7, F.lit(5)).otherwise(F.lit(0)).cast("decimal(13,3)") / 1000).cast("decimal(13,3)")
    day = F.col("purchase_date").cast("string")
    out = raw.select(
        F.when(order % 31 == 5, F.concat(F.col("id_purchase").cast("string"), F.lit(".0")))
        .otherwise(F.col("id_purchase").cast("string")).alias("id_purchase"),
        F.when(order % 67 == 9, (-1 - F.col("o_custkey")).cast("string"))
        .when(order % 29 == 4, F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
        .otherwise(F.col("o_custkey").cast("string")).alias("id_client"),
        _first_rule([(order % 101 == 3, F.lit(None).cast("string")),
                     (F.col("l_partkey") % 17 == 0, F.concat(F.lit(" "), F.col("product")))],
                    F.col("product")).alias("product"),
        price.alias("price"),
        _first_rule([(order % 59 == 8, F.lit(-1)), (order % 47 == 11, F.lit(0))],
                    F.col("quantity")).alias("quantity"),
        _first_rule([(order % 73 == 1, F.lit("bad")), (order % 43 == 2, F.lit("2099-12-31")),
                     (order % 83 == 4, F.substring(day, 1, 7)), (order % 89 == 6, F.substring(day, 1, 4)),
                     (order % 97 == 8, F.concat(day, F.lit(" garbage")))], day).alias("purchase_date"),
        (price * F.col("quantity") + F.when(order % 53 == 6, 1).otherwise(0)).cast(MONEY).alias("total"))
    return _as_text(out, PURCHASE_COLUMNS)
