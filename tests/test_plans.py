"""Plans stay in the JVM, push filters down and survive a hot key."""

import pytest
from storeloom.checks import queries as checks
from pyspark.sql import functions as F
from storeloom.operators import facts, kpis, temporal

LAZY = ["fact_sales", "clean_clients", "clean_purchases", "quality_report", "client_kpis",
        "product_analytics", "country_analytics", "daily_sales", "weekly_sales", "monthly_sales",
        "statistical_distributions", "client_features", "client_segments", "top_performers"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cartesian_product_and_no_python(spark, sf, name):
    plan = plan_of(checks.queries()[name](spark, sf))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                 "ArrowEvalPython", "PythonUDF", "InMemoryTableScan"):
        assert node not in plan, node


@pytest.mark.parametrize("name", ["daily_sales", "product_totals"])
def test_only_needed_columns_are_read(spark, sf, name):
    plan = plan_of(checks.queries()[name](spark, sf))
    for unused in ("l_extendedprice", "l_shipdate", "o_totalprice", "c_acctbal", "p_brand"):
        assert unused not in plan


def test_lookup_filter_reaches_the_scan(spark, sf):
    plan = plan_of(checks.serving_lookup(spark, sf))
    assert "PushedFilters: [IsNotNull(id_client), EqualTo(id_client,55)]" in plan


def test_top_k_limits_groups_before_the_shuffle(spark, sf):
    plan = plan_of(checks.top_k_per_group(spark, sf))
    assert plan.count("WindowGroupLimit") == 2


def test_client_totals_aggregate_before_the_join(spark, sf):
    plan = plan_of(checks.queries()["client_totals"](spark, sf))
    assert "SortAggregate" not in plan
    assert plan.index("Join [id_client") < plan.index("HashAggregate(keys=[id_client")


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all sales belong to client 0, one product and one day."""
    third = F.col("id") % 3 == 0
    p = spark.range(30_000, numPartitions=6).select(
        F.col("id").alias("id_purchase"),
        F.when(third, 0).otherwise(F.col("id") % 500).cast("bigint").alias("id_client"),
        F.when(third, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 7)).alias("product"),
        F.lit(2.5).cast("decimal(18,2)").alias("price"), F.lit(2).alias("quantity"),
        F.when(third, F.lit("2024-01-01").cast("date")).otherwise(
            F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")))
        .alias("purchase_date"), F.lit(5).cast("decimal(18,2)").alias("total"))
    c = spark.range(500).select(
        F.col("id").alias("id_client"), F.lit("n").alias("name"), F.lit("e").alias("email"),
        F.concat(F.lit("c"), F.col("id") % 4).alias("country"),
        F.lit("2020-01-01").cast("date").alias("subscription_date"))
    return p, c


def test_results_with_a_hot_key_are_whole(spark, hot):
    p, c = hot
    by_client = kpis.client_totals(p, c)
    assert by_client.where("id_client = 0").first().total_purchases == p.where("id_client = 0").count()
    assert by_client.agg(F.sum("total_purchases")).first()[0] == 30_000
    assert temporal.daily_totals(p).agg(F.sum("total_orders")).first()[0] == 30_000
    assert kpis.product_totals(p).agg(F.sum("total_orders")).first()[0] == 30_000


def test_hot_key_join_is_split(spark, hot):
    """With a sort-merge join the hot client's partition is split, not one task."""
    p, c = hot
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
                "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        fact = facts.fact_join(p, c)
        assert len(fact.collect()) == 30_000
        final = plan_of(fact).split("Initial Plan")[0]
        assert "skew=true" in final
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_product_analytics_reads_the_fact_once(spark, sf):
    from storeloom.operators import kpis
    from storeloom.session import through_table
    fact = through_table(checks._fact(spark, sf), "fact")
    plan = kpis.product_analytics(fact)._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "Join" not in final and "Expand" not in final


@pytest.mark.parametrize("name", ["clean_purchases", "clean_clients"])
def test_cleaning_parses_each_value_once(spark, sf, name):
    """No filter or join condition repeats the parsing of texts."""
    plan = plan_of(checks.queries()[name](spark, sf))
    nodes = plan.replace("\n", " ").split("+- ")
    for node in nodes:
        if node.lstrip("*(0123456789) :").startswith(("Filter", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin")):
            assert "RLIKE(CASE" not in node and "try_cast(id" not in node and "trim(" not in node
    assert "Generate inline" in plan
