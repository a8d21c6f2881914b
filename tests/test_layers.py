"""Files, the whole pipeline and the serving refresh."""

import glob
import os
from datetime import date

import pyarrow.parquet as pq
import pytest
from storeloom.checks import queries as checks
from pyspark.sql import functions as F
from storeloom.layout import Layout
from storeloom.operators import serving
from storeloom.plans import gold, refresh
from storeloom.plans.pipeline import run_pipeline, summary_of
from storeloom.plans.silver import read_silver
from storeloom.schemas import BRONZE, GOLD_TABLES
from storeloom.session import scratch_path
from storeloom.sources import files, sinks, starschema


@pytest.fixture(scope="module")
def lake(spark, sf):
    layout = Layout(scratch_path(spark, "lake"))
    source = checks._source_csv(spark, starschema.dirty_clients(spark, sf),
                                starschema.dirty_purchases(spark, sf))
    return layout, run_pipeline(spark, source, layout, checks.AS_OF)


def test_layout():
    assert Layout("s3a://b/x/").path("gold", "t") == "s3a://b/x/gold/t"
    with pytest.raises(ValueError):
        Layout("/r").path("lead", "t")


def test_csv_keeps_text(spark, tmp_path):
    awkward = [("1", "  padded ", 'quo"te', "a,b", "x\ty"), ("2", None, "é", "-", "z")]
    df = spark.createDataFrame(awkward, BRONZE["clients"])
    path = sinks.write_csv(df, str(tmp_path / "c.csv"))
    assert sorted(tuple(r) for r in files.scan_csv(spark, path, BRONZE["clients"]).collect()) == awkward


def test_csv_dates_are_iso(spark, tmp_path):
    df = spark.createDataFrame([(date(2024, 1, 2),)], "d date")
    path = sinks.write_csv(df, str(tmp_path / "d.csv"))
    assert spark.read.option("header", True).csv(path).first().d == "2024-01-02"


def test_ingest_reads_line_breaks_when_asked(spark, tmp_path):
    (tmp_path / "clients.csv").write_text(
        'id_client,name,email,subscription_date,country\n1,"a\nb",a@b.co,2024-01-01,FR\n')
    (tmp_path / "purchases.csv").write_text(
        "id_purchase,id_client,product,price,quantity,purchase_date,total\n"
        "1,1,p,1.00,1,2024-01-01,1.00\n")
    landed = files.bronze_ingest(spark, str(tmp_path), Layout(str(tmp_path / "lake")),
                                 multi_line=True)
    assert landed["clients"].first().name == "a\nb"
    assert [t for _, t in landed["purchases"].dtypes] == ["string"] * 7


def test_pipeline_writes_every_table_and_report(spark, lake):
    layout, result = lake
    summary = {r.metric: r.value for r in summary_of(result).collect()}
    tables = gold.read_gold(spark, layout)
    assert set(tables) == set(GOLD_TABLES)
    assert int(summary["total_rows"]) == tables["fact_sales"].count() > 0
    silver = read_silver(spark, layout)
    assert silver["purchases"].count() == tables["fact_sales"].count()
    for layer, table in [("silver", "clients"), ("silver", "purchases")] + [
            ("gold", t) for t in GOLD_TABLES]:
        copy = spark.read.option("header", True).csv(layout.export(layer, table, "csv"))
        assert copy.count() == spark.read.parquet(layout.path(layer, table)).count()


def test_reports(spark, lake):
    layout, result = lake
    quality = files.scan_json_report(spark, layout.export("silver", "quality_report", "json")).first()
    assert quality.processing_engine == "spark" and quality.report_timestamp
    assert quality.summary.total_output_rows == quality.clients.final_rows + quality.purchases.final_rows
    stats = files.scan_json_report(
        spark, layout.export("gold", "statistical_distributions", "json")).first()
    assert stats.overall_metrics.total_orders == quality.purchases.final_rows
    summary = files.scan_json_report(spark, layout.export("gold", "gold_summary", "json")).first()
    assert summary.kpis.total_clients == stats.overall_metrics.total_customers
    assert summary.fact_table.date_range.max == "2001-08-02"    # capped future dates
    assert summary.files_created.fact_sales == layout.path("gold", "fact_sales")
    assert os.path.exists(layout.export("gold", "gold_summary", "json"))


def test_pipeline_without_gold(spark, sf):
    layout = Layout(scratch_path(spark, "lake"))
    source = checks._source_csv(spark, starschema.clients(spark, sf), starschema.purchases(spark, sf))
    result = run_pipeline(spark, source, layout, checks.AS_OF, include_gold=False, export_csv=False)
    assert "gold" not in result and result["silver"]["clients"].count() > 0
    with pytest.raises(ValueError):
        summary_of(result)


def test_fact_is_partitioned_by_year(spark, lake):
    layout, _ = lake
    assert any(n.startswith("purchase_year=") for n in os.listdir(layout.path("gold", "fact_sales")))


def _parquet_files(folder):
    return [f"{at}/{n}" for at, _, names in os.walk(folder) for n in names if n.endswith(".parquet")]


def test_tables_are_compressed_tightly(spark, lake):
    """Each layer was written with the default codec."""
    layout, _ = lake
    refresh.load_table(spark, layout, "fact_sales")
    for place in (layout.path("bronze", "purchases"), layout.path("silver", "purchases"),
                  layout.path("gold", "fact_sales"), layout.path("serving", "fact_sales") + "/snapshot-*"):
        found = [f for p in glob.glob(place) for f in _parquet_files(p)]
        codecs = {pq.read_metadata(f).row_group(0).column(0).compression for f in found
                  if pq.read_metadata(f).num_row_groups}
        assert codecs == {"ZSTD"}, place


def test_fact_files_hold_the_purchases_of_a_client_together(spark, lake):
    layout, _ = lake
    read = [pq.ParquetFile(f).read(["id_client", "id_purchase"]).to_pylist()
            for f in _parquet_files(layout.path("gold", "fact_sales"))]
    held = [[(r["id_client"], r["id_purchase"]) for r in rows] for rows in read]
    assert sum(map(len, held)) > 100 and all(rows == sorted(rows) for rows in held)


def test_refresh_and_lookups(spark, lake):
    layout, _ = lake
    done = refresh.refresh_serving(spark, layout).collect()
    loaded = {r.table: r.rows for r in done}
    assert set(loaded) == set(GOLD_TABLES) and {r.status for r in done} == {"loaded"}
    fact = refresh.read_serving(spark, layout, "fact_sales")
    assert fact.count() == loaded["fact_sales"]
    one = fact.select("id_client", "id_purchase", "product", "country").first()
    for key in one.asDict():
        found = serving.serving_lookup(fact, **{key: one[key]})
        assert found.count() == fact.where(F.col(key) == one[key]).count() > 0
    with pytest.raises(ValueError):
        serving.serving_lookup(fact)


def test_refresh_is_ordered_by_key(spark, lake):
    layout, _ = lake
    refresh.load_table(spark, layout, "client_kpis")
    spans = (refresh.read_serving(spark, layout, "client_kpis")
             .groupBy(F.input_file_name()).agg(F.min("id_client"), F.max("id_client")).collect())
    spans = sorted((low, high) for _, low, high in spans)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_failed_refresh_keeps_the_old_data(spark, lake):
    layout, _ = lake
    refresh.refresh_serving(spark, layout, ["daily_sales"])
    before = refresh.read_serving(spark, layout, "daily_sales").count()
    # Two refreshes that ended before their log entry.
    for name in ("snapshot-a", "snapshot-b"):
        os.makedirs(f"{layout.path('serving', 'daily_sales')}/{name}")
    assert refresh.read_serving(spark, layout, "daily_sales").count() == before
    refresh.load_table(spark, layout, "daily_sales", keep=2)
    newest, last = refresh._finished(spark, layout.path("serving", "daily_sales"))[-2:]
    assert spark.read.parquet(newest).count() == spark.read.parquet(last).count() == before
    missing = Layout(scratch_path(spark, "empty"))
    row = refresh.refresh_serving(spark, missing, ["daily_sales"]).first()
    assert (row.table, row.status, row.rows) == ("daily_sales", "failed", None) and row.error and row.seconds >= 0
    with pytest.raises(FileNotFoundError):
        refresh.read_serving(spark, missing, "daily_sales")


def test_old_snapshots_are_emptied(spark, lake):
    layout, _ = lake
    for _ in range(4):
        refresh.load_table(spark, layout, "monthly_sales")
    rows = [spark.read.parquet(p).count() for p in refresh._finished(spark, layout.path("serving", "monthly_sales"))]
    assert all(rows[-2:]) and not any(rows[:-2])


def _source(folder, purchases):
    (folder / "clients.csv").write_text("id_client,name,email,subscription_date,country\n"
                                        '1,"a\nb",a@b.co,2024-01-01,FR\n2,c,c@b.co,2024-01-01,FR,surplus\n3,short\n')
    (folder / "purchases.csv").write_text("id_purchase,id_client,product,price,quantity,purchase_date,total\n" + purchases)
    return str(folder)


def test_malformed_records_are_kept_apart(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    landed = files.bronze_ingest(spark, _source(tmp_path, "1,1,p,1.00,1,2024-01-01,1.00\n"), layout)
    assert [r.name for r in landed["clients"].collect()] == ["a\nb"] and landed["purchases"].count() == 1
    wrong = {(r.table, r.malformed_record) for r in files.read_malformed(spark, layout).collect()}
    assert wrong == {("clients", "2,c,c@b.co,2024-01-01,FR,surplus"), ("clients", "3,short")}


def test_unfinished_landing_is_landed_again(spark, tmp_path):
    layout = Layout(str(tmp_path / "lake"))
    source = _source(tmp_path, "1,1,p,1.00,1,2024-01-01,1.00\n")
    os.makedirs(layout.path("bronze", "clients"))
    assert files.bronze_ingest(spark, source, layout, if_absent=True)["clients"].count() == 1
    _source(tmp_path, "")
    assert files.bronze_ingest(spark, source, layout, if_absent=True)["purchases"].count() == 1


def test_silver_reads_and_parses_bronze_once(spark, sf, monkeypatch):
    from storeloom.operators import silver as operators
    from storeloom.plans import silver as plans
    layout = Layout(scratch_path(spark, "lake"))
    source = checks._source_csv(spark, starschema.dirty_clients(spark, sf), starschema.dirty_purchases(spark, sf))
    files.bronze_ingest(spark, source, layout)
    calls, scans = [], []
    for name in ("tag_clients", "tag_purchases"):
        def tag(bronze, *a, real=getattr(operators, name), name=name):
            calls.append(name)
            out = real(bronze, *a)
            scans.append(out._jdf.queryExecution().executedPlan().toString().count("FileScan"))
            return out
        monkeypatch.setattr(operators, name, tag)
    tables = plans.silver_flow(spark, layout, checks.AS_OF, export_csv=False)
    assert sorted(calls) == ["tag_clients", "tag_purchases"] and scans == [1, 1]
    report = files.scan_json_report(spark, layout.export("silver", "quality_report", "json")).first()
    assert report.purchases.final_rows == tables["purchases"].count() > 0
    assert report.clients.final_rows == tables["clients"].count()
