"""Reading layer tables and landing the source files in bronze."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from storeloom.layout import Layout
from storeloom.schemas import BRONZE
from storeloom.session import COMPRESSION


MALFORMED = "malformed_record"


def scan_csv(spark: SparkSession, path: str, schema: StructType,
             multi_line: bool = True) -> DataFrame:
    """A header CSV under a fixed schema.

    Quoted line breaks are read by default, at the price of not splitting
    files; ``multi_line=False`` splits the files of sources that have none. A
    schema with a text column ``malformed_record`` gets the raw text of records
    with more or fewer fields than it names.
    """
    reader = (spark.read.schema(schema)
              .option("header", True).option("escape", '"').option("multiLine", multi_line))
    if MALFORMED in schema.names:
        # Without pruning every field is read, so a wrong number of them always shows.
        return reader.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False).csv(path)
    return reader.option("enforceSchema", False).csv(path)


def scan_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet file or directory; types come from the files."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def scan_json_report(spark: SparkSession, path: str,
                     schema: StructType | None = None) -> DataFrame:
    """A nested report, as one row (reports are a few kilobytes)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("multiLine", True).json(path)


def _landed_mark(layout: Layout, table: str) -> str:
    return layout.path("bronze", f"{table}_landed")


def _is_landed(spark: SparkSession, layout: Layout, table: str) -> bool:
    """Whether the mark that is written after a table can be read."""
    try:
        return spark.read.schema("rows bigint").parquet(_landed_mark(layout, table)).count() > 0
    except AnalysisException:
        return False


def _whole(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(MALFORMED, StringType())])


def bronze_ingest(spark: SparkSession, data_dir: str, layout: Layout,
                  if_absent: bool = False, multi_line: bool = True) -> dict[str, DataFrame]:
    """Land ``clients.csv`` and ``purchases.csv`` in bronze, every value as text.

    Parquet from here on gives later layers column pruning. Records with a
    wrong number of fields are landed with their raw text in a partition of
    their own and are no rows of the two tables; ``read_malformed`` gives them.
    ``if_absent`` leaves a bronze table that has been landed to the end as it
    is; an unfinished one is landed again.
    """
    for table, schema in BRONZE.items():
        if if_absent and _is_landed(spark, layout, table):
            continue
        raw = scan_csv(spark, f"{data_dir.rstrip('/')}/{table}.csv", _whole(schema), multi_line)
        # The mark goes before the table changes and comes back when it is whole.
        spark.createDataFrame([], "rows bigint").write.mode("overwrite").parquet(_landed_mark(layout, table))
        (raw.withColumn("malformed", F.col(MALFORMED).isNotNull())
         .write.mode("overwrite").partitionBy("malformed")
         .parquet(layout.path("bronze", table), compression=COMPRESSION))
        rows = _read_landed(spark, layout, table).agg(F.count(F.lit(1)).alias("rows"))
        rows.write.mode("overwrite").parquet(_landed_mark(layout, table))
    return read_bronze(spark, layout)


def _read_landed(spark: SparkSession, layout: Layout, table: str) -> DataFrame:
    schema = StructType([*_whole(BRONZE[table]).fields, StructField("malformed", BooleanType())])
    return spark.read.schema(schema).parquet(layout.path("bronze", table))


def read_bronze(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    return {t: _read_landed(spark, layout, t).filter(~F.col("malformed")).select(*s.names)
            for t, s in BRONZE.items()}


def read_malformed(spark: SparkSession, layout: Layout) -> DataFrame:
    """``table``, ``malformed_record``: records that were not landed as rows."""
    parts = [_read_landed(spark, layout, t).filter("malformed").select(F.lit(t).alias("table"), MALFORMED)
             for t in BRONZE]
    return reduce(DataFrame.unionByName, parts)
