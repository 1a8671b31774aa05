"""Writing datasets to target tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lake_ingest.functions.keys import quoted, text_literal
from lake_ingest.operators.validate import check_dataset

LOAD_ID = "load_id"
_SESSION_CATALOG = "spark_catalog"


def in_v2_catalog(spark: SparkSession, table: str) -> bool:
    """True when the name resolves to a configured catalog rather than to Spark's built-in one."""
    first = table.split(".")[0].strip("`")
    if "." in table and first == _SESSION_CATALOG:
        return False
    if "." in table and spark.conf.get(f"spark.sql.catalog.{first}", None):
        return True
    return spark.catalog.currentCatalog() != _SESSION_CATALOG


def create_or_append(df: DataFrame, table: str, **options: str) -> None:
    """Append to the table, by column name, or create it from the DataFrame's schema.

    The schema is not altered: missing or extra columns and unsafe conversions are errors. Zero rows
    still create the table.
    """
    spark = check_dataset(df).sparkSession
    if not in_v2_catalog(spark, table):
        df.write.mode("append").format("parquet").options(**options).saveAsTable(table)
        return
    if not spark.catalog.tableExists(table):
        try:
            df.writeTo(table).create()
            return
        except AnalysisException as exc:
            # Another job created it since the look-up.
            if exc.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
                raise
    df.writeTo(table).append()


def replace_load(df: DataFrame, table: str, load_id: str, **options: str) -> None:
    """Write the rows of one load, in place of those the same load wrote before.

    Tables made here have a partition column ``load_id``; in any other catalog the rows of that value are
    overwritten. To a table without the column rows are appended.
    """
    rows = check_dataset(df).withColumn(LOAD_ID, F.lit(load_id))
    spark = df.sparkSession
    v2 = in_v2_catalog(spark, table)
    if not spark.catalog.tableExists(table):
        if v2:
            rows.limit(0).writeTo(table).partitionedBy(F.col(LOAD_ID)).create()
        else:
            writer = rows.limit(0).write.format("parquet").partitionBy(LOAD_ID)
            writer.options(**options).saveAsTable(table)
    columns = spark.table(table).columns
    if LOAD_ID not in columns:
        create_or_append(df, table, **options)
    elif v2:
        rows.writeTo(table).overwrite(F.col(LOAD_ID) == load_id)
    else:
        named = ", ".join(quoted(c) for c in columns if c != LOAD_ID)
        partition = f"{quoted(LOAD_ID)} = {text_literal(load_id)}"
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION ({partition}) SELECT {named} FROM {{rows}}", rows=df
        )


def register_views(spark: SparkSession, tables: dict[str, str]) -> None:
    """Make Parquet folders, such as the control tables, visible to ``spark.sql`` by name."""
    for name, path in tables.items():
        spark.read.parquet(path).createOrReplaceTempView(name)
