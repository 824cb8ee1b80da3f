"""SNK11: a database and external tables over the insight Parquet folders."""

from __future__ import annotations

from pyspark.sql import SparkSession

from cartwheel.schema import ABANDONMENT_OUT, CATEGORY_OUT, CITY_OUT, ORIGINAL_INSIGHT_NAMES, STATUS_OUT

INSIGHT_TABLES = {
    "revenue_by_category": CATEGORY_OUT,
    "revenue_by_city": CITY_OUT,
    "cart_abandonment": ABANDONMENT_OUT,
    "delivery_status": STATUS_OUT,
}


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def create_external_table(
    spark: SparkSession, database: str, name: str, columns: str, location: str, db_location: str | None = None
) -> None:
    """``CREATE TABLE IF NOT EXISTS`` over an existing Parquet folder; the
    data stays where it is.  ``REFRESH TABLE`` makes a reader see files that
    were rewritten after the table was first read."""
    create_database(spark, database, db_location)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING PARQUET LOCATION '{location}'"
    )
    spark.sql(f"REFRESH TABLE `{database}`.`{name}`")


def register_insights(spark: SparkSession, database: str, output_root: str) -> None:
    """The four insight tables over ``<output_root>/<table>``, plus views
    under the original names.  A database created here is placed under
    ``<output_root>/_catalog`` (it holds no data: the tables are external)."""
    create_database(spark, database, f"{output_root.rstrip('/')}/_catalog/{database}.db")
    for name, columns in INSIGHT_TABLES.items():
        create_external_table(spark, database, name, columns, f"{output_root.rstrip('/')}/{name}")
    register_original_names(spark, database)


def register_original_names(spark: SparkSession, database: str, tables=None) -> None:
    """Views with the original table and column names over the insight
    tables (all four, or the named ones), so existing SQL (``SELECT * FROM
    faturamento_categoria ORDER BY faturamento DESC``) keeps working."""
    for table, (view, renames) in ORIGINAL_INSIGHT_NAMES.items():
        if tables is not None and table not in tables:
            continue
        columns = INSIGHT_TABLES[table].split(", ")
        select = ", ".join(
            f"`{c.split()[0]}` AS `{renames.get(c.split()[0], c.split()[0])}`" for c in columns
        )
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{view}` AS SELECT {select} FROM `{database}`.`{table}`")
