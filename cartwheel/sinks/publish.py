"""SNK1 + SNK11 without a gap: results that readers find whole at any time.

Overwriting a folder takes its files away before the new ones are there, and
a reader in between fails or sees nothing.  Here every result is written to a
new folder of its own; when it is complete the catalog table is pointed there
(``ALTER TABLE ... SET LOCATION``), which is one change in the catalog.  A
write that fails leaves the table as it was.  The folder before stays for
readers that have begun with it, and goes when the next result is published.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cartwheel.config import delete_path
from cartwheel.sinks.tables import INSIGHT_TABLES, create_database, create_external_table, register_original_names

PREVIOUS = "cartwheel.previous"


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _previous(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(f"key = '{PREVIOUS}'").collect()
    return rows[0]["value"] if rows else None


def publish(df: DataFrame, database: str, name: str, root: str, columns: str | None = None) -> str:
    """Make ``df`` (insight-sized: one file) the content of the table
    ``database.name``; the folder it is in, under ``root``."""
    spark = df.sparkSession
    table = f"`{database}`.`{name}`"
    folder = f"{root.rstrip('/')}/{name}/{uuid.uuid4().hex}"
    columns = columns or ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    try:
        df.coalesce(1).write.parquet(folder)
    except Exception:
        delete_path(spark, folder)
        raise
    if not spark.catalog.tableExists(f"{database}.{name}"):
        create_external_table(spark, database, name, columns, folder)
        return folder
    now, before = _location(spark, table), _previous(spark, table)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PREVIOUS}' = '{now}')")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.sql(f"REFRESH TABLE {table}")
    if before and before not in (now, folder):
        delete_path(spark, before)
    return folder


def publish_insights(spark: SparkSession, results: dict[str, DataFrame], database: str, root: str) -> None:
    """The four insight tables, each published, with the views under the
    original names.  The database is placed as ``register_insights`` does."""
    create_database(spark, database, f"{root.rstrip('/')}/_catalog/{database}.db")
    for name, columns in INSIGHT_TABLES.items():
        publish(results[name], database, name, root, columns)
    register_original_names(spark, database)
