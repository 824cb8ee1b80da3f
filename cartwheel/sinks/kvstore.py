"""SNK5-SNK10: key-value cells with upsert (merge by key, never delete).

A table is a folder of Parquet puts, ``<root>/<table>/put=<name>``.  A put only
adds its own folder; a reader keeps, per (row_key, column), the cell of the
newest put (``operators.latest_cells``: one aggregation with a partial step in
each task).  A stream names its puts by its query id and batch id, so a
replayed batch replaces its own folder and adds nothing, and a new stream (new
checkpoint, new query id) never meets the names of an old one.

Newest is by the time of the put on the driver that made it, then by name.
Old puts stay until somebody removes them; a table with very many puts is
rewritten by putting ``read()`` into a new table.
"""

from __future__ import annotations

import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.operators.kv import latest_cells
from cartwheel.schema import KV_CELL_SCHEMA

STORED = "row_key string, column string, value string, put_at timestamp, put string"


class KeyValueStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _puts(self, table: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(STORED).parquet(f"{self.root}/{table}")
        except AnalysisException as err:
            if "PATH_NOT_FOUND" in str(err) or "Path does not exist" in str(err):
                return None
            raise

    def put(self, cells: DataFrame, table: str, name: str | None = None) -> None:
        """SNK5-SNK8: upsert ``cells`` (``row_key, column, value``; a
        ``table`` column is ignored); creates the table when missing.  A put
        with the ``name`` of an earlier one replaces it."""
        stored = cells.select("row_key", "column", "value", F.current_timestamp().alias("put_at"))
        stored.write.mode("overwrite").parquet(f"{self.root}/{table}/put={name or uuid.uuid4().hex}")

    def create_table(self, table: str) -> bool:
        """SNK9: create if missing; an existing table is success.  Returns
        True when the table was created now."""
        if self._puts(table) is not None:
            return False
        self.put(self.spark.createDataFrame([], KV_CELL_SCHEMA), table, "created")
        return True

    def read(self, table: str) -> DataFrame:
        """Current cells ``table, row_key, column, value`` (empty if missing)."""
        puts = self._puts(table)
        if puts is None:
            return self.spark.createDataFrame([], KV_CELL_SCHEMA)
        return latest_cells(puts.withColumn("table", F.lit(table)), ["put_at", "put"])

    def count_rows(self, table: str) -> int:
        """SNK10: number of row keys; a missing table has 0."""
        return self.row_count(table).first()["rows"]

    def row_count(self, table: str) -> DataFrame:
        """SNK10 as a one-row frame ``table, rows`` (0 for a missing table)."""
        keys = self._puts(table)
        keys = self.read(table) if keys is None else keys
        return keys.agg(F.count_distinct("row_key").alias("rows")).select(F.lit(table).alias("table"), "rows")


class BucketedStore(KeyValueStore):
    """A store whose tables are bucketed by row key.

    A table is an external catalog table over its folder, partitioned by put
    and clustered by ``row_key`` into ``buckets``.  A put deals its cells by
    key once, as it is written; after that all cells of a key are in one
    bucket, so reading the newest cells, counting keys and merging a table into
    another of as many buckets need no shuffle.
    """

    def __init__(self, spark: SparkSession, root: str, database: str, buckets: int = 32):
        super().__init__(spark, root)
        self.database, self.buckets = database, buckets

    def _name(self, table: str) -> str:
        return f"`{self.database}`.`kv_{re.sub('[^A-Za-z0-9_]', '_', table).lower()}`"

    def _ensure(self, table: str) -> str:
        """The catalog table over the folder; puts that the folder holds from
        another session are found again."""
        name = self._name(table)
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"CREATE TABLE {name} ({STORED}) USING PARQUET PARTITIONED BY (put) "
                f"CLUSTERED BY (row_key) INTO {self.buckets} BUCKETS LOCATION '{self.root}/{table}'"
            )
            if KeyValueStore._puts(self, table) is not None:
                self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return name

    def _puts(self, table: str) -> DataFrame | None:
        known = self.spark.catalog.tableExists(self._name(table)) or super()._puts(table) is not None
        return self.spark.table(self._ensure(table)) if known else None

    def put(self, cells: DataFrame, table: str, name: str | None = None) -> None:
        target = self._ensure(table)
        stored = cells.select("row_key", "column", "value", F.current_timestamp().alias("put_at"))
        view = f"put_{uuid.uuid4().hex}"
        stored.repartition(self.buckets, "row_key").createOrReplaceTempView(view)
        try:
            self.spark.sql(
                f"INSERT OVERWRITE {target} PARTITION (put = '{name or uuid.uuid4().hex}') SELECT * FROM `{view}`"
            )
        finally:
            self.spark.catalog.dropTempView(view)

    def read(self, table: str) -> DataFrame:
        puts = self._puts(table)
        if puts is None:
            return self.spark.createDataFrame([], KV_CELL_SCHEMA)
        newest = F.max_by("value", F.struct("put_at", "put")).alias("value")
        cells = puts.groupBy("row_key", "column").agg(newest)
        return cells.select(F.lit(table).alias("table"), "row_key", "column", "value")
