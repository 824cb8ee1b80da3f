"""The batch job: landing folder -> four insights -> Parquet, CSV, catalog
tables and key-value rows.

    read_events -> dedup_events -> [catalog, purchases, items, carts, status]
                -> revenue_by_category / revenue_by_city / abandonment /
                   delivery_status_counts -> sinks

The raw files are read once: the events, cut to the columns the insights
read, are written as Parquet to the shared checkpoint folder as they come,
each row with its place, and counted on the way (rows, malformed lines,
fractional quantities).  Repeated ids are found and marked from the id column
of that table; every insight scans it less the marked places.  The four
small results are persisted once, so each output and report reuses them.
"""

from __future__ import annotations

import argparse
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartwheel import operators as op
from cartwheel.config import build_session, job_dir, remove_dir
from cartwheel.operators.dedup import SLOT
from cartwheel.plans.manifest import Manifest
from cartwheel.schema import (
    ADD_TO_CART,
    CATEGORY_CELLS,
    CITY_CELLS,
    CLICK,
    CORRUPT_COLUMN,
    DELIVERY_STATUS,
    KV_TABLE_CATEGORY,
    KV_TABLE_CITY,
    ORIGINAL_INSIGHT_NAMES,
    PURCHASE,
    UNKNOWN_CATEGORY,
)
from cartwheel.sinks import files, tables
from cartwheel.sinks.kvstore import KeyValueStore
from cartwheel.sinks.publish import publish_insights
from cartwheel.sources.events import read_events

INSIGHT_COLUMNS = [
    "event_id",
    "event_type",
    "event_time",
    "ingest_time",
    "session_id",
    "city",
    "state",
    "product_id",
    "category",
    "price",
    "quantity",
    "order_id",
    "user_id",
    "items",
    "total",
    "delivery_status",
]


@dataclass
class Insights:
    stats: DataFrame
    by_category: DataFrame
    by_city: DataFrame
    abandonment: DataFrame
    status: DataFrame
    staged: Staged | None = None

    def frames(self) -> dict[str, DataFrame]:
        return {
            "revenue_by_category": self.by_category,
            "revenue_by_city": self.by_city,
            "cart_abandonment": self.abandonment,
            "delivery_status": self.status,
        }


def _project(raw: DataFrame) -> DataFrame:
    keep = INSIGHT_COLUMNS + ([CORRUPT_COLUMN] if CORRUPT_COLUMN in raw.columns else [])
    return raw.select(*keep)


def insights_from(counted: DataFrame, unknown: str = UNKNOWN_CATEGORY, stats: DataFrame | None = None) -> Insights:
    """All four insights and the de-dup statistics from de-duplicated events
    with copy counts (``dedup_events_counted``, ``Staged.events``), lazily;
    ``stats`` if they are known already."""
    events = counted.drop("_copies", "_corrupt")
    catalog = op.derive_catalog(events)
    bought = op.purchases(_of_kind(events, PURCHASE))
    items = op.explode_items(bought)
    return Insights(
        stats=op.counted_stats(counted) if stats is None else stats,
        by_category=op.revenue_by_category(items, catalog, unknown),
        by_city=op.revenue_by_city(bought),
        abandonment=op.abandonment(_of_kind(events, ADD_TO_CART, PURCHASE)),
        status=op.delivery_status_counts(_of_kind(events, DELIVERY_STATUS)),
    )


def compute_insights(raw: DataFrame, unknown: str = UNKNOWN_CATEGORY) -> Insights:
    """Insights straight from raw events (lazy; each action re-reads them)."""
    return insights_from(whole_quantities(op.dedup_events_counted(_project(raw))), unknown)


# The staged table's folders: the types the insights filter on, all others as
# one (``event_type`` itself is free text and would make a folder per value).
KINDS = (CLICK, ADD_TO_CART, PURCHASE, DELIVERY_STATUS)


def _of_kind(events: DataFrame, *kinds: str) -> DataFrame:
    """Cut a staged table to the folders of some types (others: as it is)."""
    return events.where(F.col("kind").isin(*kinds)) if "kind" in events.columns else events


def _fraction(items: str = "items", quantity: str = "quantity"):
    """Whether any quantity of a row is not a whole number."""
    part = lambda q: q.isNotNull() & (q != F.floor(q))
    inner = F.exists(items, lambda i: F.coalesce(part(i["quantity"]), F.lit(False)))
    return F.coalesce(inner, F.lit(False)) | F.coalesce(part(F.col(quantity)), F.lit(False))


def _as_whole(counted: DataFrame) -> DataFrame:
    items = F.transform(
        "items",
        lambda i: F.when(
            i.isNotNull(),
            F.struct(i["product_id"].alias("product_id"), i["quantity"].cast("bigint").alias("quantity"), i["price"].alias("price")),
        ),
    )
    return counted.withColumns({"quantity": F.col("quantity").cast("bigint"), "items": items})


def whole_quantities(counted: DataFrame) -> DataFrame:
    """Quantities as ``bigint`` if every one is a whole number (units then
    print like 12), else as they are.  Decided over all rows, as an inferred
    schema would be."""
    return counted if counted.where(_fraction()).limit(1).count() else _as_whole(counted)


#: Marked places (and hashes of repeated ids) up to this number are broadcast, 16 bytes each.
BROADCAST_MARKS = 2_000_000
MAX_BUCKETS = 50_000


@dataclass
class Staged:
    """The staged events: ``rows`` as written (with places), the ``marks`` of
    repeated ones (None if there are none), what the write counted, and the
    catalog tables that name the ``folders``."""

    rows: DataFrame
    marks: DataFrame | None
    counts: dict[str, int]
    tables: list[str]
    folders: list[str]

    @property
    def events(self) -> DataFrame:
        """One row per event id, with ``_copies`` and ``_corrupt``."""
        return op.drop_marked(self.rows if self.counts["fractions"] else _as_whole(self.rows), self.marks)

    @property
    def stats(self) -> DataFrame:
        """``dedup_stats`` of the raw rows, from the counts: no scan."""
        c = self.counts
        row = (c["rows"], c["rows"] - c["removed"], c["removed"], c["corrupt"])
        names = ("rows_read", "rows_after", "duplicates_removed", "corrupt")
        return self.rows.sparkSession.createDataFrame([row], ", ".join(f"{n} bigint" for n in names))

    def remove(self) -> None:
        """Remove the tables and their folders, once nothing reads them."""
        spark = self.rows.sparkSession
        for name in self.tables:
            spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        for folder in self.folders:
            remove_dir(spark, folder)


def _save(df: DataFrame, path: str, buckets: int, *partitions: str) -> str:
    """Write ``df`` to ``path`` bucketed by ``_slot``; the catalog name."""
    spark, name = df.sparkSession, f"cartwheel_staged_{uuid.uuid4().hex[:12]}"
    writer = df.write.mode("overwrite").bucketBy(buckets, SLOT).option("path", path)
    # one open file per kind instead of a sort of whole rows by kind
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(2 * len(KINDS)))
    try:
        (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(name)
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
    return name


def stage(spark: SparkSession, raw: DataFrame, path: str) -> Staged:
    """Read the raw files once: cut the rows to the columns the insights use
    and write them to ``path`` in the shared folder, then find the repeated
    ids.  The lineage is cut there (a lost executor costs a re-read of Parquet,
    not of the JSON).

    No whole row is shuffled or sorted.  The rows are written by the tasks that
    read them, in one folder per kind of event (the four types that insights
    filter on, and ``other``; a filter on the kind prunes whole folders) and in
    the bucket of their task.  Rows, malformed lines and fractional quantities
    are counted by that write (an ``Observation``: a task that is run again
    counts once).  The ids alone then give the marks of repeated rows
    (``operators.mark_repeats``).  Few marks are broadcast to the scans; many
    are bucketed like the rows and meet them bucket by bucket."""
    path = path.rstrip("/")
    kind = F.when(F.col("event_type").isin(*KINDS), F.col("event_type")).otherwise(F.lit("other"))
    bad = F.col(CORRUPT_COLUMN).isNotNull() if CORRUPT_COLUMN in raw.columns else F.lit(False)
    rows = op.with_places(_project(raw).withColumns({"kind": kind, "_corrupt": bad.cast("bigint")})).drop(CORRUPT_COLUMN)
    seen = Observation()
    counted = rows.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("_corrupt"), F.lit(0)).cast("bigint").alias("corrupt"),
        F.count_if(_fraction()).alias("fractions"),
    )
    buckets = min(MAX_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    tables, folders = [_save(counted, path, buckets, "kind")], [path]
    written, counts = spark.table(tables[0]), {**seen.get, "removed": 0}

    hashes = op.repeated_hashes(written).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        repeated = hashes.count()
        if not repeated:
            return Staged(written, None, counts, tables, folders)
        found = op.mark_repeats(written, F.broadcast(hashes) if repeated <= BROADCAST_MARKS else hashes)
        copies = Observation()
        found = found.observe(
            copies, F.count(F.lit(1)).alias("n"), F.count_if(F.col("_copies") == 0).alias("removed")
        )
        folders.append(f"{path}_marks")
        found.write.mode("overwrite").parquet(folders[-1])
    finally:
        hashes.unpersist()
    counts.update(removed=copies.get["removed"], marks=copies.get["n"])
    marks = spark.read.schema(found.schema).parquet(folders[-1])
    if counts["marks"] <= BROADCAST_MARKS:
        return Staged(written, F.broadcast(marks), counts, tables, folders)
    # both sides stay in their buckets by _slot for the join on (_slot, _place)
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    folders.append(f"{path}_marks_bucketed")
    tables.append(_save(marks.repartition(buckets, SLOT), folders[-1], buckets))
    return Staged(written, spark.table(tables[-1]).hint("shuffle_hash"), counts, tables, folders)


def stage_events(spark: SparkSession, raw: DataFrame, path: str) -> DataFrame:
    """``stage``, as the de-duplicated events with copy counts."""
    return stage(spark, raw, path).events


def write_insights(
    spark: SparkSession, ins: Insights, output: str, database: str | None = None, original_names: bool = False
) -> None:
    """SNK1 + SNK2 (+ SNK11 when ``database`` is given).  With
    ``original_names`` the files, Parquet and CSV, go to folders and under
    column names as the original job wrote them (``faturamento_categoria``:
    ``category, faturamento, unidades_vendidas``, ...)."""
    out = output.rstrip("/")
    for name, df in ins.frames().items():
        folder, columns = ORIGINAL_INSIGHT_NAMES[name] if original_names else (name, {})
        files.write_parquet_single(df, f"{out}/{folder}", columns)
        if name in ("revenue_by_category", "revenue_by_city"):
            files.write_csv_single(df, f"{out}/csv/{folder}", columns)
    if database and original_names:
        raise ValueError("the catalog tables read the English names; the original ones are views there")
    if database:
        tables.register_insights(spark, database, out)


def upsert_insights(kv: KeyValueStore, ins: Insights) -> None:
    """SNK5 + SNK6: category and city rows (abandonment and status are not
    put, as in the original job)."""
    cat = ins.by_category
    kv.put(op.to_cells(cat, KV_TABLE_CATEGORY, cat["category"], CATEGORY_CELLS), KV_TABLE_CATEGORY)
    city = ins.by_city
    # str.format of a missing value prints "None"
    row_key = F.concat(
        F.coalesce(city["state"], F.lit("None")), F.lit("#"), F.coalesce(city["city"], F.lit("None"))
    )
    kv.put(op.to_cells(city, KV_TABLE_CITY, row_key, CITY_CELLS), KV_TABLE_CITY)


def _note(staged: Staged) -> dict:
    """What a later run needs to go on from the staged events."""
    marks = staged.folders[1] if len(staged.folders) > 1 else None
    return {"rows": staged.folders[0], "marks": marks, "counts": staged.counts, "folders": staged.folders}


def _staged_again(spark: SparkSession, note: dict) -> Staged:
    """The staged events of an earlier run, from their folders."""
    marks = None
    if note["marks"]:
        marks = spark.read.parquet(note["marks"])
        marks = F.broadcast(marks) if note["counts"]["marks"] <= BROADCAST_MARKS else marks
    return Staged(spark.read.parquet(note["rows"]), marks, note["counts"], [], note["folders"])


def run(
    spark: SparkSession,
    input_path: str,
    output: str,
    kv_root: str | None = None,
    database: str | None = None,
    show: bool = True,
    staging: str | None = None,
    original_names: bool = False,
    publish: bool = False,
    resume: bool = False,
) -> Insights:
    """The whole batch job.  ``staging`` defaults to a new folder under
    ``spark.checkpoint.dir``; the result's ``staged.remove()`` clears it.

    With ``publish`` the catalog tables are switched from one whole result to
    the next (``sinks.publish``) instead of naming the output folders.  With
    ``resume`` a run over input files that have not changed since goes on
    from the staged events, or from the results, of one that did not end."""
    manifest = Manifest(spark, "etl", input_path) if resume else None
    note = manifest.done("staged") if manifest else None
    if note:
        staged = _staged_again(spark, note)
    else:
        staged = stage(spark, read_events(spark, input_path), staging or job_dir(spark, "etl"))
        if manifest:
            manifest.finish("staged", **_note(staged))
    ins = insights_from(staged.events, stats=staged.stats)
    ins.staged = staged
    if manifest:
        _keep_results(spark, ins, manifest)
    for df in (ins.stats, *ins.frames().values()):
        df.persist(StorageLevel.MEMORY_AND_DISK)
    s = ins.stats.first()
    print(
        f"[etl] rows read={s['rows_read']} after dedup={s['rows_after']} "
        f"duplicates removed={s['duplicates_removed']} corrupt={s['corrupt']}"
    )
    write_insights(spark, ins, output, None if publish else database, original_names)
    if publish and database:
        publish_insights(spark, ins.frames(), database, f"{output.rstrip('/')}/tables")
    if kv_root:
        upsert_insights(KeyValueStore(spark, kv_root), ins)
    if show:
        for name, df in ins.frames().items():
            files.show_all(df, f"[etl] {name}:")
    return ins


def _keep_results(spark: SparkSession, ins: Insights, manifest: Manifest) -> None:
    """The four results as files, written once per manifest; ``ins`` reads
    them from there."""
    note = manifest.done("results")
    folder = note["folder"] if note else f"{ins.staged.folders[0]}_results"
    for field, (name, df) in zip(("by_category", "by_city", "abandonment", "status"), ins.frames().items()):
        if not note:
            df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")
        setattr(ins, field, spark.read.schema(df.schema).parquet(f"{folder}/{name}"))
    if not note:
        manifest.finish("results", folder=folder)
    ins.staged.folders.extend([folder, manifest.root])


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Batch insights over a landing folder of JSON-lines events")
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--kv-root", default=None)
    ap.add_argument("--database", default=None)
    ap.add_argument("--original-names", action="store_true", help="file and column names of the original job")
    ap.add_argument("--publish", action="store_true", help="switch the catalog tables to the new results once they are whole")
    ap.add_argument("--resume", action="store_true", help="go on from what an earlier run over the same files has finished")
    args = ap.parse_args(argv)
    spark = build_session(app_name="cartwheel-etl")
    try:
        ins = run(
            spark,
            args.input,
            args.output,
            args.kv_root,
            args.database,
            original_names=args.original_names,
            publish=args.publish,
            resume=args.resume,
        )
        for df in (ins.stats, *ins.frames().values()):
            df.unpersist()
        ins.staged.remove()
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
