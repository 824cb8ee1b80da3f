"""The named query set run by the driver, the benchmark and the tests.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables; ``ORACLE_SQL`` holds the equivalent DuckDB SQL for the ones
that have one.  Column names are the same on both sides.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel import operators as op
from cartwheel.config import shared_dir
from cartwheel.functions.money import money_parts
from cartwheel.functions.text import python_text
from cartwheel.plans import standin
from cartwheel.plans.etl import insights_from, stage_events
from cartwheel.plans.verify import check
from cartwheel.schema import (
    ALERT_CELLS,
    CATEGORY_CELLS,
    CITY_CELLS,
    CITY_OUT,
    KV_TABLE_ALERTS,
    KV_TABLE_CATEGORY,
    KV_TABLE_CITY,
    ORIGINAL_INSIGHT_NAMES,
)
from cartwheel.sinks.files import write_csv_single, write_parquet_single
from cartwheel.sinks.kvstore import BucketedStore, KeyValueStore
from cartwheel.sinks.publish import publish
from cartwheel.sinks.tables import (
    create_database,
    create_external_table,
    register_insights,
    register_original_names,
)
from cartwheel.sources.events import read_events
from cartwheel.sources.lines import count_lines, files_by_name, read_lines
from cartwheel.sources.tables import read_table
from cartwheel.streaming.cart import current_carts, start_cart
from cartwheel.streaming.growth import GrowthStream
from cartwheel.streaming.landing import start_landing
from cartwheel.streaming.restart import run_with_restarts
from cartwheel.streaming.trending import alert_cells as trending_alert_cells
from cartwheel.streaming.trending import start_trending, stream_settings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Add a query (and its SQL).  The registered callable first pins the
    session time zone to UTC: the driver tables hold time-zone-less
    timestamps, and windows, days and ISO texts are defined in UTC."""

    def deco(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
                spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


# --- insights --------------------------------------------------------------


@register(
    "revenue_by_category",
    """
    SELECT coalesce(c.category, 'desconhecida') AS category,
           round(fsum(l.l_quantity * l.l_extendedprice), 2) AS revenue, sum(l.l_quantity) AS units
    FROM lineitem l
    LEFT JOIN (SELECT p_partkey, p_type AS category FROM part
               WHERE CAST(p_partkey AS VARCHAR) IN (SELECT json_extract_string(props, '$.k') FROM events
                                                    WHERE event_type IN ('click', 'view'))) c
      ON l.l_partkey = c.p_partkey
    GROUP BY 1
    """,
)
def revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = op.derive_catalog(standin.catalog_events(spark, sf_dir), order_by=("event_id",))
    return op.revenue_by_category(standin.items(spark, sf_dir), catalog)


@register(
    "revenue_by_city",
    """
    SELECT n.n_name AS city, r.r_name AS state,
           round(fsum(o.o_totalprice), 2) AS revenue, count(*) AS orders
    FROM orders o
    JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON c.c_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
    GROUP BY 1, 2
    """,
)
def revenue_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Orders are summed per customer before the place join: the join and its
    # shuffle see one row per customer, and a customer with a third of all
    # orders is combined inside each task first.
    per_customer = standin.orders(spark, sf_dir).groupBy("customer_id").agg(
        *money_parts("total", "total"), F.count(F.lit(1)).alias("n_orders")
    )
    placed = per_customer.join(standin.places(spark, sf_dir), "customer_id")
    return op.revenue_by_city(placed, amount="total", orders="n_orders")


@register(
    "abandonment",
    """
    WITH s AS (
      SELECT user_id, CAST(ts AS DATE) AS d,
             bool_or(event_type = 'click') AS cart,
             bool_or(event_type = 'purchase') AS bought
      FROM events WHERE event_type IN ('click', 'purchase')
      GROUP BY 1, 2)
    SELECT count(*) AS sessions_with_cart,
           CAST(sum(CASE WHEN bought THEN 1 ELSE 0 END) AS BIGINT) AS sessions_bought,
           round(100 * (1 - sum(CASE WHEN bought THEN 1 ELSE 0 END) / count(*)), 2) AS abandonment_pct
    FROM s WHERE cart
    """,
)
def abandonment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.abandonment(standin.events(spark, sf_dir), cart_type="click", purchase_type="purchase")


@register(
    "delivery_status",
    "SELECT o_orderstatus AS delivery_status, count(*) AS total FROM orders GROUP BY 1",
)
def delivery_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.delivery_status_counts(standin.orders(spark, sf_dir), event_type=None)


@register(
    "derived_catalog",
    """
    SELECT json_extract_string(props, '$.k') AS product_id, arg_min(event_type, event_id) AS category
    FROM events WHERE event_type IN ('click', 'view') GROUP BY 1
    """,
)
def derived_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = standin.events(spark, sf_dir).where(F.col("event_type").isin("click", "view"))
    return op.derive_catalog(src.withColumn("category", F.col("event_type")), order_by=("event_id",))


# Re-sent events: every purchase event arrives twice.
_RAW_SQL = "(SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'purchase')"


def _raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = standin.table(spark, sf_dir, "events")
    return e.unionByName(e.where(F.col("event_type") == "purchase"))


@register(
    "dedup_stats",
    f"""
    SELECT count(*) AS rows_read,
           (SELECT count(*) FROM (SELECT DISTINCT event_id FROM {_RAW_SQL})) AS rows_after,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT event_id FROM {_RAW_SQL})) AS duplicates_removed,
           CAST(0 AS BIGINT) AS corrupt
    FROM {_RAW_SQL}
    """,
)
def dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.dedup_stats(_raw_events(spark, sf_dir))


@register("dedup_events", f"SELECT DISTINCT * FROM {_RAW_SQL}")
def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.dedup_events(_raw_events(spark, sf_dir))


@register(
    "dedup_events_preferred",
    """
    SELECT event_id, ts, user_id, event_type, value, props FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn
      FROM events) WHERE rn = 1
    """,
)
def dedup_events_preferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    # de-duplicate on a non-unique key with a deterministic survivor: the
    # first event of each (user, type)
    e = standin.table(spark, sf_dir, "events")
    return op.dedup_events(e, key=("user_id", "event_type"), prefer=("ts", "event_id"))


# --- items and orders -----------------------------------------------------


@register(
    "order_total",
    """
    WITH s AS (SELECT l_orderkey, round(fsum(l_quantity * l_extendedprice), 2) AS t FROM lineitem GROUP BY 1),
         o AS (SELECT o_orderkey, coalesce(s.t, 0.0) AS t,
                      CASE WHEN o_orderkey % 2 = 0 THEN coalesce(s.t, 0.0) ELSE o_totalprice END AS total
               FROM orders LEFT JOIN s ON o_orderkey = s.l_orderkey)
    SELECT o_orderkey AS order_id, t AS items_total, total, t = round(total, 2) AS total_matches FROM o
    """,
)
def order_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.order_totals_from_items(standin.items(spark, sf_dir), standin.checked_orders(spark, sf_dir))


@register(
    "item_subtotals",
    """
    SELECT l_orderkey AS order_id, l_partkey AS product_id, l_quantity AS quantity,
           l_extendedprice AS price, l_quantity * l_extendedprice AS subtotal
    FROM lineitem
    """,
)
def item_subtotals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.with_subtotal(standin.items(spark, sf_dir))


@register(
    "cart_state",
    """
    SELECT user_id, product_id, value FROM (
      SELECT user_id, json_extract_string(props, '$.k') AS product_id, value,
             row_number() OVER (PARTITION BY user_id, json_extract_string(props, '$.k')
                                ORDER BY ts DESC, event_id DESC) AS rn
      FROM events WHERE event_type = 'click') WHERE rn = 1
    """,
)
def cart_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.cart_state(
        standin.events(spark, sf_dir),
        session="user_id",
        product="product_id",
        values=("value",),
        order_by=("event_time", "event_id"),
        cart_type="click",
    )


# --- trending windows -----------------------------------------------------
# The event table is sparse for 60 s windows, so the stand-in queries use
# 1-day windows sliding by 12 hours; the operator is the same.

STANDIN_SIZE, STANDIN_SLIDE = "1 day", "12 hours"
_WINDOWS_SQL = """
    SELECT ws AS window_start, ws + INTERVAL 1 DAY AS window_end, product_id, count(*) AS events
    FROM (SELECT json_extract_string(props, '$.k') AS product_id,
                 time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01') - i * INTERVAL 12 HOUR AS ws
          FROM events, range(2) AS t(i)
          WHERE event_type IN ('click', 'view'))
    GROUP BY 1, 2, 3
"""
_CLOSED_SQL = f"""
    SELECT * FROM ({_WINDOWS_SQL})
    WHERE window_end <= (SELECT max(ts) FROM events WHERE event_type IN ('click', 'view')) - INTERVAL 40 SECOND
"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        standin.events(spark, sf_dir)
        .where(F.col("event_type").isin("click", "view"))
        .select("event_type", "product_id", "event_time")
    )


def _ntz(counts: DataFrame) -> DataFrame:
    return counts.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "product_id",
        "events",
    )


@register("trending", _WINDOWS_SQL)
def trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(op.trending_counts(_records(spark, sf_dir), STANDIN_SIZE, STANDIN_SLIDE))


@register("trending_paned", _WINDOWS_SQL)
def trending_paned(spark: SparkSession, sf_dir: str) -> DataFrame:
    # AG15 + ST4 of a batch: every event counted once, windows from panes
    return _ntz(op.trending_counts_paned(_records(spark, sf_dir), STANDIN_SIZE, STANDIN_SLIDE))


@register(
    "alerts",
    f"""
    SELECT product_id || '-' || CAST(epoch_ms(window_start) AS VARCHAR) AS row_key,
           product_id, events,
           strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') AS window_start_iso,
           strftime(window_end, '%Y-%m-%dT%H:%M:%SZ') AS window_end_iso
    FROM ({_WINDOWS_SQL}) WHERE events >= 5
    """,
)
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.alerts(op.trending_counts(_records(spark, sf_dir), STANDIN_SIZE, STANDIN_SLIDE), 5)


@register(
    "trending_lines",
    f"""
    SELECT 'janela=[' || strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') || ' -> '
           || strftime(window_end, '%Y-%m-%dT%H:%M:%SZ') || '] produto=' || product_id
           || ' eventos=' || CAST(events AS VARCHAR) AS value
    FROM ({_WINDOWS_SQL})
    """,
)
def trending_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.trending_text(op.trending_counts(_records(spark, sf_dir), STANDIN_SIZE, STANDIN_SLIDE))


# --- delivery check -------------------------------------------------------
# Source: every event, purchases sent twice.  Sink: error events lost,
# signup events also arriving under a foreign id (-id - 1).

_SRC_IDS_SQL = "(SELECT event_id FROM events UNION ALL SELECT event_id FROM events WHERE event_type = 'purchase')"
_SINK_IDS_SQL = (
    "(SELECT event_id FROM events WHERE event_type <> 'error' "
    "UNION ALL SELECT -event_id - 1 AS event_id FROM events WHERE event_type = 'signup')"
)


def _source_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw_events(spark, sf_dir).select("event_id")


def _sink_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = standin.table(spark, sf_dir, "events")
    return (
        e.where(F.col("event_type") != "error")
        .select("event_id")
        .unionByName(e.where(F.col("event_type") == "signup").select((-F.col("event_id") - 1).alias("event_id")))
    )


@register(
    "id_multiplicity",
    f"""
    SELECT coalesce(s.event_id, k.event_id) AS event_id,
           coalesce(s.n, 0) AS source_n, coalesce(k.n, 0) AS sink_n
    FROM (SELECT event_id, count(*) AS n FROM {_SRC_IDS_SQL} GROUP BY 1) s
    FULL OUTER JOIN (SELECT event_id, count(*) AS n FROM {_SINK_IDS_SQL} GROUP BY 1) k
      ON s.event_id = k.event_id
    """,
)
def id_multiplicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.id_multiplicity(_source_ids(spark, sf_dir), _sink_ids(spark, sf_dir))


@register(
    "reconcile_ids",
    f"""
    WITH s AS (SELECT event_id, count(*) AS n FROM {_SRC_IDS_SQL} GROUP BY 1),
         k AS (SELECT event_id, count(*) AS n FROM {_SINK_IDS_SQL} GROUP BY 1)
    SELECT (SELECT count(*) FROM k WHERE event_id NOT IN (SELECT event_id FROM s)) AS foreign_ids,
           (SELECT CAST(coalesce(sum(greatest(0, s.n - coalesce(k.n, 0))), 0) AS BIGINT)
              FROM s LEFT JOIN k ON s.event_id = k.event_id) AS missing_rows
    """,
)
def reconcile_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.reconcile_ids(_source_ids(spark, sf_dir), _sink_ids(spark, sf_dir))


register("reconcile_digest", ORACLE_SQL["reconcile_ids"])(
    lambda spark, sf_dir: op.reconcile_by_digest(_source_ids(spark, sf_dir), _sink_ids(spark, sf_dir))
)


@register("id_differences", f"SELECT * FROM ({ORACLE_SQL['id_multiplicity']}) WHERE source_n <> sink_n")
def id_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    # AG11 cut to the ids that differ, found by the digest tree
    return op.id_differences(_source_ids(spark, sf_dir), _sink_ids(spark, sf_dir))


# A sink that is all but whole: few events are lost, few come twice, few are foreign.
_FEW = (
    "(SELECT event_id FROM events WHERE event_id % 997 <> 0 UNION ALL "
    "SELECT event_id FROM events WHERE event_id % 1499 = 1 UNION ALL "
    "SELECT -event_id - 1 AS event_id FROM events WHERE event_id % 2003 = 2)"
)


def _nearly_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = standin.table(spark, sf_dir, "events").select("event_id")
    twice, foreign = e.where("event_id % 1499 = 1"), e.where("event_id % 2003 = 2").selectExpr("-event_id - 1 AS event_id")
    return e.where("event_id % 997 <> 0").unionByName(twice).unionByName(foreign)


@register(
    "id_differences_few",
    f"""
    SELECT coalesce(s.event_id, k.event_id) AS event_id, coalesce(s.n, 0) AS source_n, coalesce(k.n, 0) AS sink_n
    FROM (SELECT event_id, count(*) AS n FROM events GROUP BY 1) s
    FULL OUTER JOIN (SELECT event_id, count(*) AS n FROM {_FEW} GROUP BY 1) k ON s.event_id = k.event_id
    WHERE coalesce(s.n, 0) <> coalesce(k.n, 0)
    """,
)
def id_differences_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.id_differences(standin.table(spark, sf_dir, "events").select("event_id"), _nearly_all(spark, sf_dir))


@register(
    "missing_rows_except_all",
    f"""
    SELECT count(*) AS missing_rows FROM (
      SELECT event_id FROM {_SRC_IDS_SQL} EXCEPT ALL SELECT event_id FROM {_SINK_IDS_SQL})
    """,
)
def missing_rows_except_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    # JN4 written as a multiset difference
    diff = _source_ids(spark, sf_dir).exceptAll(_sink_ids(spark, sf_dir))
    return diff.agg(F.count(F.lit(1)).alias("missing_rows"))


@register(
    "foreign_ids_anti_join",
    f"""
    SELECT DISTINCT event_id FROM {_SINK_IDS_SQL} k
    WHERE NOT EXISTS (SELECT 1 FROM {_SRC_IDS_SQL} s WHERE s.event_id = k.event_id)
    """,
)
def foreign_ids_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    # JN3 as a left anti join of the distinct sink ids
    src = _source_ids(spark, sf_dir).distinct()
    return _sink_ids(spark, sf_dir).distinct().join(src, "event_id", "left_anti")


@register(
    "growth",
    """
    WITH d AS (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS sample_ts,
                      count(*) AS s, count(*) FILTER (WHERE event_type <> 'error') AS k
               FROM events GROUP BY 1),
         c AS (SELECT sample_ts,
                      CAST(sum(s) OVER (ORDER BY sample_ts) AS BIGINT) AS source_rows,
                      CAST(sum(k) OVER (ORDER BY sample_ts) AS BIGINT) AS sink_rows
               FROM d)
    SELECT sample_ts, source_rows, sink_rows, source_rows - sink_rows AS difference,
           CASE WHEN lag(sink_rows) OVER (ORDER BY sample_ts) IS NULL THEN 'first sample'
                WHEN sink_rows > lag(sink_rows) OVER (ORDER BY sample_ts) THEN 'growing'
                ELSE 'stalled' END AS state
    FROM c
    """,
)
def growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.growth_report(_daily_samples(spark, sf_dir, F.col("event_type") != "error"))


def _daily_samples(spark: SparkSession, sf_dir: str, arrives) -> DataFrame:
    # Daily samples of the running source and sink counts.  The per-day
    # aggregation is distributed; the running sums and the lag then run
    # over the day series (one row per day).
    e = standin.events(spark, sf_dir)
    daily = e.groupBy(F.to_date("event_time").cast("timestamp_ntz").alias("sample_ts")).agg(
        F.count(F.lit(1)).alias("s"), F.count(F.when(arrives, 1)).alias("k")
    )
    upto = Window.orderBy("sample_ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(
        "sample_ts",
        F.sum("s").over(upto).cast("bigint").alias("source_rows"),
        F.sum("k").over(upto).cast("bigint").alias("sink_rows"),
    )


@register(
    "growth_ok",
    """
    WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) FILTER (WHERE event_type <> 'error') AS k
               FROM events GROUP BY 1)
    SELECT coalesce(bool_and(k > 0) FILTER (WHERE day > (SELECT min(day) FROM d)), true) AS ok FROM d
    """,
)
def growth_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.growth_ok(growth(spark, sf_dir))


@register(
    "growth_stalled",
    ORACLE_SQL["growth"].replace("event_type <> 'error'", "event_type <> 'error' AND day(ts) % 3 = 1"),
)
def growth_stalled(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a sink that receives nothing on two days out of three
    arrives = (F.col("event_type") != "error") & (F.dayofmonth("event_time") % 3 == 1)
    return op.growth_report(_daily_samples(spark, sf_dir, arrives))


@register(
    "growth_stream",
    """
    WITH b AS (SELECT day(ts) % 4 AS b, count(*) AS n FROM events GROUP BY 1)
    SELECT CAST(sum(n) OVER (ORDER BY b) AS BIGINT) AS sink_rows,
           CASE WHEN lag(n) OVER (ORDER BY b) IS NULL THEN 'first sample' ELSE 'growing' END AS state
    FROM b
    """,
)
def growth_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # WF2 + SRC4 from a stream's progress: the events land in four goes, so
    # many files each; every go is a micro-batch and a sample
    lines = standin.event_json_from(standin.events(spark, sf_dir), "day")
    root, files = shared_dir(spark, "growth", unique=True), 4
    for go in range(4):
        lines.where(F.col("day") % 4 == go).select("value").repartition(files).write.mode("append").text(f"{root}/sink")
    report = GrowthStream(spark, f"{root}/sink", f"{root}/state").sample(max_files_per_trigger=files)
    return report.select("sink_rows", "state")


# --- key-value cells --------------------------------------------------------

_LATEST_SQL = """
    SELECT user_id, event_type, value FROM (
      SELECT user_id, event_type, value,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1
"""


@register(
    "kv_upsert",
    f"""
    SELECT 'user_last_value' AS "table", CAST(user_id AS VARCHAR) AS row_key,
           'cf:' || event_type AS "column", CAST(value AS VARCHAR) AS value
    FROM ({_LATEST_SQL})
    """,
)
def kv_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    # every event is a put of cell cf:<type> under its user; the newest put
    # per cell wins
    e = standin.events(spark, sf_dir)
    cells = e.select(
        F.lit("user_last_value").alias("table"),
        F.col("user_id").cast("string").alias("row_key"),
        F.concat(F.lit("cf:"), "event_type").alias("column"),
        python_text("value").alias("value"),
        "event_time",
        "event_id",
    )
    return op.latest_cells(cells, ["event_time", "event_id"])


def _kv_store(spark: SparkSession, name: str) -> KeyValueStore:
    return KeyValueStore(spark, shared_dir(spark, "kv", name, unique=True))


@register(
    "kv_store",
    f"""
    WITH l AS ({_LATEST_SQL})
    SELECT 'user_value' AS "table", CAST(user_id AS VARCHAR) AS row_key, 'cf:last' AS "column",
           CAST(coalesce(max(value) FILTER (WHERE event_type = 'view'),
                         max(value) FILTER (WHERE event_type = 'click')) AS VARCHAR) AS value
    FROM l WHERE event_type IN ('click', 'view') GROUP BY user_id
    """,
)
def kv_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Two puts into one key-value table: the newest click value per user,
    # then the newest view value per user under the same cell.  The second
    # put replaces the cell where a user has a view and leaves it otherwise;
    # replaying the second put changes nothing.  The cells are aggregated
    # once and staged.
    staged = shared_dir(spark, "kv", "latest", unique=True)
    kv_upsert(spark, sf_dir).write.parquet(staged)
    latest = spark.read.parquet(staged)
    store = _kv_store(spark, "user_value")
    for name, kind in (("1", "cf:click"), ("2", "cf:view"), ("2", "cf:view")):
        cells = latest.where(F.col("column") == kind).select(
            "row_key", F.lit("cf:last").alias("column"), "value"
        )
        store.put(cells, "user_value", name)
    return store.read("user_value")


@register("kv_store_bucketed", ORACLE_SQL["kv_store"])
def kv_store_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the puts of kv_store into a table bucketed by row key: read without a shuffle
    root = shared_dir(spark, "kv", "bucketed", unique=True)
    db = "cartwheel_kv_" + root.rsplit("/", 1)[-1]
    create_database(spark, db, f"{root}/{db}.db")
    store = BucketedStore(spark, root, db, buckets=8)
    staged = shared_dir(spark, "kv", "latest", unique=True)
    kv_upsert(spark, sf_dir).write.parquet(staged)
    latest = spark.read.parquet(staged)
    for name, kind in (("1", "cf:click"), ("2", "cf:view"), ("2", "cf:view")):
        cells = latest.where(F.col("column") == kind).select("row_key", F.lit("cf:last").alias("column"), "value")
        store.put(cells, "user_value", name)
    return store.read("user_value")


@register(
    "kv_row_count",
    """
    SELECT 'user_value' AS "table", count(DISTINCT user_id) AS rows FROM events
    """,
)
def kv_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _kv_store(spark, "count")
    store.create_table("user_value")
    store.put(kv_upsert(spark, sf_dir).select("row_key", "column", "value"), "user_value")
    return store.row_count("user_value")


# --- files, landing and streams over JSON lines derived from the tables ----


def _lines_dir(spark: SparkSession, df: DataFrame, name: str) -> str:
    return standin.write_lines(df, shared_dir(spark, "standin", name, unique=True))


def _event_lines(spark: SparkSession, sf_dir: str) -> str:
    return _lines_dir(spark, standin.event_json(spark, sf_dir), "events_json")


_TYPE_COUNTS_SQL = """
    SELECT CASE event_type WHEN 'view' THEN 'add_to_cart' ELSE event_type END AS event_type,
           count(*) AS count
    FROM events GROUP BY 1
"""


@register("event_type_counts", _TYPE_COUNTS_SQL)
def event_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = op.inspect_lines(read_lines(spark, _event_lines(spark, sf_dir)))
    return op.event_type_counts(lines)


def _delivery_dirs(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Source: every event line, purchases twice.  Sink: one file per day of
    the month, lines in the order of event ids; error events arrive cut short
    (broken lines), signup events also arrive under a foreign id."""
    e = standin.events(spark, sf_dir)
    src = standin.event_json_from(e.unionByName(e.where(F.col("event_type") == "purchase")))
    foreign = e.where(F.col("event_type") == "signup").withColumn("event_id", -F.col("event_id") - 1)
    sent = e.unionByName(foreign)
    lines = standin.event_json_from(sent, "day", "event_id", "event_type").withColumn(
        "value",
        F.when(F.col("event_type") == "error", F.expr("substring(value, 1, length(value) - 2)")).otherwise(F.col("value")),
    )
    sink = shared_dir(spark, "standin", "sink", unique=True)
    (
        lines.repartition("day")
        .sortWithinPartitions("day", "event_id")
        .select("day", "value")
        .write.partitionBy("day")
        .text(sink)
    )
    return _lines_dir(spark, src, "source"), sink


def _delivery_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, sink = _delivery_dirs(spark, sf_dir)
    return check(spark, source, sink)[0]


_DELIVERY_SQL = """
    WITH sent AS (
        SELECT event_id, event_type, day(ts) AS d FROM events
        UNION ALL SELECT -event_id - 1, event_type, day(ts) FROM events WHERE event_type = 'signup'),
    files AS (
        SELECT d, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS bad,
               CAST(arg_max(event_type, event_id) = 'error' AS BIGINT) AS last_bad
        FROM sent GROUP BY d),
    src AS (
        SELECT count(*) + count(*) FILTER (WHERE event_type = 'purchase') AS source_rows,
               count(*) FILTER (WHERE event_type = 'signup') AS foreign_ids,
               count(*) FILTER (WHERE event_type IN ('purchase', 'error')) AS missing_rows
        FROM events)
    SELECT any_value(source_rows) AS source_rows, count(*) AS sink_files, CAST(sum(n) AS BIGINT) AS sink_rows,
           CAST(sum(bad - last_bad) AS BIGINT) AS invalid, CAST(sum(last_bad) AS BIGINT) AS incomplete_last,
           any_value(foreign_ids) AS foreign_ids, any_value(missing_rows) AS missing_rows, false AS ok
    FROM files, src
"""

register("delivery_report", _DELIVERY_SQL)(_delivery_report)


@register(
    "delivery_report_ok",
    """
    SELECT count(*) AS source_rows, count(DISTINCT day(ts)) AS sink_files, count(*) AS sink_rows,
           CAST(0 AS BIGINT) AS invalid, CAST(0 AS BIGINT) AS incomplete_last,
           CAST(0 AS BIGINT) AS foreign_ids, CAST(0 AS BIGINT) AS missing_rows, true AS ok
    FROM events
    """,
)
def delivery_report_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a sink that has every line, one file per day of the month
    lines = standin.event_json_from(standin.events(spark, sf_dir), "day")
    sink = shared_dir(spark, "standin", "clean_sink", unique=True)
    lines.repartition("day").write.partitionBy("day").text(sink)
    return check(spark, _lines_dir(spark, lines.select("value"), "clean_source"), sink)[0]


@register(
    "line_counts",
    """
    SELECT day(ts) AS day, count(*) AS lines FROM events GROUP BY 1
    UNION ALL SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT)
    """,
)
def line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # SRC4 + SO5: lines per file of a folder, files in name order; a path
    # that does not exist has none (day 0)
    lines = standin.event_json_from(standin.events(spark, sf_dir), "day")
    folder = shared_dir(spark, "standin", "counted", unique=True)
    lines.repartition("day").write.partitionBy("day").text(folder)
    day = lambda c: F.regexp_extract(c, "day=([0-9]+)", 1).cast("bigint").alias("day")
    counted = read_lines(spark, folder).groupBy(day("file").alias("day")).agg(F.count(F.lit(1)).alias("lines"))
    named = files_by_name(spark, folder).select(day("path")).join(counted, "day", "left")
    none = spark.createDataFrame([(0, count_lines(spark, f"{folder}/no-such-folder"))], "day bigint, lines bigint")
    return named.select("day", F.coalesce("lines", F.lit(0)).alias("lines")).unionByName(none)


@register(
    "delivery_report_totals",
    """
    SELECT count(*) + count(*) FILTER (WHERE event_type = 'purchase') AS source_rows,
           count(*) + count(*) FILTER (WHERE event_type = 'signup') AS sink_rows,
           count(*) FILTER (WHERE event_type = 'error') AS bad_lines,
           count(*) FILTER (WHERE event_type = 'signup') AS foreign_ids,
           count(*) FILTER (WHERE event_type IN ('purchase', 'error')) AS missing_rows,
           false AS ok
    FROM events
    """,
)
def delivery_report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _delivery_report(spark, sf_dir)
    return r.select(
        "source_rows",
        "sink_rows",
        (F.col("invalid") + F.col("incomplete_last")).alias("bad_lines"),
        "foreign_ids",
        "missing_rows",
        "ok",
    )


@register("landed_event_counts", _TYPE_COUNTS_SQL)
def landed_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _event_lines(spark, sf_dir)
    landing = shared_dir(spark, "landing", unique=True)
    q = start_landing(spark, src, f"{landing}/out", f"{landing}/checkpoint", available_now=True)
    q.awaitTermination()
    return op.event_type_counts(op.inspect_lines(read_lines(spark, f"{landing}/out")))


@register("stream_trending", _CLOSED_SQL)
def stream_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Event-time windows over a parquet stream of the event table with a
    # 40 s watermark; only windows the watermark closed are emitted.

    batch = standin.table(spark, sf_dir, "events")
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    reader = spark.readStream.schema(batch.schema)
    if any(f.rstrip("/").endswith("/events.parquet") for f in batch.inputFiles()):
        # the table is one file: stream the folder, taking only that file
        reader, path = reader.option("pathGlobFilter", "events.parquet"), sf_dir
    stream = reader.parquet(path)
    e = stream.select(
        "event_type",
        F.get_json_object("props", "$.k").alias("product_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
    ).where(F.col("event_type").isin("click", "view"))
    counts = op.trending_counts(e, STANDIN_SIZE, STANDIN_SLIDE, watermark="40 seconds")
    out = shared_dir(spark, "stream_trending", unique=True)
    with stream_settings(spark):
        q = (
            counts.writeStream.outputMode("append")
            .format("parquet")
            .option("checkpointLocation", f"{out}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{out}/data")
        )
    q.awaitTermination()
    return _ntz(spark.read.schema(counts.schema).parquet(f"{out}/data"))


def _trending_job(spark: SparkSession, src: str, out: str, run: str = "", **options) -> KeyValueStore:
    """The full trending job (text lines -> windows -> lines + alerts) over
    what has landed in ``src``; ``run`` names its checkpoint."""
    kv = KeyValueStore(spark, f"{out}/kv")
    q = start_trending(
        spark,
        src,
        f"{out}/lines",
        f"{out}/checkpoint{run}",
        kv=kv,
        size=STANDIN_SIZE,
        slide=STANDIN_SLIDE,
        delay="40 seconds",
        threshold=5,
        available_now=True,
        **options,
    )
    q.awaitTermination()
    return kv


_LINE_SQL = """
    SELECT 'janela=[' || strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') || ' -> '
           || strftime(window_end, '%Y-%m-%dT%H:%M:%SZ') || '] produto=' || product_id
           || ' eventos=' || CAST(events AS VARCHAR) AS value
"""


@register("stream_lines", f"{_LINE_SQL} FROM ({_CLOSED_SQL})")
def stream_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "trending_job", unique=True)
    _trending_job(spark, _event_lines(spark, sf_dir), out)
    return spark.read.text(f"{out}/lines").select("value")


@register("stream_lines_two_runs", f"{_LINE_SQL} FROM ({_CLOSED_SQL}) UNION ALL {_LINE_SQL} FROM ({_CLOSED_SQL})")
def stream_lines_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # two streams (two checkpoints) into one folder: the second adds its
    # lines and leaves those of the first; the first once more adds nothing
    out = shared_dir(spark, "trending_runs", unique=True)
    src = _event_lines(spark, sf_dir)
    for run in ("-a", "-b", "-a"):
        _trending_job(spark, src, out, run)
    return spark.read.text(f"{out}/lines").select("value")


class _FirstPutFails(KeyValueStore):
    failed = False

    def put(self, cells: DataFrame, table: str, name: str | None = None) -> None:
        if not self.failed:
            self.failed = True
            raise OSError("key-value store not reachable")
        super().put(cells, table, name)


@register("stream_lines_restarted", f"{_LINE_SQL} FROM ({_CLOSED_SQL})")
def stream_lines_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    # ST8 + ST10: the first run fails (its output folder is on no known file
    # system) and is restarted from its checkpoint; there the alert put fails
    # once, which costs no line
    out = shared_dir(spark, "trending_restarted", unique=True)
    src = _event_lines(spark, sf_dir)
    kv = _FirstPutFails(spark, f"{out}/kv")
    folders = iter(["nowhere://lines"])

    def start():
        lines = next(folders, f"{out}/lines")
        sizes = {"size": STANDIN_SIZE, "slide": STANDIN_SLIDE, "delay": "40 seconds"}
        return start_trending(spark, src, lines, f"{out}/checkpoint", kv=kv, available_now=True, **sizes)

    if run_with_restarts(start, delay_seconds=0, max_attempts=2) != 1 or not kv.failed:
        raise RuntimeError("the stream was to fail once, and so was its alert put")
    return spark.read.text(f"{out}/lines").select("value")


# Three landings, one per micro-batch: the first half of the days, the
# second half, and every seventh event of all days (most of it late).  Signup
# and error events become lines that must be dropped: blank, malformed, and
# without a zone.
_LATE_SQL = f"""
    WITH days AS (SELECT CAST(min(ts) AS DATE) + CAST((CAST(max(ts) AS DATE) - CAST(min(ts) AS DATE)) // 2 AS INTEGER) AS mid
                  FROM events),
    rec AS (SELECT json_extract_string(props, '$.k') AS product_id, ts,
                   CASE WHEN event_id % 7 = 0 THEN 2 WHEN CAST(ts AS DATE) <= mid THEN 0 ELSE 1 END AS batch
            FROM events, days WHERE event_type IN ('click', 'view')),
    marks AS (SELECT b.batch, coalesce((SELECT max(ts) FROM rec WHERE batch < b.batch), TIMESTAMP '1970-01-02')
                              - INTERVAL 40 SECOND AS mark
              FROM (VALUES (0), (1), (2)) AS b(batch)),
    win AS (SELECT product_id, batch,
                   time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01') - i * INTERVAL 12 HOUR AS window_start
            FROM rec, range(2) AS t(i)),
    kept AS (SELECT product_id, window_start, window_start + INTERVAL 1 DAY AS window_end, count(*) AS events
             FROM win JOIN marks USING (batch)
             WHERE window_start + INTERVAL 1 DAY > mark GROUP BY 1, 2)
    {_LINE_SQL} FROM kept WHERE window_end <= (SELECT max(ts) FROM rec) - INTERVAL 40 SECOND
"""


_LATE_FILES = 4


@register("stream_late_rows", _LATE_SQL)
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = standin.events(spark, sf_dir)
    ends = e.agg(F.min("event_time").cast("date").alias("a"), F.max("event_time").cast("date").alias("b")).first()
    mid = ends["a"] + (ends["b"] - ends["a"]) // 2
    batch = (
        F.when(F.col("event_id") % 7 == 0, 2).when(F.to_date("event_time") <= F.lit(mid), 0).otherwise(1)
    )
    lines = standin.event_json_from(e.withColumn("batch", batch), "batch", "event_type")
    bad = (
        F.when(F.col("event_type") == "signup", F.lit("   "))
        .when(F.col("event_type") == "error", F.expr("substring(value, 1, length(value) - 2)"))
        .when(F.col("event_type") == "purchase", F.regexp_replace(F.replace("value", F.lit('"purchase"'), F.lit('"click"')), 'Z"', '"'))
        .otherwise(F.col("value"))
    )
    src = shared_dir(spark, "standin", "late", unique=True)
    for b in range(3):  # so many files each, landing one after the other
        lines.where(F.col("batch") == b).select(bad.alias("value")).repartition(_LATE_FILES).write.mode("append").text(src)
    out = shared_dir(spark, "trending_late", unique=True)
    _trending_job(spark, src, out, max_files_per_trigger=_LATE_FILES)
    return spark.read.text(f"{out}/lines").select("value")


_ALERT_CELLS_SQL = """
    SELECT '{table}' AS "table", product_id || '-' || CAST(epoch_ms(window_start) AS VARCHAR) AS row_key,
           'cf:' || c AS "column",
           CASE c WHEN 'produto' THEN product_id
                  WHEN 'eventos' THEN CAST(events AS VARCHAR)
                  WHEN 'janela_inicio' THEN strftime(window_start, '%Y-%m-%dT%H:%M:%SZ')
                  ELSE strftime(window_end, '%Y-%m-%dT%H:%M:%SZ') END AS value
    FROM ({windows}) w, (VALUES ('produto'), ('eventos'), ('janela_inicio'), ('janela_fim')) AS t(c)
    WHERE events >= 5
"""


@register("stream_alert_cells", _ALERT_CELLS_SQL.format(windows=_CLOSED_SQL, table=KV_TABLE_ALERTS))
def stream_alert_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "trending_job", unique=True)
    return _trending_job(spark, _event_lines(spark, sf_dir), out).read(KV_TABLE_ALERTS)


@register("alert_cells", _ALERT_CELLS_SQL.format(windows=_WINDOWS_SQL, table=KV_TABLE_ALERTS))
def alert_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trending_alert_cells(op.trending_counts(_records(spark, sf_dir), STANDIN_SIZE, STANDIN_SLIDE), 5)


def _b64(x: str) -> str:
    return f"to_base64(encode({x}))"


@register(
    "alert_payloads",
    f"""
    SELECT '{KV_TABLE_ALERTS}' AS "table", row_key,
           json_object('Row', [json_object('key', {_b64('row_key')}, 'Cell', [
               json_object('column', {_b64("'cf:produto'")}, '$', {_b64('product_id')}),
               json_object('column', {_b64("'cf:eventos'")}, '$', {_b64('CAST(events AS VARCHAR)')}),
               json_object('column', {_b64("'cf:janela_inicio'")}, '$', {_b64('s')}),
               json_object('column', {_b64("'cf:janela_fim'")}, '$', {_b64('e')})])])::VARCHAR AS payload
    FROM (SELECT product_id || '-' || CAST(epoch_ms(window_start) AS VARCHAR) AS row_key, product_id, events,
                 strftime(window_start, '%Y-%m-%dT%H:%M:%SZ') AS s, strftime(window_end, '%Y-%m-%dT%H:%M:%SZ') AS e
          FROM ({_WINDOWS_SQL}) WHERE events >= 5)
    """,
)
def alert_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op.alerts(op.trending_counts(_records(spark, sf_dir), STANDIN_SIZE, STANDIN_SLIDE), 5)
    return op.row_payloads(rows, KV_TABLE_ALERTS, rows["row_key"], ALERT_CELLS)


# --- insight outputs: Parquet + catalog table, CSV, key-value rows --------


@register("insight_table_category", ORACLE_SQL["revenue_by_category"])
def insight_table_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    # SNK1 + SNK11 + SRC6: one Parquet file, an external table over it, read
    # back by name

    root = shared_dir(spark, "insights", unique=True)
    write_parquet_single(revenue_by_category(spark, sf_dir), f"{root}/revenue_by_category")
    name = "revenue_by_category_" + root.rsplit("/", 1)[-1]
    create_external_table(
        spark,
        "cartwheel_standin",
        name,
        "category string, revenue double, units double",
        f"{root}/revenue_by_category",
        db_location=shared_dir(spark, "warehouse", "cartwheel_standin.db"),
    )
    return read_table(spark, name, "cartwheel_standin")


@register("csv_revenue_by_city", ORACLE_SQL["revenue_by_city"])
def csv_revenue_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    # SNK2: one CSV file with a header, read back with its schema

    path = shared_dir(spark, "csv", "revenue_by_city", unique=True)
    write_csv_single(revenue_by_city(spark, sf_dir), path)
    return spark.read.schema(CITY_OUT).option("header", True).csv(path)


@register(
    "csv_original_names",
    f"SELECT category, revenue AS faturamento, units AS unidades_vendidas FROM ({ORACLE_SQL['revenue_by_category']})",
)
def csv_original_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    # SNK2 under the original column names: the names come from the file's
    # header when it is read back
    path = shared_dir(spark, "csv", "faturamento_categoria", unique=True)
    _, names = ORIGINAL_INSIGHT_NAMES["revenue_by_category"]
    write_csv_single(revenue_by_category(spark, sf_dir), path, names)
    back = spark.read.option("header", True).csv(path)
    return back.select("category", *[F.col(c).cast("double").alias(c) for c in back.columns[1:]])


@register(
    "parquet_original_names",
    f"SELECT city, state, revenue AS faturamento, orders AS pedidos FROM ({ORACLE_SQL['revenue_by_city']})",
)
def parquet_original_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "insights", "faturamento_cidade", unique=True)
    _, names = ORIGINAL_INSIGHT_NAMES["revenue_by_city"]
    write_parquet_single(revenue_by_city(spark, sf_dir), path, names)
    return spark.read.parquet(path)


_CAT_SQL = ORACLE_SQL["revenue_by_category"]
_CITY_SQL = ORACLE_SQL["revenue_by_city"]


@register(
    "kv_category_cells",
    f"""
    SELECT 'insights_categoria' AS "table", category AS row_key, 'cf:faturamento' AS "column",
           CAST(revenue AS VARCHAR) AS value FROM ({_CAT_SQL})
    UNION ALL
    SELECT 'insights_categoria', category, 'cf:unidades_vendidas', CAST(units AS VARCHAR) FROM ({_CAT_SQL})
    """,
)
def kv_category_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    # SNK5: category insight upserted as key-value rows, read back

    cat = revenue_by_category(spark, sf_dir)
    store = _kv_store(spark, "category")
    store.put(op.to_cells(cat, KV_TABLE_CATEGORY, cat["category"], CATEGORY_CELLS), KV_TABLE_CATEGORY)
    return store.read(KV_TABLE_CATEGORY)


@register(
    "kv_city_cells",
    f"""
    SELECT 'insights_cidade' AS "table", state || '#' || city AS row_key, 'cf:faturamento' AS "column",
           CAST(revenue AS VARCHAR) AS value FROM ({_CITY_SQL})
    UNION ALL
    SELECT 'insights_cidade', state || '#' || city, 'cf:pedidos', CAST(orders AS VARCHAR) FROM ({_CITY_SQL})
    """,
)
def kv_city_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    # SNK6: city insight under the key state#city

    city = revenue_by_city(spark, sf_dir)
    key = F.concat(city["state"], F.lit("#"), city["city"])
    store = _kv_store(spark, "city")
    store.put(op.to_cells(city, KV_TABLE_CITY, key, CITY_CELLS), KV_TABLE_CITY)
    return store.read(KV_TABLE_CITY)


@register("abandonment_join", ORACLE_SQL["abandonment"])
def abandonment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    # JN2: the cart sessions that bought, found by a semi join
    return op.abandonment_by_join(standin.events(spark, sf_dir), cart_type="click", purchase_type="purchase")


@register("dedup_stats_one_pass", ORACLE_SQL["dedup_stats"])
def dedup_stats_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    # AG1 + AG2 in one aggregation: survivors with their copy counts
    return op.counted_stats(op.dedup_events_counted(_raw_events(spark, sf_dir)))


@register("dedup_events_by_place", ORACLE_SQL["dedup_events"])
def dedup_events_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    # AG1 over written rows: repeats found by id and place, whole rows stay
    # where they are
    path = shared_dir(spark, "dedup", "placed", unique=True)
    op.with_places(_raw_events(spark, sf_dir)).withColumn("_corrupt", F.lit(0).cast("bigint")).write.parquet(path)
    rows = spark.read.parquet(path)
    return op.drop_marked(rows, op.mark_repeats(rows, op.repeated_hashes(rows))).drop("_copies", "_corrupt")


# --- the batch job over a JSON landing folder derived from the tables ------


def _etl_staged(spark: SparkSession, sf_dir: str, odd_numbers: bool = False) -> DataFrame:
    # SRC1 -> one-pass dedup with copy counts -> staged Parquet
    landing = _lines_dir(spark, standin.landing_events(spark, sf_dir, odd_numbers), "landing")
    return stage_events(spark, read_events(spark, landing), shared_dir(spark, "etl", "events", unique=True))


def _etl(spark: SparkSession, sf_dir: str):
    return insights_from(_etl_staged(spark, sf_dir))


_ETL_CAT_SQL = """
    WITH cat AS (
      SELECT json_extract_string(e.props, '$.k') AS product_id, min(p.p_type) AS category
      FROM events e JOIN part p ON CAST(p.p_partkey AS VARCHAR) = json_extract_string(e.props, '$.k')
      WHERE e.event_type IN ('click', 'view') GROUP BY 1),
    items AS (
      SELECT json_extract_string(props, '$.k') AS product_id, value AS price, 1 AS quantity
      FROM events WHERE event_type = 'purchase'
      UNION ALL
      SELECT CAST(event_id % 50 AS VARCHAR), value, 2
      FROM events WHERE event_type = 'purchase' AND event_id % 2 = 0)
    SELECT coalesce(c.category, 'desconhecida') AS category,
           round(fsum(i.quantity * i.price), 2) AS revenue, CAST(sum(i.quantity) AS BIGINT) AS units
    FROM items i LEFT JOIN cat c ON i.product_id = c.product_id
    GROUP BY 1
"""
_ETL_TOTAL = """CASE WHEN e.event_id % 3 <> 0 THEN e.value
                      WHEN e.event_id % 2 = 0 THEN e.value + e.value * 2 ELSE e.value END"""


@register("etl_revenue_by_category", _ETL_CAT_SQL)
def etl_revenue_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _etl(spark, sf_dir).by_category


@register(
    "etl_odd_numbers",
    _ETL_CAT_SQL.replace("CAST(sum(i.quantity) AS BIGINT)", "CAST(sum(i.quantity) / 2 AS DOUBLE)"),
)
def etl_odd_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the same landing folder with fractional quantities and quoted amounts
    return insights_from(_etl_staged(spark, sf_dir, odd_numbers=True)).by_category


@register(
    "etl_odd_numbers_stats",
    """
    SELECT (SELECT count(*) + count(*) FILTER (WHERE event_type = 'purchase') FROM events)
           + (SELECT count(*) FROM orders) AS rows_read,
           (SELECT count(*) FROM events WHERE event_type = 'error') AS corrupt
    """,
)
def etl_odd_numbers_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    # only cut lines are malformed, not those with fractions or quoted numbers
    return insights_from(_etl_staged(spark, sf_dir, odd_numbers=True)).stats.select("rows_read", "corrupt")


# Amounts at the edges, by user: millionths, NaN, infinities and huge ones.
_EDGE = """CASE WHEN user_id % 5 = 0 THEN 0.00004 WHEN user_id % 5 = 1 THEN value
                WHEN user_id % 5 = 2 THEN CASE WHEN event_id % 2 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END
                WHEN user_id % 5 = 3 THEN CASE WHEN event_id % 3 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE value END
                ELSE 2e14 + event_id END"""


@register(
    "revenue_edge_amounts",
    f"""
    SELECT CAST(user_id % 5 AS VARCHAR) AS city, event_type AS state,
           CASE WHEN bool_or(isnan(x)) THEN CAST('NaN' AS DOUBLE) WHEN bool_or(isinf(x)) THEN CAST('Infinity' AS DOUBLE)
                WHEN min(x) >= 1e14 -- whole numbers: added as integers
                  THEN CAST(CAST(sum(CAST(CASE WHEN abs(x) < 1e18 THEN x ELSE 0 END AS BIGINT)) AS BIGINT) AS DOUBLE)
                ELSE round(fsum(CASE WHEN isnan(x) OR isinf(x) THEN 0 ELSE x END), 2) END AS revenue,
           count(*) AS orders
    FROM (SELECT *, {_EDGE} AS x FROM events) GROUP BY 1, 2
    """,
)
def revenue_edge_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = standin.table(spark, sf_dir, "events")
    return op.revenue_by_city(
        e.select(
            (F.col("user_id") % 5).cast("string").alias("city"),
            F.col("event_type").alias("state"),
            F.expr(_EDGE).alias("total"),
        )
    )


@register(
    "etl_revenue_by_city",
    f"""
    SELECT n.n_name AS city, r.r_name AS state,
           round(fsum({_ETL_TOTAL}), 2) AS revenue, count(*) AS orders
    FROM events e
    LEFT JOIN customer c ON c.c_custkey = e.user_id
    LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
    LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
    WHERE e.event_type = 'purchase'
    GROUP BY 1, 2
    """,
)
def etl_revenue_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _etl(spark, sf_dir).by_city


@register("etl_abandonment", ORACLE_SQL["abandonment"].replace("'click'", "'view'"))
def etl_abandonment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _etl(spark, sf_dir).abandonment


@register("etl_delivery_status", ORACLE_SQL["delivery_status"])
def etl_delivery_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _etl(spark, sf_dir).status


@register(
    "etl_dedup_stats",
    """
    WITH n AS (
      SELECT count(*) AS all_events,
             count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
             count(*) FILTER (WHERE event_type = 'error') AS errors
      FROM events),
    o AS (SELECT count(*) AS orders FROM orders)
    SELECT all_events + purchases + orders AS rows_read,
           all_events - errors + orders + CASE WHEN errors > 0 THEN 1 ELSE 0 END AS rows_after,
           purchases + errors - CASE WHEN errors > 0 THEN 1 ELSE 0 END AS duplicates_removed,
           errors AS corrupt
    FROM n, o
    """,
)
def etl_dedup_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _etl(spark, sf_dir).stats


@register(
    "serving_view_city",
    f"SELECT city, state, revenue AS faturamento, orders AS pedidos FROM ({ORACLE_SQL['revenue_by_city']})",
)
def serving_view_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    # SNK11 + SRC6 under the original names: external table over the Parquet
    # output, a view with the original column names, read by name
    root = shared_dir(spark, "serving", unique=True)
    write_parquet_single(revenue_by_city(spark, sf_dir), f"{root}/revenue_by_city")
    db = "cartwheel_serving_" + root.rsplit("/", 1)[-1]
    create_external_table(
        spark, db, "revenue_by_city", CITY_OUT, f"{root}/revenue_by_city", db_location=f"{root}/{db}.db"
    )
    register_original_names(spark, db, tables=["revenue_by_city"])
    return read_table(spark, "faturamento_cidade", db)


@register("published_revenue_by_city", ORACLE_SQL["revenue_by_city"])
def published_revenue_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    # SNK1 + SNK11 without a gap: a first result (one state only), one whose
    # write fails, and the whole one, each published under one table name
    root = shared_dir(spark, "published", unique=True)
    db = "cartwheel_published_" + root.rsplit("/", 1)[-1]
    create_database(spark, db, f"{root}/{db}.db")
    city = revenue_by_city(spark, sf_dir)
    publish(city.where("state = 'ASIA'"), db, "revenue_by_city", root, CITY_OUT)
    try:
        publish(city.withColumn("orders", F.raise_error(F.lit("no result")).cast("bigint")), db, "revenue_by_city", root)
    except Exception as err:  # noqa: BLE001 - the table keeps the first result
        if "no result" not in str(err):
            raise
    publish(city, db, "revenue_by_city", root, CITY_OUT)
    return read_table(spark, "revenue_by_city", db)


@register(
    "etl_order_totals",
    f"""
    SELECT 'o' || CAST(event_id AS VARCHAR) AS order_id, items AS items_total, total, items = round(total, 2) AS total_matches
    FROM (SELECT e.event_id, {_ETL_TOTAL} AS total,
                 round(CASE WHEN e.event_id % 2 = 0 THEN e.value + e.value * 2 ELSE e.value END, 2) AS items
          FROM events e WHERE e.event_type = 'purchase')
    """,
)
def etl_order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    # RA1 on purchase events that carry their items array (per row, no shuffle)
    return op.order_totals_from_arrays(op.purchases(_etl_staged(spark, sf_dir)))


@register(
    "etl_cart_state",
    """
    SELECT session_id, product_id, quantity, price FROM (
      SELECT CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
             json_extract_string(props, '$.k') AS product_id, CAST(1 AS BIGINT) AS quantity, value AS price,
             row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), json_extract_string(props, '$.k')
                                ORDER BY ts DESC, 'e' || CAST(event_id AS VARCHAR) DESC) AS rn
      FROM events WHERE event_type = 'view') WHERE rn = 1
    """,
)
def etl_cart_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    # RA2: the last add_to_cart per (session, product) by ingest time
    return op.cart_state(_etl_staged(spark, sf_dir).drop("_copies", "_corrupt", "kind"))


@register("cart_stream", ORACLE_SQL["etl_cart_state"].replace("CAST(1 AS BIGINT)", "CAST(1 AS DOUBLE)"))
def cart_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # RA2 as a continuous state over three landing files that overlap in time
    # (every file holds a third of all days' events, so most rows come out of
    # order); the stream ends after the second and is started again
    out = shared_dir(spark, "cart_stream", unique=True)
    lines = standin.landing_events(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(3)))
    staged = f"{out}/lines"
    lines.write.partitionBy("part").text(staged)
    for parts in ((0, 1), (2,)):
        for part in parts:
            # one file landing after the other
            spark.read.text(f"{staged}/part={part}").repartition(4).write.mode("append").text(f"{out}/landing")
        start_cart(
            spark, f"{out}/landing", f"{out}/carts", f"{out}/checkpoint", delay="400 days", idle="800 days",
            available_now=True, max_files_per_trigger=4,
        ).awaitTermination()
    return current_carts(spark, f"{out}/carts")


# --- the four serving queries, as written against the original table names --


def _serving_db(spark: SparkSession, sf_dir: str) -> str:
    """The four stand-in insights as single Parquet files, registered as
    external tables of one database with views under the original names
    (SNK1 + SNK11)."""
    root = shared_dir(spark, "serving_sql", unique=True)
    cat = revenue_by_category(spark, sf_dir)
    outputs = {
        "revenue_by_category": cat.withColumn("units", F.col("units").cast("bigint")),
        "revenue_by_city": revenue_by_city(spark, sf_dir),
        "cart_abandonment": abandonment(spark, sf_dir),
        "delivery_status": delivery_status(spark, sf_dir),
    }
    for name, df in outputs.items():
        write_parquet_single(df, f"{root}/{name}")
    db = "cartwheel_sql_" + root.rsplit("/", 1)[-1]
    create_database(spark, db, f"{root}/{db}.db")
    register_insights(spark, db, root)
    return db


@register(
    "sql_faturamento_categoria",
    f"""
    SELECT category, revenue AS faturamento, CAST(units AS BIGINT) AS unidades_vendidas
    FROM ({ORACLE_SQL['revenue_by_category']}) ORDER BY faturamento DESC
    """,
)
def sql_faturamento_categoria(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _serving_db(spark, sf_dir)
    return spark.sql(f"SELECT * FROM `{db}`.faturamento_categoria ORDER BY faturamento DESC")


@register(
    "sql_faturamento_cidade",
    f"""
    SELECT city, state, revenue AS faturamento, orders AS pedidos
    FROM ({ORACLE_SQL['revenue_by_city']}) ORDER BY faturamento DESC
    """,
)
def sql_faturamento_cidade(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _serving_db(spark, sf_dir)
    return spark.sql(f"SELECT * FROM `{db}`.faturamento_cidade ORDER BY faturamento DESC")


@register(
    "sql_abandono_carrinho",
    f"""
    SELECT sessions_with_cart AS sessoes_com_carrinho, sessions_bought AS sessoes_que_compraram,
           abandonment_pct AS taxa_abandono_pct
    FROM ({ORACLE_SQL['abandonment']})
    """,
)
def sql_abandono_carrinho(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _serving_db(spark, sf_dir)
    return spark.sql(f"SELECT * FROM `{db}`.abandono_carrinho")


@register("sql_status_entrega", ORACLE_SQL["delivery_status"])
def sql_status_entrega(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = _serving_db(spark, sf_dir)
    return spark.sql(f"SELECT * FROM `{db}`.status_entrega")


@register(
    "trending_default_windows",
    """
    SELECT ws AS window_start, ws + INTERVAL 60 SECOND AS window_end, product_id, count(*) AS events
    FROM (SELECT json_extract_string(props, '$.k') AS product_id,
                 time_bucket(INTERVAL 30 SECOND, ts, TIMESTAMP '1970-01-01') - i * INTERVAL 30 SECOND AS ws
          FROM events, range(2) AS t(i)
          WHERE event_type IN ('click', 'view'))
    GROUP BY 1, 2, 3
    """,
)
def trending_default_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the job's own window parameters (60 s sliding by 30 s) over the event table
    return _ntz(op.trending_counts(_records(spark, sf_dir)))
