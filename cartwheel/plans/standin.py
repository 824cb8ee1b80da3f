"""Driver tables -> the inputs the operators expect.

The driver's test tables hold no commerce events, so each query runs the
library's operators on stand-ins derived from them (all columns keep their
native types, so no join key is cast):

* items ............ lineitem rows: order = l_orderkey, product = l_partkey,
                     quantity = l_quantity, price = l_extendedprice;
* catalog events ... click and view events whose key is a part: product =
                     p_partkey, category = p_type (parts without such an event
                     are unknown to the catalog);
* purchases ........ orders: total = o_totalprice, place from
                     customer -> nation (city) -> region (state); where totals
                     are checked, every second order's total is that of its
                     line items;
* delivery events .. orders: status = o_orderstatus;
* event stream ..... events: product = props.k, session = user and UTC day,
                     event_time = ts as a timestamp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("price"),
    )


def catalog_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that name a product's category (the click / cart events)."""
    seen = events(spark, sf_dir).where(F.col("event_type").isin("click", "view"))
    part = table(spark, sf_dir, "part")
    return seen.join(part, seen.product_id == part.p_partkey.cast("string")).select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"), "event_id"
    )


def checked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_id, total``: the total of an even order is the sum of its line
    items (it matches them), that of an odd one is ``o_totalprice``."""
    amount = (F.col("l_quantity") * F.col("l_extendedprice")).cast("decimal(18,2)")
    sums = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.sum(amount).cast("double").alias("_items")
    )
    own = F.when(F.col("order_id") % 2 == 0, F.coalesce("_items", F.lit(0.0))).otherwise(F.col("total"))
    return orders(spark, sf_dir).join(sums, "order_id", "left").select("order_id", own.alias("total"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderstatus").alias("delivery_status"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer -> (city, state) = (nation name, region name).

    nation (25 rows) and region (5 rows) have the same size at every scale
    factor, so they are broadcast; customer grows and is left to the planner.
    """
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    region = F.broadcast(table(spark, sf_dir, "region"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("state"),
        )
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table in the library's vocabulary."""
    e = table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    return e.select(
        "event_id",
        "event_type",
        ts.alias("event_time"),
        "user_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.to_date(ts).cast("string")).alias("session_id"),
        F.get_json_object("props", "$.k").alias("product_id"),
        "value",
    )


# --- JSON-lines events derived from the driver tables ------------------------
# For the queries that exercise the file sources, the landing stream and the
# text-line trending stream: the event table written out as event JSON lines
# (click -> click, view -> add_to_cart, others keep their type; times as ISO
# instants with microseconds and "Z").

STANDIN_TYPES = {"view": "add_to_cart"}


def event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value`` = one JSON event line per row of the event table."""
    return event_json_from(events(spark, sf_dir))


def event_json_from(e: DataFrame, *keep: str) -> DataFrame:
    """JSON event lines from a frame shaped like ``events()``, after the
    ``keep`` columns (``day``: the day of the month)."""
    kind = F.col("event_type")
    for src, dst in STANDIN_TYPES.items():
        kind = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(kind)
    iso = F.date_format(F.col("event_time"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    rec = F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        kind.alias("event_type"),
        iso.alias("event_time"),
        iso.alias("ingest_time"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("session_id"),
        F.col("product_id"),
        F.col("value").alias("price"),
    )
    kept = [F.dayofmonth("event_time").alias(c) if c == "day" else F.col(c) for c in keep]
    return e.select(*kept, F.to_json(rec).alias("value"))


def write_lines(df: DataFrame, path: str) -> str:
    """Write a one-string-column frame as text files under ``path``."""
    df.write.mode("overwrite").text(path)
    return path


# --- a landing folder of commerce events derived from the tables ------------


def landing_events(spark: SparkSession, sf_dir: str, odd_numbers: bool = False) -> DataFrame:
    """``value`` = JSON event lines in the commerce vocabulary, built row by
    row from the tables in one pass over the events (no grouping):

    * click -> click, view -> add_to_cart (quantity 1, price = value), with
      product = props.k and category = the part type of that key;
    * purchase -> purchase with an ``items`` array (one of product k and, for
      even event ids, two of part ``event_id % 50``, each at the price value),
      total = their sum for ids that 3 divides, else value, place from the
      user's customer row; sent twice (the copies must be removed);
    * error -> a line cut short (a malformed record);
    * signup -> signup (ignored by the insights);
    * each order -> one delivery_status event with ``o_orderstatus``.

    With ``odd_numbers`` item quantities are halved (0.5, 1.0), their prices
    doubled, and prices and totals are written as quoted text.
    """
    e = events(spark, sf_dir)
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), F.col("p_type").alias("category")
    )
    kind = F.col("event_type")
    browse, bought = kind.isin("click", "view"), kind == "purchase"
    value = F.col("value")
    amount = (lambda c: c.cast("string")) if odd_numbers else (lambda c: c)

    def item(product, n):
        quantity = F.lit(n / 2) if odd_numbers else F.lit(n).cast("bigint")
        price = amount(value * 2 if odd_numbers else value)
        return F.struct(product.alias("product_id"), quantity.alias("quantity"), price.alias("price"))

    second = (F.col("event_id") % 50).cast("string")
    one = F.array(item(F.col("product_id"), 1))
    two = F.array(item(F.col("product_id"), 1), item(second, 2))
    even = F.col("event_id") % 2 == 0
    whole = F.when(even, value + value * 2).otherwise(value)
    iso = F.date_format(F.col("event_time"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    places_ = places(spark, sf_dir)
    rec = F.struct(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("event_id"),
        F.when(kind == "view", F.lit("add_to_cart")).otherwise(kind).alias("event_type"),
        iso.alias("event_time"),
        iso.alias("ingest_time"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("session_id"),
        F.when(browse, F.col("product_id")).alias("product_id"),
        F.when(browse, F.col("category")).alias("category"),
        F.when(browse, amount(value)).alias("price"),
        F.when(kind == "view", F.lit(1).cast("bigint")).alias("quantity"),
        F.when(bought, F.concat(F.lit("o"), F.col("event_id").cast("string"))).alias("order_id"),
        F.when(bought, F.when(even, two).otherwise(one)).alias("items"),
        F.when(bought, amount(F.when(F.col("event_id") % 3 == 0, whole).otherwise(value))).alias("total"),
        F.when(bought, F.col("city")).alias("city"),
        F.when(bought, F.col("state")).alias("state"),
    )
    text = F.to_json(rec)
    cut = F.when(F.col("_kind") == "error", F.expr("substring(_text, 1, length(_text) - 2)")).otherwise(F.col("_text"))
    lines = (
        e.join(part, "product_id", "left")
        .join(places_, e.user_id == places_.customer_id, "left")
        .select(kind.alias("_kind"), text.alias("_text"))
        .withColumn("value", cut)
        .select(F.explode(F.when(F.col("_kind") == "purchase", F.array("value", "value")).otherwise(F.array("value"))).alias("value"))
    )
    status = table(spark, sf_dir, "orders").select(
        F.to_json(
            F.struct(
                F.concat(F.lit("d"), F.col("o_orderkey").cast("string")).alias("event_id"),
                F.lit("delivery_status").alias("event_type"),
                F.date_format(F.col("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("event_time"),
                F.col("o_orderkey").cast("string").alias("order_id"),
                F.col("o_orderstatus").alias("delivery_status"),
            )
        ).alias("value")
    )
    return lines.unionByName(status)
