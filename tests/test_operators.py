"""Operators not covered by the job tests: order totals, cart state,
preferred survivors, payloads, file listing, CLIs."""

import base64
import json
import os

import pytest
from pyspark.sql import functions as F

from cartwheel import operators as op
from cartwheel.schema import ALERT_CELLS, EVENT_SCHEMA, KV_TABLE_ALERTS
from cartwheel.sources.lines import files_by_name


def test_order_totals_from_arrays(spark):
    df = spark.createDataFrame(
        [
            ("o1", [("p", 2, 2.675), ("q", 1, 0.1)], 5.45),
            ("o2", [], 0.0),
            ("o3", None, 3.0),
            ("o4", [("p", 1, 1.0)], 2.0),
        ],
        "order_id string, items array<struct<product_id:string,quantity:bigint,price:double>>, total double",
    )
    got = {r.order_id: (r.items_total, r.total_matches) for r in op.order_totals_from_arrays(df).collect()}
    assert got == {"o1": (5.45, True), "o2": (0.0, True), "o3": (None, None), "o4": (1.0, False)}


def test_cart_state_last_event_wins(spark):
    rows = [
        ("e1", "add_to_cart", "2026-07-01T10:00:00Z", "2026-07-01T10:00:01Z", "S", "P1", 1, 10.0),
        ("e2", "add_to_cart", "2026-07-01T10:00:05Z", "2026-07-01T10:00:02Z", "S", "P1", 3, 9.0),
        ("e3", "add_to_cart", "2026-07-01T09:59:00Z", "2026-07-01T10:00:03Z", "S", "P1", 2, 8.0),
        ("e4", "click", "2026-07-01T10:01:00Z", "2026-07-01T10:01:00Z", "S", "P1", None, 7.0),
        ("e5", "add_to_cart", "2026-07-01T10:00:00Z", "2026-07-01T10:00:00Z", "T", "P2", 5, 1.0),
    ]
    df = spark.createDataFrame(
        rows,
        "event_id string, event_type string, event_time string, ingest_time string, session_id string, "
        "product_id string, quantity bigint, price double",
    )
    got = sorted(tuple(r) for r in op.cart_state(df).collect())
    # order by ingest time: e3 arrived last although its event time is oldest
    assert got == [("S", "P1", 2, 8.0), ("T", "P2", 5, 1.0)]


def test_dedup_with_preference_is_deterministic(spark):
    df = spark.createDataFrame(
        [("a", "2", "x"), ("a", "1", "y"), ("b", "5", "z"), (None, "3", "n1"), (None, "1", "n2")],
        "event_id string, ingest_time string, v string",
    )
    got = sorted((r.event_id or "", r.v) for r in op.dedup_events(df, prefer=["ingest_time"]).collect())
    assert got == [("", "n2"), ("a", "y"), ("b", "z")]


def test_dedup_counted_matches_stats(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 1), ("b", 2), (None, 3), (None, 4)], "event_id string, x int"
    )
    counted = op.dedup_events_counted(df)
    assert tuple(op.counted_stats(counted).first()) == tuple(op.dedup_stats(df).first()) == (5, 3, 2, 0)


def test_row_payloads_keep_cell_order(spark):
    rows = spark.createDataFrame(
        [("P1-60000", "P1", 6, "1970-01-01T00:01:00Z", "1970-01-01T00:02:00Z")],
        "row_key string, product_id string, events bigint, window_start_iso string, window_end_iso string",
    )
    p = op.row_payloads(rows, KV_TABLE_ALERTS, rows["row_key"], ALERT_CELLS).first()
    body = json.loads(p.payload)
    cells = body["Row"][0]["Cell"]
    decode = lambda s: base64.b64decode(s).decode()
    assert decode(body["Row"][0]["key"]) == "P1-60000"
    assert [(decode(c["column"]), decode(c["$"])) for c in cells] == [
        ("cf:produto", "P1"),
        ("cf:eventos", "6"),
        ("cf:janela_inicio", "1970-01-01T00:01:00Z"),
        ("cf:janela_fim", "1970-01-01T00:02:00Z"),
    ]


def test_to_cells_prints_values_like_python(spark):
    df = spark.createDataFrame([("cat", 12345678.5, 7), ("none", None, None)], "category string, revenue double, units bigint")
    cells = op.to_cells(df, "t", df["category"], {"revenue": "faturamento", "units": "unidades_vendidas"})
    got = sorted((r.row_key, r.column, r.value) for r in cells.collect())
    assert got == [
        ("cat", "cf:faturamento", "12345678.5"),
        ("cat", "cf:unidades_vendidas", "7"),
        ("none", "cf:faturamento", "None"),
        ("none", "cf:unidades_vendidas", "None"),
    ]


def test_files_by_name_lists_empty_files(spark, tmp_path):
    for name in ("b.log", "a.log", "c.log"):
        with open(tmp_path / name, "w") as f:
            f.write("" if name == "c.log" else "x\n")
    got = [os.path.basename(r.path) for r in files_by_name(spark, str(tmp_path)).collect()]
    assert got == ["a.log", "b.log", "c.log"]


def test_explode_items_drops_null_and_empty(spark):
    df = spark.createDataFrame(
        [("o1", [("p", 1, 2.0), ("q", 2, 3.0)]), ("o2", []), ("o3", None)],
        "order_id string, items array<struct<product_id:string,quantity:bigint,price:double>>",
    )
    got = sorted(tuple(r) for r in op.with_subtotal(op.explode_items(df, "order_id")).collect())
    assert got == [("o1", "p", 1, 2.0, 2.0), ("o1", "q", 2, 3.0, 6.0)]
    assert op.explode_items(df).columns == ["product_id", "quantity", "price"]


def test_sums_of_money_lose_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("tiny", 0.00004)] * 1000 + [("cents", 0.1)] * 1000 + [("nan", 1.0), ("nan", nan), ("inf", inf), ("inf", 5.0)]
    rows += [("large", 2e14)] * 3 + [("large", 0.25), ("huge", 3e17), ("huge", 1.0), ("null", None), ("mixed", None), ("mixed", -2.5)]
    df = spark.createDataFrame([(c, "s", x) for c, x in rows], "city string, state string, total double")
    got = {r.city: r.revenue for r in op.revenue_by_city(df).collect()}
    assert got.pop("nan") != got.get("nan")  # NaN, as in a plain sum
    assert got == {
        "tiny": 0.04, "cents": 100.0, "inf": inf, "large": 6e14 + 0.25, "huge": 3e17, "null": None, "mixed": -2.5
    }


def test_order_totals_keep_orders_without_items(spark):
    items = spark.createDataFrame([("a", 2.0, 1.25), ("a", 1.0, 0.5), ("x", 1.0, 9.0)], "order_id string, quantity double, price double")
    orders = spark.createDataFrame([("a", 3.0), ("b", 0.0), ("c", 4.0)], "order_id string, total double")
    got = sorted(tuple(r) for r in op.order_totals_from_items(items, orders).collect())
    assert got == [("a", 3.0, 3.0, True), ("b", 0.0, 0.0, True), ("c", 0.0, 4.0, False)]


def test_etl_and_verify_command_lines(spark, tmp_path, lines_writer):
    from cartwheel.plans import etl, verify

    lines = [
        json.dumps({"event_id": "1", "event_type": "purchase", "city": "c", "state": "s", "total": 2.0,
                    "items": [{"product_id": "p", "quantity": 1, "price": 2.0}]}) + "\n",
        json.dumps({"event_id": "2", "event_type": "click", "product_id": "p", "category": "k"}) + "\n",
    ]
    lines_writer(str(tmp_path / "in"), lines)
    lines_writer(str(tmp_path / "src"), lines, name="events.log")
    ins = etl.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), show=False)
    assert [tuple(r) for r in ins.by_category.collect()] == [("k", 2.0, 1)]
    report, types = verify.check(spark, str(tmp_path / "src" / "events.log"), str(tmp_path / "in"))
    r = report.first()
    assert (r.source_rows, r.sink_rows, r.missing_rows, r.ok) == (2, 2, 0, True)
    assert EVENT_SCHEMA["items"].dataType.elementType.names == ["product_id", "quantity", "price"]
    assert F is not None


def test_sizing_conf_follows_the_largest_shuffle():
    from cartwheel.config import sizing_conf

    big = sizing_conf(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == -(-int(100 * 2**40 * 0.3) // (200 << 20))
    assert sizing_conf(10**8, 8)["spark.sql.shuffle.partitions"] == "16"  # at least two per core


def test_scratch_paths_live_under_the_session_checkpoint_dir(spark):
    from cartwheel.config import checkpoint_root, job_dir, remove_dir, shared_dir

    root = checkpoint_root(spark)
    assert root == (spark.conf.get("spark.checkpoint.dir", None) or root)
    a, b = shared_dir(spark, "x", unique=True), shared_dir(spark, "x", unique=True)
    assert a != b and a.startswith(root) and b.startswith(root)
    # runs may overlap: each has a folder of its own, removed in the end
    own, other = job_dir(spark, "etl"), job_dir(spark, "etl")
    assert own != other
    spark.range(3).write.parquet(own)
    remove_dir(spark, own)
    assert not os.path.exists(own.removeprefix("file:"))
    for path in ("/tmp", root, "/etc/passwd"):
        with pytest.raises(ValueError):
            remove_dir(spark, path)


def test_a_cluster_needs_a_shared_folder():
    from cartwheel.config import checkpoint_root

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_paned_windows_equal_sliding_ones(spark):
    import random

    import pytest

    r = random.Random(2)
    rows = [(f"p{r.randrange(4)}" if i % 3 else "hot", 1_700_000_000 + r.randrange(400) + r.random()) for i in range(600)]
    rows += [("edge", float(t)) for t in (1_700_000_010, 1_700_000_040, -45, -15, 0)]
    df = spark.createDataFrame(rows, "product_id string, at double").selectExpr("product_id", "timestamp_seconds(at) AS event_time")
    for size, slide in (("60 seconds", "30 seconds"), ("90 seconds", "30 seconds"), ("1 day", "12 hours"), ("30 seconds", "30 seconds")):
        want = sorted(tuple(x) for x in op.trending_counts(df, size, slide).collect())
        assert sorted(tuple(x) for x in op.trending_counts_paned(df, size, slide).collect()) == want
    with pytest.raises(ValueError, match="multiple"):
        op.trending_counts_paned(df, "50 seconds", "30 seconds")
    assert "Expand" not in op.trending_counts_paned(df)._jdf.queryExecution().executedPlan().toString()
