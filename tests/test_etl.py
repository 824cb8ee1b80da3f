"""Batch insights on a hand-made landing folder (FIXTURES F2)."""

import json
import os

from pyspark.sql import functions as F

from cartwheel.plans import etl
from cartwheel.sinks.kvstore import KeyValueStore
from cartwheel.sources.events import read_events


def ev(**kw):
    return json.dumps(kw) + "\n"


FIXTURE = [
    ev(event_id="e1", event_type="add_to_cart", session_id="S1", product_id="P001", category="A", price=10.0, quantity=1,
       event_time="2026-07-01T10:00:00.000Z"),
    ev(event_id="e1", event_type="add_to_cart", session_id="S1", product_id="P001", category="A", price=10.0, quantity=1,
       event_time="2026-07-01T10:00:00.000Z"),
    ev(event_id="e2", event_type="click", session_id="S2", product_id="P002", category="B", price=5.0,
       event_time="2026-07-01T10:00:01.000Z"),
    ev(event_id="e3", event_type="purchase", session_id="S1", order_id="O1", city="X", state="SX", total=32.0,
       items=[{"product_id": "P001", "quantity": 2, "price": 10.0},
              {"product_id": "P002", "quantity": 1, "price": 5.0},
              {"product_id": "P999", "quantity": 1, "price": 7.0}]),
    ev(event_id="e4", event_type="purchase", session_id="S3", order_id="O2", city="X", state="SX", total=15.0, items=None),
    ev(event_id="e5", event_type="purchase", session_id="S4", order_id="O3", city="Y", state="SY", total=0.0, items=[]),
    ev(event_id="e6", event_type="add_to_cart", session_id="S5", product_id="P002", category="B", price=5.0, quantity=1),
    ev(event_id="e7", event_type="add_to_cart", session_id=None, product_id="P001", category="A", price=10.0, quantity=3),
    ev(event_id="e8", event_type="delivery_status", order_id="O1", delivery_status="em_transito", carrier="c1"),
    ev(event_id="e9", event_type="delivery_status", order_id="O1", delivery_status="entregue", carrier="c1"),
    ev(event_id="e10", event_type="delivery_status", order_id="O2", delivery_status="em_transito", carrier="c2"),
    '{"event_id": "x", broken\n',
    "not json at all\n",
    "   \n",
]


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_insights_on_edge_rows(spark, tmp_path, lines_writer):
    lines_writer(str(tmp_path / "in"), FIXTURE)
    ins = etl.compute_insights(read_events(spark, str(tmp_path / "in")))
    assert rows(ins.stats) == [(13, 11, 2, 2)]
    assert rows(ins.by_category) == [("A", 20.0, 2), ("desconhecida", 7.0, 1), ("B", 5.0, 1)]
    assert rows(ins.by_city) == [("X", "SX", 47.0, 2), ("Y", "SY", 0.0, 1)]
    assert rows(ins.abandonment) == [(3, 1, 66.67)]
    assert rows(ins.status) == [("em_transito", 2), ("entregue", 1)]
    assert ins.by_category.schema.simpleString() == "struct<category:string,revenue:double,units:bigint>"
    assert ins.by_city.schema.simpleString() == "struct<city:string,state:string,revenue:double,orders:bigint>"


def test_numbers_of_any_json_form_count(spark, tmp_path, lines_writer):
    lines_writer(
        str(tmp_path / "in"),
        [
            ev(event_id="1", event_type="purchase", city="c", state="s", total=3.0,
               items=[{"product_id": "p", "quantity": 1.5, "price": 2.0}]),
            ev(event_id="2", event_type="purchase", city="c", state="s", total="9.0",
               items=[{"product_id": "p", "quantity": 2, "price": "3.0"}]),
            ev(event_id="3", event_type="click", product_id="p", category="k", price="no number"),
        ],
    )
    ins = etl.compute_insights(read_events(spark, str(tmp_path / "in")))
    assert rows(ins.by_category) == [("k", 9.0, 3.5)]
    assert rows(ins.by_city) == [("c", "s", 12.0, 2)]
    assert rows(ins.stats) == [(3, 3, 0, 0)]


def test_original_names(spark, tmp_path, lines_writer):
    lines_writer(str(tmp_path / "in"), FIXTURE)
    etl.run(spark, str(tmp_path / "in"), str(tmp_path / "out"), show=False, original_names=True)
    for folder, header in (
        ("faturamento_categoria", "category,faturamento,unidades_vendidas"),
        ("faturamento_cidade", "city,state,faturamento,pedidos"),
    ):
        csv = [f for f in os.listdir(tmp_path / "out" / "csv" / folder) if f.endswith(".csv")]
        with open(tmp_path / "out" / "csv" / folder / csv[0]) as f:
            assert f.readline().strip() == header
        assert ",".join(spark.read.parquet(str(tmp_path / "out" / folder)).columns) == header
    assert spark.read.parquet(str(tmp_path / "out" / "abandono_carrinho")).columns[2] == "taxa_abandono_pct"


def test_show_all_prints_every_row(spark, capsys):
    from cartwheel.sinks.files import show_all

    show_all(spark.range(1500), "all:")
    assert capsys.readouterr().out.splitlines()[-1] == "1499"


def test_no_cart_gives_zero_and_nulls(spark, tmp_path, lines_writer):
    lines_writer(str(tmp_path / "in"), [ev(event_id="p", event_type="purchase", session_id="S", total=1.0)])
    ins = etl.compute_insights(read_events(spark, str(tmp_path / "in")))
    assert rows(ins.abandonment) == [(0, None, None)]


def test_empty_folder_gives_typed_empty_results(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    ins = etl.compute_insights(read_events(spark, str(tmp_path / "in")))
    assert ins.by_category.count() == 0 and ins.by_city.count() == 0
    assert rows(ins.stats) == [(0, 0, 0, 0)]


def test_equal_revenue_is_ordered_by_key(spark, tmp_path, lines_writer):
    lines_writer(
        str(tmp_path / "in"),
        [
            ev(event_id="1", event_type="purchase", city="b", state="S", total=5.0),
            ev(event_id="2", event_type="purchase", city="a", state="S", total=5.0),
        ],
    )
    ins = etl.compute_insights(read_events(spark, str(tmp_path / "in")))
    assert rows(ins.by_city) == [("a", "S", 5.0, 1), ("b", "S", 5.0, 1)]


def test_category_and_city_revenue_reconcile(spark, tmp_path, lines_writer):
    lines = []
    for i in range(40):
        items = [{"product_id": f"P{j}", "quantity": (i + j) % 3 + 1, "price": 1.25 * (j + 1)} for j in range(i % 4 + 1)]
        total = sum(it["quantity"] * it["price"] for it in items)
        lines.append(ev(event_id=f"o{i}", event_type="purchase", city=f"c{i % 5}", state="S", total=total, items=items))
        lines.append(ev(event_id=f"k{i}", event_type="click", product_id=f"P{i % 4}", category=f"cat{i % 2}"))
    lines_writer(str(tmp_path / "in"), lines)
    ins = etl.compute_insights(read_events(spark, str(tmp_path / "in")))
    by_cat = ins.by_category.agg(F.sum("revenue")).first()[0]
    by_city = ins.by_city.agg(F.sum("revenue")).first()[0]
    assert round(by_cat, 2) == round(by_city, 2)


def test_counts_do_not_depend_on_file_split(spark, tmp_path, lines_writer):
    lines_writer(str(tmp_path / "one"), FIXTURE)
    for i, line in enumerate(FIXTURE):
        lines_writer(str(tmp_path / "many"), [line], name=f"part-{i:03d}.json")
    a = etl.compute_insights(read_events(spark, str(tmp_path / "one")))
    b = etl.compute_insights(read_events(spark, str(tmp_path / "many")))
    for x, y in zip(a.frames().values(), b.frames().values()):
        assert rows(x) == rows(y)
    assert rows(a.stats) == rows(b.stats)


def test_dedup_is_idempotent(spark, tmp_path, lines_writer):
    from cartwheel.operators import dedup_events

    lines_writer(str(tmp_path / "in"), FIXTURE)
    once = dedup_events(read_events(spark, str(tmp_path / "in")))
    twice = dedup_events(once)
    assert once.count() == twice.count() == 11


def test_run_writes_all_outputs(spark, tmp_path, lines_writer):
    lines_writer(str(tmp_path / "in"), FIXTURE)
    out = str(tmp_path / "out")
    kv_root = str(tmp_path / "kv")
    etl.run(spark, str(tmp_path / "in"), out, kv_root=kv_root, database="cw_test_etl", show=False)
    for name in ("revenue_by_category", "revenue_by_city", "cart_abandonment", "delivery_status"):
        parts = [f for f in os.listdir(os.path.join(out, name)) if f.endswith(".parquet")]
        assert len(parts) == 1
    csv = [f for f in os.listdir(os.path.join(out, "csv", "revenue_by_category")) if f.endswith(".csv")]
    with open(os.path.join(out, "csv", "revenue_by_category", csv[0])) as f:
        assert f.read().splitlines() == ["category,revenue,units", "A,20.0,2", "desconhecida,7.0,1", "B,5.0,1"]
    assert rows(spark.sql("SELECT * FROM cw_test_etl.cart_abandonment")) == [(3, 1, 66.67)]
    legacy = spark.sql("SELECT * FROM cw_test_etl.faturamento_categoria ORDER BY faturamento DESC")
    assert legacy.columns == ["category", "faturamento", "unidades_vendidas"]
    assert rows(legacy) == [("A", 20.0, 2), ("desconhecida", 7.0, 1), ("B", 5.0, 1)]
    assert spark.table("cw_test_etl.abandono_carrinho").columns[2] == "taxa_abandono_pct"
    kv = KeyValueStore(spark, kv_root)
    cells = {(r.row_key, r.column): r.value for r in kv.read("insights_categoria").collect()}
    assert cells[("A", "cf:faturamento")] == "20.0"
    assert cells[("A", "cf:unidades_vendidas")] == "2"
    city = {(r.row_key, r.column): r.value for r in kv.read("insights_cidade").collect()}
    assert city[("SX#X", "cf:pedidos")] == "2"
    assert kv.count_rows("insights_cidade") == 2
    assert kv.count_rows("missing_table") == 0


def test_rerun_keeps_vanished_key_and_replaces_changed(spark, tmp_path, lines_writer):
    kv_root = str(tmp_path / "kv")
    lines_writer(str(tmp_path / "in1"), FIXTURE)
    etl.run(spark, str(tmp_path / "in1"), str(tmp_path / "out1"), kv_root=kv_root, show=False)
    # second run: only category A is sold, at a new amount
    lines_writer(
        str(tmp_path / "in2"),
        [
            ev(event_id="c", event_type="click", product_id="P001", category="A"),
            ev(event_id="p", event_type="purchase", city="X", state="SX", total=30.0,
               items=[{"product_id": "P001", "quantity": 3, "price": 10.0}]),
        ],
    )
    etl.run(spark, str(tmp_path / "in2"), str(tmp_path / "out2"), kv_root=kv_root, show=False)
    kv = KeyValueStore(spark, kv_root)
    cells = {(r.row_key, r.column): r.value for r in kv.read("insights_categoria").collect()}
    assert cells[("A", "cf:faturamento")] == "30.0"  # replaced
    assert cells[("B", "cf:faturamento")] == "5.0"  # vanished from input, kept
    out2 = spark.read.parquet(str(tmp_path / "out2" / "revenue_by_category"))
    assert rows(out2) == [("A", 30.0, 3)]  # the Parquet output is replaced whole
