"""The continuous cart: order, restarts, timers."""

import json
import random
from datetime import datetime

from pyspark.sql import Row

from cartwheel import operators as op
from cartwheel.sources.events import read_events
from cartwheel.streaming import cart
from cartwheel.streaming.cart import cart_events, current_carts, start_cart


def event(i, session, product, minute, price, kind="add_to_cart", **more):
    at = f"2026-01-01T{minute // 60:02d}:{minute % 60:02d}:00Z"
    return json.dumps(
        {"event_id": f"e{i:04d}", "event_type": kind, "event_time": at, "ingest_time": at, "session_id": session,
         "product_id": product, "quantity": 1, "price": price, **more}
    ) + "\n"


def run(spark, tmp_path, **options):
    q = start_cart(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt"), available_now=True,
        max_files_per_trigger=1, **options,
    )
    q.awaitTermination()


def carts(spark, tmp_path):
    rows = current_carts(spark, str(tmp_path / "out")).collect()
    return sorted((r.session_id, r.product_id, r.quantity, r.price) for r in rows)


def test_out_of_order_files_and_restart_equal_the_batch(spark, tmp_path, lines_writer):
    r = random.Random(3)
    lines = []
    for i in range(400):
        session = "hot" if i % 3 == 0 else f"s{r.randrange(12)}"
        kind = r.choice(["add_to_cart"] * 4 + ["click", "purchase"])
        lines.append(event(i, session, f"p{r.randrange(6)}", r.randrange(900), r.randrange(100) / 4, kind))
    lines += [event(900, None, "p1", 5, 1.0), event(901, "s1", None, 5, 1.0), "{broken\n", "\n"]
    lines += [event(902, "s1", "p1", 5, 1.0, event_time="not a time")]
    r.shuffle(lines)
    for n in range(4):
        lines_writer(str(tmp_path / "in"), lines[n::4], f"part-{n}.json")
        if n in (1, 3):  # two runs of two files each
            run(spark, tmp_path, delay="2 days", idle="9 days")
    batch = op.cart_state(
        cart_events(read_events(spark, str(tmp_path / "in"))).withColumn("event_type", op.cart.F.lit("add_to_cart")),
        values=("quantity", "price"),
    )
    want = sorted((x.session_id, x.product_id, x.quantity, x.price) for x in batch.collect())
    assert want and carts(spark, tmp_path) == want
    run(spark, tmp_path, delay="2 days", idle="9 days")  # nothing landed, nothing changes
    assert carts(spark, tmp_path) == want


def test_an_unchanged_product_is_not_emitted_again(spark, tmp_path, lines_writer):
    folder = str(tmp_path / "in")
    lines_writer(folder, [event(1, "s", "a", 50, 1.0), event(2, "s", "b", 50, 2.0)], "part-0.json")
    run(spark, tmp_path, delay="1 day")
    lines_writer(folder, [event(3, "s", "a", 40, 9.0), event(4, "s", "b", 60, 3.0)], "part-1.json")
    run(spark, tmp_path, delay="1 day")
    assert carts(spark, tmp_path) == [("s", "a", 1.0, 1.0), ("s", "b", 1.0, 3.0)]
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.product_id, r.price) for r in rows) == [("a", 1.0), ("b", 2.0), ("b", 3.0)]


def test_an_idle_session_is_closed_by_its_timer(spark, tmp_path, lines_writer):
    folder = str(tmp_path / "in")
    options = {"delay": "1 minute", "idle": "30 minutes"}
    for n, (session, minute) in enumerate([("old", 0), ("old", 10), ("new", 100), ("new", 101)]):
        lines_writer(folder, [event(n, session, "p", minute, float(n))], f"part-{n}.json")
        run(spark, tmp_path, **options)
    # the timer of "old" stands at minute 40, not at 30, and has fired once
    assert carts(spark, tmp_path) == [("new", "p", 1.0, 3.0)]
    closed = [r for r in spark.read.parquet(str(tmp_path / "out")).collect() if r.closed]
    assert [(r.session_id, r.price) for r in closed] == [("old", 1.0)]
    lines_writer(folder, [event(9, "old", "q", 120, 5.0)], "part-9.json")
    run(spark, tmp_path, **options)
    assert carts(spark, tmp_path) == [("new", "p", 1.0, 3.0), ("old", "q", 1.0, 5.0)]


class Maps:
    """A stand-in for state, which counts the calls."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def _call(self, result=None):
        self.calls += 1
        return result

    def containsKey(self, key):
        return self._call(key in self.held)

    def getValue(self, key):
        return self._call(self.held[key])

    def updateValue(self, key, value):
        self._call(self.held.__setitem__(key, value))

    def exists(self):
        return self.containsKey("value")

    def get(self):
        return self.getValue("value")

    def update(self, value):
        self.updateValue("value", value)

    def registerTimer(self, at):
        self.updateValue(at, None)

    deleteTimer = containsKey

    def iterator(self):
        return iter(list(self._call(self.held).items()))

    def getMapState(self, name, *schemas):
        self.held[name] = Maps()
        return self.held[name]

    getValueState = getMapState


def test_an_entry_costs_one_call():
    state, handle = cart.CartState(1000), Maps()
    state.init(handle)

    def batch(begin, end, price):
        at = datetime(2026, 1, 1, hour=price)
        rows = [
            Row(session_id=f"s{i}", product_id="p", quantity=1, price=price, ingest_time=f"t{price}", event_id="e", event_time=at)
            for i in range(begin, end)
        ]
        before = handle.calls + sum(x.calls for x in handle.held.values() if x)
        out = [(r.session_id, r.price) for r in state.handleInputRows((1,), iter(rows), None)]
        return out, handle.calls + sum(x.calls for x in handle.held.values() if x) - before

    out, calls = batch(0, 500, 2)
    assert len(out) == 500 and calls <= 500 + 6
    out, calls = batch(400, 600, 1)  # older ones change nothing
    assert sorted(out) == [(f"s{i}", 1) for i in range(500, 600)] and calls <= 100 + 6
    out, calls = batch(7, 9, 3)  # few of many entries are not read through
    assert out == [("s7", 3), ("s8", 3)] and calls <= 3 * 2 + 6 and state.slot.held["value"][1] == 600


def test_sessions_of_one_slot_are_closed_apart(spark, tmp_path, lines_writer, monkeypatch):
    monkeypatch.setattr(cart, "SLOTS", 1)
    folder = str(tmp_path / "in")
    options = {"delay": "20 minutes", "idle": "30 minutes"}
    files = [
        [("a", 0, "p"), ("b", 5, "p"), ("b", 5, "q"), ("c", 20, "p")],
        [("b", 3, "r"), ("a", 12, "q"), ("d", 20, "p")],
        [("e", 60, "p")],  # ends b (35), not a (42)
        [("e", 64, "q")],  # ends a
        [("e", 80, "p")],  # ends c and d (50)
        [("a", 81, "z")],
    ]
    closed = []
    for n, rows in enumerate(files):
        lines_writer(folder, [event(10 * n + i, s, p, m, float(n)) for i, (s, m, p) in enumerate(rows)], f"part-{n}.json")
        run(spark, tmp_path, **options)
        out = spark.read.parquet(str(tmp_path / "out")).where("closed").collect()
        closed.append("".join(sorted(r.session_id for r in out)))
    assert closed == ["", "", "bbb", "aabbb", "aabbbcd", "aabbbcd"]
    assert [x[:2] for x in carts(spark, tmp_path)] == [("a", "z"), ("e", "p"), ("e", "q")]
