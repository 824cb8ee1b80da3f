"""Tables that readers find whole: publication, resumed jobs, counts that hold."""

import json
import os
import subprocess
import sys
import textwrap
import threading

import pytest
from pyspark.sql import functions as F

from cartwheel import operators as op
from cartwheel.plans import etl
from cartwheel.sinks.publish import publish
from cartwheel.sources.events import read_events

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_a_reader_sees_whole_results_only(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS pub LOCATION '{tmp_path}/db'")
    result = lambda n: spark.range(40, numPartitions=1).selectExpr(f"{n}L AS run", "id")
    publish(result(0), "pub", "t", str(tmp_path / "out"))
    seen, errors, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append({(r.run, r.n) for r in spark.table("pub.t").groupBy("run").agg(F.count("*").alias("n")).collect()})
            except Exception as err:  # noqa: BLE001
                errors.append(err)

    reader = threading.Thread(target=read)
    reader.start()
    folders = [publish(result(n), "pub", "t", str(tmp_path / "out")) for n in (1, 2, 3)]
    stop.set()
    reader.join()
    assert not errors and seen and all(s in [{(n, 40)} for n in range(4)] for s in seen)
    # the folder before the last is kept for readers, older ones are gone
    assert [os.path.isdir(f) for f in folders] == [False, True, True]
    with pytest.raises(Exception, match="broken"):
        publish(result(4).withColumn("id", F.raise_error(F.lit("broken")).cast("bigint")), "pub", "t", str(tmp_path / "out"))
    assert {r.run for r in spark.table("pub.t").collect()} == {3}
    assert len([d for d in os.listdir(tmp_path / "out" / "t")]) == 2


def line(i, kind="purchase", **more):
    return json.dumps({"event_id": i, "event_type": kind, "city": "c", "state": "s", "total": 2.0, **more}) + "\n"


def events():
    """Repeats of all kinds: a hot id, malformed lines, copies that differ."""
    out = [line(f"e{i}", order_id=f"o{i}", items=[{"product_id": "p", "quantity": 1, "price": 2.0}]) for i in range(60)]
    out += [line("hot")] * 50 + ["{broken\n"] * 7 + [line(f"e{i}") for i in range(0, 60, 6)]
    return out + [line(f"d{i}", "delivery_status", delivery_status="ok") for i in range(5)]


@pytest.mark.parametrize("limit", [etl.BROADCAST_MARKS, 0])
def test_repeats_found_by_place_equal_the_aggregation(spark, tmp_path, lines_writer, monkeypatch, limit):
    monkeypatch.setattr(etl, "BROADCAST_MARKS", limit)
    for n in range(3):
        lines_writer(str(tmp_path / "in"), events()[n::3], f"part-{n}.json")
    raw = read_events(spark, str(tmp_path / "in"))
    want = op.dedup_events_counted(etl._project(raw))
    staged = etl.stage(spark, raw, str(tmp_path / "staged"))
    ids = ("event_id", "_copies", "_corrupt")
    rows = lambda df: sorted((tuple(r) for r in df.select(*ids).collect()), key=str)
    assert rows(staged.events) == rows(want)
    assert tuple(staged.stats.first()) == tuple(op.counted_stats(want).first()) == (132, 67, 65, 7)
    assert tuple(op.counted_stats(staged.events).first()) == (132, 67, 65, 7)
    ins, plain = etl.insights_from(staged.events, stats=staged.stats), etl.compute_insights(raw)
    for name, df in ins.frames().items():
        assert df.collect() == plain.frames()[name].collect()
    text = staged.events._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "hashpartitioning" not in text
    assert ("ShuffledHashJoin" if limit == 0 else "BroadcastHashJoin") in text
    spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def test_no_repeats_no_marks(spark, tmp_path, lines_writer):
    lines_writer(str(tmp_path / "in"), [line("a"), line("b")])
    staged = etl.stage(spark, read_events(spark, str(tmp_path / "in")), str(tmp_path / "staged"))
    assert staged.marks is None and tuple(staged.stats.first()) == (2, 2, 0, 0)
    assert staged.events.agg(F.sum("_copies")).first()[0] == 2


def test_a_job_goes_on_after_staging(spark, tmp_path, lines_writer, monkeypatch):
    source = str(tmp_path / "in")
    lines_writer(source, events())
    want = {n: df.collect() for n, df in etl.compute_insights(read_events(spark, source)).frames().items()}
    reads = []
    monkeypatch.setattr(etl, "read_events", lambda *a: reads.append(a) or read_events(*a))
    whole = etl.write_insights
    monkeypatch.setattr(etl, "write_insights", lambda *a: (_ for _ in ()).throw(OSError("ended")))
    with pytest.raises(OSError, match="ended"):
        etl.run(spark, source, str(tmp_path / "out"), show=False, resume=True)
    monkeypatch.setattr(etl, "write_insights", whole)
    again = etl.run(spark, source, str(tmp_path / "out"), show=False, resume=True)
    assert len(reads) == 1
    assert {n: df.collect() for n, df in again.frames().items()} == want
    assert tuple(again.stats.first()) == (132, 67, 65, 7)
    # a new file is a new input
    lines_writer(source, [line("new")], "part-1.json")
    more = etl.run(spark, source, str(tmp_path / "out"), show=False, resume=True)
    assert len(reads) == 2 and more.stats.first()["rows_after"] == 68


def test_published_tables_of_the_job(spark, tmp_path, lines_writer):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    lines_writer(source, events())
    for n in (1, 2):
        etl.run(spark, source, out, database="pubjob", show=False, publish=True)
        assert spark.table("pubjob.faturamento_cidade").first()["pedidos"] == 60 + n
        lines_writer(source, [line("later")], "part-1.json")


def test_counts_hold_when_a_task_is_run_again(tmp_path):
    script = f"""
        import json, sys
        sys.path.insert(0, {ROOT!r})
        from pyspark import TaskContext
        from cartwheel.config import build_session
        from cartwheel.plans import etl
        from cartwheel.sources.events import read_events
        spark = build_session("local[2,3]", shuffle_partitions=4)
        src = {str(tmp_path / "in")!r}
        spark.range(3000).selectExpr(
            "CASE WHEN id % 100 = 7 THEN '{{broken' ELSE concat('{{{{\\"event_id\\":\\"e', id % 2900, '\\",\\"quantity\\":1.5}}}}') END"
        ).repartition(4).write.text(src)
        raw = read_events(spark, src)
        def fails_once(batches):
            for n, b in enumerate(batches):
                yield b
            if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
                raise RuntimeError("lost")
        staged = etl.stage(spark, raw.mapInPandas(fails_once, raw.schema), {str(tmp_path / "staged")!r})
        print("COUNTS", json.dumps(staged.counts))
    """
    script = textwrap.dedent(script).replace("{{{{", "{").replace("}}}}", "}").replace("{{", "{")
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300)
    found = [x for x in done.stdout.splitlines() if x.startswith("COUNTS")]
    assert found, done.stderr[-2000:]
    counts = json.loads(found[0][7:])
    assert "lost" in done.stderr
    assert counts["rows"] == 3000 and counts["corrupt"] == 30 and counts["fractions"] == 2970
    assert counts["removed"] == 99 + 29  # 100 repeated ids less one malformed line, malformed lines less one
