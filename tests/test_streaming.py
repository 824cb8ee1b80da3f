"""The trending stream: late data per window (FIXTURES F3), restarts, alerts,
and the landing stream."""

import json
import os
import time

from cartwheel.schema import KV_TABLE_ALERTS
from cartwheel.sinks.kvstore import KeyValueStore
from cartwheel.streaming.landing import start_landing
from cartwheel.streaming.trending import start_trending


def line(product, hhmmss):
    return json.dumps({"event_type": "click", "product_id": product, "event_time": f"2026-07-01T{hhmmss}Z"}) + "\n"


FILES = [
    [line("P1", "10:00:05"), line("P1", "10:02:10")],
    [line("P1", "10:00:40"), line("P1", "10:01:10"), line("P2", "10:00:10")],
    [line("P1", "10:10:00")],
    [line("P3", "10:10:05")],
]


def write_files(folder, files, start=0):
    os.makedirs(folder, exist_ok=True)
    base = time.time() - 1000
    for i, rows in enumerate(files, start):
        path = os.path.join(folder, f"f{i + 1}.json")
        with open(path, "w") as f:
            f.write("".join(rows))
        os.utime(path, (base + 10 * i, base + 10 * i))


def read_lines(spark, folder):
    if not os.path.exists(folder):
        return []
    return sorted(r.value for r in spark.read.text(folder).collect())


def expected_p1(starts):
    out = []
    for s in starts:
        h, m, sec = (int(x) for x in s.split(":"))
        total = h * 3600 + m * 60 + sec + 60
        e = f"{total // 3600:02d}:{total % 3600 // 60:02d}:{total % 60:02d}"
        out.append(f"janela=[2026-07-01T{s}Z -> 2026-07-01T{e}Z] produto=P1 eventos=1")
    return sorted(out)


def run(spark, tmp, kv=None, threshold=5):
    q = start_trending(
        spark,
        str(tmp / "in"),
        str(tmp / "lines"),
        str(tmp / "ckpt"),
        kv=kv,
        threshold=threshold,
        available_now=True,
        max_files_per_trigger=1,
    )
    q.awaitTermination()
    return q


def test_late_rows_are_dropped_per_window(spark, tmp_path):
    write_files(str(tmp_path / "in"), FILES)
    run(spark, tmp_path)
    got = read_lines(spark, str(tmp_path / "lines"))
    assert got == expected_p1(["09:59:30", "10:00:00", "10:01:00", "10:01:30", "10:02:00"])


def test_restart_repeats_nothing_and_continues(spark, tmp_path):
    write_files(str(tmp_path / "in"), FILES[:2])
    run(spark, tmp_path)
    # f1 moved the watermark to 10:01:30: the two windows ending by then closed
    closed = expected_p1(["09:59:30", "10:00:00"])
    assert read_lines(spark, str(tmp_path / "lines")) == closed
    run(spark, tmp_path)  # restart, no new file: nothing repeated
    assert read_lines(spark, str(tmp_path / "lines")) == closed
    write_files(str(tmp_path / "in"), FILES[2:], start=2)
    run(spark, tmp_path)
    got = read_lines(spark, str(tmp_path / "lines"))
    assert got == expected_p1(["09:59:30", "10:00:00", "10:01:00", "10:01:30", "10:02:00"])


def test_alerts_are_upserted_once(spark, tmp_path):
    rows = [line("P9", f"10:00:{s:02d}") for s in range(0, 12, 2)]  # 6 events
    rows.append(line("P8", "10:05:00"))  # closes the P9 windows
    write_files(str(tmp_path / "in"), [rows])
    kv = KeyValueStore(spark, str(tmp_path / "kv"))
    run(spark, tmp_path, kv=kv, threshold=5)
    cells = {(r.row_key, r.column): r.value for r in kv.read(KV_TABLE_ALERTS).collect()}
    start_ms = 1782899970000  # 2026-07-01T09:59:30Z
    assert cells[(f"P9-{start_ms}", "cf:eventos")] == "6"
    assert cells[(f"P9-{start_ms}", "cf:janela_inicio")] == "2026-07-01T09:59:30Z"
    assert cells[(f"P9-{start_ms}", "cf:janela_fim")] == "2026-07-01T10:00:30Z"
    assert cells[(f"P9-{start_ms + 30000}", "cf:produto")] == "P9"
    assert kv.count_rows(KV_TABLE_ALERTS) == 2
    run(spark, tmp_path, kv=kv, threshold=5)  # restart: no new batch, no change
    assert kv.count_rows(KV_TABLE_ALERTS) == 2


def test_a_failing_alert_write_leaves_all_lines(spark, tmp_path, caplog):
    class Broken(KeyValueStore):
        def put(self, cells, table, name=None):
            cells.count()
            raise OSError("store is away")

    rows = [line("P9", f"10:00:{s:02d}") for s in range(0, 12, 2)] + [line("P8", "10:05:00")]
    write_files(str(tmp_path / "in"), [rows, [line("P8", "10:20:00")]])
    run(spark, tmp_path, kv=Broken(spark, str(tmp_path / "kv")))
    got = read_lines(spark, str(tmp_path / "lines"))
    assert sum("produto=P9 eventos=6" in x for x in got) == 2 and any("produto=P8" in x for x in got)
    assert sum("alert write failed" in r.message for r in caplog.records) >= 2


def test_a_new_checkpoint_adds_and_an_emptied_one_loses_nothing(spark, tmp_path):
    rows = [line("P9", f"10:00:{s:02d}") for s in range(0, 12, 2)] + [line("P8", "10:05:00")]
    write_files(str(tmp_path / "in"), [rows])
    kv = KeyValueStore(spark, str(tmp_path / "kv"))
    run(spark, tmp_path, kv=kv)
    first = read_lines(spark, str(tmp_path / "lines"))
    assert first and kv.count_rows(KV_TABLE_ALERTS) == 2
    os.rename(tmp_path / "ckpt", tmp_path / "ckpt-of-the-first-run")  # the path is used again
    os.rename(tmp_path / "in", tmp_path / "in-of-the-first-run")
    more = [line("P7", f"11:00:{s:02d}") for s in range(0, 12, 2)] + [line("P6", "11:05:00")]
    write_files(str(tmp_path / "in"), [more])
    run(spark, tmp_path, kv=kv)
    both = read_lines(spark, str(tmp_path / "lines"))
    assert len(both) == 2 * len(first) and set(first) < set(both)
    keys = {r.row_key.split("-")[0] for r in kv.read(KV_TABLE_ALERTS).collect()}
    assert keys == {"P9", "P7"}


def test_starting_a_stream_leaves_the_session_settings(spark, tmp_path):
    keys = (
        "spark.sql.streaming.statefulOperator.allowMultiple",
        "spark.sql.streaming.stateStore.providerClass",
    )
    before = [spark.conf.get(k, None) for k in keys]
    write_files(str(tmp_path / "in"), FILES[:1])
    run(spark, tmp_path)
    assert [spark.conf.get(k, None) for k in keys] == before


def test_landing_copies_lines_once(spark, tmp_path):
    write_files(str(tmp_path / "src"), FILES)
    q = start_landing(spark, str(tmp_path / "src"), str(tmp_path / "land"), str(tmp_path / "ck"), available_now=True)
    q.awaitTermination()
    first = read_lines(spark, str(tmp_path / "land"))
    assert first == sorted(x.rstrip("\n") for f in FILES for x in f)
    q = start_landing(spark, str(tmp_path / "src"), str(tmp_path / "land"), str(tmp_path / "ck"), available_now=True)
    q.awaitTermination()
    assert read_lines(spark, str(tmp_path / "land")) == first


def test_restart_after_failure_resumes(spark, tmp_path):
    from cartwheel.streaming.restart import run_with_restarts

    write_files(str(tmp_path / "in"), FILES)
    attempts = []

    def start():
        attempts.append(1)
        reader = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(tmp_path / "in"))

        def sink(df, batch_id):
            if len(attempts) == 1 and batch_id == 1:
                raise RuntimeError("injected failure")
            df.write.mode("overwrite").text(str(tmp_path / "out" / f"batch={batch_id}"))

        return (
            reader.writeStream.foreachBatch(sink)
            .option("checkpointLocation", str(tmp_path / "ck"))
            .trigger(availableNow=True)
            .start()
        )

    assert run_with_restarts(start, delay_seconds=0.1, max_attempts=3) == 1
    got = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert got == sorted(x.rstrip("\n") for f in FILES for x in f)


def test_continuous_mode_with_files_arriving(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    q = start_trending(
        spark,
        str(tmp_path / "in"),
        str(tmp_path / "lines"),
        str(tmp_path / "ckpt"),
        poll="1 second",
    )
    try:
        for i, rows in enumerate(FILES):
            staged = tmp_path / f"f{i + 1}.tmp"
            with open(staged, "w") as f:
                f.write("".join(rows))
            os.replace(staged, tmp_path / "in" / f"f{i + 1}.json")  # land atomically
            q.processAllAvailable()
    finally:
        q.stop()
    assert read_lines(spark, str(tmp_path / "lines")) == expected_p1(
        ["09:59:30", "10:00:00", "10:01:00", "10:01:30", "10:02:00"]
    )
