"""The delivery check on hand-made source and sink files (FIXTURES F7)."""

import datetime as dt
import os

from cartwheel import operators as op
from cartwheel.plans.verify import check


def j(i, t=None):
    return '{"event_id":"%s"%s}' % (i, "" if t is None else ',"event_type":"%s"' % t)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)


def test_report_counts_every_case(spark, tmp_path):
    src = tmp_path / "events.log"
    write(str(src), "\n".join([j("a", "click"), j("b", "click"), j("b", "click"), j("c", "purchase"), j("d", "click")]) + "\n")
    sink = tmp_path / "sink"
    write(
        str(sink / "f1.log"),
        j("a", "click") + "\r\n"
        + "\n"
        + j("b", "click") + "\n"
        + '{"event_id":"c", broken' + "\n"  # broken middle line: invalid
        + j("x", "click") + "\n"  # foreign id
        + j("d") + "\n"  # id but no type: id counted, line invalid
        + j("c", "purchase") + "\n",
    )
    write(str(sink / "f2.log"), j("d", "click") + "\n" + '{"event_id":"e","event_ty')  # broken last line
    report, types = check(spark, str(src), str(sink))
    r = report.first().asDict()
    assert r == {
        "source_rows": 5,
        "sink_files": 2,
        "sink_rows": 8,
        "invalid": 2,
        "incomplete_last": 1,
        "foreign_ids": 1,
        "missing_rows": 1,
        "ok": False,
    }
    assert [tuple(x) for x in types.collect()] == [("click", 4), ("purchase", 1)]


def test_clean_delivery_is_ok_and_missing_source_counts_zero(spark, tmp_path):
    sink = tmp_path / "sink"
    write(str(sink / "f1.log"), j("a", "click") + "\n" + j("b", "view") + "\n")
    report, _ = check(spark, str(tmp_path / "no-such-file.log"), str(sink))
    r = report.first()
    assert (r.source_rows, r.sink_rows, r.foreign_ids, r.ok) == (0, 2, 2, False)
    write(str(tmp_path / "src.log"), j("a", "click") + "\n" + j("b", "view") + "\n" + j("c", "view") + "\n")
    r = check(spark, str(tmp_path / "src.log"), str(sink))[0].first()
    assert (r.missing_rows, r.invalid, r.incomplete_last, r.ok) == (1, 0, 0, True)


def test_empty_sink_fails(spark, tmp_path):
    write(str(tmp_path / "src.log"), j("a", "click") + "\n")
    r = check(spark, str(tmp_path / "src.log"), str(tmp_path / "nothing"))[0].first()
    assert (r.sink_files, r.sink_rows, r.missing_rows, r.ok) == (0, 0, 1, False)


def test_last_line_found_across_splits(spark, tmp_path):
    # a file cut into many splits: only its true last line is "incomplete"
    body = "".join(j(f"id{i:06d}", "click") + "\n" for i in range(20000)) + "{broken"
    write(str(tmp_path / "sink" / "big.log"), body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        r = check(spark, str(tmp_path / "sink" / "big.log"), str(tmp_path / "sink"))[0].first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert (r.sink_rows, r.invalid, r.incomplete_last) == (20001, 0, 1)


def test_growth_states(spark):
    t = dt.datetime(2026, 7, 1, 10, 0, 0)
    samples = spark.createDataFrame(
        [(t + dt.timedelta(seconds=15 * i), 10 * (i + 1), s) for i, s in enumerate([3, 5, 5, 9])],
        "sample_ts timestamp_ntz, source_rows bigint, sink_rows bigint",
    )
    rep = op.growth_report(samples)
    assert [(r.difference, r.state) for r in rep.orderBy("sample_ts").collect()] == [
        (7, "first sample"),
        (15, "growing"),
        (25, "stalled"),
        (31, "growing"),
    ]
    assert op.growth_ok(rep).first().ok is False


def test_empty_rolled_file_counts_as_a_file(spark, tmp_path):
    write(str(tmp_path / "src.log"), j("a", "click") + "\n")
    write(str(tmp_path / "sink" / "f1.log"), j("a", "click") + "\n")
    write(str(tmp_path / "sink" / "f2.log"), "")
    r = check(spark, str(tmp_path / "src.log"), str(tmp_path / "sink"))[0].first()
    assert (r.sink_files, r.sink_rows, r.ok) == (2, 1, True)


def test_ids_of_different_json_types_stay_apart(spark, tmp_path):
    write(str(tmp_path / "src.log"), '{"event_id":7,"event_type":"x"}\n{"event_id":null,"event_type":"x"}\n{"event_id":1,"event_type":"x"}\n')
    sink = '{"event_id":"7","event_type":"x"}\n{"event_id":"null","event_type":"x"}\n{"event_id":1.0,"event_type":"x"}\n'
    write(str(tmp_path / "sink" / "f"), sink)
    r = check(spark, str(tmp_path / "src.log"), str(tmp_path / "sink"))[0].first()
    assert (r.foreign_ids, r.missing_rows) == (2, 2)


def test_a_file_that_grows_is_counted_again(spark, tmp_path):
    from cartwheel.streaming.line_count import RunningLineCount

    write(str(tmp_path / "sink" / "open.log"), "a\nb\n\nc\n")
    write(str(tmp_path / "sink" / "closed.log"), "d\n")
    write(str(tmp_path / "sink" / "empty.log"), "")
    count = RunningLineCount(spark, str(tmp_path / "sink"), str(tmp_path / "state"))
    assert count.sample() == 4
    assert count.sample() == 4
    with open(tmp_path / "sink" / "open.log", "a") as f:
        f.write("e\nf\ng\nh\n")
    assert count.sample() == 8
    write(str(tmp_path / "sink" / "new.log"), "i\n")
    assert count.sample() == 9
    os.remove(tmp_path / "sink" / "closed.log")
    assert count.sample() == 8
    assert RunningLineCount(spark, str(tmp_path / "nothing"), str(tmp_path / "state2")).sample() == 0


def test_monitor_sees_the_sink_grow(spark, tmp_path):
    import threading
    import time

    from cartwheel.plans.verify import monitor

    write(str(tmp_path / "src.log"), "".join(j(f"i{n}", "click") + "\n" for n in range(6)))
    write(str(tmp_path / "sink" / "f1.log"), j("i0", "click") + "\n" + j("i1", "click") + "\n")

    def land_later():
        time.sleep(6)
        write(str(tmp_path / "stage.tmp"), j("i2", "click") + "\n\n" + j("i3", "click") + "\n")
        os.replace(str(tmp_path / "stage.tmp"), str(tmp_path / "sink" / "f2.log"))  # atomic landing

    t = threading.Thread(target=land_later)
    t.start()
    rep = monitor(spark, str(tmp_path / "src.log"), str(tmp_path / "sink"), minutes=12 / 60, interval=1.5)
    t.join()
    rows = [tuple(r) for r in rep.orderBy("sample_ts").select("source_rows", "sink_rows", "state").collect()]
    assert rows[0][0] == 6 and rows[0][2] == "first sample"
    assert rows[-1][:2] == (6, 4)
    sinks = [r[1] for r in rows]
    assert sinks == sorted(sinks)
    if rows[0][1] == 2:  # the first sample came before the second file
        assert "growing" in [r[2] for r in rows]
