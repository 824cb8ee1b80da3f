"""Growth samples from a stream's progress: new, stalled and restarted sinks."""

import threading
import time

from cartwheel.streaming.growth import GrowthStream


def states(report):
    return [(r.sink_rows, r.state) for r in report.orderBy("sample_ts").collect()]


def test_every_batch_is_a_sample_and_a_restart_goes_on(spark, tmp_path, lines_writer):
    sink, state = str(tmp_path / "sink"), str(tmp_path / "state")
    for n in range(3):
        lines_writer(sink, [f"line {i}\n" for i in range(n + 1)] + ["\n", "  \n"], f"part-{n}.txt")
        time.sleep(0.05)
    stream = GrowthStream(spark, sink, state)
    assert stream.counted() == 0
    assert states(stream.sample(max_files_per_trigger=1)) == [(1, "first sample"), (3, "growing"), (6, "growing")]
    lines_writer(sink, ["\n"], "part-3.txt")
    lines_writer(sink, ["more\n"] * 4, "part-4.txt")
    again = GrowthStream(spark, sink, state)
    assert again.counted() == 6
    assert states(again.sample()) == [(10, "first sample")]
    assert again.counted() == 10


def test_an_idle_sink_is_stalled(spark, tmp_path, lines_writer):
    sink = str(tmp_path / "sink")
    lines_writer(sink, ["a\n", "b\n"], "part-0.txt")
    stream = GrowthStream(spark, sink, str(tmp_path / "state"))
    late = threading.Timer(14, lambda: lines_writer(sink, ["c\n"], "part-1.txt"))
    late.start()
    got = states(stream.sample(seconds=24, interval="500 milliseconds"))
    late.join()
    counts = [n for n, _ in got]
    assert counts[0] == 2 and counts[-1] == 3 and counts == sorted(counts)
    assert ("stalled" in [s for _, s in got]) and (3, "growing") in got
    # a sample that did not grow is stalled, whatever came before
    assert all((s == "growing") == (a < b) for a, (b, s) in zip(counts, got[1:]))
