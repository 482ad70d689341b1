"""Streams over files, one file a micro-batch."""

import json

from sparkloom.streaming import streams


def run(spark, tmp_path, batches, schema, build, mode="append"):
    src, name = tmp_path / "in", f"out{abs(hash(str(tmp_path))) % 10**8}"
    src.mkdir()
    for i, rows in enumerate(batches):
        (src / f"{i}.json").write_text("\n".join(json.dumps(r) for r in rows))
        os_time = 1_700_000_000 + i
        import os

        os.utime(src / f"{i}.json", (os_time, os_time))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(src))
    q = build(stream).writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return [tuple(r) for r in spark.table(name).collect()]


def test_notes_pair_across_batches(spark, tmp_path):
    on = lambda s, t, v: {"track": "a", "seq": s, "tick": t, "pitch": 60, "velocity": v}
    got = run(spark, tmp_path, [[on(1, 0, 80), on(2, 10, 70)], [on(4, 30, 0), on(3, 20, 0), on(5, 40, 0)]], "track string, seq int, tick long, pitch int, velocity int", streams.paired_notes)
    assert sorted(got) == [("a", 60, 70, 10, 30), ("a", 60, 80, 0, 20)]


def test_first_seen_and_counts(spark, tmp_path):
    rows = [[{"ts": "2024-01-01T00:00:00", "k": "a"}, {"ts": "2024-01-01T00:01:00", "k": "a"}], [{"ts": "2024-01-01T00:02:00", "k": "a"}, {"ts": "2024-01-01T02:00:00", "k": "b"}]]
    (tmp_path / "x").mkdir()
    (tmp_path / "y").mkdir()
    got = run(spark, tmp_path / "x", rows, "ts timestamp, k string", lambda s: streams.first_seen(s, ["k"], "ts").select("k"))
    assert sorted(got) == [("a",), ("b",)]
    got = run(spark, tmp_path / "y", rows, "ts timestamp, k string", lambda s: streams.window_counts(s, "ts", "k"))
    assert [(k, n) for _, k, n in got] == [("a", 3)]
