"""Plans, note pairing and rendering."""

import hashlib
import json
import random
import struct
from collections import deque

import pytest

from sparkloom.operators import windows
from sparkloom.plans import groove as G
from sparkloom.sources import symbolic


def varlen(n):
    out = [n & 127]
    while n := n >> 7:
        out.append(n & 127 | 128)
    return bytes(out[::-1])


def midi(tracks, division=480):
    """A MIDI file of tracks, each a list of (tick, bytes)."""
    body = b""
    for events in tracks:
        data, last = b"", 0
        for tick, raw in events:
            data += varlen(tick - last) + raw
            last = tick
        data += b"\x00\xff\x2f\x00"
        body += b"MTrk" + struct.pack(">I", len(data)) + data
    return b"MThd" + struct.pack(">IHHH", 6, 1, len(tracks), division) + body


def song(seed=0):
    rng = random.Random(seed)
    tracks = [[(0, b"\xff\x51\x03" + (400_000).to_bytes(3, "big")), (960, b"\xff\x51\x03" + (600_000).to_bytes(3, "big"))]]
    for k, name in enumerate((b"bass", b"piano")):
        events = [(0, b"\xff\x03" + bytes([len(name)]) + name)]
        for i in range(20):
            for pitch in rng.sample(range(40, 80), 1 + k * 2):
                events += [(i * 240, bytes([0x90 + k, pitch, 80])), (i * 240 + 200, bytes([0x80 + k, pitch, 0]))]
        tracks.append(sorted(events, key=lambda e: e[0]))
    return midi(tracks)


PLAN = {"work_id": "w", "arrangement_id": "a", "genre": "funk", "sections": [{"id": "a", "type": "verse", "start_tick": 0, "end_tick": 2400}], "tracks": [{"id": "bass", "family": "bass", "role": "electric_bass"}, {"id": "kick", "family": "drums", "role": "kick"}, {"id": "piano", "family": "keyboard", "role": "piano", "peak_notes_per_second": 9}]}


def planned(spark, *songs, seed=None):
    rows = spark.createDataFrame([(i, t if t is None or isinstance(t, str) else json.dumps(t)) for i, t in enumerate(songs)], "i int, song string")
    return [r.plan if r.plan is None else json.loads(r.plan) for r in G.plans(rows, song_seed=seed).orderBy("i").collect()]


def test_plans(spark):
    plan, other, *bad = planned(spark, PLAN, PLAN | {"work_id": "v"}, "nonsense", None, "[]")
    assert bad == [None, None, None] and plan != other
    assert plan["anchor_groups"] == {"RHYTHM_CORE": ["bass", "kick"]} and plan["tracks"][2]["anchor_group"] == "NONE"
    assert plan["tracks"][2]["family"] == "keys" and plan["tracks"][2]["fast_passage_timing_multiplier"] == 0.45
    assert plan["render_audio_enabled"] is False and plan["sections"][0]["end_tick"] == 2400 and plan["status"] == "RENDER_HOLD_PLAN_ONLY"
    assert plan["clean_tier_constraints"]["target_is_original_canonical_midi"] and not plan["macro_tempo_warp"]["enabled"]
    assert planned(spark, PLAN, seed=5)[0]["song_seed"] == 5


def test_draws_are_those_of_the_format(spark):
    """Level and strength by the generator itself: the plan's draws come in a fixed order."""
    for work in "abcdefgh":
        plan = planned(spark, {"work_id": work, "arrangement_id": "x", "genre": "jazz"})[0]
        number = int.from_bytes(hashlib.sha256("\x1f".join((work, "x", G.POLICY)).encode()).digest()[:8], "big")
        rng = random.Random(number)
        x, reached = rng.random(), 0.0
        for name, chance, lo, hi in G.LEVELS:
            reached += chance
            if x <= reached:
                break
        strength = rng.uniform(lo, hi)
        template = rng.choice(G.TEMPLATES["jazz"])
        if name == "NONE_OR_TIGHT":
            template = rng.choice(list(G.TIGHT))
        assert (plan["song_seed"], plan["global_level"], plan["global_strength"], plan["template"]) == (number, name, round(strength, 4), template)
        assert plan["sections"] == [{"id": "whole_song", "type": "unknown", "strength_multiplier": round(rng.uniform(*G.SECTIONS["unknown"]), 4)}]


def test_first_note_ends_first(spark):
    events = [(0, b"\x90\x3c\x50"), (10, b"\x90\x3c\x46"), (20, b"\x80\x3c\x00"), (30, b"\x90\x3c\x00"), (40, b"\x80\x3c\x00"), (50, b"\x90\x3e\x50")]
    rows = G.notes(spark.createDataFrame([("f", bytearray(midi([events]))), ("bad", bytearray(b"x")), ("none", None)], "file string, content binary")).collect()
    assert [(r.event_id, r.on_tick, r.off_tick, r.velocity) for r in rows] == [("t0:n1", 0, 20, 80), ("t0:n2", 10, 30, 70)]


def test_render(spark):
    files = spark.createDataFrame([("f", bytearray(song())), ("g", bytearray(song(1)))], "file string, content binary")
    rows = G.with_seconds(G.notes(files), G.tempos(files))
    by = {(r.file, r.event_id): r for r in rows.collect()}
    assert len(by) == 2 * (20 + 60) and {r.track_name for r in by.values()} == {"bass", "piano"}
    # a faster tempo at tick 0 is lost to the default, as in the format's rules
    assert all(r.on_seconds == pytest.approx(min(r.on_tick, 960) * 0.5 / 480 + max(0, r.on_tick - 960) * 0.6 / 480) for r in by.values())
    fast = G.with_speed(rows)
    times = {}
    for r in by.values():
        times.setdefault((r.file, r.track), []).append(r.on_seconds)
    for r in fast.collect():
        n = sum(abs(t - r.on_seconds) <= 0.5 for t in times[r.file, r.track])
        assert r.density == n and r.speed == next((s for most, s in G.DENSITY_STEPS if n < most), G.DENSE)
    plan = planned(spark, PLAN, seed=7)[0]
    for t in plan["tracks"]:  # strong, so that bounds and order protection matter
        t |= {"timing_strength": 1.1, "velocity_strength": 0.9, "duration_strength": 1.0, "chord_spread_strength": 1.0}
    plans = spark.createDataFrame([(f, json.dumps(plan)) for f in "fg"], "file string, plan string")
    out = G.perform(fast, plans)
    report = G.quality(rows, out).first()
    assert report.passed and report.notes_in == report.notes_out == 160 and report.one_to_one
    moved = out.collect()
    step = 120
    for r in moved:
        long = max(1, r.off_tick - r.on_tick)
        assert 1 <= r.velocity_out <= 127 and r.render_on - r.on_tick == r.onset_offset and r.render_off - r.render_on <= max(1, int(long * 1.3 + step * 0.1))
        assert -0.45 * step <= r.onset_offset <= 0.45 * step + 0.2 * step
    assert any(r.onset_offset for r in moved) and any(r.velocity_out != r.velocity for r in moved)
    assert set(G.groove_map(out).columns) == {"file", *G.GROOVE}
    loud = {(r.file, r.event_id): r for r in moved}
    for (_, event), r in loud.items():  # the draws of a note, by the generator itself
        seeds = [int.from_bytes(hashlib.sha256("\x1f".join((str(plan["song_seed"]), event, x)).encode()).digest()[:8], "big") for x in ("dur", "vel")]
        stretch = random.Random(seeds[0]).uniform(-0.14, 0.14)
        want = max(1, round((r.off_tick - r.on_tick) * (1 + stretch)))
        assert abs((r.render_off - r.render_on) - min(want, max(1, int((r.off_tick - r.on_tick) * 1.3 + 12)))) <= 0
        accent = G.ACCENTS[round(r.on_tick / step) % 4]
        assert r.velocity_out == round(min(127, max(1, r.velocity * (1 + (accent - 1) * 0.9) + random.Random(seeds[1]).gauss(0.0, 5.4))))
    again = G.render_files(files, out)
    rendered = G.notes(again).collect()
    assert sorted((r.file, r.track, r.pitch, r.velocity, r.on_tick) for r in rendered) == sorted((r.file, r.track, r.pitch, r.velocity_out, r.render_on) for r in moved)
    assert sorted(map(tuple, G.tempos(again).collect())) == sorted(map(tuple, G.tempos(files).collect()))


def test_plans_that_may_not_be_performed(spark):
    files = spark.createDataFrame([("f", bytearray(song()))], "file string, content binary")
    rows = G.with_speed(G.with_seconds(G.notes(files), G.tempos(files)))
    good = planned(spark, PLAN)[0]
    for bad in (good | {"render_audio_enabled": True}, {k: v for k, v in good.items() if k != "render_audio_enabled"}, good | {"clean_tier_constraints": {}}):
        with pytest.raises(G.BadPlan):
            G.perform(rows, spark.createDataFrame([("f", json.dumps(bad))], "file string, plan string"))


def test_fifo_pairs_as_by_queues(spark):
    rng = random.Random(5)
    rows = [(g, i, rng.random() < 0.5) for g in "abc" for i in range(200)]
    want = []
    for g in "abc":
        held = deque()
        for _, i, on in (r for r in rows if r[0] == g):
            if on:
                held.append(i)
            elif held:
                want.append((g, held.popleft(), i))
    got = windows.fifo_pairs(spark.createDataFrame(rows, "g string, i int, is_on boolean"), ["g"], "i", "is_on")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_midi_summary():
    events = [(0, b"\xc0\x05"), (0, b"\xc9\x07"), (0, b"\x90\x3c\x40"), (5, b"\x3d\x40"), (9, b"\x3c\x00"), (9, b"\xf0\x02\x01\xf7"), (9, b"\xff\x01\x01x")]
    got = symbolic.midi_summary(midi([events]))
    assert got == {"format": 1, "division": 480, "tracks": 1, "notes": 2, "programs": [5], "error": None}
    assert symbolic.midi_summary(b"nope")["error"] and symbolic.midi_summary(None) is None
    data = midi([events])
    assert symbolic.midi_summary(data[:30])["tracks"] == 1
    assert symbolic.varlen(b"\x83\x60", 0) == (480, 2)
