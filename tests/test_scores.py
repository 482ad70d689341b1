"""Manifests of linked scores."""

from pyspark.sql import functions as F

from sparkloom.plans import scores as S

ABC = b"X:1\nT:A\nC:B\nM:4/4\nK:C\nV:1\n%%MIDI program 40\n"


def test_aligned_pairs(spark):
    scores = spark.createDataFrame([("s1", "w")], "score_id string, folder string")
    audios = spark.createDataFrame([(10, "s1", "1001"), (11, "s1", "1002"), (12, "s1", "1001"), (13, "s9", "1001")], "audio_id int, score_id string, number string")
    headers = spark.createDataFrame([("w", ["q", "1001_tstamp", "1003_tstamp"])], "folder string, header array<string>")
    got = {r.audio_id: r for r in S.aligned_pairs(scores, audios, headers).collect()}
    assert {k: r.reason for k, r in got.items()} == {10: "ok", 11: "audio_metadata_has_no_alignment_column", 12: "duplicate_number_for_score", 13: "score_not_found"}
    assert got[10].alignment_column == "1001_tstamp" and len(got[10].pair_id) == 20
    assert [r.alignment_column for r in S.unused_columns(audios, scores, headers).collect()] == ["1003_tstamp"]


def test_tree(spark):
    names = [f"/r/data/Some_Composer/A_Work/{m}/W_{m}{s}" for m in ("01", "02") for s in (".mxl", ".mscz", ".mm.json", "_melody.mxl")]
    rows = S.tree_scores(spark.createDataFrame([(n,) for n in names], "path string")).collect()
    assert len(rows) == 2 and {(r.composer, r.work, r.movement) for r in rows} == {("Some Composer", "A Work", "01"), ("Some Composer", "A Work", "02")}
    assert all(r.mscz and r.mm_json for r in rows)


def test_note_scores(spark):
    members = [("s/Track_A.txt", b"onset\toffset\tpitch\tprogram\n0\t1\t60\t40\n"), ("s/Track_B.txt", b"0\t2\t62\t41\n1\t0\t1\t1\n"), ("s/C.txt", b"0\t2\t62\t41\n1\t0\t1\t1\n")]
    songs = [("track-a", "Song A"), ("Track B", "Song B"), ("C", "x"), ("c", "y")]
    got = {r.member: r for r in S.note_scores(spark.createDataFrame(members, "member string, content binary"), spark.createDataFrame(songs, "key string, song_name string")).collect()}
    assert [got[m].song_name for m, _ in members] == ["Song A", "Song B", "C"] and [got[m].matched for m, _ in members] == [True, True, False]
    assert (got["s/Track_B.txt"].n_notes, got["s/Track_B.txt"].n_malformed, got["s/Track_B.txt"].programs) == (1, 1, [41])
    assert got["s/C.txt"].is_canonical and not got["s/Track_B.txt"].is_canonical


def test_abc_scores(spark):
    scores = [("dataset/Collection/alpha.abci", ABC), ("dataset/Collection/alpha-copy.abci", ABC), ("dataset/flat/beta.abci", ABC + b"x"), ("dataset/other/piano.abci", ABC + b"y")]
    midis = [("original/alpha.mid", b""), ("original/betafile.mid", b"")]
    hints = [("dataset/flat/beta.json", ["original/betafile.mid"])]
    kind = "member string, content binary"
    rows = S.abc_scores(spark.createDataFrame(scores, kind), spark.createDataFrame(midis, kind), ["/Collection/"], hints=spark.createDataFrame(hints, "member string, names array<string>"))
    got = {r.member.rsplit("/", 1)[1]: r for r in rows.collect()}
    assert set(got) == {"alpha.abci", "alpha-copy.abci", "beta.abci"}
    assert got["beta.abci"].selection_method == "sidecar-json" and got["beta.abci"].midi_member == "original/betafile.mid"
    assert got["alpha.abci"].midi_member == "original/alpha.mid" and got["alpha.abci"].selection_method == "path-marker"
    assert sum(r.canonical_score_hash for r in got.values()) == 2 and got["alpha.abci"].programs == [40]
    assert S.declared_count_ok(990, 1000) and not S.declared_count_ok(960, 1000)


def test_selected(spark):
    members = spark.createDataFrame([("./mid/a.mid",), ("mid/b.mid",)], "member string")
    some, missing = S.selected(members, spark.createDataFrame([("mid/a.mid",), ("./mid/c.mid",), ("",)], "member string"))
    assert [r.member for r in some.collect()] == ["./mid/a.mid"] and [r.member for r in missing.collect()] == ["mid/c.mid"]


def test_manifests_in_order(spark):
    members = [("s/b.txt", b"0\t1\t60\t40\n"), ("s/a.txt", b"0\t2\t62\t41\n"), ("s/none.txt", b"x\n")]
    songs = [("b", "alpha"), ("a", "Beta")]
    notes = S.note_scores(spark.createDataFrame(members, "member string, content binary"), spark.createDataFrame(songs, "key string, song_name string"))
    got = S.note_manifest(notes, {"human_performance_claim": False}).collect()
    assert [(r.track_name, r.start_seconds, r.end_seconds, r.instrument_programs) for r in got] == [("alpha", "0.000000", "1.000000", "[40]"), ("Beta", "0.000000", "2.000000", "[41]")]
    assert not got[0].human_performance_claim and got[0].metadata_sources == "" and got[0].score_bytes == 10
    kind = "member string, content binary"
    midi = bytes.fromhex("4d546864000000060000000100604d54726b0000000c00c0050090 3c40 00803c00 00ff2f00".replace(" ", ""))
    scores = spark.createDataFrame([("d/M/one.abc", ABC), ("d/M/two.abc", ABC + b"%source here\n"), ("d/other/three.abc", ABC + b"%SOURCE here\n")], kind)
    midis = spark.createDataFrame([("m/one.mid", midi), ("m/three.mid", midi)], kind)
    rows = S.abc_scores(scores, midis, ["/M/"], content_markers=("source here",))
    out = {r.score_member_path: r for r in S.abc_manifest(rows, {"license_claim": "x"}, midis).collect()}
    assert {k: r.source_detection_method for k, r in out.items()} == {"d/M/one.abc": "path-marker", "d/M/two.abc": "path-marker", "d/other/three.abc": "abc-content-marker"}
    assert out["d/M/one.abc"].source_midi_bytes == len(midi) and out["d/M/one.abc"].abc_midi_programs == "[40]" and out["d/M/two.abc"].source_midi_member_path == ""
    assert S.match_rate(rows) == 2 / 3 and S.match_rate(rows.limit(0)) == 0
    hints = spark.createDataFrame([("d/M/two.json", ["m/one.mid"], 1), ("d/x/two.json", ["m/three.mid"], 2)], "member string, names array<string>, ordinal int")
    assert {r.member: r.midi_member for r in S.abc_scores(scores, midis, ["/M/"], hints=hints).collect()}["d/M/two.abc"] == "m/three.mid"  # the last hint of a name counts
