"""Files, archives, symbolic scores, sinks."""

import gzip
import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from sparkloom.sources import archives, sinks, symbolic, tables

ABC = b"\xef\xbb\xbfX:1\nT: First \nT:Second\nC:Bach\nM:4/4\nK:G\nV:1 name=a\nV:2\n%%MIDI program 40\n%%MIDI program 1 7\n%%MIDI program 200\n[V:1] abc [V:3] d\n"


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('\ufeffid,"x.y",text\n1,2,"two\nlines, ""quoted"""\n3,,é\n'.encode())
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write("id,x.y,text\n5,6,z\n")
    rows = tables.read_csv(spark, str(tmp_path / "a.csv"), ["id", "x.y"]).collect()
    assert [tuple(r) for r in rows] == [("1", "2", 'two\nlines, "quoted"'), ("3", None, "é")]
    assert tables.read_csv(spark, str(tmp_path / "b.csv.gz")).count() == 1
    with pytest.raises(tables.MissingColumns):
        tables.read_csv(spark, str(tmp_path / "a.csv"), ["nope"])


def test_headers_and_tree(spark, tmp_path):
    for work in ("A/W", "B/V"):
        (tmp_path / work).mkdir(parents=True)
        (tmp_path / work / "s.mxl").write_text("x")
        (tmp_path / work / "s.mscz").write_text("y")
        (tmp_path / work / "s_melody.mxl").write_text("z")
    (tmp_path / "A/W/x_alignment.csv").write_text("q,1001_tstamp\n1,2\n3,4\n")
    (tmp_path / "A/W/y_alignment.csv").write_text("\n")
    from sparkloom.operators import joins

    files = tables.tree(spark, str(tmp_path), "*.m*").select("path", "parts")
    kept = files.filter(~F.col("path").endswith("_melody.mxl"))
    assert joins.siblings(kept.select("path"), ".mxl", [".mscz"], [".mm.json"]).count() == 2
    heads = tables.headers(spark, str(tmp_path), "*_alignment.csv")
    got = {r.path.rsplit("/", 1)[1]: (r.header, r.n_rows) for r in heads.collect()}
    assert got == {"x_alignment.csv": (["q", "1001_tstamp"], 2), "y_alignment.csv": ([], 0)}
    rows = spark.createDataFrame([("w", "1001", 10), ("w", "1002", 11)], "work string, number string, audio int")
    met = joins.header_join(rows, heads.select(F.lit("w").alias("work"), "header"), "work", "number")
    assert [(r.audio, r.alignment_column) for r in met.collect()] == [(10, "1001_tstamp")]
    with pytest.raises(Exception, match="not exactly one"):
        tables.exactly_one(kept.select(F.lit("f").alias("folder"), "path"), "folder", "score").collect()


def make_archives(root):
    with tarfile.open(root / "a.tar.gz", "w:gz") as t:
        for name, data in (("d/x.abc", ABC), ("d/y.mid", b"MThd"), ("d/z.txt", b"")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    with zipfile.ZipFile(root / "b.zip", "w") as z:
        z.writestr("notes/A.txt", "onset\toffset\tpitch\tprogram\n0.5\t1.5\t60\t40\n1\t0\t60\t40\n1\t2\tx\t1\n")
        z.writestr("notes/B.txt", "0\t1\t61\t0\n")


def test_archives(spark, tmp_path):
    make_archives(tmp_path)
    archives.register(spark)
    df = spark.read.format("archive").option("path", str(tmp_path)).option("members_a_task", "1").load()
    rows = sorted((r.member, r.ordinal, r.size, bytes(r.content)) for r in df.collect())
    assert [r[:3] for r in rows] == [("d/x.abc", 0, len(ABC)), ("d/y.mid", 1, 4), ("d/z.txt", 2, 0), ("notes/A.txt", 0, rows[3][2]), ("notes/B.txt", 1, 9)]
    again = archives.members(spark, str(tmp_path))
    assert sorted((r.member, r.ordinal, r.size, bytes(r.content)) for r in again.collect()) == rows
    named = spark.read.format("archive").option("path", str(tmp_path)).option("suffixes", ".abc").option("content", "false").load().collect()
    assert [(r.member, r.content) for r in named] == [("d/x.abc", None)]
    fields = df.filter("member = 'd/x.abc'").select(symbolic.abc_fields(F.col("content")).alias("f")).first().f
    assert (fields.title, fields.composer, fields.meter, fields.key, fields.voices, fields.programs) == ("First", "Bach", "4/4", "G", ["1", "2", "3"], [7, 40])
    notes = symbolic.note_lists(df.filter("member LIKE 'notes/%'"))
    assert sorted((r.member[-5], r.pitch, r.malformed) for r in notes.collect() if not r.malformed) == [("A", 60, False), ("B", 61, False)]
    assert notes.filter("malformed").count() == 2
    out = sinks.extract(df.filter("member LIKE 'd/%'"), str(tmp_path / "out")).collect()
    assert len(out) == 3 and (tmp_path / "out/d/x.abc").read_bytes() == ABC
    for bad in ("/etc/x", "a/../../b", "C:/x"):
        with pytest.raises(archives.UnsafePath):
            archives.safe(bad)


def test_json(spark):
    texts = [json.dumps({"songs": {"k": {"a": [1, "x"]}}}), json.dumps([{"b": "y"}, 3]), json.dumps({"m": {"c": 1}, "n": 2}), "bad", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r for r in df.select(tables.json_strings(F.col("t"), df).alias("s"), tables.json_songs(F.col("t"), df).alias("o")).collect()]
    assert got[0].s == ["songs", "k", "a", "x"] and [(x.key, x.song) for x in got[0].o] == [("k", '{"a": [1, "x"]}')]
    assert [x.key for x in got[1].o] == ["0"] and [x.key for x in got[2].o] == ["m"] and got[3].s is None and got[4].o is None


def test_shards_and_checksums(spark, tmp_path):
    df = spark.range(25).selectExpr("id", "id % 2 = 0 AS even", "concat('t,', id) AS text").repartition(4)
    index = sinks.write_shards(df, str(tmp_path / "s"), [F.desc("id")], 10, ["text", "id", "even"]).collect()
    assert [(r.file, r.rows) for r in index] == [("part-00001.csv.gz", 10), ("part-00002.csv.gz", 10), ("part-00003.csv.gz", 5)]
    with gzip.open(tmp_path / "s/part-00001.csv.gz", "rt") as f:
        assert f.read().splitlines()[:2] == ["text,id,even", '"t,24",24,True']
    from hashlib import sha256

    assert index[1].sha256 == sha256((tmp_path / "s/part-00002.csv.gz").read_bytes()).hexdigest()
    assert sinks.checksum_lines(sinks.checksums(spark, str(tmp_path / "s"), "*.gz")).count("\n") == 3
    sinks.complete(spark, str(tmp_path / "s"), {"rows": 25})
    assert json.loads((tmp_path / "s/_COMPLETE.json").read_text()) == {"rows": 25}
    with pytest.raises(FileExistsError):
        sinks.complete(spark, str(tmp_path / "s"), {})


def test_replace_and_fan_out(spark, tmp_path):
    target = str(tmp_path / "t")
    for n in (3, 5):
        sinks.replace_atomically(spark.range(n), target)
        assert spark.read.parquet(target).count() == n
    sinks.fan_out(spark.range(10), {"low": F.col("id") < 4, "high": F.col("id") >= 4}, str(tmp_path / "f"))
    assert spark.read.parquet(str(tmp_path / "f/low")).count() == 4
    assert [r.value for r in sinks.json_lines(spark.sql("SELECT 'é' AS b, 1 AS a, CAST(null AS int) AS c")).collect()] == ['{"a":1,"b":"é","c":null}']
    assert sinks.report("T", {"rows": 1234567}).endswith("- rows: 1,234,567\n") and sinks.empty_table(spark, "a int").count() == 0


def test_long_shards_never_split_a_record(spark, tmp_path):
    import random

    rng = random.Random(1)
    sizes = {f"r{i:03d}": rng.randrange(0, 9) for i in range(60)}
    records = spark.createDataFrame([(r,) for r in sizes], "id string")
    long = spark.createDataFrame([(r, k) for r, n in sizes.items() for k in range(n)], "id string, k int")
    want, shard, held = {}, 1, 0
    for r in sorted(sizes):
        want[r], held = shard, held + sizes[r]
        if held >= 20:
            shard, held = shard + 1, 0
    got = {r.id: r["__shard"] for r in sinks.long_shards(records, long, "id", [F.asc("id")], 20).collect()}
    assert got == {r: want[r] for r in got} and set(got) == {r for r, n in sizes.items() if n}
    index = sinks.write_long_shards(records, long, str(tmp_path / "long"), "id", [F.asc("id")], "k", 20).collect()
    assert sum(r.rows for r in index) == sum(sizes.values()) and index[0].file == "part-00001.csv.gz" and len(index) == len(set(got.values()))


def test_publish_has_no_moment_without_rows(spark, tmp_path):
    target = str(tmp_path / "p")
    for n in (3, 5):
        sinks.publish(spark.range(n), target)
        assert sinks.published(spark, target).count() == n


def test_summaries_reports_logs_and_provenance(spark, tmp_path, capsys):
    path = str(tmp_path / "summary.json")
    sinks.write_summary(spark, path, {"b": 1, "a": "é"})
    assert (tmp_path / "summary.json").read_text() == '{\n  "a": "é",\n  "b": 1\n}\n'
    assert sinks.patch_summary(spark, path, {"b": 2, "c": []}) == {"a": "é", "b": 2, "c": []} == json.loads((tmp_path / "summary.json").read_text())
    (tmp_path / "README.md").write_text("# T\n")
    for _ in range(2):
        sinks.append_section(spark, str(tmp_path / "README.md"), "\nmore\n")
    assert (tmp_path / "README.md").read_text() == "# T\n\nmore\n\nmore\n"
    sinks.print_report({"x": 1})
    assert json.loads(capsys.readouterr().out) == {"x": 1}
    for n in (2, 3):
        sinks.append_log(spark.range(n), str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 5
    sinks.write_sample(spark.range(50), str(tmp_path / "sample"), [F.desc("id")], 3)
    assert [r.id for r in tables.read_csv(spark, str(tmp_path / "sample")).collect()] == ["49", "48", "47"]
    (tmp_path / "data").mkdir()
    (tmp_path / "data/x").write_bytes(b"abc")
    assert sinks.same_digest(spark, str(tmp_path / "data/x"), "900150983CD24FB0D6963F7D28E17F72") and not sinks.same_digest(spark, str(tmp_path / "data/x"), "0" * 64)
    record = sinks.provenance(spark, {"data": str(tmp_path / "data")}, {}, {"steps": 3})
    assert record["inputs"]["data"]["bytes"] == 3 and record["steps"] == 3


def test_headers_of_odd_files(spark, tmp_path):
    for name, text in {"a.csv": '"q,1",plain,"say ""hi"""\n1,2,3\n', "b.csv": "", "c.csv": "\n \n", "d.csv": "x\n"}.items():
        (tmp_path / name).write_text(text)
    got = {r.path.rsplit("/", 1)[1]: (r.header, r.n_rows) for r in tables.headers(spark, str(tmp_path)).collect()}
    assert got == {"a.csv": (["q,1", "plain", 'say "hi"'], 1), "b.csv": ([], 0), "c.csv": ([], 0), "d.csv": (["x"], 0)}


def test_exactly_one_file_in_each_folder(spark):
    files = spark.createDataFrame([("a", "a/x"), ("b", "b/x")], "folder string, path string")
    folders = spark.createDataFrame([("a",), ("b",), ("c",)], "folder string")
    assert {r.folder: r.score for r in tables.exactly_one(files, "folder", "score").collect()} == {"a": "a/x", "b": "b/x"}
    with pytest.raises(Exception, match="not exactly one"):
        tables.exactly_one(files, "folder", "score", folders).collect()


def test_extensions(spark):
    from sparkloom.sources import archives

    members = spark.createDataFrame([("a/b.TXT",), ("c.txt",), ("d.tar.gz",), ("e",), (".hidden",)], "member string")
    assert [tuple(r) for r in archives.extensions(members).collect()] == [(".txt", 2), ("<none>", 2), (".gz", 1)]
