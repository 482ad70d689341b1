"""Sinks: numbered shards with an index, CSV and JSON lines, fan-out, checksums, staged replacement, archive members."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping, Sequence
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.selection import numbered, prefix
from .archives import safe


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, gzip: bool = False, mode: str = "errorifexists") -> None:
    """A folder of CSV files with headers and the columns in the given order; booleans as True and False."""
    out = df.select(*[_csv_text(df, c) for c in columns or df.columns])
    out.write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").option("compression", "gzip" if gzip else "none").csv(path)


def _csv_text(df: DataFrame, c: str) -> Column:
    if df.schema[c].dataType.typeName() == "boolean":
        return F.initcap(F.col(f"`{c}`").cast("string")).alias(c)
    return F.col(f"`{c}`")


def json_lines(df: DataFrame) -> DataFrame:
    """(value): each row as JSON with keys in order."""
    return df.select(F.to_json(F.struct(*sorted(f"`{c}`" for c in df.columns)), {"ignoreNullFields": "false"}).alias("value"))


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    json_lines(df).write.mode(mode).text(path)


def sharded(df: DataFrame, order: Sequence[Column], rows_per_shard: int, first: int = 1) -> DataFrame:
    """df with its number in order (__n) and the number of its shard (__shard), the first being `first`."""
    return numbered(df, order, "__n").withColumn("__shard", F.expr(f"cast((__n - 1) div {rows_per_shard} as int) + {first}"))


def write_shards(df: DataFrame, path: str, order: Sequence[Column], rows_per_shard: int, columns: Sequence[str] | None = None, first: int = 1) -> DataFrame:
    """Gzip CSV files part-00001.csv.gz ... of rows_per_shard rows each in order; returns their index (file, rows, sha256).

    Rows get their number by a range-partitioned sort; each shard is then one task's file, renamed in place.
    """
    columns = list(columns or df.columns)
    return _write_sharded(sharded(df.select(*columns), order, rows_per_shard, first), path, columns)


def long_shards(records: DataFrame, long: DataFrame, record_id: str, order: Sequence[Column], rows_per_shard: int, first: int = 1) -> DataFrame:
    """long (several rows for each record) with __n and __shard: a shard is closed after the record that fills it to
    rows_per_shard or more, so no record's rows are in two shards.

    Where a shard ends depends on where the one before it did. The records' sizes, in
    order, pass the driver one partition at a time as small arrays; it keeps only the numbers of the
    records that begin a shard.
    """
    sizes = numbered(records.join(long.groupBy(record_id).agg(F.count("*").alias("__size")), record_id, "left"), order, "__r")
    runs = sizes.groupBy(F.floor((F.col("__r") - 1) / 100_000).alias("__run")).agg(F.transform(F.array_sort(F.collect_list(F.struct("__r", F.coalesce("__size", F.lit(0)).alias("s")))), lambda x: x["s"]).alias("sizes"))
    begins, held, r = [1], 0, 0
    for run in runs.orderBy("__run").toLocalIterator():
        for size in run.sizes:
            r += 1
            held += size
            if held >= rows_per_shard:
                begins.append(r + 1)
                held = 0
    starts = records.sparkSession.createDataFrame([(b, i + first) for i, b in enumerate(begins)], "__r long, __shard int")
    w = Window.partitionBy("__run").orderBy("__r").rowsBetween(Window.unboundedPreceding, 0)
    both = sizes.select("__r", record_id).withColumn("__run", F.floor((F.col("__r") - 1) / 100_000)).join(F.broadcast(starts), "__r", "left")
    own = F.max("__shard").over(w)
    before = both.groupBy("__run").agg(F.max("__shard").alias("__top")).withColumn("__carry", F.max("__top").over(Window.orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)))
    placed = both.withColumn("__shard", own).join(F.broadcast(before.select("__run", "__carry")), "__run").select(record_id, "__r", F.coalesce("__shard", "__carry").alias("__shard"))
    return long.join(placed, record_id)


def write_long_shards(records: DataFrame, long: DataFrame, path: str, record_id: str, order: Sequence[Column], item: str, rows_per_shard: int) -> DataFrame:
    """Files of `long_shards`, rows in order of their record and item; returns their index."""
    rows = long_shards(records, long, record_id, order, rows_per_shard).withColumn("__n", F.struct("__r", F.col(item).alias("__i")))
    return _write_sharded(rows, path, long.columns)


def _write_sharded(rows: DataFrame, path: str, columns: Sequence[str]) -> DataFrame:
    spark = rows.sparkSession
    counts = {r[0]: r[1] for r in rows.groupBy("__shard").count().collect()}
    numbers = sorted(counts)
    stage = f"{path.rstrip('/')}/.stage-{uuid.uuid4().hex}"
    sorted_rows = rows.repartitionByRange(max(len(numbers), 1), "__shard").sortWithinPartitions("__shard", "__n")
    out = sorted_rows.select("__shard", *[_csv_text(rows, c) for c in columns])
    out.write.partitionBy("__shard").option("header", True).option("escape", '"').option("compression", "gzip").csv(stage)
    fs, path_of = _fs(spark, path)
    names = []
    for k in numbers:
        found = [s.getPath() for s in fs.listStatus(path_of(f"{stage}/__shard={k}")) if s.getPath().getName().startswith("part-")]
        if len(found) != 1:
            raise RuntimeError(f"shard {k} has {len(found)} files")
        names.append(f"part-{k:05d}.csv.gz")
        fs.rename(found[0], path_of(f"{path.rstrip('/')}/{names[-1]}"))
    fs.delete(path_of(stage), True)
    index = spark.createDataFrame([(f"part-{k:05d}.csv.gz", n) for k, n in counts.items()], "file string, rows long")
    return index.join(checksums(spark, path, "part-*.csv.gz"), "file").select("file", "rows", "sha256").orderBy("file")


def checksums(spark: SparkSession, root: str, glob: str = "*", exclude: str = "SHA256SUMS") -> DataFrame:
    """(file, size, sha256) of the files below root, in order of their relative path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root)
    name = F.regexp_replace("path", "^.*?\\Q" + root.rstrip("/").removeprefix("file://") + "\\E/", "")
    return files.select(name.alias("file"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256")).filter(F.col("file") != exclude).orderBy("file")


def checksum_lines(sums: DataFrame) -> str:
    """The text of a SHA256SUMS file: as long as there are files."""
    return "".join(f"{r.sha256}  {r.file}\n" for r in sums.collect())


def fan_out(df: DataFrame, outputs: Mapping[str, Column], root: str, fmt: str = "parquet") -> None:
    """Several filtered outputs of one input, which is written once and read for each."""
    from ..session import written

    kept = written(df, "fan-out")
    for name, test in outputs.items():
        kept.filter(test).write.format(fmt).save(f"{root.rstrip('/')}/{name}")


def replace_atomically(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write beside the target, then rename it away and the new one in. For a moment there is neither; `publish` has no such moment."""
    spark = df.sparkSession
    stage, old = f"{path.rstrip('/')}.tmp-{uuid.uuid4().hex}", f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    df.write.format(fmt).save(stage)
    fs, path_of = _fs(spark, path)
    if fs.exists(path_of(path)):
        fs.rename(path_of(path), path_of(old))
    fs.rename(path_of(stage), path_of(path))
    if fs.exists(path_of(old)):
        fs.delete(path_of(old), True)


def publish(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write a new version below path and point to it by one atomic rename: readers by `published` see the old or the new rows, whenever a crash comes. Returns the version."""
    spark, root = df.sparkSession, path.rstrip("/")
    version = f"v-{uuid.uuid4().hex}"
    df.write.format(fmt).save(f"{root}/{version}")
    jvm, (fs, path_of) = spark.sparkContext._jvm, _fs(spark, path)
    part, target = path_of(f"{root}/._CURRENT.{version}"), path_of(f"{root}/_CURRENT")
    out = fs.create(part, True)
    out.write(bytearray(version.encode()))
    out.close()
    renames = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    renames[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fs.makeQualified(part), fs.makeQualified(target), renames)
    return version


def published(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The rows that `publish` wrote last."""
    root = path.rstrip("/")
    version = _read_text(spark, f"{root}/_CURRENT")
    return spark.read.format(fmt).load(f"{root}/{version}")


def _read_text(spark: SparkSession, path: str) -> str:
    fs, path_of = _fs(spark, path)
    stream = fs.open(path_of(path))
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, path_of = _fs(spark, path)
    out = fs.create(path_of(path), True)
    out.write(bytearray(text.encode()))
    out.close()


def summary_text(summary: Mapping[str, object], sort: bool = True) -> str:
    """A summary as indented JSON, non-ASCII kept."""
    return json.dumps(summary, sort_keys=sort, ensure_ascii=False, indent=2) + "\n"


def write_summary(spark: SparkSession, path: str, summary: Mapping[str, object], sort: bool = True) -> None:
    _write_text(spark, path, summary_text(summary, sort))


def patch_summary(spark: SparkSession, path: str, changes: Mapping[str, object]) -> dict:
    """The JSON summary at path with some values replaced or added, written back."""
    summary = json.loads(_read_text(spark, path)) | dict(changes)
    _write_text(spark, path, summary_text(summary, False))
    return summary


def append_section(spark: SparkSession, path: str, section: str) -> None:
    """A section of text put behind a report; each call adds it again."""
    _write_text(spark, path, _read_text(spark, path) + section)


def print_report(summary: Mapping[str, object]) -> None:
    """A summary on standard output."""
    print(summary_text(summary), end="", flush=True)


def write_sample(df: DataFrame, path: str, order: Sequence[Column], n: int = 100, gzip: bool = False) -> None:
    """The first n rows in order as CSV."""
    write_csv(prefix(df, order, n), path, gzip=gzip)


def append_log(df: DataFrame, path: str) -> None:
    """Rows as JSON lines behind those that are there, as new files: a log that only grows."""
    write_json_lines(df, path, "append")


def same_digest(spark: SparkSession, path: str, expected: str) -> bool:
    """Whether the one file at path has the expected MD5 or SHA-256, told apart by length."""
    algorithm = F.md5("content") if len(expected) == 32 else F.sha2("content", 256)
    return spark.read.format("binaryFile").load(path).select(algorithm.alias("d")).first().d == expected.lower()


def provenance(spark: SparkSession, inputs: Mapping[str, str], outputs: Mapping[str, str], facts: Mapping[str, object] | None = None) -> dict:
    """A record of a run: the digest and size of each named input and output (files or folders), and other facts."""
    def digests(paths: Mapping[str, str]) -> dict:
        out = {}
        for name, path in paths.items():
            one = checksums(spark, path).agg(F.sum("size").alias("bytes"), F.count("*").alias("files"), F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list(F.concat_ws("  ", "sha256", "file")))), 256).alias("sha256")).first()
            out[name] = one.asDict()
        return out

    return {"inputs": digests(inputs), "outputs": digests(outputs), **(facts or {})}


def complete(spark: SparkSession, path: str, record: Mapping[str, object]) -> None:
    """A marker with the record, written last by rename; raises if there is one."""
    fs, path_of = _fs(spark, path)
    target = path_of(f"{path.rstrip('/')}/_COMPLETE.json")
    if fs.exists(target):
        raise FileExistsError(str(target))
    part = path_of(f"{path.rstrip('/')}/._COMPLETE.part")
    out = fs.create(part, True)
    out.write(bytearray(json.dumps(record, sort_keys=True, ensure_ascii=False, indent=2).encode()))
    out.close()
    fs.rename(part, target)


def report(title: str, counts: Mapping[str, int]) -> str:
    """A Markdown report with thousands separators."""
    return f"# {title}\n\n" + "".join(f"- {k}: {v:,}\n" for k, v in counts.items())


def empty_table(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def extract(members: DataFrame, root: str) -> DataFrame:
    """Write archive members (member, content) below a folder that all executors mount; returns (member, size, sha256). Unsafe names raise."""
    root = root.removeprefix("file://")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for member, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                target = os.path.join(root, safe(member))
                os.makedirs(os.path.dirname(target), exist_ok=True)
                part = f"{target}.{uuid.uuid4().hex}.part"
                with open(part, "wb") as f:
                    f.write(content or b"")
                os.replace(part, target)
                yield pa.RecordBatch.from_arrays([pa.array([member]), pa.array([len(content or b"")], pa.int64()), pa.array([sha256(content or b"").hexdigest()])], names=["member", "size", "sha256"])

    return members.select("member", "content").mapInArrow(run, "member string, size long, sha256 string")
