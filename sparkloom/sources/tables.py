"""Text tables, JSON documents and directory trees as DataFrames."""

from __future__ import annotations

import json
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship


class MissingColumns(ValueError):
    """A table lacks columns that are needed."""


def require(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise MissingColumns(", ".join(missing))
    return df


def read_csv(spark: SparkSession, path: str | list[str], required: Iterable[str] = (), sep: str = ",") -> DataFrame:
    """A delimited file with a header, all columns as text: byte order marks, quoted line breaks and gzip files are handled.

    Quoted line breaks make a file one task's work; gzip files are so anyway. Shards spread over tasks.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("sep", sep).option("mode", "FAILFAST")
    return require(reader.csv(path), required)


def read_tsv(spark: SparkSession, path: str | list[str], required: Iterable[str] = ()) -> DataFrame:
    return read_csv(spark, path, required, "\t")


def with_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """df with a number that grows in file order: for the semantics of 'first seen'."""
    return df.withColumn(name, F.monotonically_increasing_id())


def read_json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return spark.read.option("multiLine", not lines).json(path)


def read_parquet_union(spark: SparkSession, paths: list[str], columns: Iterable[str] = ("*",)) -> DataFrame:
    """Parquet files whose schemas are merged by name; only the named columns, nested fields too, are read."""
    return spark.read.option("mergeSchema", True).parquet(*paths).select(*columns)


def headers(spark: SparkSession, path: str, glob: str = "*.csv", sep: str = ",") -> DataFrame:
    """(path, header array, n_rows) of side files: their columns are data.

    Files of blank lines or of no bytes have an empty header. Names may be quoted, with separators and
    doubled quotes inside."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    lines = F.filter(F.split(F.regexp_replace(F.col("content").cast("string"), "^\ufeff", ""), r"\r?\n"), lambda x: F.trim(x) != "")
    # each name with the separator before it: quoted, or up to the next separator
    cut = "\\Q" + sep + "\\E"
    names = F.regexp_extract_all(F.concat(F.lit(sep), F.get("lines", F.lit(0))), F.lit(f'{cut}((?:"(?:[^"]|"")*"|(?!{cut}).)*)'), F.lit(1))
    plain = lambda x: F.replace(F.regexp_replace(F.trim(x), '^"|"$', ""), F.lit('""'), F.lit('"'))
    head = F.when(F.size("lines") > 0, F.transform(names, plain)).otherwise(F.array().cast("array<string>"))
    found = files.select("path", lines.alias("lines")).select("path", head.alias("header"), F.greatest(F.size("lines") - 1, F.lit(0)).alias("n_rows"))
    empty = [(p,) for p in _files(spark, path, glob) if p[1] == 0]
    none = spark.createDataFrame([(p[0],) for (p,) in empty], "path string")  # readers pass over files of no bytes; the listing has them
    return found.unionByName(none.select("path", F.array().cast("array<string>").alias("header"), F.lit(0).alias("n_rows")).join(found.select("path"), "path", "left_anti"))


def _files(spark: SparkSession, root: str, glob: str) -> list[tuple[str, int]]:
    """(path, size) of the files below root whose names match, by the file system's own listing."""
    from fnmatch import fnmatch

    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(root)
    at = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(top, True)
    out = []
    while at.hasNext():
        f = at.next()
        if fnmatch(f.getPath().getName(), glob):
            out.append((f.getPath().toString(), f.getLen()))
    return out


def tree(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, relative, parts, size, content) of all files below root; content is read only if used."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(root)
    relative = F.regexp_replace("path", f"^.*?{_quoted(root.rstrip('/'))}/", "")
    return files.select("path", relative.alias("relative"), F.split(relative, "/").alias("parts"), F.col("length").alias("size"), "content")


def _quoted(text: str) -> str:
    return "\\Q" + text.removeprefix("file://") + "\\E"


def exactly_one(files: DataFrame, folder: str, what: str, folders: DataFrame | None = None) -> DataFrame:
    """One row for each folder (of `folders`, if given, else of those with files); raises when the plan runs if a folder has more, or none."""
    n = files.groupBy(folder).agg(F.count("*").alias("__n"), F.min("path").alias(what))
    if folders is not None:
        n = folders.select(folder).distinct().join(n, folder, "left")
    return n.withColumn(what, F.when(F.coalesce("__n", F.lit(0)) == 1, F.col(what)).otherwise(F.raise_error(F.concat(F.lit(f"not exactly one {what} in "), folder)))).drop("__n")


def json_strings(value: Column, df: DataFrame) -> Column:
    """All strings, keys too, in a JSON text of any shape, in order of appearance; null for text that isn't JSON."""
    ship(df.sparkSession)
    return F.arrow_udf(_json_strings, "array<string>")(value)


def _json_strings(texts: pa.Array) -> pa.Array:
    def walk(x, out):
        if isinstance(x, str):
            out.append(x)
        elif isinstance(x, list):
            for y in x:
                walk(y, out)
        elif isinstance(x, dict):
            for k, y in x.items():
                out.append(k)
                walk(y, out)
        return out

    return pa.array([_parsed(t, lambda x: walk(x, [])) for t in texts.to_pylist()], pa.list_(pa.string()))


def json_songs(value: Column, df: DataFrame) -> Column:
    """(key, song as JSON) of a JSON text that is {"songs": {...}}, a dict of dicts, or a list."""
    ship(df.sparkSession)
    return F.arrow_udf(_json_songs, "array<struct<key:string,song:string>>")(value)


def _json_songs(texts: pa.Array) -> pa.Array:
    def songs(x):
        if isinstance(x, dict) and isinstance(x.get("songs"), (dict, list)):
            x = x["songs"]
        pairs = x.items() if isinstance(x, dict) else enumerate(x) if isinstance(x, list) else ()
        return [{"key": str(k), "song": json.dumps(v, ensure_ascii=False, sort_keys=True)} for k, v in pairs if isinstance(v, dict)]

    kind = pa.list_(pa.struct([("key", pa.string()), ("song", pa.string())]))
    return pa.array([_parsed(t, songs) for t in texts.to_pylist()], kind)


def _parsed(text, then):
    try:
        return then(json.loads(text)) if text is not None else None
    except ValueError:
        return None
