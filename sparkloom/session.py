"""Session helpers: a local session for tests and benches, and shipping this package to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: dict[str, str] = {}


def local_session(cpus: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once an application, so that their Python workers can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="sparkloom-"), "sparkloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, str(p.relative_to(top.parent)))
    sc.addPyFile(path)
    _shipped[sc.applicationId] = path


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; where it is unset, a folder of our own on a local master, and an error elsewhere."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file:///tmp/checkpoints/sparkloom"
        spark.sparkContext.setCheckpointDir(found)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str, row_group_mb: int = 16) -> DataFrame:
    """The same rows, written as Parquet to the shared folder and read back.

    Cuts lineage: a lost executor costs a re-read, not a recomputation. Small
    row groups keep large binary columns splittable among readers.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", row_group_mb << 20).option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
