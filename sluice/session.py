"""Session helper shared by tests, bench and ad-hoc use."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; in a local session without one, a temporary folder."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) or _local.get(spark.sparkContext.applicationId)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = _local[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="sluice-")
    return named.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Cut lineage: write df as Parquet in the shared folder and read it back."""
    path = f"{work_folder(df.sparkSession)}/sluice-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_session(cores: int = 8, memory: str = "12g", **extra: str) -> SparkSession:
    """A local session with UTC time zone and adaptive execution; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sluice")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
