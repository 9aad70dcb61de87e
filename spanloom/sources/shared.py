"""The folder that the driver and all executors share, for tables between steps and stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DIR_KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset a local master gets a new
    temporary folder; on a cluster this is an error, since executors wouldn't see each other's files."""
    found = spark.conf.get(DIR_KEY, None) or spark.sparkContext.getConf().get(DIR_KEY)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {DIR_KEY} to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spanloom-")
        spark.conf.set(DIR_KEY, found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read back: what follows sees one set of rows in one order, and a
    lost executor costs a re-read."""
    path = f"{shared_dir(df.sparkSession)}/spanloom-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._spanloom_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables that written returned and that nothing still to be run reads."""
    for table in tables:
        delete(table.sparkSession, table._spanloom_path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder wherever Spark reads it."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
