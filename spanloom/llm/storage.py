"""Tables written between the steps of one job, in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..sources.shared import shared_dir


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends here, and a lost
    executor costs a re-read instead of a recomputation."""
    spark = df.sparkSession
    folder = f"{shared_dir(spark)}/spanloom-{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/{name}")
    out = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    out._spanloom_folder = folder
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables that materialize returned and that nothing still to be run reads."""
    for table in tables:
        sc = table.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(table._spanloom_folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
