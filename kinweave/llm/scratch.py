"""Tables written once to the folder that driver and executors share, in place of cached or local blocks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark deletes the shuffle files of a query at its end, not when the driver next collects garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; the warehouse, which is shared as well, where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{folder.rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Writes ``df`` as Parquet and reads it back: lineage ends here, and a lost executor costs nothing.

    The table goes to ``folder`` if given, to be deleted with :func:`drop_folder`. What was shuffled for it is released.
    """
    spark = df.sparkSession
    path = f"{folder}/{name}" if folder else new_path(spark, name)
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_stored(spark: SparkSession) -> None:
    """Deletes what :func:`stored` has written in this application; call it once the results are written."""
    drop_folder(spark, shared_root(spark))
