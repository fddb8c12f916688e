"""Session settings and the shared folder for intermediate tables."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "adlode", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution and UTC time; a cluster's own settings stay in force."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="adlode-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, in a part of this application's own that can be removed after it."""
    own = f"adlode-{spark.sparkContext.applicationId}"
    return os.path.join(shared_dir(spark), own, f"{name}-{uuid.uuid4().hex[:12]}")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    Cuts the lineage: what follows neither recomputes ``df`` per reader nor depends
    on the executors that made it, and Spark knows the table's size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
