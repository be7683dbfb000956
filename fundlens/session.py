"""Session defaults for local runs, and durable materialisation."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "fundlens", **conf: str) -> SparkSession:
    """Session for tests and the benchmark. On a cluster the caller brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_checkpoint_folder(spark: SparkSession) -> None:
    """Make sure that checkpoints have a folder: the session's spark.checkpoint.dir.

    Only plain local mode without one gets a temporary folder; on a cluster that is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="fundlens-checkpoint-")
        sc.setCheckpointDir(folder)


def fresh_folder(spark: SparkSession, kind: str) -> str:
    """The name of a new folder in the session's shared checkpoint folder."""
    use_checkpoint_folder(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{kind}-{uuid4()}"


def stored(df: DataFrame, kind: str, compression: str = "snappy") -> DataFrame:
    """The rows as a written table in the shared folder: packed columns, short lineage."""
    folder = fresh_folder(df.sparkSession, kind)
    df.write.option("compression", compression).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later reads see exactly these rows, also after losing executors."""
    use_checkpoint_folder(df.sparkSession)
    return df.checkpoint()
