"""Session helpers: the shared folder, lineage cuts and recommended settings."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that suit wide survey tables.  Adaptive execution picks the shuffle
#: width and splits skewed join partitions; the field limit keeps code
#: generation on for a few hundred columns, and the method limit turns it off
#: where the generated method is longer than the JVM compiles.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.maxFields": "400",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply :data:`RECOMMENDED` to a session builder."""
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may run without that setting; a temporary folder is
    then chosen once per session.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sparkprep-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in one folder per application."""
    return f"{_application_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _application_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/sparkprep-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> bool:
    """Delete the tables that this application stored; true if there were any.

    For when its results are written and its models saved: DataFrames and
    unsaved models that were built before can't be read any more.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_application_dir(spark))
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a derived table, so that it survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Unlike a checkpoint the result keeps column pruning and filter pushdown.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
