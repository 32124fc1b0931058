"""Session settings and the shared folder that jobs write their cut points to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings every job of the library relies on.  Shuffle sizing is left to AQE:
# start from many partitions and let it coalesce to about 128 MB each.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "threadlytics", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session carrying :data:`SETTINGS`; ``conf`` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session, where driver and executors share one machine, may
    fall back to a fresh temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    fresh = tempfile.mkdtemp(prefix="threadlytics-")
    context.setCheckpointDir(fresh)
    return fresh


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    A lost executor then costs a re-read only, later steps read just the columns they
    use, and the planner knows the size.  The files stay until the folder is cleaned.
    """
    path = f"{shared_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_observed(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """:func:`cut_lineage` with aggregates of ``df`` taken by the write itself, in no job of their own."""
    seen = Observation()
    written = cut_lineage(df.observe(seen, *[value.alias(name) for name, value in measures.items()]))
    return written, seen.get
