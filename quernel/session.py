"""Session factory and the few session-level services operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings that only matter for correctness; sizes of memory and parallelism stay with the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # rounds of graph operators leave one each
}


def build_session(app: str = "quernel", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``DEFAULTS``; later settings win. ``master`` None keeps what spark-submit chose."""
    builder = SparkSession.builder.appName(app).config(map=DEFAULTS | conf)
    return (builder.master(master) if master else builder).getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: the session's ``spark.checkpoint.dir``, else one already set, else, in
    local mode only, a temporary one. On a cluster without the setting this raises: a machine-local folder
    wouldn't survive the loss of an executor."""
    sc = spark.sparkContext
    if named := spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir"):
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if present := sc.getCheckpointDir():
        return present
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="quernel-ckpt-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint, so lost executors cost no recomputation.

    A checkpoint keeps the planner's estimate of its size. Where joins follow each other in a loop, estimates multiply until
    planning takes longer than the work; one beyond any real size is dropped."""
    checkpoint_dir(df.sparkSession)
    done = df.checkpoint(eager=True)
    if int(str(done._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())).bit_length() > 50:
        bare = df.sparkSession._jsparkSession.internalCreateDataFrame(done._jdf.queryExecution().toRdd(), done._jdf.schema(), False)
        done = DataFrame(bare, df.sparkSession)
    return done


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder``."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
