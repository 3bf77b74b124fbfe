"""Session settings and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "pagliaio", master: str | None = None, **conf: str) -> SparkSession:
    """A session for local runs; on a cluster the submitted configuration wins."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": cpus,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": "12g",
        "spark.checkpoint.compress": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.appName(app).master(master or f"local[{cpus}]")
    for key, value in (base | conf).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in ``spark.checkpoint.dir``; make one up only for a local session.

    A cluster session without that setting is refused: a folder of the driver's
    machine would not be readable by the executors.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="pagliaio-checkpoint-")
    sc.setCheckpointDir(folder)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read on from there.

    A checkpointed frame keeps the size estimate of the plan it came from; in loops
    of joins these estimates multiply round by round until planning stalls. The rows
    are therefore wrapped anew, without an estimate.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    done = df.checkpoint(eager=eager)
    try:
        bare = spark._jsparkSession.internalCreateDataFrame(done._jdf.queryExecution().toRdd(), done._jdf.schema(), False)
    except (AttributeError, Py4JError):
        return done
    return type(done)(bare, spark)


#: Spark's setting by which the shuffle files of a query go when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """``df`` as compressed columns in the shared checkpoint folder, for a step between others.

    The shuffle files behind it go as soon as it is written, not when the driver happens to
    collect its garbage; its own files stay until ``forget``.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.select("*").write.option("compression", "zstd").parquet(folder)  # planned anew, under the setting
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(folder)
    out.folder = folder
    return out


def forget(*frames: DataFrame) -> None:
    """Delete the files of frames from ``written``, which nothing reads any more; other frames stay as they are."""
    for df in frames:
        if folder := vars(df).get("folder"):
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
