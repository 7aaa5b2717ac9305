"""Session settings used by tests, bench and examples.

On a cluster the session comes from the platform; these helpers only fill in
settings that are unset.  Nothing here points at a machine-local folder
unless the caller passes one (tests do).
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the engine relies on (AQE for runtime re-planning and skew joins).
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, app: str = "seekframe",
                  extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
         .config("spark.driver.memory", "16g"))
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _own_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="seekframe-")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session that runs everything in one process gets a folder of its own where none is set.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
        d = _own_dir()
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(d)
    return d


def gone_at_exit(spark: SparkSession, path: str) -> None:
    """Have the folder removed from the shared store when the application ends (it must exist by now)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: lineage is cut there and Spark knows the size.

    What the caller keeps is his to write elsewhere; the staged copy goes when the application ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/staged-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    gone_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)
