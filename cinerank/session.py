"""Session construction and the shared folder used for checkpoints and scratch output.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names (set at submit
time).  Only a local session (tests, bench) may fall back to a fresh temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.caseSensitive": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def scale_conf(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings that keep every scan and shuffle partition near ``partition_bytes``.

    The initial shuffle partition count is sized from the input (at least 2 per core), and
    AQE coalesces small partitions toward the advisory size and splits skewed ones.  For
    100 TB on 8,000 cores: about 400k initial partitions, coalesced at run time.
    """
    n = max(2 * cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def get_session(master: str | None = None, app: str = "cinerank", conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    ``master`` is only set when given: on a cluster the submitter decides it.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # session-level settings also apply when a session already existed
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    shared_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    If it is unset, a local session gets a fresh temporary folder (tests); a cluster
    session gets an error, because a machine-local folder is not visible to executors.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        d = tempfile.mkdtemp(prefix="cinerank-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder (for round trips and versioned outputs)."""
    return f"{shared_dir(spark)}/cinerank-scratch/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, name: str, base: str | None = None):
    """Write ``df`` once as parquet under the shared folder and return the table read back.

    Cuts lineage like a reliable checkpoint but computes the input only once (an eager
    ``checkpoint()`` runs it twice when it is not cached), survives lost executors, and
    gives the planner the real size of the result.
    """
    spark = df.sparkSession
    path = f"{base.rstrip('/')}/{name}" if base else scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path this library wrote (through the Hadoop file system of the path)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
