"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is under the threshold), coalesces
# small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python workers talk over Unix sockets: a job with Python takes 50 ms instead of 100
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Runtime SQL settings for a large cluster (about 100 TB of input). Shuffle
# partitions are an upper bound that AQE coalesces toward the advisory size;
# scan splits of 256 MB keep task counts manageable; broadcasts stay behind
# AQE's measured-size check.
CLUSTER_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Set CLUSTER_SQL_CONF on a running session, leaving keys the cluster set at launch.

    ``overrides`` are the caller's explicit choices and always apply.
    """
    launch = spark.sparkContext.getConf()
    for k, v in CLUSTER_SQL_CONF.items():
        if not launch.contains(k):
            spark.conf.set(k, v)
    for k, v in (overrides or {}).items():
        spark.conf.set(k, v)


def build_session(master: str | None = "local[8]", shuffle_partitions: int = 8,
                  app: str = "shopsignal", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench.

    ``master=None`` leaves the master, the shuffle partitions and the checkpoint folder to the
    launcher (spark-submit) and applies the cluster settings that it has not set.
    """
    local = master is not None and master.startswith("local")
    b = SparkSession.builder.appName(app)
    conf = dict(DEFAULT_CONF)
    if master is not None:
        b = b.master(master)
    if local:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.master.startswith("local["):
        apply_cluster_conf(spark, extra)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins. Only when it is unset (local tests)
    is a private scratch folder created and registered.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            # a driver-local folder is invisible to executors: the cluster must name a shared one
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/DBFS)")
        d = tempfile.mkdtemp(prefix="shopsignal-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def ship_sources(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python, as submitting it with --py-files would.

    Nothing is sent where the workers' module path already has it; else once per context.
    """
    import shopsignal

    sc, root = spark.sparkContext, os.path.dirname(os.path.dirname(os.path.abspath(shopsignal.__file__)))
    if getattr(sc, "_shopsignal_sent", False) or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    place = tempfile.mkdtemp(prefix="shopsignal-src-")
    sc.addPyFile(shutil.make_archive(os.path.join(place, "shopsignal"), "zip", root, "shopsignal"))
    sc._shopsignal_sent = True
