"""SparkSession construction and the few session settings the models rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every model assumes: UTC wall clock for timestamp literals, AQE with skew-join
# splitting, and no UI server.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # the JVM never compiles a method of more than 8000 bytes: a wider projection runs as several
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove reliable-checkpoint files of the skew path once their data is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "finsight", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if _context(spark) is not None:
        spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a remote (Connect) session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions expose no SparkContext
        return None


class CheckpointDirMissing(RuntimeError):
    pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory named by ``spark.checkpoint.dir`` (never overridden).

    Only when it is unset *and* the session runs in local mode (tests, a single machine) is a
    private temporary directory created; on a cluster an unset setting is an error, because a
    machine-local folder is not reachable from the executors."""
    sc = _context(spark)
    if sc is None:  # remote session: the server side owns the checkpoint directory
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise CheckpointDirMissing("set spark.checkpoint.dir to a shared folder (e.g. on the cluster's "
                                       "distributed file system) before running this job")
        configured = tempfile.mkdtemp(prefix="finsight-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return configured


def session_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else str(id(spark))


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    return sc.defaultParallelism if sc is not None else int(spark.conf.get("spark.sql.shuffle.partitions"))


def configure_for_models(spark: SparkSession) -> None:
    """Apply the session settings the models need on a session created elsewhere
    (e.g. by the driver); runtime-modifiable SQL settings only. The checkpoint directory is
    resolved lazily, where a checkpoint is actually taken."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled", "spark.sql.codegen.hugeMethodLimit",
              "spark.sql.adaptive.skewJoin.enabled", "spark.sql.ansi.enabled"):
        try:
            spark.conf.set(k, BASE_CONF[k])
        except Exception:  # noqa: BLE001 - static or locked setting on a managed session
            pass
