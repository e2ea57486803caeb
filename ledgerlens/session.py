"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job wants: adaptive execution (coalesces small shuffle
# partitions, splits skewed join partitions, turns joins into broadcasts once
# the real size is known) and no web UI.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    master: str | None = None,
    app: str = "ledgerlens",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    ``master`` is left to spark-submit when None.  ``shuffle_partitions``
    should be sized so that one partition of the largest shuffle fits in
    executor memory (AQE then coalesces the small ones).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Streaming checkpoints and lineage cuts go below it.  We never fall back to
    a machine-local temporary folder: on a cluster that folder is not shared
    and dies with the executor.  Tests set the option themselves.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/...) before starting durable jobs"
        )
    return root.rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """:func:`checkpoint_root`; where it is unset in a local session, which is
    one process, a folder of its own.  On a cluster an unset folder raises."""
    local = spark.sparkContext.master.split("[")[0] == "local"
    if local and not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-checkpoint-"))
    return checkpoint_root(spark)
