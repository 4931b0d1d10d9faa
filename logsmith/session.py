"""Session defaults and the shared scratch / checkpoint folder.

Every job in the library assumes three things about its session:

* ``spark.sql.session.timeZone`` is UTC, so ``hour``, ``date_format`` and
  ``window`` bucket log instants the same way on every machine;
* adaptive query execution is on (runtime broadcast conversion for joins whose
  small side only proves small once it is materialised, skew-join splitting
  for hot clients and hot URLs, partition coalescing);
* a reliable checkpoint directory on shared storage exists, used to cut the
  lineage of the iterative graph jobs and for scratch tables.  It is read from
  the session (``spark.checkpoint.dir``); a local temporary folder is created
  only when nothing is configured, which is the case in tests.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Fixed session settings the results depend on.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "logsmith",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the library defaults applied.

    On a cluster pass ``master=None`` and let ``spark-submit`` decide; the
    shuffle partition count then stays whatever the cluster configured.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false")
    # iterative jobs checkpoint every round; delete checkpoint files once no
    # DataFrame refers to them, so long sessions do not fill the shared folder
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings results depend on (idempotent)."""
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only if unset.

    Order: the directory already set on the context, then the
    ``spark.checkpoint.dir`` setting, and only then -- in local mode (tests,
    one machine) -- a fresh temporary folder.  On a cluster a machine-local
    folder would not be visible to the executors, so an unset directory is an
    error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) for this cluster")
        configured = tempfile.mkdtemp(prefix="logsmith-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a scratch table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"
