"""Session helpers.

Cluster jobs get their session from the platform; these helpers only fill in
settings that are unset, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the exhibits rely on. AQE re-plans joins and coalesces the many
# small post-aggregation partitions; skew-join splits a hot vehicle/policy.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# The exhibits' projections (bands, prep, composites) generate large Java
# methods under whole-stage codegen. HotSpot refuses to JIT-compile methods
# over 8,000 bytes of bytecode and runs them in its interpreter, which made the
# closing-view prep 4x slower; letting it compile them keeps codegen fast
# (measured at sf0.1: 20 s -> 5 s). On a cluster set the same flag in
# spark.executor.extraJavaOptions at launch.
JVM_OPTIONS = "-XX:-DontCompileHugeMethods"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ratecell") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g")
               .config("spark.driver.extraJavaOptions", JVM_OPTIONS)
               .config("spark.executor.extraJavaOptions", JVM_OPTIONS)
               .config("spark.sql.warehouse.dir",
                       tempfile.mkdtemp(prefix="ratecell-wh-", dir=os.environ.get("TMPDIR", "/tmp"))))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the folder ``checkpoint()`` / ``materialize`` write to, setting one
    only if none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Without one, a session of a single machine (master ``local``) gets a scratch folder, and any
    other raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:           # Spark Connect: no SparkContext on the client
        sc = None
    current = None
    if sc is not None:
        current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:
            current = None
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc is None or not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="ratecell-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is not None:
        sc.setCheckpointDir(path)
    return path
