"""Session helpers.

Library code never invents storage locations on a cluster: lineage cuts and
artifacts go to the shared folder named by ``spark.checkpoint.dir``.  Only
local runs (tests, bench) set one, and only when it is unset.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def get_spark(master: str | None = None, app: str = "seriesflow",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests / bench (UI off, UTC, AQE on)."""
    master = master or os.environ.get("SERIESFLOW_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, create_local: bool = False) -> str:
    """The shared checkpoint folder of the session.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  When it
    is unset and ``create_local`` is true (local tests only) a scratch folder
    is made and registered; otherwise an error tells the caller to configure
    a shared folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not conf:
        if not create_local and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) visible to every executor")
        conf = tempfile.mkdtemp(prefix="seriesflow-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (never a local one)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def bound_batches(spark: SparkSession, limit: int = 64 << 20) -> None:
    """Bound the session's Arrow batches by bytes, unless it has a bound of its own: a batch of long binaries may have 10,000 of them."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(limit))
