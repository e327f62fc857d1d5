"""Session construction and lineage cutting.

On a cluster the session is the user's; ``build_session`` exists for tests,
the bench and local runs.  The checkpoint folder is always read from the
session (``spark.checkpoint.dir``); only when it is unset — a bare local test
session — does ``checkpoint_dir`` fall back to a fresh temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Wide feature vectors (one column per dimension) make constraint
    # inference expensive at planning time; the library never relies on it.
    "spark.sql.constraintPropagation.enabled": "false",
}


def build_session(master: str | None = None, app: str = "setlist",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Sets the SparkContext checkpoint folder from ``spark.checkpoint.dir``; if
    the session names none, a local master gets a fresh temp folder and any
    other master an error: executors would each write to a disk of their own.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="setlist-ckpt-")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def materialize(df: DataFrame, by: str | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` as a parquet table under the session's
    shared checkpoint folder and reading it back.

    Unlike an RDD checkpoint this is one job (no recomputation of the last
    stage to write the files), keeps columnar pruning and gives AQE real
    statistics; like it, the files survive executor loss, so later stages
    re-read them instead of recomputing from the start.  With ``by``, a column,
    a filter on its value reads the rows of that value only.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "setlist-tables", uuid.uuid4().hex)
    write = df.write.mode("errorifexists")
    (write.partitionBy(by) if by else write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
