"""Session construction and lineage cutting."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "panelkit", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster ``master`` stays None so spark-submit decides; locally the
    caller passes ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only a session that runs in one process (master ``local``) may lack the
    setting: it gets a scratch folder. A cluster without it is an error, since
    its executors share no local folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not d:
        if sc is None or not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="panelkit-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - some deployments lock core settings
            pass
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


#: Folders of tables written in this process, for drop_tables; the innermost
#: scope is last.
_SCOPES: list[list[str]] = [[]]


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's file system (a shared store)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def table_path(spark: SparkSession, kind: str = "panelkit_tables") -> str:
    """A new folder in the shared checkpoint folder, known to drop_tables."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{kind}/{uuid.uuid4().hex}"
    _SCOPES[-1].append(path)
    return path


def drop_tables(spark: SparkSession) -> None:
    """Delete the tables written so far in the innermost scope. Call it when
    no result that was derived from them will be evaluated again."""
    own = _SCOPES[-1]
    while own:
        drop_path(spark, own.pop())


@contextmanager
def table_scope(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at its end, and only these."""
    _SCOPES.append([])
    try:
        yield
    finally:
        drop_tables(spark)
        _SCOPES.pop()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Cut lineage with a table written to the shared checkpoint folder and
    read back: computed once (a plain RDD checkpoint would compute the plan
    a second time for the write), durable across executor loss, and the
    reader gets file statistics for later planning. Never a local
    checkpoint."""
    spark = df.sparkSession
    path = table_path(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
