"""Session defaults and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Timestamps are naive UTC throughout;
# adaptive execution sizes the shuffles and splits partitions that turn out skewed;
# streaming state lives on disk, and bursts of a busy address merge before the shuffle.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "wardlog", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session carrying the settings above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session
    without that setting (a laptop, a unit test) gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="wardlog-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; never reused, so reruns cannot collide."""
    path = f"{shared_dir(spark)}/wardlog/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables made inside, once their results are written elsewhere."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, cutting its lineage.

    The copy outlives lost executors, and anything that depends on row placement
    (partition numbers, range bounds) is frozen as plain column values.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
