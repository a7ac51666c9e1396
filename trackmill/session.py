"""Session settings and the shared folder for cut lineages and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: State on disk, with what changed written for each batch.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
# Roots chosen here for local sessions that name no shared folder, per application; they go with the program.
_local_roots: dict[str, tempfile.TemporaryDirectory] = {}
# The folder in use for each purpose, per application.
_renewed: dict[tuple[str, str], str] = {}


def build_session(app: str = "trackmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution, stream state on disk and no user interface.

    Keyword arguments are further settings with ``__`` in place of dots, such as
    ``spark__sql__shuffle__partitions="8"``.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config(map=STATE_STORE)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def state_session(spark: SparkSession) -> SparkSession:
    """The session, if it keeps stream state in RocksDB, or else a new one that does, so the caller's settings stay."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(provider) == STATE_STORE[provider]:
        return spark
    session = spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        session.conf.set(name, spark.conf.get(name))
    for name, value in STATE_STORE.items():
        session.conf.set(name, value)
    return session


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or a temporary one in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.TemporaryDirectory(prefix="trackmill-", ignore_cleanup_errors=True)
    return _local_roots[context.applicationId].name


def new_shared_dir(spark: SparkSession, purpose: str) -> str:
    """A path, not yet in use, below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def renewed_dir(spark: SparkSession, purpose: str) -> str:
    """Like ``new_shared_dir``; the folder that the session had for this purpose before is removed."""
    key = (spark.sparkContext.applicationId, purpose)
    if key in _renewed:
        remove_dir(spark, _renewed[key])
    _renewed[key] = new_shared_dir(spark, purpose)
    return _renewed[key]


def checkpointed(df: DataFrame) -> DataFrame:
    """Write the frame to reliable storage and go on from there.

    Values that differ from one run of a plan to the next, such as range
    boundaries, are settled by this before a plan reads them twice.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that Spark uses for it; one that is not there is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def make_dir(spark: SparkSession, path: str) -> None:
    """Create a folder, through the same file system, if it is not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)
