"""Session construction and shared-storage helpers."""

from __future__ import annotations

import atexit
import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Keeps streaming state in RocksDB on local disk; the only store that has what ``transformWithState`` needs.
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # streaming state (watermark dedup keys, open windows, alert runs) lives in
    # RocksDB on local disk instead of executor heap; it grows with key rate x delay
    STATE_PROVIDER: ROCKSDB,
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "fabflow", extra: dict | None = None) -> SparkSession:
    """Return the active session, creating one with telemetry defaults.

    On a cluster the master, shuffle width and checkpoint folder come from the
    cluster's own configuration; only local runs (tests, bench) pass them.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside the block keep their state in RocksDB, whatever the session is set to.

    A stream takes a copy of the session's settings when it starts, so the session's own value comes
    back at once and other streams are not touched.
    """
    before = spark.conf.get(STATE_PROVIDER, None)
    spark.conf.set(STATE_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_PROVIDER)
        else:
            spark.conf.set(STATE_PROVIDER, before)


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local``, ``local[n]``), so that they share a disk."""
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged tables.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared folder
    there), else from the SparkContext's checkpoint directory. Only when
    neither is set and the master is local, as in tests, a fresh scratch folder
    becomes the context's checkpoint directory (``spark.checkpoint.dir`` itself
    cannot be changed once the session runs). On any other master a folder of
    one machine would lose data, so a missing setting raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        if not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share: staged tables are written there")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="fabflow-ckpt-"))
        root = sc.getCheckpointDir()
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure RDD/DataFrame ``checkpoint()`` has a directory; return the staging root."""
    root = checkpoint_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def file_system(spark: SparkSession, path: str):
    """The file system of a path and the path in its terms (any store Spark can reach)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


#: Staged paths of the ``stages`` blocks open in this thread, innermost last.
_OPEN = threading.local()
#: Stage folders that go when this process ends.
_OWNED: set[str] = set()


def staging_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder.

    It belongs to the innermost :func:`stages` block of this thread, which removes it at its end;
    outside any block it belongs to the application and goes when the driver process ends.
    """
    root = checkpoint_root(spark).rstrip("/")
    app = f"{root}/fabflow-stage/{spark.sparkContext.applicationId}-{os.getpid()}"
    if app not in _OWNED:
        _OWNED.add(app)
        fs, p = file_system(spark, app)
        atexit.register(_remove, fs, p)
    path = f"{app}/{name}-{os.urandom(6).hex()}"
    if getattr(_OPEN, "blocks", None):
        _OPEN.blocks[-1].append(path)
    return path


def _remove(fs, path) -> None:
    try:
        fs.delete(path, True)
    except Exception:  # noqa: BLE001  the JVM may be gone already; the folder is then left to the store's own cleaning
        pass


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside the block are removed at its end, so everything made of them must be written by then.

    Streams wrap each micro-batch in one, so that a query that runs for ever leaves nothing behind.
    """
    blocks = _OPEN.__dict__.setdefault("blocks", [])
    blocks.append([])
    try:
        yield
    finally:
        for path in blocks.pop():
            delete_path(spark, path)
