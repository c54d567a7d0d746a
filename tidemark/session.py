"""Sessions and shared folders.

Every job runs in a session derived from the caller's: same Spark context, own SQL settings, so
nothing the caller configured is changed.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Keeps join and window state on executor disk and uploads only changes per batch.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Counting the rows in state would cost a read before every write.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # One store per join partition instead of four.
    "spark.sql.streaming.join.stateFormatVersion": "3",
}
STATE_PARTITIONS = "spark.tidemark.state.partitions"


def derive(spark: SparkSession) -> SparkSession:
    """A session for static tables: UTC event time, adaptive plans with skew splitting."""
    session = spark.newSession()
    inherited = spark.conf.getAll
    for key, value in inherited.items():
        if key.startswith("spark.sql.") and session.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.adaptive.enabled", "true")
    session.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Split a skewed join even where that costs another shuffle after it.
    session.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return session


def derive_streaming(spark: SparkSession) -> SparkSession:
    """A session for streaming queries.

    The number of state partitions is fixed in a query's checkpoint on its first run, so it is
    taken from the cluster's parallelism (or from ``spark.tidemark.state.partitions``) rather than
    from whatever ``spark.sql.shuffle.partitions`` the caller uses for static jobs. State store
    settings that the caller has made are kept.
    """
    session = derive(spark)
    chosen = spark.conf.getAll
    for key, value in STATE_STORE.items():
        if key not in chosen:
            session.conf.set(key, value)
    partitions = spark.conf.get(STATE_PARTITIONS, None)
    session.conf.set("spark.sql.shuffle.partitions", partitions or str(spark.sparkContext.defaultParallelism))
    session.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    return session


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is missing and Spark itself is local. Results are read from these
    folders lazily; ``clear_workspaces`` removes them.
    """
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_workspaces(spark: SparkSession) -> None:
    """Remove every working folder that this Spark application has made, when all results taken from it have been read.

    Folders of other applications stay, also those of one that has been lost; each application's are in one folder,
    ``tidemark/<application id>`` below ``spark.checkpoint.dir``.
    """
    remove(spark, _application_folder(spark))


_local_base: dict[str, str] = {}


def _application_folder(spark: SparkSession) -> str:
    application, base = spark.sparkContext.applicationId, spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_base.setdefault(application, "") or tempfile.mkdtemp(prefix="tidemark-")
        _local_base[application] = base
    return f"{base.rstrip('/')}/tidemark/{application}"


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, whatever storage it is on."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = hadoop_path(spark, path)
    return fs.exists(jpath)


def is_file(spark: SparkSession, path: str) -> bool:
    jpath, fs = hadoop_path(spark, path)
    return fs.exists(jpath) and fs.getFileStatus(jpath).isFile()


def make_dir(spark: SparkSession, path: str) -> None:
    jpath, fs = hadoop_path(spark, path)
    fs.mkdirs(jpath)


def rename(spark: SparkSession, path: str, target: str) -> None:
    """Move a folder to a name that is free; fails if the file system refuses."""
    jpath, fs = hadoop_path(spark, path)
    if not fs.rename(jpath, hadoop_path(spark, target)[0]):
        raise OSError(f"cannot rename {path} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    jpath, fs = hadoop_path(spark, path)
    fs.delete(jpath, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of the driver's own, such as a position; the folder is made where it is missing."""
    jpath, fs = hadoop_path(spark, path)
    out = fs.create(jpath, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    jpath, fs = hadoop_path(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def committed_numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers ``n`` of the ``<prefix><n>`` folders below ``path`` whose write was committed, in order."""
    return _numbers(spark, f"{path}/{prefix}*/_SUCCESS", lambda p: p.getParent().getName()[len(prefix):])


def numbered_files(spark: SparkSession, path: str) -> list[int]:
    """Numbers used as file names in ``path``, in order."""
    return _numbers(spark, f"{path}/*", lambda p: p.getName())


def _numbers(spark: SparkSession, pattern: str, name_of) -> list[int]:
    jpath, fs = hadoop_path(spark, pattern)
    names = [name_of(status.getPath()) for status in (fs.globStatus(jpath) or [])]
    return sorted(int(n) for n in names if n.isdigit())
