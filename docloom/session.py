"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "docloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are designed for.

    Every operator also runs in a session somebody else made: none depends on
    a setting made here for its result.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Looking up the caller's line at every step makes large expressions
        # twice as slow to build.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # A second copy of a running generator task would call the model twice.
        "spark.speculation": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local session, which has no other machine, falls back to a
    temporary folder; it is then set as the session's checkpoint directory.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    configured = configured or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="docloom-"))
    return context.getCheckpointDir().rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared one."""
    return f"{shared_dir(spark)}/docloom-{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return bool(fs.exists(hadoop_path))


def replace_path(spark: SparkSession, source: str, target: str) -> None:
    """Put a finished folder in the place of ``target``."""
    fs, target_path = _file_system(spark, target)
    if fs.exists(target_path):
        fs.delete(target_path, True)
    if not fs.rename(_file_system(spark, source)[1], target_path):
        raise OSError(f"could not move {source} to {target}")


def path_kind(spark: SparkSession, path: str) -> str:
    """``"file"``, ``"directory"`` or ``"missing"``."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return "missing"
    return "directory" if fs.getFileStatus(hadoop_path).isDirectory() else "file"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as file scans report it."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty if it does not exist."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))
