"""Shared folders and the few file-system questions the engine asks."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor sees, as the cluster names it.

    Only a local session without the setting gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):  # local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tributary-")
    return _local_roots[app]


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused folder name below the shared root."""
    return f"{shared_root(spark)}/tributary/{purpose}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


FINISHED = "_FINISHED"
EVER_FINISHED = "_EVER_FINISHED"


def touch(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.create(hadoop_path, True).close()


def finish(spark: SparkSession, path: str) -> None:
    """Mark a version as completely written; our own mark, as Spark's can be switched off.

    The folder above it then says that a version was finished once.
    """
    touch(spark, f"{path}/{FINISHED}")
    if not exists(spark, f"{path.rsplit('/', 1)[0]}/{EVER_FINISHED}"):
        touch(spark, f"{path.rsplit('/', 1)[0]}/{EVER_FINISHED}")


def is_finished(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path}/{FINISHED}")


def finished_versions(spark: SparkSession, base: str) -> list[str]:
    """The finished `run=` folders below `base`, oldest first.

    A first run that died leaves a version that is not finished: there is none yet. But once one
    was finished, versions of which none is are an error: taken for no version at all they would make
    the next run start over.
    """
    names = children(spark, base)
    runs = [name for name in names if name.startswith("run=")]
    done = [f"{base}/{n}" for n in runs if is_finished(spark, f"{base}/{n}")]
    if runs and not done and EVER_FINISHED in names:
        raise ValueError(f"no version below {base} is finished any more: {runs}")
    return done


def newest_version(spark: SparkSession, base: str) -> str | None:
    """The newest `run=` folder below `base` whose write finished, None if there is no version."""
    return (finished_versions(spark, base) or [None])[-1]


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below `path`; empty when it does not exist."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))
