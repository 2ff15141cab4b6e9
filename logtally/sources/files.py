"""Paths on whatever file system the session uses, and small control files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN_DIR: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only where the session names none and runs on one machine (a test), a fresh
    local folder is made; on a cluster that would be an error, and is one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN_DIR:
        _OWN_DIR.append(tempfile.mkdtemp(prefix="logtally-"))
    return _OWN_DIR[0]


def _fs(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``; empty where it does not exist."""
    fs, target = _fs(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def last_number(spark: SparkSession, folder: str) -> int:
    """Highest number among files named like 000000000042.json; 0 if none."""
    names = [n for n in children(spark, folder) if n.endswith(".json") and n[0].isdigit()]
    return max((int(n.removesuffix(".json")) for n in names), default=0)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _fs(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> None:
    """Write a new small file that appears whole or not at all.

    The text goes to a side file first; the rename that publishes it fails
    if ``path`` exists, so two writers cannot both take the same name.
    """
    fs, target = _fs(spark, path)
    side = spark._jvm.org.apache.hadoop.fs.Path(
        target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}"
    )
    out = fs.create(side, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
    if fs.exists(target) or not fs.rename(side, target):
        fs.delete(side, False)
        raise FileExistsError(path)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _fs(spark, path)
    fs.delete(target, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, old = _fs(spark, source)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"cannot rename {source} to {target}")
