"""The few file-system calls the loads need, on whatever Hadoop path is given."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def join(*parts: str) -> str:
    head, *tail = [p for p in parts if p]
    return "/".join([head.rstrip("/"), *[t.strip("/") for t in tail]])


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(_path(spark, path))


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the plain files directly inside a directory."""
    if not exists(spark, path):
        return []
    found = file_system(spark, path).listStatus(_path(spark, path))
    return sorted(f.getPath().getName() for f in found if f.isFile())


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly inside a directory."""
    if not exists(spark, path):
        return []
    found = file_system(spark, path).listStatus(_path(spark, path))
    return sorted(f.getPath().getName() for f in found if f.isDirectory())


def read_json(spark: SparkSession, path: str):
    stream = file_system(spark, path).open(_path(spark, path))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def write_new_json(spark: SparkSession, path: str, value) -> None:
    """Publish a file in one step: write aside, then rename; never replace."""
    fs = file_system(spark, path)
    aside = _path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(json.dumps(value, indent=1).encode()))
    finally:
        stream.close()
    target = _path(spark, path)
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise FileExistsError(f"another writer has published {path}")


def delete_tree(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(_path(spark, path), True)


def archive(spark: SparkSession, paths: list[str], folder: str = "Archive") -> int:
    """Move files into a sub-folder next to them, replacing namesakes."""
    for path in paths:
        source = _path(spark, path)
        fs = file_system(spark, path)
        target_dir = spark._jvm.org.apache.hadoop.fs.Path(source.getParent(), folder)
        fs.mkdirs(target_dir)
        target = spark._jvm.org.apache.hadoop.fs.Path(target_dir, source.getName())
        fs.delete(target, False)
        if not fs.rename(source, target):
            raise OSError(f"could not archive {path}")
    return len(paths)
