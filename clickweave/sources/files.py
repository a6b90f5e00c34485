"""Small steps on the shared store by Spark's own client: PySpark has no call to look for or move a
file, and Python's own calls do not reach it."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    store, path = _at(spark, path)
    return store.exists(path)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none if it does not exist."""
    store, path = _at(spark, folder)
    if not store.exists(path):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(path))


def make_folder(spark: SparkSession, path: str) -> None:
    store, path = _at(spark, path)
    store.mkdirs(path)


def delete(spark: SparkSession, path: str) -> None:
    store, path = _at(spark, path)
    store.delete(path, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder in one step, in place of what a broken move left."""
    store, target_path = _at(spark, target)
    _, source_path = _at(spark, source)
    if store.exists(target_path):
        store.delete(target_path, True)
    store.mkdirs(target_path.getParent())
    if not store.rename(source_path, target_path):
        raise OSError(f"cannot move {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    store, path = _at(spark, path)
    stream = store.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place and move it there: nobody sees a part of it."""
    store, target = _at(spark, path)
    _, beside = _at(spark, f"{path}.tmp")
    stream = store.create(beside, True)
    stream.write(text.encode())
    stream.close()
    if store.exists(target):
        store.delete(target, False)
    if not store.rename(beside, target):
        raise OSError(f"cannot write {path}")
