"""Notes of a few lines beside the tables, on whatever file system those are; rows never pass through here."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder in order, none if it is absent."""
    path, system = _at(spark, folder)
    return sorted(f.getPath().getName() for f in system.listStatus(path)) if system.exists(path) else []


def write_note(spark: SparkSession, path: str, text: str) -> None:
    """Replaces the note: it is written beside its place first, so a reader never meets half of one."""
    target, system = _at(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    out = system.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    system.delete(target, False)
    if not system.rename(beside, target):
        raise OSError(f"cannot write {path}")


def read_note(spark: SparkSession, path: str) -> str | None:
    """The note's text, None if there is none; one whose writer died between the two steps is taken from beside its place."""
    for name in (path, f"{path}.part"):
        target, system = _at(spark, name)
        if system.exists(target):
            stream = system.open(target)
            try:
                return str(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            finally:
                stream.close()
    return None


def delete(spark: SparkSession, path: str) -> None:
    target, system = _at(spark, path)
    system.delete(target, True)


def move_into(spark: SparkSession, paths: list[str], folder: str, base: str) -> None:
    """Moves files under ``base`` to the same places under ``folder``; those that are gone already are passed over."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    root = jvm_path(base).toUri().getPath().rstrip("/")
    for name in paths:
        source, system = _at(spark, name)
        if system.exists(source):
            target = jvm_path(f"{folder}/{source.toUri().getPath().removeprefix(root).lstrip('/')}")
            system.mkdirs(target.getParent())
            if not system.rename(source, target):
                raise OSError(f"cannot move {name}")
