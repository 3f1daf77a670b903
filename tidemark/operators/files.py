"""Single files and folders, through the file system that Spark itself uses for a path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, or None."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written whole."""
    system, place = _place(spark, path)
    stream = system.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """A file or folder with all it holds, if there is one."""
    system, place = _place(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, path: str, folder: str) -> None:
    """Rename a file into another folder of its file system."""
    system, place = _place(spark, path)
    _, target = _place(spark, f"{folder}/{place.getName()}")
    if not system.rename(place, target):
        raise OSError(f"{path} could not be moved to {folder}")


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """The folders in a folder whose names begin with ``prefix``."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return []
    return [s.getPath().toString() for s in system.listStatus(place) if s.isDirectory() and s.getPath().getName().startswith(prefix)]


def same_place(spark: SparkSession, path: str) -> str:
    """A path in its full form, so that two of them can be compared."""
    system, place = _place(spark, path)
    return system.makeQualified(place).toString().rstrip("/")
