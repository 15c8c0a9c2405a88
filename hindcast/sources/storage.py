"""Metadata-sized file operations through Hadoop's FileSystem, so any Spark store works."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, uri: str) -> bool:
    path, fs = _path(spark, uri)
    return fs.exists(path)


def children(spark: SparkSession, uri: str) -> list[str]:
    path, fs = _path(spark, uri)
    if not fs.exists(path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(path))


def read_text(spark: SparkSession, uri: str) -> str:
    path, fs = _path(spark, uri)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, uri: str, text: str) -> None:
    path, fs = _path(spark, uri)
    stream = fs.create(path, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def states(spark: SparkSession, uri: str) -> list[tuple[str, int, int]]:
    """Name, length and time of change of the visible files of a folder."""
    path, fs = _path(spark, uri)
    if not fs.exists(path):
        return []
    found = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path)]
    return sorted(f for f in found if not f[0].startswith(("_", ".")))


def files_below(spark: SparkSession, uri: str) -> list[str]:
    """All visible files below a folder."""
    path, fs = _path(spark, uri)
    found, listing = [], fs.listFiles(path, True)
    while listing.hasNext():
        file = listing.next().getPath()
        if not file.getName().startswith(("_", ".")):
            found.append(file.toString())
    return sorted(found)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Give a file another name of the same store; a file of that name is replaced. Readers see the
    one or the other, whole."""
    jvm = spark._jvm
    to, fs = _path(spark, target)
    fs.mkdirs(to.getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(to).toUri(), spark._jsc.hadoopConfiguration()
    )
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE
    context.rename(fs.makeQualified(_path(spark, source)[0]), fs.makeQualified(to), how)


def replace_text(spark: SparkSession, uri: str, text: str) -> None:
    """Write aside, then rename: a reader gets the old document or the new one, never part of one, and
    a writer that dies leaves the old one."""
    folder, _, name = uri.rpartition("/")
    aside = f"{folder}/_{name}-{uuid.uuid4().hex}"
    write_text(spark, aside, text)
    move(spark, aside, uri)


def publish(spark: SparkSession, uri: str, seen: str | None, text: str, *, patience: float = 60.0) -> bool:
    """Replace a document that still says what its writer has ``seen`` (None: is not there).

    False if it has changed, or another writer is at it: look again and repeat. Writers exclude each
    other by a file beside it; one left behind by a writer that died counts for ``patience`` seconds.
    """
    folder, _, name = uri.rpartition("/")
    mark = f"{folder}/_{name}.writing"
    if not create(spark, mark):
        if age_seconds(spark, mark) > patience:
            delete_below(spark, mark, guard=folder)
        return False
    try:
        if (read_text(spark, uri) if exists(spark, uri) else None) != seen:
            return False
        replace_text(spark, uri, text)
        return True
    finally:
        delete_below(spark, mark, guard=folder)


def create(spark: SparkSession, uri: str) -> bool:
    """Make an empty file; False if it is there. Of several callers one gets True."""
    path, fs = _path(spark, uri)
    fs.mkdirs(path.getParent())
    return fs.createNewFile(path)


def age_seconds(spark: SparkSession, uri: str) -> float:
    """Seconds since a file was last changed; 0 if it is gone."""
    path, fs = _path(spark, uri)
    if not fs.exists(path):
        return 0.0
    return max(0.0, spark._jvm.java.lang.System.currentTimeMillis() - fs.getFileStatus(path).getModificationTime()) / 1000


def delete_below(spark: SparkSession, uri: str, *, guard: str) -> bool:
    """Remove ``uri``, but only from inside ``guard``."""
    inside = uri.removeprefix(guard.rstrip("/") + "/")
    if inside == uri or not inside.strip("/") or ".." in inside.split("/"):
        raise ValueError(f"{uri} is not below {guard}")
    path, fs = _path(spark, uri)
    return fs.delete(path, True)
