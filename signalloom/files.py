"""Small files in the shared folder that decide something: written whole, and only if absent."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    """The file system of a path and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _local(fs, place) -> str | None:
    """The path on this machine's own disk, or None."""
    uri = urlparse(place.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri().toString())
    return unquote(uri.path) if uri.scheme == "file" else None


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    fs, place = _path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None where there is none."""
    fs, place = _path(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file unless there is one; False if another was first.

    The text is written under a name of its own and then given the asked one in one step that fails where that
    name is taken: a link on a local disk, a rename on HDFS and the like. On stores without an atomic
    rename two writers at the very same moment could both pass.
    """
    fs, place = _path(spark, path)
    own = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}.tmp")
    local = _local(fs, place)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        draft = _local(fs, own)
        with open(draft, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(draft, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
    if fs.exists(place):
        return False
    out = fs.create(own, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        done = fs.rename(own, place)
    except Exception:  # some file systems raise where others answer false
        if not fs.exists(place):
            raise
        done = False
    if not done:
        fs.delete(own, False)
    return done


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or folder, if there is one."""
    fs, place = _path(spark, path)
    fs.delete(place, True)
