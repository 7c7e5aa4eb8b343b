"""Small files and folders through the session's file systems."""
from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str):
    """(path, its file context) in the session's file systems."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    return at, jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.getFileSystem(conf).getUri(), conf)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def write_bytes(content: bytes, path: str, spark: SparkSession, tries: int = 5, over: bool = True) -> bool:
    """A small file, written beside its place and renamed to it in one step, so readers see the old or the new one
    whole. A rename that fails is tried again, each time after a longer wait. Not `over`: False, and nothing is done, if
    there is a file by that name already."""
    tmp, fs = _file_system(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    to, files = located(spark, path)
    out = fs.create(tmp, True)
    out.write(bytearray(content))
    out.close()
    kinds = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(kinds, 1)
    how[0] = kinds.OVERWRITE if over else kinds.NONE
    for k in range(tries):
        try:
            files.rename(tmp, to, how)
            return True
        except Exception:  # noqa: BLE001  the last one is raised
            taken = not over and fs.exists(to)
            if taken or k == tries - 1:
                fs.delete(tmp, False)
                if taken:
                    return False
                raise
            time.sleep(0.1 * 2**k)
    return True


def write_object(text: str, path: str, spark: SparkSession) -> None:
    write_bytes(text.encode(), path, spark)


def read_text(path: str, spark: SparkSession) -> str:
    """A small file's text."""
    at, fs = _file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def names(path: str, spark: SparkSession) -> list[str]:
    """The names in a folder, sorted; none if it isn't there."""
    at, fs = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def exists(path: str, spark: SparkSession) -> bool:
    at, fs = _file_system(spark, path)
    return fs.exists(at)


def delete(path: str, spark: SparkSession) -> None:
    at, fs = _file_system(spark, path)
    fs.delete(at, True)
