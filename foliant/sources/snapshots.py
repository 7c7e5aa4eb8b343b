"""Tables that change in one step: a version is written to a folder of its own, then an entry in the table's log names it.

    table/_log/000000000007.json     what version 7 consists of: kind, schema, folders
    table/data/000000000007-<id>/    the files that version 7 added

Readers take the newest entry, so until the entry is there they see the version before, whole, and after a job that
failed half-way they still do. An entry is made by a rename that fails if another writer has made it first
(ConflictError), so no version is lost. The last KEEP versions stay readable; what only older ones use is deleted, and
so is what failed writers left behind."""
from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from foliant.sources import files

KEEP = 2


class ConflictError(RuntimeError):
    """Another writer has committed since the version was read."""


def version_of(spark: SparkSession, path: str) -> tuple[int, dict[str, Any] | None]:
    """The newest version's number and entry; (0, None) where there is none."""
    found = [n for n in files.names(f"{path}/_log", spark) if n.endswith(".json")]
    return (int(found[-1][:-5]), json.loads(files.read_text(f"{path}/_log/{found[-1]}", spark))) if found else (0, None)


def fresh_folder(version: int) -> str:
    """A folder for what the version after `version` adds."""
    return f"data/{version + 1:012d}-{uuid.uuid4().hex}"


def write_folder(df: DataFrame, path: str, folder: str, kind: str, partition_by: tuple[str, ...] = ()) -> None:
    """Write df to a folder that no entry names yet; nothing stays of it if the job fails."""
    try:
        df.write.format(kind).partitionBy(*partition_by).save(f"{path}/{folder}")
    except Exception:
        files.delete(f"{path}/{folder}", df.sparkSession)
        raise


def publish(spark: SparkSession, path: str, version: int, entry: dict[str, Any], keep: int = KEEP) -> int:
    """Make `entry` the version after `version`, and prune."""
    if not files.write_bytes(json.dumps(entry).encode(), f"{path}/_log/{version + 1:012d}.json", spark, over=False):
        raise ConflictError(f"{path}: version {version + 1} is another writer's")
    prune(spark, path, keep)
    return version + 1


def commit(df: DataFrame, path: str, kind: str = "parquet", keep: int = KEEP, partition_by: tuple[str, ...] = ()) -> int:
    """Replace the table by df, which may read the table itself; the new version's number."""
    spark = df.sparkSession
    version, _ = version_of(spark, path)
    folder = fresh_folder(version)
    write_folder(df, path, folder, kind, partition_by)
    try:
        return publish(spark, path, version, {"kind": kind, "schema": df.schema.json(), "folders": [folder]}, keep)
    except ConflictError:
        files.delete(f"{path}/{folder}", spark)
        raise


def read_entry(spark: SparkSession, path: str, entry: dict[str, Any]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    return reduce(DataFrame.unionByName, [spark.read.schema(schema).format(entry["kind"]).load(f"{path}/{f}") for f in entry["folders"]])


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or one that is still kept."""
    if version is None:
        _, entry = version_of(spark, path)
    else:
        name = f"{path}/_log/{version:012d}.json"
        entry = json.loads(files.read_text(name, spark)) if files.exists(name, spark) else None
    if entry is None:
        raise FileNotFoundError(f"{path} has no such version")
    return read_entry(spark, path, entry)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Where the newest version's files are; the path itself where it isn't such a table."""
    _, entry = version_of(spark, path)
    return [f"{path}/{f}" for f in entry["folders"]] if entry else [path]


def update(spark: SparkSession, path: str, change: Callable[[DataFrame | None], DataFrame], kind: str = "parquet", tries: int = 3) -> int:
    """Replace the table by change(table), again from the start if another writer comes between."""
    for k in range(tries):
        version, entry = version_of(spark, path)
        try:
            return commit(change(read_entry(spark, path, entry) if entry else None), path, kind)
        except ConflictError:
            if k == tries - 1:
                raise
    return version


def prune(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Delete entries but the last `keep`, and folders of their time or earlier that no kept entry names."""
    log = [n for n in files.names(f"{path}/_log", spark) if n.endswith(".json")]
    kept = log[-keep:]
    named = {f for n in kept for f in json.loads(files.read_text(f"{path}/_log/{n}", spark))["folders"]}
    for name in log[:-keep]:
        files.delete(f"{path}/_log/{name}", spark)
    for folder in files.names(f"{path}/data", spark):
        if f"data/{folder}" not in named and int(folder.partition("-")[0]) <= int(kept[-1][:-5]) - keep + 1:
            files.delete(f"{path}/data/{folder}", spark)
