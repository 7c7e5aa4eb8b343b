"""Sinks: JSON lines, JSON, text, CSV, data modules, one file a key with pruning, checkpoints, result caches, reports.

JSON lines, text and checkpoints are snapshot tables (sources.snapshots), which a reader sees as they were or as they
are, and which a job that fails leaves as they were. CSV and folders a key are overwritten in place, for programs that
know nothing of snapshots: a job that fails may leave them empty. Small single files (a summary, a report) are assembled
on the driver from results that are small by construction, and renamed into place."""
from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions.text import markdown_cell
from foliant.sources import files, snapshots
from foliant.sources.files import write_bytes, write_object  # noqa: F401  sinks too

PRUNED = 10_000  #: folders that are looked up at once


def ascii_json(line: Column) -> Column:
    """JSON with all that lies beyond ASCII as \\u escapes, by UTF-16 units."""
    units = lambda c: F.lower(F.regexp_replace(F.hex(F.encode(c, "UTF-16BE")), "(.{4})", r"\\u$1"))
    escaped = F.array_join(F.transform(F.split(line, ""), lambda c: F.when(c.rlike(r"^[\x00-\x7F]$"), c).otherwise(units(c))), "")
    return F.when(line.rlike(r"[^\x00-\x7F]"), escaped).otherwise(line)


def write_jsonl(df: DataFrame, path: str) -> int:
    """A line of ASCII JSON a row, nulls included, in place of what was there, in one step."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"})
    return snapshots.commit(df.select(ascii_json(row).alias("value")), path, "text")


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """Header, arrays joined by "; ", nulls empty, booleans as True and False. One file only where asked for."""
    out = df.select(*[csv_cell(F.col(f"`{f.name}`"), f.dataType.typeName()).alias(f.name) for f in df.schema])
    (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def csv_cell(c: Column, kind: str) -> Column:
    if kind == "array":
        return F.array_join(c, "; ")
    if kind == "boolean":
        return F.when(c, "True").when(~c, "False").otherwise("")
    return F.coalesce(c.cast("string"), F.lit(""))


def write_text(df: DataFrame, column: str, path: str) -> int:
    """A line a row, in place of what was there, in one step."""
    return snapshots.commit(df.select(F.col(column).cast("string").alias("value")), path, "text")


def assert_writable(path: str, spark) -> None:
    """Raise unless files can be made in a folder, which is made if need be."""
    probe = f"{path}/.{uuid.uuid4().hex}"
    write_object("", probe, spark)
    files.delete(probe, spark)


def data_module(df: DataFrame, key: str, order: list[Column] | None = None, register: str = "register") -> DataFrame:
    """The lines of a script, `module`, that registers the rows as JSON under a key: (place, module) with the rows
    between a first and a last line, in order, a comma after each row (which an array literal of the script may end
    with). Nothing is collected, however many rows there are."""
    rows = (df.orderBy(*order) if order else df).select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("row"))
    placed = rows.withColumn("place", F.monotonically_increasing_id() + 1)  # ascends with the order
    body = placed.select("place", F.concat("row", F.lit(",")).alias("module"))
    ends = df.sparkSession.createDataFrame([(0, f"{register}({json.dumps(key)}, ["), ((1 << 63) - 1, "]);")], "place long, module string")
    return body.union(ends)


def copy_files(listed: DataFrame, source: str, target: str, path: str = "pdf_path") -> DataFrame:
    """(path, bytes, status): each file of source copied to the same place in target, by the tasks, through pyarrow's
    file systems. A file that is there with the same size isn't copied again, so a task may be repeated."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs as pafs

        (from_fs, from_at), (to_fs, to_at) = (pafs.FileSystem.from_uri(x) for x in (source, target))
        for batch in batches:
            out = []
            for name in batch[path]:
                try:
                    size = from_fs.get_file_info(f"{from_at}/{name}").size
                    if size is None:
                        raise FileNotFoundError(name)
                    there = to_fs.get_file_info(f"{to_at}/{name}")
                    if there.size != size:
                        to_fs.create_dir(f"{to_at}/{name}".rpartition("/")[0], recursive=True)
                        pafs.copy_files(f"{from_at}/{name}", f"{to_at}/{name}", source_filesystem=from_fs, destination_filesystem=to_fs)
                    out.append((name, size, "copied" if there.size != size else "present"))
                except Exception as e:  # noqa: BLE001  one file's failure is its row's
                    out.append((name, -1, f"error: {type(e).__name__}"))
            yield pd.DataFrame(out, columns=[path, "bytes", "status"])

    return listed.select(path).mapInPandas(run, f"{path} string, bytes long, status string")


def write_per_key(df: DataFrame, key: str, path: str) -> None:
    """One folder a key; only the folders of keys in df are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).json(path)


def orphans(existing: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """Keys whose files are to be pruned."""
    return existing.select(key).distinct().join(current.select(key), key, "left_anti")


def prune(path: str, key: str, current: DataFrame) -> list[str]:
    """Delete the folders of write_per_key() whose key isn't in current; returns their keys. The folders are named in
    the driver as a listing of path is; which of them are orphaned is found by Spark, a bounded number at a time."""
    spark = current.sparkSession
    known = current.select(F.col(key).cast("string").alias(key))
    held = [n.partition("=")[2] for n in files.names(path, spark) if n.startswith(f"{key}=")]
    out = []
    for at in range(0, len(held), PRUNED):
        some = spark.createDataFrame([(unquote(v), v) for v in held[at : at + PRUNED]], f"`{key}` string, _folder string")
        for value, folder in some.join(known, key, "left_anti").collect():
            files.delete(f"{path}/{key}={folder}", spark)
            out.append(value)
    return sorted(out)


def write_checkpoint(fingerprints: DataFrame, stage: str, version: str, run: str, path: str) -> int:
    """(key, fingerprint) of a stage, with the version that wrote them; other stages' stay as they are."""
    rows = fingerprints.select(F.lit(stage).alias("stage"), "key", "fingerprint", F.lit(version).alias("record_version"), F.lit(run).alias("last_run_id"))
    return snapshots.commit(rows, f"{path}/{stage}")


def cache_key(*cs: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cs]), 256)


def cache_misses(wanted: DataFrame, cache: DataFrame, key: str = "cache_key") -> DataFrame:
    return wanted.join(cache.select(key), key, "left_anti")


def add_to_cache(results: DataFrame, path: str, status: str = "status") -> None:
    """Only successes are kept."""
    results.where(F.col(status) == "success").write.mode("append").parquet(path)


def write_sheets(tables: dict[str, DataFrame], path: str, width: int = 60) -> dict[str, list[int]]:
    """A workbook as one CSV a sheet, an empty sheet holding `(no data)`; returns each sheet's column widths (the
    longest cell's, at most `width`)."""
    widths = {}
    for name, df in tables.items():
        cells = df.select(*[csv_cell(F.col(f"`{f.name}`"), f.dataType.typeName()).alias(f.name) for f in df.schema])
        longest = cells.agg(F.count("*").alias("_n"), *[F.max(F.length(f"`{c}`")).alias(c) for c in cells.columns]).first()
        widths[name] = [min(width, max(len(c), longest[c] or 0) + 2) for c in cells.columns]
        sheet = df if longest["_n"] else df.sparkSession.createDataFrame([("(no data)",)], "note string")
        write_csv(sheet, f"{path}/{name}", single=True)
    return widths


def thumbnail_paths(*sides: DataFrame, column: str = "thumbnail_path") -> DataFrame:
    out = sides[0].select(column)
    for s in sides[1:]:
        out = out.union(s.select(column))
    return out.where(F.col(column).isNotNull()).distinct()


def ordered_paths(sides: list[DataFrame], column: str, position: str) -> DataFrame:
    """(column, first): the values of all sides, each once, with the place (side, position) where it comes first."""
    rows = [s.select(F.col(column), F.struct(F.lit(i).alias("side"), F.col(position).alias("position")).alias("_at")) for i, s in enumerate(sides)]
    return reduce(lambda a, b: a.union(b), rows).where(F.col(column).isNotNull()).groupBy(column).agg(F.min("_at").alias("first"))


def markdown_rows(df: DataFrame) -> DataFrame:
    """Each row as a line of a Markdown table, `line`."""
    cells = [markdown_cell(F.col(f"`{f.name}`").cast("string") if f.dataType.typeName() != "array" else F.array_join(f"`{f.name}`", "; ")) for f in df.schema]
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def markdown_report(title: str, sections: list[tuple[str, DataFrame, int]]) -> str:
    """A report of headed tables, each of at most the given number of rows (with a note on what is left out)."""
    out = [f"# {title}", ""]
    for head, df, most in sections:
        lines = [r.line for r in markdown_rows(df).limit(most + 1).collect()]
        out += [f"## {head}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *lines[:most]]
        out += ["", "(more rows not shown)"] if len(lines) > most else []
        out.append("")
    return "\n".join(out)


def shown_targets(targets: Column, most: int = 8) -> Column:
    """The first targets, and how many more there are."""
    more = F.when(F.size(targets) > most, F.concat(F.lit(" +"), (F.size(targets) - most).cast("string"), F.lit(" more"))).otherwise("")
    return F.concat(F.array_join(F.slice(targets, 1, most), ", "), more)
