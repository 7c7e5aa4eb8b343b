"""Incremental runs: reuse by fingerprint in batch, and file streams that upsert by key.

The stream's own checkpoint makes each file count once, and the table's version names the batch that it has come to, so
a batch that is run again after a crash changes nothing."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from foliant.operators.joins import one_per_key, orphans, reuse_split
from foliant.sources import snapshots


def run_incremental(current: DataFrame, previous: DataFrame | None, key: str, version: str, process: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Results for all of current: earlier ones whose fingerprint and version still hold, and new ones of process().
    Keys that are gone are dropped. previous: the earlier results with fingerprint and record_version."""
    if previous is None:
        return process(current).withColumn("record_version", F.lit(version)).withColumn("reused", F.lit(False))
    kept, to_do = reuse_split(current, previous.select(key, "fingerprint", "record_version"), key, version)
    old = previous.join(kept.select(key), key, "left_semi").withColumn("reused", F.lit(True))
    fresh = process(to_do).withColumn("record_version", F.lit(version)).withColumn("reused", F.lit(False))
    return old.unionByName(fresh, allowMissingColumns=True)


def gone(previous: DataFrame, current: DataFrame, key: str) -> DataFrame:
    return orphans(previous, current, key)


def scoped(df: DataFrame, number: str, wanted: int | None, prior: DataFrame, key: str) -> DataFrame:
    """df with `decision`: with one piece singled out, other pieces that an earlier run has seen are reused."""
    from foliant.functions.predicates import single_piece_decision

    seen = prior.select(key).distinct().withColumn("_seen", F.lit(True))
    both = df.join(seen, key, "left")
    return both.withColumn("decision", single_piece_decision(F.col(number), wanted, F.coalesce("_seen", F.lit(False)))).drop("_seen")


def upsert_stream(stream: DataFrame, key: str, order: str, table: str, checkpoint: str, process: Callable[[DataFrame], DataFrame] = lambda d: d, on_batch: Callable[[int, int], None] | None = None, available_now: bool = True, buckets: int = 64, most_folders: int = 8) -> StreamingQuery:
    """Keep, of each key, the record of the greatest `order` that any batch has brought; latest() reads them. Rows need
    a `fingerprint`. See merge_batch()."""

    def apply(batch: DataFrame, number: int) -> None:
        rows = merge_batch(batch, number, key, order, table, process, buckets, most_folders)
        if on_batch:
            on_batch(number, rows)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def merge_batch(batch: DataFrame, number: int, key: str, order: str, table: str, process: Callable[[DataFrame], DataFrame] = lambda d: d, buckets: int = 64, most_folders: int = 8) -> int:
    """Merge a batch into a snapshot table in one step; how many records it made anew.

    A row counts only if its order is at least the one the table has for its key, whichever batch brought that, so late
    rows never win; a row of the same order and another fingerprint is a correction. Of a key's rows within a batch the
    greatest counts, of ties the one of the least fingerprint. If its fingerprint is the known one, the record stays as
    it is and only its order moves on; otherwise process() makes a new one. Rows without a key or an order are left out. The version names the last batch, so one that is run again changes
    nothing. A batch adds one folder, partitioned by a hash of the key, and is compared with the buckets that its keys
    fall in; beyond `most_folders` of them the table is rewritten as one, so files don't add up."""
    spark = batch.sparkSession
    version, entry = snapshots.version_of(spark, table)
    if entry and number <= entry["batch"]:
        return entry["rows"] if number == entry["batch"] else 0
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    rows = one_per_key(batch.where(F.col(key).isNotNull() & F.col(order).isNotNull()), [key], F.desc(order), "fingerprint").withColumn("_order", F.col(order))
    moved = None
    if entry:
        touched = [r[0] for r in rows.select(bucket).distinct().collect()]  # at most `buckets`
        known = _newest(snapshots.read_entry(spark, table, entry).where(F.col("_bucket").isin(touched)), key)
        seen = known.select(key, F.col("_order").alias("_was"), F.col("fingerprint").alias("_print"))
        same = F.coalesce(F.col("_print") == F.col("fingerprint"), F.lit(False))
        newer = rows.join(seen, key, "left").withColumn("_same", same).where("_was is null or _order > _was or (_order = _was and not _same)")
        later = newer.where("_same").select(key, F.col("_order").alias("_later"))
        moved = known.join(later, key).withColumn("_order", F.col("_later")).drop("_later")
        rows = newer.where("not _same").drop("_was", "_print", "_same")
    made = process(rows)
    if "_order" not in made.columns:
        made = made.join(rows.select(key, "_order"), key)
    made = made.withColumn("_bucket", bucket).withColumn("_batch", F.lit(number).cast("long"))
    out = made if moved is None else made.unionByName(moved, allowMissingColumns=True)
    folder = snapshots.fresh_folder(version)
    snapshots.write_folder(out.repartition("_bucket"), table, folder, "parquet", ("_bucket",))
    schema = out.schema.json()
    added = snapshots.read_entry(spark, table, {"kind": "parquet", "schema": schema, "folders": [folder]})
    count = added.where(F.col("_batch") == number).count()
    folders = [*(entry["folders"] if entry else []), folder]
    version = snapshots.publish(spark, table, version, {"kind": "parquet", "schema": schema, "folders": folders, "batch": number, "rows": count})
    if len(folders) > most_folders:
        compact(spark, table, key)
    return count


def compact(spark: SparkSession, table: str, key: str) -> None:
    """Rewrite a merged table as one folder that has each key once."""
    version, entry = snapshots.version_of(spark, table)
    folder = snapshots.fresh_folder(version)
    rows = _newest(snapshots.read_entry(spark, table, entry), key)
    snapshots.write_folder(rows.repartition("_bucket"), table, folder, "parquet", ("_bucket",))
    snapshots.publish(spark, table, version, {**entry, "folders": [folder]})


def _newest(rows: DataFrame, key: str) -> DataFrame:
    return one_per_key(rows, [key], F.desc("_order"), F.desc("_batch"))


def latest(spark: SparkSession, table: str, key: str) -> DataFrame:
    """Each key's record, and the batch that made it."""
    return _newest(snapshots.read(spark, table), key).drop("_bucket", "_order")


def file_stream(spark: SparkSession, folder: str, schema: str, kind: str = "json", files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(kind).load(folder)
