"""Helpers shared by the training-data operators."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of characters other than space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset and
    driver and executors are one process (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="foliant-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/foliant/{tag}-{uuid.uuid4().hex}"
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(conf).deleteOnExit(hadoop)
    return path


def written(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write df to the shared folder and read it back (with sizes Spark can plan by)."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_lean(df: DataFrame, tag: str) -> DataFrame:
    """written(), whose shuffle files go once the table is there; else they'd stay until the driver collects garbage."""
    name, conf = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", df.sparkSession.conf
    before = conf.get(name)
    conf.set(name, "true")
    try:
        return written(df, tag)
    finally:
        conf.set(name, before)


def drop_folder(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(hadoop, True)


def drop_written(*tables: DataFrame) -> None:
    """Delete what written() made, once nothing reads it any more."""
    for df in tables:
        for parent in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if "/foliant/" in parent:
                drop_folder(df.sparkSession, parent)


def as_row(df: DataFrame) -> Column:
    """All of df's columns in one struct, so that none can clash with what an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def crc_fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(crc_fold(doc_id) == 0, F.lit(False))


def bounded_sample(df: DataFrame, label: str, bound: int, seed: int = 7) -> DataFrame:
    """At most `bound` different rows of df, as evenly over the values of `label` as they allow and one of each at least
    (so more than `bound` only if there are more labels), chosen by the least hashes of whole rows. Equal rows count as
    one, and rows that share an id or a label are told apart by the rest of them, so no hot value makes the sample larger
    or empties it. Only hashes are shuffled: they are ranked within a label, each task passing on no more than a label's
    share, and the chosen ones, whose number is bounded, are broadcast to fetch their rows. Rows without a label are
    never chosen."""
    known = df.where(F.col(label).isNotNull()).withColumn("_h", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns], F.lit(seed)))
    hashes = written(known.select(label, "_h").distinct(), "hashes")
    counts = {r[0]: r[1] for r in hashes.groupBy(label).count().collect()}
    if not counts:
        return df.limit(0)
    share, left = {}, bound
    for i, (value, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], str(x[0])))):
        share[value] = max(1, min(n, left // (len(counts) - i)))
        left = max(0, left - share[value])
    most = max(share.values())
    place = F.row_number().over(Window.partitionBy(label).orderBy("_h"))
    ranked = hashes.withColumn("_place", place).where(F.col("_place") <= most).collect()  # `most` rows a label at most
    chosen = df.sparkSession.createDataFrame([(r[0], r[1]) for r in ranked if r["_place"] <= share[r[0]]], hashes.schema)
    drop_written(hashes)
    return known.join(F.broadcast(chosen), [label, "_h"], "left_semi").dropDuplicates([label, "_h"]).select(*df.columns)


def texts_of(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """sample (doc_id and more, a bounded number of rows) with the text of each row's document, whole; a null text is
    empty. Of rows that share an id, the text of the least hash is taken, so a hot id brings one text."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keys = sample.columns
    return text.join(F.broadcast(sample), "doc_id").groupBy(*keys).agg(F.min_by("text", F.xxhash64("text")).alias("text"))
