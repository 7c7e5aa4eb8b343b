"""Substring search by an index of short pieces of names and titles, for tables that are searched often.

Every searched value is posted under the distinct runs of one, two and three characters that it holds, in lower case.
The postings are a snapshot table partitioned by a hash of the run, so a search reads the folders of the needle's runs
and no other; a value that holds the needle is in all of their lists. What is in all of them is looked up in the tables
and tested."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.predicates import any_column_contains
from foliant.operators.joins import search
from foliant.sources import snapshots

LONGEST = 3
BUCKETS = 256

Groups = list[tuple[str, DataFrame, str, list[str]]]


def _runs(c, size: int):
    """The distinct runs of so many characters of a text."""
    n = F.length(c) - size + 1
    return F.array_distinct(F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda i: F.substring(c, i, F.lit(size))))


def postings(groups: Groups) -> DataFrame:
    """(run, grp, place, id): the runs of every searched value; place tells its column. Null ids and values have none."""
    out = []
    for name, df, key, columns in groups:
        for place, c in enumerate(columns):
            text = F.lower(F.col(c).cast("string"))
            runs = F.concat(*[_runs(text, k) for k in range(1, LONGEST + 1)])
            rows = df.where(F.col(key).isNotNull() & F.col(c).isNotNull())
            out.append(rows.select(F.explode(runs).alias("run"), F.lit(name).alias("grp"), F.lit(place).alias("place"), F.col(key).cast("string").alias("id")))
    return reduce(DataFrame.union, out)


def _bucket(run, buckets: int):
    return F.pmod(F.xxhash64(run), F.lit(buckets)).cast("int")


def write_index(groups: Groups, path: str, buckets: int = BUCKETS) -> int:
    """Index the groups' searched columns, in place of what was there, in one step. Rows are dealt by run and a share of
    their ids, so a run that nearly all values hold isn't one task."""
    rows = postings(groups).withColumn("bucket", _bucket(F.col("run"), buckets))
    dealt = rows.repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(8)))
    return snapshots.commit(dealt.sortWithinPartitions("bucket", "run"), path, partition_by=("bucket",))


def needle_runs(needle: str) -> list[str]:
    """The runs that a value must hold to hold the needle."""
    low = needle.lower()
    return sorted({low[i : i + LONGEST] for i in range(max(1, len(low) - LONGEST + 1))}) if low else []


def candidates(spark: SparkSession, path: str, needle: str, buckets: int = BUCKETS) -> DataFrame:
    """(grp, id) of the rows one of whose values is in the lists of all of the needle's runs."""
    wanted = spark.createDataFrame([(r,) for r in needle_runs(needle)], "run string").withColumn("bucket", _bucket(F.col("run"), buckets)).collect()
    lists = snapshots.read(spark, path).where(F.col("bucket").isin(sorted({r.bucket for r in wanted})) & F.col("run").isin([r.run for r in wanted]))
    full = lists.groupBy("grp", "place", "id").agg(F.countDistinct("run").alias("n")).where(F.col("n") == len(wanted))
    return full.select("grp", "id").distinct()


def indexed_search(groups: Groups, path: str, needle: str, most: int, buckets: int = BUCKETS) -> DataFrame:
    """What joins.search() finds, (grp, ord, id, label), through the index. An empty needle is in every value, so there
    is nothing to look up and the tables are read."""
    if not needle:
        return search(groups, needle, most)
    found = []
    for i, (name, df, key, columns) in enumerate(groups):
        ids = candidates(df.sparkSession, path, needle, buckets).where(F.col("grp") == name).select(F.col("id").alias("_id"))
        rows = df.join(ids, F.col(key).cast("string") == F.col("_id"), "left_semi")
        hits = any_column_contains(rows, needle, columns).orderBy(key).limit(most)
        found.append(hits.select(F.lit(name).alias("grp"), F.lit(i).alias("ord"), F.col(key).cast("string").alias("id"), F.col(columns[0]).cast("string").alias("label")))
    return reduce(DataFrame.unionByName, found)
