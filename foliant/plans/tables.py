"""The tables that registered queries read, in the roles that their operators need."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.text import alnum_ratio, word_count


ROWS_A_TASK = 250_000  #: rows that a task sorts or folds, about


def tasks_for(table: DataFrame, rows: int = ROWS_A_TASK) -> int:
    """How many tasks a table's work is dealt to: a task's share stays the same as the table grows. Counting a Parquet
    table reads its files' footers alone."""
    return max(table.sparkSession.sparkContext.defaultParallelism, -(-table.count() // rows))


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str, names: list[str]) -> None:
    """Tables as temporary views, for SQL and for looking rows up by id."""
    for name in names:
        load(spark, sf_dir, name).createOrReplaceTempView(name)


def document_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pages with metrics: a piece is a source, a page a document of it."""
    docs = load(spark, sf_dir, "documents", "doc_id", "source", "lang", "text", "n_chars")
    none = F.lit(None)
    return docs.select(
        "doc_id",
        "source",
        "lang",
        F.col("doc_id").alias("page_num"),
        word_count(F.col("text")).alias("word_count"),
        alnum_ratio(F.col("text")).alias("alnum_ratio"),
        (F.col("lang") != "en").alias("is_image_based"),
        (F.col("n_chars") / 4.0).alias("estimated_dpi"),
        none.cast("double").alias("render_width_px"),
        none.cast("double").alias("render_height_px"),
        F.pmod("doc_id", F.lit(97)).cast("double").alias("skew_angle_deg"),
        (F.col("n_chars") / 20.0).alias("contrast_std"),
        (F.col("n_chars") / 5.0).alias("blur_variance"),
        F.lit(0.3).alias("text_density"),
        F.lit(False).alias("is_blank"),
        none.cast("double").alias("ocr_confidence"),
        F.lit(0).alias("ocr_word_count"),
        F.lit("ocr").alias("text_source"),
        F.lit(True).alias("ocr_applied"),
    )


#: The same in SQL.
PAGES_SQL = r"""
pages_of AS (
  SELECT doc_id, source, lang, text, n_chars,
    len(list_filter(string_split_regex(trim(text), '\s+'), lambda x: x <> '')) AS word_count,
    CASE WHEN length(regexp_replace(text, '\s', '', 'g')) > 0 THEN
      round(length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) / length(regexp_replace(text, '\s', '', 'g')), 4) END AS alnum_ratio
  FROM documents),
issues_of AS (
  SELECT *,
    (lang <> 'en' AND n_chars / 4.0 < 200) AS low_resolution,
    abs(((((doc_id % 97) + 45) % 90) - 45)) > 3 AS excessive_skew,
    n_chars / 20.0 < 22 AS low_contrast,
    n_chars / 5.0 < 90 AS heavy_blur,
    (word_count > 0 AND coalesce(alnum_ratio < 0.55, false)) AS ocr_illegible
  FROM pages_of)
"""
