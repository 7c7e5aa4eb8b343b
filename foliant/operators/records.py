"""Record builders: envelopes, typed projections, flatteners, the tables that are shown."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions.numbers import page_id, piece_order, run_id, short_id, to_pct, utc_text
from foliant.functions.predicates import needs_ocr, readable_text, yes
from foliant.functions.text import alnum_ratio, first_truthy, text_hash, word_count


def envelope(df: DataFrame, version: str, run: Column | None = None, status: str = "success") -> DataFrame:
    now = F.current_timestamp()
    return df.withColumns({"record_version": F.lit(version), "run_id": run if run is not None else run_id(now), "processing_status": F.lit(status), "processing_timestamp": utc_text(now)})


def with_errors(good: DataFrame, failed: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Good rows, and failed ones with fixed values for what they lack."""
    return good.unionByName(failed.withColumns({k: v for k, v in defaults.items() if k not in failed.columns}), allowMissingColumns=True)


def page_text(pages: DataFrame) -> DataFrame:
    """The derived columns of a page's text: which source it is from, signals and hash."""
    embedded, ocr = F.col("embedded_text"), F.col("ocr_text")
    searchable = readable_text(embedded)
    source = F.when(searchable, "embedded").when(first_truthy(ocr).isNotNull(), "ocr").otherwise("none")
    text = F.when(searchable, embedded).otherwise(F.coalesce(ocr, F.lit("")))
    out = pages.withColumns({"text_source": source, "text": text, "text_is_searchable": searchable, "needs_ocr": needs_ocr(embedded, F.col("is_image_based"))})
    t = F.col("text")
    return out.withColumns({"embedded_text_length": F.length(F.coalesce(embedded, F.lit(""))), "word_count": word_count(t), "alnum_ratio": alnum_ratio(t), "page_text_hash": text_hash(t)})


def enriched(df: DataFrame, extra: DataFrame, key: str, status: str, default: str = "not_applied") -> DataFrame:
    """df with what an enrichment found; its status says so where it wasn't applied."""
    return df.join(extra, key, "left").withColumn(status, F.coalesce(status, F.lit(default)))


def facet(canonical: Column, index: Column, family: Column, section: Column) -> Column:
    return F.struct(canonical.alias("canonical"), index.alias("part_index"), family.alias("family"), section.alias("section"))


def primary(instruments: Column, field: str, is_score: Column | None = None) -> Column:
    """A field of the first facet; `score` for a score, if asked for."""
    first = F.get(instruments, F.lit(0))[field]
    return first if is_score is None else F.when(is_score, "score").otherwise(first)


def conservative(status: Column, value: Column) -> Column:
    """A value that is asserted only where the lookup matched."""
    return F.when(status == "matched", value)


def resolved(given: Column, looked_up: Column, fields: list[str]) -> Column:
    """A struct of fields, what a lookup found winning over what was known, if it is neither null nor empty."""
    return F.struct(*[first_truthy(looked_up[f], given[f]).alias(f) for f in fields])


def evidence(items: Column) -> Column:
    """Items with any of url, title and snippet; a missing title is the url, else `source`."""
    kept = F.filter(items, lambda x: first_truthy(x["url"], x["title"], x["snippet"]).isNotNull())
    return F.transform(kept, lambda x: F.struct(x["url"].alias("url"), F.coalesce(first_truthy(x["title"], x["url"]), F.lit("source")).alias("title"), x["snippet"].alias("snippet")))


def missing_required(slots: Column) -> Column:
    return F.filter(slots, lambda p: yes(p["required"]) & ~yes(p["present"]))


def flattened(df: DataFrame, array: str, *keep: str, keep_empty: bool = False) -> DataFrame:
    """A row for each element of an array of structs; with keep_empty, one row of nulls for none."""
    out = df.select(*keep, (F.explode_outer if keep_empty else F.explode)(array).alias("_x"))
    return out.select(*keep, "_x.*")


def metric_rows(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """A nested row as (metric, value) text rows: dotted paths for fields, [i] for the places of structs in an array;
    an array of other values is joined."""

    def walk(c: Column, kind: T.DataType, path: Column) -> Column:
        """An array of (metric, value)."""
        one = lambda v: F.array(F.struct(path.alias("metric"), v.alias("value")))
        if isinstance(kind, T.StructType):
            return F.concat(*[walk(c[f.name], f.dataType, F.concat(path, F.lit(f".{f.name}"))) for f in kind])
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            each = F.transform(c, lambda x, i: walk(x, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
            return F.coalesce(F.flatten(each), F.array().cast("array<struct<metric:string,value:string>>"))
        if isinstance(kind, T.ArrayType):
            return one(F.array_join(c.cast("array<string>"), "; "))
        return one(F.to_json(c) if isinstance(kind, T.MapType) else c.cast("string"))

    cells = F.concat(*[walk(F.col(f"`{f.name}`"), f.dataType, F.lit(f.name)) for f in df.schema if f.name not in skip])
    return df.select(F.explode(cells).alias("x")).select("x.*")


def display_rows(documents: DataFrame, path: str = "pdf_path") -> DataFrame:
    """Ids and percentages of what is shown."""
    c = documents.columns
    out = documents.withColumn("doc_id", short_id(F.col(path)))
    if "confidence" in c:
        out = out.withColumn("confidence_pct", to_pct(F.col("confidence")).cast("int"))
    return out.withColumn("page_id", page_id(F.col(path), F.col("page_num"))) if "page_num" in c else out


def in_piece_order(df: DataFrame, catalog: str = "catalog_number", folder: str = "piece_folder") -> DataFrame:
    return df.orderBy(*piece_order(F.col(catalog), F.col(folder)))


def ranked_order(items: Column, dims: dict[str, dict[str, int]]) -> Column:
    """An array of structs ordered by the ranks of several fields; unknown values last."""
    maps = {f: F.create_map(*[F.lit(x) for kv in ranks.items() for x in kv]) for f, ranks in dims.items()}
    key = lambda x: F.struct(*[F.coalesce(F.try_element_at(m, x[f]), F.lit(9999)).alias(f) for f, m in maps.items()], x.alias("x"))
    return F.transform(F.array_sort(F.transform(items, key)), lambda y: y["x"])


#: The shares of a page's height and width that its zones end or begin at.
TOP, LEFT, RIGHT, BOTTOM = 0.22, 0.38, 0.62, 0.82


def zones(spans: Column) -> Column:
    """struct(top_left, top_center, top_right, bottom) texts of spans (x, y, text; 0 to 1), read from the top."""
    place = F.transform(spans, lambda s: F.struct(s["y"].alias("y"), s["x"].alias("x"), s["text"].alias("text")))
    pick = lambda cond: F.array_join(F.transform(F.array_sort(F.filter(place, cond)), lambda s: s["text"]), " ")
    top = lambda s: s["y"] <= TOP
    return F.struct(
        pick(lambda s: top(s) & (s["x"] < LEFT)).alias("top_left"),
        pick(lambda s: top(s) & s["x"].between(LEFT, RIGHT)).alias("top_center"),
        pick(lambda s: top(s) & (s["x"] > RIGHT)).alias("top_right"),
        pick(lambda s: s["y"] >= BOTTOM).alias("bottom"),
    )


def prominent(spans: Column, share: float = 0.85, most: int = 5) -> Column:
    """The texts of spans nearly as large as the largest, from the top."""
    top = F.array_max(F.transform(spans, lambda s: s["size"]))
    big = F.filter(spans, lambda s: s["size"] >= top * share)
    order = F.array_sort(F.transform(big, lambda s: F.struct(s["y"].alias("y"), s["x"].alias("x"), s["text"].alias("text"))))
    return F.slice(F.transform(order, lambda s: s["text"]), 1, most)


def excerpt_lines(text: Column, most: int = 8) -> Column:
    """The first lines that aren't blank."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x))
    return F.slice(F.filter(lines, lambda x: x != ""), 1, most)
