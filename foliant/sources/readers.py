"""Sources: folders of documents, JSON lines, JSON folders, earlier results, YAML dictionaries and settings, and
pluggable readers for what needs a library or a network."""
from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions.numbers import file_fingerprint, short_id
from foliant.functions.predicates import readable_pdf
from foliant.functions.text import file_name, top_folder
from foliant.sources import files, snapshots
from foliant.sources.calls import called

PASSED_ON = 256  #: rows of finished calls that are passed on together


def scan_library(spark: SparkSession, root: str, ending: str = "pdf", content: bool = False) -> DataFrame:
    """One row for each file below root: path, rel_path, pdf_filename, piece_folder, piece_id, size, modified time
    and fingerprint. The ending's case doesn't matter. Contents are read only where they are asked for."""
    glob = "*." + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in ending)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    base = root.rstrip("/").removeprefix("file://")
    rel = F.regexp_replace(F.col("path"), rf"^(?:file:)?/*{_quoted(base.strip('/'))}/+", "")
    out = files.select("path", rel.alias("rel_path"), "length", "modificationTime", *(["content"] if content else []))
    folder = top_folder(F.col("rel_path"))
    return out.select(
        "path",
        F.col("rel_path").alias("pdf_path"),
        file_name(F.col("rel_path")).alias("pdf_filename"),
        folder.alias("piece_folder"),
        short_id(folder).alias("piece_id"),
        F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").alias("modified"),
        file_fingerprint(F.col("rel_path"), F.col("length"), F.col("modificationTime")).alias("file_fingerprint"),
        *(["content"] if content else []),
    )


def _quoted(text: str) -> str:
    import re

    return re.escape(text)


PROBE = T.StructType(
    [
        T.StructField("page_count", T.IntegerType()),
        T.StructField("pdf_readable", T.BooleanType()),
        T.StructField("is_encrypted", T.BooleanType()),
        T.StructField("is_zero_page", T.BooleanType()),
        T.StructField("is_malformed", T.BooleanType()),
        T.StructField("error_message", T.StringType()),
        *[T.StructField(n, T.StringType()) for n in ("title", "author", "subject", "creator", "producer", "creation_date", "modification_date")],
    ]
)
#: The keys of a document's metadata.
METADATA_KEYS = {"title": b"Title", "author": b"Author", "subject": b"Subject", "creator": b"Creator", "producer": b"Producer", "creation_date": b"CreationDate", "modification_date": b"ModDate"}


def probe_bytes(content: bytes) -> dict[str, Any]:
    """What a PDF's bytes tell without a PDF library: a header, an end, an encryption entry, page objects and plain
    metadata strings."""
    import re

    head = content[:1024].find(b"%PDF-") >= 0
    pages = len(re.findall(rb"/Type\s*/Page(?![a-zA-Z])", content))
    ended = b"%%EOF" in content[-2048:]
    return {
        "page_count": pages if head else -1,
        "pdf_readable": head and pages > 0,
        "is_encrypted": b"/Encrypt" in content,
        "is_zero_page": head and pages == 0,
        "is_malformed": not (head and ended),
        "error_message": None if head else "no PDF header",
        **{n: _metadata(content, k) if head else None for n, k in METADATA_KEYS.items()},
    }


def _metadata(content: bytes, key: bytes) -> str | None:
    import re

    found = re.search(rb"/" + key + rb"\s*\(((?:[^()\\]|\\.)*)\)", content)
    return found[1].decode("latin-1") if found else None


def probe_documents(files: DataFrame, probe: Callable[[bytes], dict[str, Any]] = probe_bytes) -> DataFrame:
    """files (with content) and a struct `health`; a file whose probe raises gets an error row, not a failed task."""

    @F.pandas_udf(PROBE)
    def run(contents: pd.Series) -> pd.DataFrame:
        rows = []
        for c in contents:
            try:
                rows.append({f.name: probe(bytes(c)).get(f.name) for f in PROBE})
            except Exception as e:  # noqa: BLE001  the error is the row's result
                rows.append({**dict.fromkeys(f.name for f in PROBE), "page_count": -1, "pdf_readable": False, "is_encrypted": False, "is_zero_page": False, "is_malformed": True, "error_message": str(e)})
        return pd.DataFrame(rows, columns=[f.name for f in PROBE])

    return files.select(*[c for c in files.columns if c != "content"], run("content").alias("health"))


def read_pages(files: DataFrame, extract: Callable[[bytes], Iterator[dict[str, Any]]], schema: str, key: str = "pdf_path") -> DataFrame:
    """A row for each page that `extract` yields of a file's bytes, under its key. A file that fails gives one row
    with processing_status `error`; `schema` must hold the key, processing_status and error_message."""
    names = T._parse_datatype_string(schema).names

    def frame(found: list[dict[str, Any]]) -> pd.DataFrame:
        full = pd.DataFrame(found, dtype=object).reindex(columns=names).astype(object)
        return full.where(full.notna(), None)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[dict[str, Any]] = []
        for batch in batches:
            for at, content in zip(batch[key], batch["content"], strict=True):
                try:
                    held += [{"processing_status": "success", **page, key: at} for page in extract(bytes(content))]
                except Exception as e:  # noqa: BLE001
                    held.append({key: at, "processing_status": "error", "error_message": str(e)})
                if len(held) >= 5000:
                    yield frame(held)
                    held = []
        if held:
            yield frame(held)

    return files.select(key, "content").mapInPandas(rows, schema)


def read_jsonl(spark: SparkSession, path: str, schema: str, with_rejects: bool = False) -> DataFrame:
    """JSON lines; blank, malformed and non-object lines are left out, or kept in `_corrupt_record`. A value of another
    type than the schema's is null, its row stays. `path`: files, or what sinks.write_jsonl() has written."""
    names = T._parse_datatype_string(schema).names
    lines = spark.read.text(snapshots.folders(spark, path)).where(F.trim("value") != "")
    whole = F.try_parse_json("value")
    rows = lines.select(F.when(F.startswith(F.trim("value"), F.lit("{")) & whole.isNotNull(), whole).alias("v"), "value")
    good = rows.where(F.col("v").isNotNull())
    kinds = {f.name: f.dataType.simpleString() for f in T._parse_datatype_string(schema)}
    out = good.select(*[F.try_variant_get("v", f"$.{n}", kinds[n]).alias(n) for n in names])
    if not with_rejects:
        return out
    bad = rows.where(F.col("v").isNull()).select(*[F.lit(None).cast(kinds[n]).alias(n) for n in names], F.col("value").alias("_corrupt_record"))
    return out.withColumn("_corrupt_record", F.lit(None).cast("string")).union(bad)


def read_json_folder(spark: SparkSession, folder: str, schema: str, key: str) -> tuple[DataFrame, DataFrame]:
    """The objects of a folder's *.json files, and the number of files skipped: unreadable or without the key."""
    rows = spark.read.schema(schema + ", _corrupt_record string").option("multiLine", True).option("pathGlobFilter", "[!.]*.json").option("columnNameOfCorruptRecord", "_corrupt_record").json(folder)
    bad = F.col("_corrupt_record").isNotNull() | F.col(key).isNull()
    return rows.where(~bad).drop("_corrupt_record"), rows.agg(F.count_if(bad).alias("skipped"))


def read_json_object(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def readable_items(inventory: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The readable documents' six columns, and how many were skipped."""
    columns = ("pdf_path", "piece_id", "piece_folder", "pdf_filename", "file_fingerprint", "page_count")
    return inventory.where(readable_pdf()).select(*columns), inventory.agg(F.count_if(~readable_pdf()).alias("skipped"))


def prior_results(previous: DataFrame, key: str, position: str) -> DataFrame:
    """Earlier records, the last one of each key."""
    last = F.row_number().over(W.partitionBy(key).orderBy(F.desc(position)))
    return previous.withColumn("_n", last).where("_n = 1").drop("_n")


def checkpoint_of(checkpoint: DataFrame, version: str) -> DataFrame:
    """The fingerprints of a checkpoint table; of another version, none."""
    return checkpoint.where(F.col("record_version") == version).select("key", "fingerprint")


def read_checkpoint(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """The checkpoint that sinks.write_checkpoint() wrote last for a stage; no rows before the first."""
    at = f"{path}/{stage}"
    if snapshots.version_of(spark, at)[1] is None:
        return spark.createDataFrame([], "stage string, key string, fingerprint string, record_version string, last_run_id string")
    return snapshots.read(spark, at)


def few(df: DataFrame, most: int = 100_000) -> list:
    """The rows of a table that is to be a dictionary or settings; an error if there are more than `most`."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    return rows


def _given(source: str | dict[str, Any] | None, spark: SparkSession | None = None) -> dict[str, Any]:
    """The settings of a YAML file, or those given as a dict. With a session the file may be in any of its stores."""
    if isinstance(source, dict) or not source:
        return source or {}
    import yaml

    if spark is not None:
        return yaml.safe_load(files.read_text(source, spark)) or {}

    with open(source) as f:
        return yaml.safe_load(f) or {}


def merged_settings(defaults: dict[str, Any], source: str | dict[str, Any] | None, spark: SparkSession | None = None) -> dict[str, Any]:
    """Defaults overlaid, two levels deep, by the known keys of a YAML file or a dict; nulls and unknown keys, nested
    ones too, change nothing."""
    out = dict(defaults)
    for k, v in _given(source, spark).items():
        if k in out and v is not None:
            known = isinstance(out[k], dict) and isinstance(v, dict)
            out[k] = {**out[k], **{a: b for a, b in v.items() if b is not None and a in out[k]}} if known else v
    return out


def merged_lexicon(defaults: dict[str, Any], source: str | dict[str, Any] | None, spark: SparkSession | None = None) -> dict[str, Any]:
    """A dictionary overlaid key by key: instruments, sections, families, clef and transposition markers, score
    keywords, interchangeable groups. A key that is given replaces the default's, others stay."""
    out = {k: dict(v) if isinstance(v, dict) else v for k, v in defaults.items()}
    for k, v in _given(source, spark).items():
        if isinstance(v, dict) and isinstance(out.get(k), dict):
            out[k].update({a: b for a, b in v.items() if b is not None})
        elif v is not None:
            out[k] = v
    return out


MARKER_SCHEMA = "kind string, marker string, value string, pos int"


def markers(spark: SparkSession, data: dict[str, Any]) -> DataFrame:
    """The markers of a dictionary, in order: (kind, marker, value, pos) of clefs, transpositions, score keywords
    (`score_types`: type to words) and interchangeable groups (`interchangeable`: lists of names)."""
    rows = []
    for kind in ("clef_markers", "transposition_markers"):
        rows += [(kind, str(m).lower(), v) for m, v in (data.get(kind) or {}).items()]
    rows += [("score_types", str(w).lower(), t) for t, words in (data.get("score_types") or {}).items() for w in words or []]
    rows += [("interchangeable", n, str(i)) for i, names in enumerate(data.get("interchangeable") or []) for n in names]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], MARKER_SCHEMA)


ALIAS_SCHEMA = "canonical string, alias string, family string, section string, pos int"


def lexicon(spark: SparkSession, path: str | dict[str, Any]) -> DataFrame:
    """The dictionary of a YAML file (or the same as a dict): a row for each canonical name and alias.
    `instruments`: name to aliases, or family to name to aliases; `sections` and `families`: group to names."""
    data = _given(path, spark)
    group_of = lambda kind: {name: group for group, names in (data.get(kind) or {}).items() for name in names or []}
    sections, families = group_of("sections"), group_of("families")
    rows = []
    for name, aliases in (data.get("instruments") or {}).items():
        named = aliases.items() if isinstance(aliases, dict) else [(name, aliases)]
        for canonical, words in named:
            family = name if isinstance(aliases, dict) else families.get(canonical)
            rows += [(canonical, " ".join(str(w).lower().replace("-", " ").replace("_", " ").split()), family, sections.get(canonical, family)) for w in words or []]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ALIAS_SCHEMA)


def prompt_template(path: str | None, default: str, spark: SparkSession | None = None) -> str:
    if not path:
        return default
    if spark is not None:
        return files.read_text(path, spark)
    with open(path) as f:
        return f.read()


def fetched(keys: DataFrame, key: str, fetch: Callable[[str], str | None], column: str = "text", width: int = 1, deadline: float | None = None, budget: float | None = None) -> DataFrame:
    """(key, column, status): what a pluggable source gives for each distinct key; a failure is a null and a status. A
    task makes `width` calls at a time, each with a deadline, and all within its budget of seconds (calls.called()); rows
    are passed on as calls finish."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [key, column, "status"]
        asked = (k for batch in batches for k in batch[key])
        held: list[tuple] = []
        for k, found, status in called(asked, lambda k: fetch(k) or None, width, deadline, budget):
            held.append((k, found, status))
            if len(held) >= PASSED_ON:
                yield pd.DataFrame(held, columns=names)
                held = []
        yield pd.DataFrame(held, columns=names)

    return keys.select(F.col(key).cast("string")).distinct().mapInPandas(run, f"{key} string, {column} string, status string")


def image_urls(text: Column) -> Column:
    """The distinct image addresses of a text, in order."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?i)(https?://[^\s\"'<>]+\.(?:png|jpe?g|gif|webp|tiff?))"), F.lit(1)))


def title_variations(title: str | None, folder: str | None) -> list[str]:
    """What to look a piece up by, the most specific first: its title, that without a leading article, its folder's
    name without a catalog number; each once, `unknown` never."""
    known = [(x or "").strip() for x in (title, folder)]
    title, folder = ("" if x.lower() == "unknown" else x for x in known)
    bare = title[4:].strip() if title.lower().startswith("the ") else ""
    number, _, rest = folder.partition(" ")
    return [x for x in dict.fromkeys([title, bare, (rest.strip() or folder) if number.isdigit() else folder]) if x]


def wiki_text(get: Callable[[dict[str, str], float], Any], title: str | None, folder: str | None, section: str = "instrument", budget: float = 10.0, clock: Callable[[], float] | None = None) -> str | None:
    """A work's text from a MediaWiki site: the first page that a title search, or else a full-text search, finds under
    any variation; of it the section whose heading holds a word, or else all. One time budget covers all calls; any
    failure gives None. `get` makes an API call (parameters, seconds left) and returns its JSON."""
    import time

    now = clock or time.monotonic
    end = now() + budget

    def call(**params: str) -> Any:
        left = end - now()
        if left <= 0.5:
            raise TimeoutError("the lookup's time is used up")
        return get({**params, "format": "json"}, left)

    def pages(term: str) -> list[str]:
        found = call(action="opensearch", limit="5", search=term)
        titles = found[1] if isinstance(found, list) and len(found) > 1 else []
        if not titles:
            hits = ((call(action="query", list="search", srlimit="5", srsearch=term) or {}).get("query") or {}).get("search") or []
            titles = [h.get("title") for h in hits if isinstance(h, dict)]
        return [t for t in titles if t]

    try:
        page = next((p[0] for term in title_variations(title, folder) if (p := pages(term))), None)
        if page is None:
            return None
        heads = ((call(action="parse", page=page, prop="sections") or {}).get("parse") or {}).get("sections") or []
        index = next((str(h.get("index")) for h in heads if section in str(h.get("line", "")).lower()), None)
        body = ((call(action="parse", page=page, prop="wikitext", **({"section": index} if index else {})) or {}).get("parse") or {}).get("wikitext") or {}
        text = body.get("*") if isinstance(body, dict) else None
        return f"{page}\n\n{text}" if isinstance(text, str) and text.strip() else None
    except (OSError, ValueError, KeyError, IndexError, AttributeError):
        return None


def http_get(url: str) -> Callable[[dict[str, str], float], Any]:
    """An API call over HTTP for wiki_text()."""

    def get(params: dict[str, str], seconds: float) -> Any:
        import json
        import urllib.parse
        import urllib.request

        with urllib.request.urlopen(f"{url}?{urllib.parse.urlencode(params)}", timeout=seconds) as r:
            return json.loads(r.read().decode("utf-8", errors="replace"))

    return get


def looked_up(pieces: DataFrame, key: str, get: Callable[[dict[str, str], float], Any], cache: DataFrame | None = None, budget: float = 10.0) -> DataFrame:
    """(key, text, status) of pieces (key, title, folder): from the cache (key, text) where it has them, else by
    wiki_text(). Append the successes to the cache with sinks.add_to_cache()."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [wiki_text(get, t, f, budget=budget) for t, f in zip(batch["title"], batch["folder"], strict=True)]
            yield pd.DataFrame({key: batch[key], "text": pd.Series(found, dtype=object), "status": ["success" if x else "not_found" for x in found]})

    kind = pieces.schema[key].dataType.simpleString()
    wanted = pieces if cache is None else pieces.join(cache.select(key), key, "left_anti")
    fresh = wanted.select(key, "title", "folder").mapInPandas(run, f"{key} {kind}, text string, status string")
    if cache is None:
        return fresh
    return fresh.union(pieces.select(key).join(cache.select(key, "text"), key).withColumn("status", F.lit("cached")))


def command_source(command: list[str], seconds: float = 600.0) -> Callable[[str], str | None]:
    """A command-line program as a source for fetched(): the prompt goes to its standard input, its output is the
    answer. A run that takes too long is killed and raises."""

    def run(prompt: str) -> str | None:
        import subprocess

        done = subprocess.run(command, input=prompt, capture_output=True, text=True, timeout=seconds)
        if done.returncode:
            raise RuntimeError(f"exit {done.returncode}: {done.stderr[-200:]}")
        return done.stdout or None

    return run


def reread_pages(documents: DataFrame, read: Callable[[str], str | None], key: str = "pdf_path", text: str = "text", least: int = 200) -> DataFrame:
    """documents with `text` read anew, by an injected reader, where it is shorter than `least` characters; what is
    found must be longer than what there was. `reread` tells."""
    short = documents.where(F.length(F.trim(F.coalesce(text, F.lit("")))) < least)
    fresh = fetched(short, key, read, "_again").where("status = 'success'").select(key, "_again")
    both = documents.join(fresh, key, "left")
    better = F.coalesce(F.length("_again") > F.length(F.coalesce(text, F.lit(""))), F.lit(False))
    return both.withColumn("reread", better).withColumn(text, F.when(better, F.col("_again")).otherwise(F.col(text))).drop("_again")


def image_texts(texts: DataFrame, key: str, text: str, fetch: Callable[[str], bytes | None], read: Callable[[bytes], str | None]) -> DataFrame:
    """(key, found, images): what an injected reader reads in the images that a text links to, in order, an image once;
    images that can't be fetched or read are left out. Each address is fetched once, however many texts link to it."""

    def both(url: str) -> str | None:
        raw = fetch(url)
        return read(raw) if raw else None

    links = texts.select(key, F.posexplode(image_urls(F.col(text))).alias("at", "url"))
    known = fetched(links, "url", both, "said").where("status = 'success'").select("url", "said")
    rows = links.join(known, "url")
    told = F.array_sort(F.collect_list(F.struct("at", "said")))
    return rows.groupBy(key).agg(F.array_join(F.transform(told, lambda x: x["said"]), "\n").alias("found"), F.count("*").alias("images"))
