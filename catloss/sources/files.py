"""File sources (S1-S4) and the EP long CSV writer.

Listing goes through the Hadoop FileSystem of the data root, so local folders,
HDFS and object stores behave the same. Reads are lazy DataFrames; CSVs are read
as text and cast by name to the declared types (strict under ANSI: a bad value
fails the job instead of turning into null).
"""

from __future__ import annotations

import csv
import posixpath
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catloss import schemas as SC
from catloss.inputs import RunInputs
from catloss.operators import ep_convert as EC
from catloss.params import VENDORS

EP_CANONICAL_COLUMNS = SC.names(SC.EP_LONG)
#: Files whose column places (some 200 bytes a file) are broadcast.
FILES_BROADCAST = 100_000


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _list(spark: SparkSession, root: str, recursive: bool) -> list[str]:
    """Files under ``root`` (any depth when recursive); direct children (files or
    folders, e.g. Spark-written ``*.parquet`` folders) otherwise."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    if not recursive:
        return sorted(s.getPath().toString() for s in fs.listStatus(p))
    out = set()
    it = fs.listFiles(p, True)
    while it.hasNext():
        path = it.next().getPath().toString()
        # a Spark-written ``x.parquet`` / ``x.csv`` folder is listed as one entry
        for suffix in (".parquet/", ".csv/"):
            if suffix in path:
                path = path[: path.index(suffix) + len(suffix) - 1]
                break
        out.add(path)
    return sorted(out)


def _rel(path: str, root: str) -> str:
    """``path`` relative to ``root`` (both as listed by the file system)."""
    root = root.rstrip("/")
    i = path.find(root.split(":", 1)[-1].rstrip("/"))
    tail = path[i + len(root.split(":", 1)[-1].rstrip("/")):] if i >= 0 else path
    return tail.lstrip("/")


def _csv_strings(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    return spark.read.option("header", True).option("inferSchema", False).csv(paths)


def _cast_by_name(df: DataFrame, schema, source: str) -> DataFrame:
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{source} is missing columns {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def load_ylts(spark: SparkSession, data_root: str) -> dict[str, DataFrame]:
    """Every direct ``*.parquet`` child of ``ylt/<vendor>/`` (no recursion)."""
    frames = {}
    for vendor in VENDORS:
        root = posixpath.join(data_root, "ylt", vendor)
        paths = [p for p in _list(spark, root, recursive=False) if p.endswith(".parquet")]
        if not paths:
            raise FileNotFoundError(f"no {vendor} YLT parquet files found in {root}")
        frames[vendor] = spark.read.parquet(*paths)
    return frames


def load_seeds(spark: SparkSession, data_root: str) -> dict[str, DataFrame]:
    """CSV and parquet seeds anywhere under ``seeds/``, keyed by file stem.

    A stem found twice is an error; a missing folder gives no seeds. Known stems are
    cast to their declared schema; others stay as read.
    """
    root = posixpath.join(data_root, "seeds")
    frames: dict[str, DataFrame] = {}
    seen: dict[str, str] = {}
    for path in _list(spark, root, recursive=True):
        name = posixpath.basename(path)
        if name.endswith(".csv"):
            stem, kind = name[:-4], "csv"
        elif name.endswith(".parquet"):
            stem, kind = name[: -len(".parquet")], "parquet"
        else:
            continue
        if stem in seen:
            raise ValueError(f"duplicate seed stem {stem!r}: {seen[stem]} and {path}")
        seen[stem] = path
        df = spark.read.parquet(path) if kind == "parquet" else _csv_strings(spark, path)
        if stem in SC.SEED_SCHEMAS:
            df = _cast_by_name(df, SC.SEED_SCHEMAS[stem], path)
        frames[stem] = df
    return frames


def _ep_summary_entries(spark: SparkSession, root: str) -> dict[str, str]:
    """Listed ``*.long.csv`` entries (files or Spark-written folders) and their vendors."""
    entries = {}
    for path in _list(spark, root, recursive=True):
        if not path.endswith(".long.csv"):
            continue
        parts = _rel(path, root).split("/")
        if len(parts) < 2:
            raise ValueError(f"EP summary file must sit in a vendor folder: {path}")
        if parts[0] not in VENDORS:
            raise ValueError(f"unknown EP summary vendor folder {parts[0]!r}: {path}")
        entries[path] = parts[0]
    for vendor in VENDORS:
        if vendor not in entries.values():
            raise FileNotFoundError(f"no {vendor} EP summary files (*.long.csv) under {root}/{vendor}")
    return entries


def _header_lines(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """File -> its first line that is not blank, of all files in one job.

    Rows of a file's first block come in the order of the file, so the least row id is
    the header's; each task sends one line a file.
    """
    lines = spark.read.text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start")
    lines = lines.where((F.col("file_block_start") == 0) & (F.trim("value") != "")).withColumn("row", F.monotonically_increasing_id())
    return {r.file_path: r.header for r in lines.groupBy("file_path").agg(F.min_by("value", "row").alias("header")).collect()}


def _entry_of(file_path: str, entries: dict[str, str]) -> str:
    """The listed entry a data file is, or lies in; the file's path may be URL-encoded and have another number of slashes."""
    bare = lambda p: re.sub(r"^([a-z][a-z0-9+.-]*):/+", r"\1:/", p)
    known = {bare(e): e for e in entries}
    for path in (bare(file_path), bare(unquote(file_path))):
        for candidate in (path, posixpath.dirname(path)):
            if candidate in known:
                return known[candidate]
    raise ValueError(f"{file_path} belongs to no listed EP summary file")


def load_ep_summaries(spark: SparkSession, data_root: str) -> DataFrame:
    """S3: ``*.long.csv`` files under ``ep_summaries/<vendor>/`` (any depth), in one scan.

    The first folder must be exactly a vendor name; each vendor needs at least one
    file; every file must carry the 7 canonical columns (checked from its header);
    ``vendor`` is taken from the folder, extra columns are dropped.

    Spark maps the columns of a CSV scan by position. So the scan reads fields by number,
    and a table of one row a file says which number holds which column: any mix of column
    orders is one scan, and the jobs are as many for 500 files as for two.
    """
    root = posixpath.join(data_root, "ep_summaries")
    entries = _ep_summary_entries(spark, root)
    headers = {f: next(csv.reader([line.lstrip("\ufeff")])) for f, line in _header_lines(spark, list(entries)).items()}
    wanted = [c for c in EP_CANONICAL_COLUMNS if c != "vendor"]
    layout, seen = [], set()
    for path, header in headers.items():
        entry = _entry_of(path, entries)
        seen.add(entry)
        missing = [c for c in EP_CANONICAL_COLUMNS if header.count(c) != 1]
        if missing:
            raise ValueError(f"{entry} is missing EP summary columns {missing}, or repeats them")
        layout.append((path, entries[entry], [header.index(c) for c in wanted]))
    if empty := sorted(set(entries) - seen):
        raise ValueError(f"{empty[0]} is missing EP summary columns {EP_CANONICAL_COLUMNS}: it has no header")

    width = max(map(len, headers.values()))
    fields = ", ".join(f"_{i} string" for i in range(width))
    data = spark.read.schema(fields).option("header", True).csv(list(entries))
    data = data.select(F.array(*[f"_{i}" for i in range(width)]).alias("fields"), "_metadata.file_path")
    places = spark.createDataFrame(layout, "file_path string, vendor string, places array<int>")
    # a row a file: broadcast, as one large file would be one key of a shuffle
    rows = data.join(F.broadcast(places) if len(layout) <= FILES_BROADCAST else places, "file_path")
    rows = rows.select("vendor", *[F.get("fields", F.get("places", i)).alias(c) for i, c in enumerate(wanted)])
    digits = F.col("analysis_id").rlike(r"^[0-9]+$")
    # ids of digits only are numbers in the YLT, so they lose leading zeros (X11)
    number = F.regexp_replace("analysis_id", r"^0+(?=[0-9])", "")
    return _cast_by_name(rows.withColumn("analysis_id", F.when(digits, number).otherwise(F.col("analysis_id"))), SC.EP_LONG, root)


def load_inputs(spark: SparkSession, data_root: str) -> RunInputs:
    return RunInputs(
        seeds=load_seeds(spark, data_root),
        ylts=load_ylts(spark, data_root),
        ep_summaries=load_ep_summaries(spark, data_root),
        data_root=data_root,
    )


def scan_ep_summary_csvs(spark: SparkSession, data_root: str, vendor: str) -> list[str]:
    """Wide EP CSVs of a vendor (not ``*.long.csv``), sorted by lower-cased name."""
    EC.long_file(vendor)
    root = posixpath.join(data_root, "ep_summaries", vendor)
    paths = [p for p in _list(spark, root, recursive=False) if p.endswith(".csv") and not p.endswith(".long.csv")]
    return sorted(paths, key=lambda p: posixpath.basename(p).lower())


def build_ep_summary_from_wide_csv(spark: SparkSession, path: str, vendor: str) -> DataFrame:
    """S4 + B13: read a wide EP CSV as text and convert it to the long form."""
    return EC.ep_wide_to_long(_csv_strings(spark, path), vendor, source=path)


def generate_ep_summaries(spark: SparkSession, data_root: str, vendors=VENDORS) -> dict[str, str]:
    """W5 batch mode: each vendor needs exactly one wide CSV; writes its long CSV beside it."""
    from catloss.sinks.writers import write_csv

    out = {}
    for vendor in vendors:
        candidates = scan_ep_summary_csvs(spark, data_root, vendor)
        if not candidates:
            raise FileNotFoundError(f"{vendor} has no wide EP summary CSV")
        if len(candidates) > 1:
            raise ValueError(f"{vendor} has several wide EP summary CSVs: {', '.join(map(posixpath.basename, candidates))}")
        target = posixpath.join(data_root, "ep_summaries", vendor, EC.long_file(vendor))
        out[vendor] = write_csv(build_ep_summary_from_wide_csv(spark, candidates[0], vendor), target)
    return out
