"""Sinks: all-or-nothing publishing of Spark outputs.

Spark writes directories. ``publish`` stages one or several outputs in a hidden folder beside
their targets, then commits them together by renaming one small journal file, and only then
moves them to their targets. A run that stops before the commit leaves the old outputs, one
that stops after it is finished by ``recover``, which every write and ``read_parquet`` call
first: what is read is a complete old or a complete new output. Steps can be repeated, and
don't need directory renames to be atomic. One writer at a time is assumed per folder. File
operations go through the Hadoop FileSystem of the target path.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catloss.operators import wide as WD
from catloss.params import VENDOR_LABELS

FANOUT_FILE_COLUMNS = [
    "ModelEventID", "ModelYear", "CurrencyCode", "ModelYOA", "ModelGrossLoss",
    "ModelInwardsReinstatement", "ModelEventDay", "LossClassName",
]


class _FS:
    """Thin helper over the Hadoop FileSystem of one path."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self.path = self._Path(path)
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def p(self, path: str):
        return self._Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.p(path))

    def rename(self, src: str, dst: str) -> None:
        if not self.fs.rename(self.p(src), self.p(dst)):
            raise OSError(f"could not move {src} to {dst}")

    def delete(self, path: str) -> None:
        if self.fs.exists(self.p(path)):
            self.fs.delete(self.p(path), True)

    def is_dir(self, path: str) -> bool:
        return self.fs.getFileStatus(self.p(path)).isDirectory()

    def mkdirs(self, path: str) -> None:
        self.fs.mkdirs(self.p(path))

    def children(self, path: str) -> list[str]:
        if not self.fs.exists(self.p(path)):
            return []
        return [s.getPath().toString() for s in self.fs.listStatus(self.p(path))]

    def write(self, path: str, text: str) -> None:
        out = self.fs.create(self.p(path), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, path: str) -> str:
        stream = self.fs.open(self.p(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()


def _parent(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[0]


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


PUBLISHING = ".publish-"
JOURNAL = "journal.json"


def publish(spark: SparkSession, parent: str, build: Callable[[str], Mapping[str, str]]) -> list[str]:
    """Publish together what ``build(folder)`` writes below ``folder``: it returns {target: staged}, targets in ``parent``."""
    fs = _FS(spark, parent)
    fs.mkdirs(parent)
    recover(spark, parent)
    folder = f"{parent}/{PUBLISHING}{uuid.uuid4().hex}"
    try:
        moves = dict(build(folder))
        elsewhere = [t for t in moves if _parent(t) != parent.rstrip("/")]
        if elsewhere:
            raise ValueError(f"outputs published together lie in {parent}, these don't: {elsewhere}")
        fs.write(f"{folder}/{JOURNAL}.tmp", json.dumps([[staged, target] for target, staged in moves.items()]))
        fs.rename(f"{folder}/{JOURNAL}.tmp", f"{folder}/{JOURNAL}")  # the commit
    except BaseException:
        fs.delete(folder)
        raise
    _finish(fs, folder)
    return list(moves)


def recover(spark: SparkSession, parent: str) -> list[str]:
    """Finish the committed publications of a folder that were stopped; returns their targets."""
    fs = _FS(spark, parent)
    done = []
    for folder in sorted(fs.children(parent)):
        if _name(folder).startswith(PUBLISHING) and fs.exists(f"{folder}/{JOURNAL}"):
            done += _finish(fs, folder)
    return done


def _finish(fs: _FS, folder: str) -> list[str]:
    moves = json.loads(fs.read(f"{folder}/{JOURNAL}"))
    for i, (staged, target) in enumerate(moves):
        if not fs.exists(f"{folder}/cleared-{i}"):
            fs.delete(target)
            fs.write(f"{folder}/cleared-{i}", "")  # from now on all of the target is new
        _move(fs, staged, target)
    fs.delete(folder)
    return [target for _, target in moves]


def _move(fs: _FS, source: str, target: str) -> None:
    """Move a folder; of one that was moved in part, what is left."""
    if not fs.exists(source):
        return
    if not fs.exists(target):
        fs.rename(source, target)
        return
    for child in fs.children(source):
        if fs.is_dir(child):
            _move(fs, child, f"{target}/{_name(child)}")
        else:
            fs.delete(f"{target}/{_name(child)}")
            fs.rename(child, f"{target}/{_name(child)}")
    fs.delete(source)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Write ``df`` as parquet at ``path`` (a directory named ``*.parquet``), all or nothing."""
    path = path.rstrip("/")
    if not path.endswith(".parquet"):
        raise ValueError(f"a parquet output is named *.parquet: {path}")

    def build(folder: str) -> dict[str, str]:
        df.write.partitionBy(*(partition_by or [])).parquet(f"{folder}/{_name(path)}")
        return {path: f"{folder}/{_name(path)}"}

    return publish(df.sparkSession, _parent(path), build)[0]


def write_csv(df: DataFrame, path: str) -> str:
    """A small result as one headed CSV part inside directory ``path``, all or nothing."""
    return write_csvs({path: df})[0]


def write_csvs(reports: Mapping[str, DataFrame]) -> list[str]:
    """Small results of one folder as headed CSVs, replaced together."""
    first = next(iter(reports))

    def build(folder: str) -> dict[str, str]:
        for path, df in reports.items():
            df.coalesce(1).write.option("header", True).csv(f"{folder}/{_name(path)}")
        return {path: f"{folder}/{_name(path)}" for path in reports}

    return publish(reports[first].sparkSession, _parent(first), build)


def fanout_file_name(base_model: F.Column, forecast_date: F.Column, metric: F.Column) -> F.Column:
    """``Hisco{AIR|RMS}_{YYYYMM}_{metric}``; an unknown base model fails the job."""
    label = F.raise_error(F.concat(F.lit("unknown base model: "), F.coalesce(base_model, F.lit("<null>"))))
    for model, tag in VENDOR_LABELS.items():
        label = F.when(base_model == model, F.lit(tag)).otherwise(label)
    return F.concat(F.lit("Hisco"), label, F.lit("_"), F.date_format(forecast_date, "yyyyMM"), F.lit("_"), metric)


#: What a fanout needs: the columns that name its file, of these types, and those of the file.
FANOUT_TYPES = {"forecast_date": (T.DateType, T.TimestampType, T.TimestampNTZType), "base_model": (T.StringType,), "metric": (T.StringType,)}


def _fanout_rows(name: str, df: DataFrame) -> DataFrame:
    found = {f.name: f.dataType for f in df.schema.fields}
    problems = [f"no column {c}" for c in [*FANOUT_TYPES, *FANOUT_FILE_COLUMNS] if c not in found]
    problems += [f"{c} is {found[c].simpleString()}" for c, kinds in FANOUT_TYPES.items() if c in found and not isinstance(found[c], kinds)]
    if problems:
        raise ValueError(f"{name} can't be fanned out: {', '.join(problems)}")
    date = F.to_date("forecast_date")
    return df.select(fanout_file_name(F.col("base_model"), date, F.col("metric")).alias("_file"), date.alias("_date"), *FANOUT_FILE_COLUMNS)


def write_fanout_partitions(fanouts: Mapping[str, DataFrame], marts_dir: str) -> list[str]:
    """One 8-column parquet per (forecast date, base model, metric), named like
    ``HiscoAIR_202601_euws_override.parquet``, published together as ``marts_dir``.

    All fanouts are staged in one partitioned pass; the folder then replaces ``marts_dir``:
    a failure keeps all files of the earlier run, a success none. Two forecast dates of one
    month share a name and are rejected.
    """
    rows = [_fanout_rows(name, df) for name, df in fanouts.items()]
    if not rows:
        raise ValueError("there is no fanout to write")
    union = rows[0]
    for f in rows[1:]:
        union = union.unionByName(f)
    spark, marts_dir = union.sparkSession, marts_dir.rstrip("/")
    fs = _FS(spark, marts_dir)
    names: list[str] = []

    def build(folder: str) -> dict[str, str]:
        # Rebalanced by file, so that parts are of even size however many tasks there are;
        # AQE splits a large file over several tasks. Each published ``*.parquet`` is a
        # directory of parts, like every other output.
        union.hint("rebalance", "_file").write.partitionBy("_file", "_date").parquet(f"{folder}/parts")
        fs.mkdirs(f"{folder}/marts")
        for part in sorted(c for c in fs.children(f"{folder}/parts") if _name(c).startswith("_file=")):
            file_name = _name(part).split("=", 1)[1] + ".parquet"
            dates = [c for c in fs.children(part) if _name(c).startswith("_date=")]
            if len(dates) > 1:
                raise ValueError(f"{len(dates)} forecast dates share the file {file_name}")
            fs.rename(dates[0], f"{folder}/marts/{file_name}")
            names.append(f"{marts_dir}/{file_name}")
        return {marts_dir: f"{folder}/marts"}

    publish(spark, _parent(marts_dir), build)
    return names


def write_wide(main_long_df: DataFrame, dialsup_long_df: DataFrame, path: str, candidates: list[str]) -> str:
    """Pivot (A8), grain check (A9) and dates present (A10) in one pass with one shuffle.

    The pivot over the candidate dates is written to a staging folder while its duplicates
    and the rows of each date are observed. Duplicates leave the target as it was. Columns
    of dates without rows are left out by a second, shuffle-free copy, if there are any.
    """
    candidates = WD.check_months(candidates)
    pivot = WD.wide_pivot(WD.wide_source(main_long_df, dialsup_long_df), candidates, grain=True)
    spark, seen = pivot.sparkSession, Observation()
    watched = [c for c in pivot.columns if c.startswith(("_dup_", "_rows_"))]
    pivot = pivot.observe(seen, *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in watched]).drop(*watched)

    def build(folder: str) -> dict[str, str]:
        pivot.write.parquet(f"{folder}/all")
        counts = seen.get
        duplicates = {m: counts[f"_dup_{m}"] for m in WD.WIDE_METRICS}
        if any(duplicates.values()):
            raise WD.grain_error(duplicates)
        dates = WD.check_months([d for d in candidates if counts[f"_rows_{d}"]])
        if dates == candidates:
            return {path: f"{folder}/all"}
        spark.read.parquet(f"{folder}/all").select(*WD.wide_columns(dates)).write.parquet(f"{folder}/present")
        return {path: f"{folder}/present"}

    return publish(spark, _parent(path), build)[0]


def write_debug(layers: Mapping[str, Mapping[str, DataFrame]], debug_dir: str) -> list[str]:
    """Opt-in dump of every layer as ``{prefix}_{name}.parquet`` (prefixes
    ``src seed stg int mts``); names must be unique within a layer."""
    out = []
    for prefix, frames in layers.items():
        for name, df in frames.items():
            out.append(write_parquet(df, f"{debug_dir.rstrip('/')}/{prefix}_{name}.parquet"))
    return out


def register_tables(tables, persist_as_tables: bool = False) -> list[str]:
    """Expose outputs and seeds for inspection under their stems (views, or
    catalogue tables when asked). ``tables`` is a mapping or a list of (name, frame)
    pairs; duplicate names are rejected before anything is registered."""
    pairs = list(tables.items()) if isinstance(tables, Mapping) else list(tables)
    names = [n for n, _ in pairs]
    dupes = sorted({n for n in names if names.count(n) > 1})
    if dupes:
        raise ValueError(f"duplicate inspection table names: {dupes}")
    for name, df in pairs:
        if persist_as_tables:
            df.write.mode("overwrite").saveAsTable(name)
        else:
            df.createOrReplaceTempView(name)
    return names


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A published output, after finishing a publication that was stopped."""
    recover(spark, _parent(path))
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


__all__ = [
    "publish", "read_parquet", "recover", "register_tables", "write_csv", "write_csvs", "write_debug", "write_fanout_partitions",
    "write_parquet", "write_wide",
]
