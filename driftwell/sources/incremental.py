"""Incremental partitioned Parquet: watermark, lookback, late rows, drift and schema changes."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.operators.joins import last_by

_WRITES = re.compile(r"\b(insert|update|delete|merge|create|drop|alter|truncate)\b", re.IGNORECASE)
_RANK = {"timestamp": 3, "date": 3, "string": 2, "double": 1, "float": 1}


def read_only(sql: str) -> str:
    """``sql`` if no statement outside comments (``--``, ``#``, ``/* */``) and quotes writes; else ValueError."""
    bare = re.sub(r"'(?:[^']|'')*'|\"[^\"]*\"|`[^`]*`|--[^\n]*|#[^\n]*|/\*.*?\*/", " ", sql, flags=re.DOTALL)
    if _WRITES.search(bare):
        raise ValueError("only reading statements are allowed")
    return sql


def start_date(watermark: date | None, first: date, lookback: int) -> date:
    """Where a run reads from: ``lookback`` days before the watermark; from 7 on its Monday, from 30 on its month's first."""
    if watermark is None:
        return first
    at = watermark - timedelta(days=lookback)
    if lookback >= 30:
        at = at.replace(day=1)
    elif lookback >= 7:
        at -= timedelta(days=at.weekday())
    return max(at, first)


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def watermark(spark: SparkSession, path: str) -> date | None:
    """The last stored day, read off the names of the partition folders: no file is opened."""
    if not exists(spark, path):
        return None
    fs, where = _fs(spark, path)
    days = [f.getPath().getName() for f in fs.listStatus(where) if f.getPath().getName().startswith("day=")]
    days = [d.removeprefix("day=") for d in days if not d.endswith("__HIVE_DEFAULT_PARTITION__")]
    return date.fromisoformat(max(days)) if days else None


def check_drift(spark: SparkSession, path: str, config: dict, overwrite: bool = False) -> None:
    """Raise if the stored dataset was made with another ``config``."""
    side = f"{path.rstrip('/')}.config"
    if exists(spark, side) and not overwrite:
        old = json.loads(spark.read.text(side, wholetext=True).first()[0])
        if changed := sorted(k for k in old.keys() | config.keys() if old.get(k) != config.get(k)):
            raise ValueError(f"the configuration changed: {', '.join(changed)}")
    spark.createDataFrame([(json.dumps(config, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(side)


def touched_days(stored: DataFrame, begin: date) -> DataFrame:
    """Rows of the partitions from ``begin`` on; older folders are not read."""
    return stored.where(F.col("day") >= F.lit(begin))


def merged(new: DataFrame, stored: DataFrame, keys: list[str], date_col: str) -> DataFrame:
    """One row for each key: the last processed, of equal ones the latest by ``date_col``, then the least of all its values."""
    rows = new.unionByName(stored, allowMissingColumns=True)
    rest = F.to_json(F.struct(*sorted(c for c in new.columns if c not in (*keys, "_processed_at"))))
    return last_by(rows, keys, [F.desc("_processed_at"), F.desc(date_col), rest])


def run_incremental(spark: SparkSession, path: str, query: Callable[[SparkSession, date], DataFrame], keys: list[str], date_col: str, first: date, lookback: int = 0) -> date:
    """Query from the start date, and rewrite the touched days with the newest row of each key.

    New rows replace stored ones by ``keys``; if a column is new, everything is
    queried again and overwritten.  Each run's rows are written once, into a
    folder beside ``path`` that holds whole days; then only names change: each
    new day's folder takes the old one's place.  Errors are raised, and nothing
    is published before the staged data are whole; a run that ends between two
    days is mended by the next, which queries the same days again.
    """
    begin = start_date(watermark(spark, path), first, lookback)
    new = query(spark, begin)
    stored = spark.read.parquet(path) if exists(spark, path) else None
    if stored is not None and set(new.columns) - set(stored.columns):
        begin, new, stored = first, query(spark, first), None
    new = new.withColumn("_processed_at", F.current_timestamp()).withColumn("day", F.to_date(date_col))
    old = touched_days(stored, begin) if stored is not None else new.limit(0)
    stage = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    merged(new, old, keys, date_col).write.partitionBy("day").parquet(stage)
    fs, staged = _fs(spark, stage)
    to = staged.getParent().getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(spark._jvm.org.apache.hadoop.fs.Path(path))
    if stored is None:
        fs.delete(to, True)
        fs.rename(staged, to)
        return begin
    kept = set()
    for status in fs.listStatus(staged):
        day = status.getPath().getName()
        if day.startswith("day="):
            kept.add(day)
            target = spark._jvm.org.apache.hadoop.fs.Path(to, day)
            fs.delete(target, True)
            if not fs.rename(status.getPath(), target):
                raise OSError(f"{day} could not be put in place")
    for status in fs.listStatus(to):  # a day all of whose keys moved to another one
        day = status.getPath().getName()
        if day.startswith("day=") and day not in kept and day.removeprefix("day=")[:1].isdigit() and date.fromisoformat(day.removeprefix("day=")) >= begin:
            fs.delete(status.getPath(), True)
    fs.delete(staged, True)
    spark.catalog.refreshByPath(path)
    return begin


def align(frames: list[DataFrame]) -> DataFrame:
    """The union of frames with other columns or types: time over string over double over whole numbers, missing ones null."""
    kinds: dict[str, str] = {}
    for df in frames:
        for name, kind in df.dtypes:
            if name not in kinds or _RANK.get(kind, 0) > _RANK.get(kinds[name], 0):
                kinds[name] = kind
    out = None
    for df in frames:
        cast = df.select(*((F.col(n) if n in df.columns else F.lit(None)).cast(k).alias(n) for n, k in sorted(kinds.items())))
        out = cast if out is None else out.unionByName(cast)
    return out


def read_with_path(spark: SparkSession, path: str, pattern: str, names: list[str], kind: str = "parquet", **options) -> DataFrame:
    """Files of ``path`` with columns from the groups of ``pattern`` over each file's name; no match is null."""
    df = spark.read.format(kind).options(**options).load(path)
    return df.withColumns({n: F.nullif(F.regexp_extract(F.col("_metadata.file_path"), pattern, i), F.lit("")) for i, n in enumerate(names, 1)})
