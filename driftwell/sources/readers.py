"""Readers of files, folders and SQL text."""

from __future__ import annotations

import logging
import re
import uuid
from collections.abc import Iterable
from concurrent.futures import Future, ThreadPoolExecutor
from datetime import date
from numbers import Number

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftwell.functions.columns import row_filters
from driftwell.sources.incremental import align, read_only

log = logging.getLogger(__name__)
#: File name endings and the formats that they stand for.
FORMATS = {".parquet": "parquet", ".pq": "parquet", ".csv": "csv", ".csv.gz": "csv"}


def literal(value) -> str:
    """SQL text of a value: NULL, numbers, TRUE, dates, quoted strings, and lists of them in brackets."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, Number):
        return repr(value)
    if isinstance(value, date):
        return f"'{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, Iterable):
        return f"({', '.join(map(literal, value))})"
    raise TypeError(f"no literal for {type(value).__name__}")


def bound(sql: str, values: dict) -> str:
    """``sql`` with each ``{name}`` as its literal.  Where Spark runs the text, ``Catalog.query`` takes named parameters instead."""
    return re.sub(r"\{(\w+)\}", lambda m: literal(values[m[1]]), sql)


class Catalog:
    """Folders of tables as views, and reading queries over them, kept by their text if asked."""

    def __init__(self, spark: SparkSession):
        self.spark, self.kept, self.pool = spark, {}, ThreadPoolExecutor(4)

    def register(self, folder: str, names: list[str]) -> Catalog:
        for name in names:
            self.spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)
        return self

    def query(self, sql: str, params: dict | None = None, keep: bool = False, reload: bool = False) -> DataFrame:
        """The rows of a reading statement; ``:name`` in it is a named parameter.  ``keep`` caches them under the text and parameters."""
        read_only(sql)
        key = (sql, tuple(sorted((k, repr(v)) for k, v in (params or {}).items())))
        if key in self.kept:
            if not reload:
                return self.kept[key]
            self.kept.pop(key).unpersist()
        df = self.spark.sql(sql, args=params) if params else self.spark.sql(sql)
        if keep:
            self.kept[key] = df = df.cache()
        return df


    def submit(self, sql: str, params: dict | None = None) -> Future:
        """Start a reading statement; ``result()`` of what it gives waits for its rows, a cached table.
        It runs in a thread of its own, as a job group that ``stop`` can end."""
        df = self.query(sql, params)

        def run() -> DataFrame:
            self.spark.sparkContext.setJobGroup(name, sql[:80], True)
            out = df.cache()
            out.count()
            return out

        name = f"driftwell-{uuid.uuid4().hex}"
        future = self.pool.submit(run)
        future.job_group = name
        return future

    def stop(self, future: Future) -> None:
        future.cancel()
        self.spark.sparkContext.cancelJobGroup(future.job_group)


def format_of(path: str) -> str:
    for ending in sorted(FORMATS, key=len, reverse=True):
        if path.rstrip("/").endswith(ending):
            return FORMATS[ending]
    raise ValueError(f"no known format: {path}")


def read_one(spark: SparkSession, path: str, columns: list[str] | None = None, types: dict[str, str] | None = None) -> DataFrame:
    """A CSV (with header) or Parquet file or folder: its ``columns``, with ``types`` cast where they are there."""
    kind = format_of(path)
    df = spark.read.option("header", True).option("inferSchema", True).csv(path) if kind == "csv" else spark.read.parquet(path)
    if columns is not None:
        df = df.select(*columns)
    return df.withColumns({c: F.col(c).cast(t) for c, t in (types or {}).items() if c in df.columns})


def expand(spark: SparkSession, path: str) -> list[str]:
    """The data files below a folder or prefix, in order; a file stands for itself."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    if not fs.getFileStatus(where).isDirectory():
        return [path]
    files, out = fs.listFiles(where, True), []
    while files.hasNext():
        name = files.next().getPath().toString()
        if name.endswith(tuple(FORMATS)) and not name.rsplit("/", 1)[-1].startswith(("_", ".")):
            out.append(name)
    return sorted(out)


def read_many(spark: SparkSession, paths: list[str], columns: list[str] | None = None, filters: dict | None = None, types: dict[str, str] | None = None, source_col: str | None = None) -> DataFrame:
    """The union of files of any of the formats, with missing columns null and types widened.

    Folders are expanded.  A file that can't be read is left out with a warning;
    if none can, an error is raised.  ``filters`` as in ``row_filters``;
    ``source_col`` gets the file's name.
    """
    frames, wrong = [], []
    for path in dict.fromkeys(f for p in paths for f in (expand(spark, p) or [p])):
        try:
            df = read_one(spark, path)
        except Exception as e:  # noqa: BLE001 - one bad file of many
            log.warning("left out %s: %s", path, e)
            wrong.append(path)
            continue
        if source_col:
            df = df.withColumn(source_col, F.lit(path.rsplit("/", 1)[-1]))
        df = row_filters(df, filters or {})
        if columns is not None:
            df = df.select(*((F.col(c) if c in df.columns else F.lit(None).cast("string")).alias(c) for c in [*columns, *([source_col] if source_col else [])]))
        frames.append(df.withColumns({c: F.col(c).cast(t) for c, t in (types or {}).items() if c in df.columns}))
    if not frames:
        raise ValueError(f"none of the files can be read: {wrong or paths}")
    return align(frames)


def read_dataset(spark: SparkSession, root: str) -> DataFrame:
    """A partitioned Parquet folder; its partition folders become columns."""
    return spark.read.parquet(root)


def read_csv_sampled(spark: SparkSession, paths: list[str], columns: list[str], filters: dict | None = None, sample: int | float | None = None, seed: int = 0) -> DataFrame:
    """``columns`` of CSV files, filtered; of each file ``sample`` rows (a whole number) or that share of its rows, drawn by a seeded hash."""
    df = read_many(spark, paths, sorted({*columns, *(filters or {})}), filters, source_col="__file")
    if sample:
        w = Window.partitionBy("__file")
        turn = F.row_number().over(w.orderBy(F.xxhash64(F.lit(seed), F.monotonically_increasing_id())))
        most = F.floor(F.count("*").over(w) * F.lit(sample)) if isinstance(sample, float) else F.lit(sample)
        df = df.withColumn("__turn", turn).withColumn("__most", most).where(F.col("__turn") <= F.col("__most"))
    return df.select(*columns)


def read_headerless(spark: SparkSession, paths: list[str], names: list[str], keep: list[str]) -> DataFrame:
    return spark.read.csv(paths, header=False, inferSchema=True).toDF(*names).select(*keep)


def since(df: DataFrame, date_col: str, min_date: str) -> DataFrame:
    """Every row from ``min_date`` (yyyy-mm-dd) on; another form raises ValueError."""
    return df.where(F.col(date_col) >= F.lit(date.fromisoformat(min_date)))


def table_sample(df: DataFrame, percent: float, seed: int) -> DataFrame:
    """About ``percent`` of a hundred rows, the same for a seed and layout."""
    return df.sample(False, percent / 100, seed)
