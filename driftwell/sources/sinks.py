"""Where results go: files, views and indexes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwell.sources.incremental import align, exists


def write_csv(df: DataFrame, path: str, compress: bool = True) -> None:
    df.write.mode("overwrite").option("header", True).option("compression", "gzip" if compress else "none").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    df.write.mode("overwrite").partitionBy(*(by or [])).parquet(path)


def save_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def fan_out(df: DataFrame, path: str, label: str) -> None:
    """A folder of Parquet for each value of ``label``, in one pass."""
    df.write.mode("overwrite").partitionBy(label).parquet(path)


def write_stats(df: DataFrame, path: str) -> str:
    """A small table (of statistics) as one JSON text of a list of objects, also written to ``path``."""
    rows = [json.loads(x) for x in df.limit(10_001).toJSON().collect()]
    if len(rows) > 10_000:
        raise ValueError("statistics of more than 10,000 rows: write a table")
    text = json.dumps(rows, sort_keys=True)
    df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return text


def append_cache(df: DataFrame, path: str) -> DataFrame:
    """What is stored at ``path`` and ``df`` after it, with aligned columns; stored again and returned."""
    spark = df.sparkSession
    if not exists(spark, path):
        df.write.parquet(path)
        return spark.read.parquet(path)
    both = align([spark.read.parquet(path), df])
    stage = f"{path.rstrip('/')}.next"
    both.write.mode("overwrite").parquet(stage)
    spark.read.parquet(stage).write.mode("overwrite").parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(stage)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return spark.read.parquet(path)


def save_index(chunks: DataFrame, path: str, vector: str = "embedding") -> None:
    """Chunks with their vectors at length 1 (a zero vector stays zero), and how many there are beside them."""
    v = F.col(vector).cast("array<double>")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    chunks.withColumn(vector, F.transform(v, lambda x: F.coalesce(x / F.nullif(norm, F.lit(0.0)), F.lit(0.0)))).write.mode("overwrite").parquet(f"{path}/chunks")
    n = chunks.sparkSession.read.parquet(f"{path}/chunks").count()
    chunks.sparkSession.createDataFrame([(json.dumps({"chunks": n}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_index(spark: SparkSession, path: str) -> DataFrame:
    """A saved index; an error if its rows aren't as many as were saved."""
    df = spark.read.parquet(f"{path}/chunks")
    saved = json.loads(spark.read.text(f"{path}/meta", wholetext=True).first()[0])["chunks"]
    if df.count() != saved:
        raise ValueError(f"the index holds {df.count()} chunks of {saved}")
    return df
