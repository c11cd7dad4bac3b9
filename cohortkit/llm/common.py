"""Shared helpers: column picking, staged tables, connected components, Arrow maps."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_BATCH_CONF, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
#: Bytes of an Arrow batch on its way to a Python worker.
BATCH_BYTES = "8m"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _position(df: DataFrame, name: str) -> int:
    """Index of the column called ``name``; an exact match wins over one in another case."""
    found = [i for i, c in enumerate(df.columns) if c == name]
    found = found or [i for i, c in enumerate(df.columns) if c.lower() == name.lower()]
    if not found:
        raise ValueError(f"no column {name!r} among {df.columns}")
    return found[0]


def prepare_workers(spark: SparkSession) -> None:
    """Let Python workers of this session import the library from where the driver did, and
    bound what they hold at once (unless the session sets its own bound)."""
    if spark.conf.get(_BATCH_CONF) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_CONF, BATCH_BYTES)
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def by_position(df: DataFrame) -> DataFrame:
    """The frame with columns ``_0, _1, ...``, so that clashing names stay apart."""
    prepare_workers(df.sparkSession)
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; other columns, also of clashing names, are left out."""
    at = [_position(df, n) for n in names]
    return by_position(df).select(*[F.col(f"_{i}").alias(n) for i, n in zip(at, names, strict=True)])


def map_rows(df: DataFrame, text_col: str, each: Callable[[pa.RecordBatch, int], pa.RecordBatch]) -> DataFrame:
    """Arrow map that keeps the columns of ``df``; ``each`` gets a batch and the text column's index."""
    at, names, flat = _position(df, text_col), df.columns, by_position(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield each(batch, at)

    return flat.mapInArrow(run, flat.schema).toDF(*names)


def work_folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a local one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write the frame as Parquet under the shared folder and read it back (cuts lineage).

    A collection on the driver then lets Spark's cleaner delete the shuffle
    files that the written frame needed, instead of at some later time.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark).rstrip('/')}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def hash_pair(col: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes: together the key of a text."""
    return F.xxhash64(col), F.xxhash64(F.lit("second"), F.reverse(col))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Components of an undirected graph as (id, component), component the smallest id in it.

    Alternating large-star and small-star rounds until no edge changes. Every
    round is two grouped minima and joins; nodes without edges are not
    returned. Edges are staged each round, so a lost executor recomputes one
    round at most.
    """
    u, v = F.col("u"), F.col("v")
    now = staged(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    seen = _state(now)
    while seen[0]:
        both = now.unionByName(now.select(v.alias("u"), u.alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), u).alias("m"))
        large = both.join(low, "u").where("v > u").select(v.alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(v.alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        now = staged(small.where("u <> v").distinct(), "edges")
        state = _state(now)
        if state == seen:
            break
        seen = state
    return now.select(u.alias("id"), v.alias("component")).unionByName(now.select(v.alias("id"), v.alias("component")).distinct())


def _state(edges: DataFrame) -> tuple[int, int]:
    one = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % 1000003).alias("h"), F.sum(F.xxhash64("v", "u") % 998244353).alias("g")).first()
    return one["n"], one["h"], one["g"]
