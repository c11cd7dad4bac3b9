"""Writing stage tables (one dataset per step, as the workbook does).

Stage tables go to shared storage: the folder the cluster names in
``spark.checkpoint.dir`` unless the caller gives one. Reading a written table
back cuts the lineage, so a lost executor recomputes from that table rather
than from the raw inputs, and several downstream tables reuse one
computation. ``sources.stages`` writes the tables of a whole run so that those
published before stay readable and a run that died is resumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir

STAGE_SUBDIR = "cohortkit_tables"


def stage_root(spark: SparkSession, base: str | None = None) -> str:
    """``base`` or ``<spark.checkpoint.dir>/cohortkit_tables``."""
    if base:
        return base.rstrip("/")
    root = checkpoint_dir(spark)
    if not root:
        raise ValueError("no output folder: pass one, or set spark.checkpoint.dir to a shared folder")
    return f"{root.rstrip('/')}/{STAGE_SUBDIR}"


def write_stage(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    fmt: str = "parquet",
) -> str:
    """Write ``df`` to ``path`` (overwrite by default, so a retried job
    replaces a partial earlier attempt) and return the path."""
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def materialize(spark: SparkSession, df: DataFrame, name: str, base: str | None = None) -> DataFrame:
    """Write ``df`` as table ``name`` under the stage root and read it back."""
    path = write_stage(df, f"{stage_root(spark, base)}/{name}")
    return spark.read.parquet(path)
