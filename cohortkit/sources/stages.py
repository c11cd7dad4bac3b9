"""Runs of stage tables: written under a run id, published as a whole, resumed after a failure.

Layout under a root on shared storage::

    _runs/<run id>/<table>/    the tables of one run
    _open.json                 the run in progress and what it computes
    _current.json              the published run: table -> path, and the run before it

A run never touches the tables of another one: readers of the published tables
keep them while the next run writes, and also if it dies midway. A table counts
as written when Spark has put ``_SUCCESS`` beside its files. Manifests are small
files that replace their predecessor by one rename.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def _read_json(spark: SparkSession, path: str) -> dict | None:
    if not _exists(spark, path):
        return None
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _write_json(spark: SparkSession, path: str, value: dict) -> None:
    """Write beside and rename over: a reader sees the old or the new text, never a part."""
    jvm, beside = spark._jvm, f"{path}.{uuid.uuid4().hex}"
    out = _fs(spark, path).create(_path(spark, beside), True)
    try:
        out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), spark._jsc.hadoopConfiguration())
    qualified = [_fs(spark, path).makeQualified(_path(spark, p)) for p in (beside, path)]
    context.rename(*qualified, how)


def published(spark: SparkSession, root: str) -> dict[str, str]:
    """Table -> path of the published run; empty before the first one."""
    return (_read_json(spark, f"{root}/_current.json") or {}).get("tables", {})


class StageRun:
    """One run; see :func:`start_run`."""

    def __init__(self, spark: SparkSession, root: str, run_id: str) -> None:
        self.spark, self.root, self.run_id = spark, root, run_id
        self.tables: dict[str, str] = {}
        self.written: list[str] = []  # by this process, not by an earlier attempt

    def table(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table ``name`` of this run, read from storage. ``make`` is called
        only if no attempt has completed it; what a dead attempt left is replaced."""
        path = f"{self.root}/_runs/{self.run_id}/{name}"
        if not _exists(self.spark, f"{path}/_SUCCESS"):
            make().write.mode("overwrite").parquet(path)
            self.written.append(name)
        self.tables[name] = path
        return self.spark.read.parquet(path)

    def publish(self) -> dict[str, str]:
        """Make this run's tables the published ones, then remove runs older than the one before."""
        now = _read_json(self.spark, f"{self.root}/_current.json") or {}
        before = now.get("before") if now.get("run") == self.run_id else now.get("run")
        _write_json(self.spark, f"{self.root}/_current.json", {"run": self.run_id, "before": before, "tables": self.tables})
        open_ = f"{self.root}/_open.json"
        if (_read_json(self.spark, open_) or {}).get("run") == self.run_id:
            _fs(self.spark, open_).delete(_path(self.spark, open_), False)
        remove_stale_runs(self.spark, self.root)
        return dict(self.tables)


def start_run(spark: SparkSession, root: str, key: str, resume: bool = True) -> StageRun:
    """Begin a run that computes ``key`` (a text of its inputs and parameters),
    or go on with the open one if it computes the same and ``resume`` is set."""
    open_ = _read_json(spark, f"{root}/_open.json") or {}
    if resume and open_.get("key") == key:
        return StageRun(spark, root, open_["run"])
    run = StageRun(spark, root, uuid.uuid4().hex)
    _fs(spark, root).mkdirs(_path(spark, root))
    _write_json(spark, f"{root}/_open.json", {"run": run.run_id, "key": key})
    return run


def remove_stale_runs(spark: SparkSession, root: str) -> list[str]:
    """Delete runs that are neither published, nor the one before (it may still be read), nor open."""
    if not _exists(spark, f"{root}/_runs"):
        return []
    now, open_ = _read_json(spark, f"{root}/_current.json") or {}, _read_json(spark, f"{root}/_open.json") or {}
    keep, gone = {now.get("run"), now.get("before"), open_.get("run")}, []
    for status in _fs(spark, root).listStatus(_path(spark, f"{root}/_runs")):
        name = status.getPath().getName()
        if name not in keep:
            _fs(spark, root).delete(status.getPath(), True)
            gone.append(name)
    return gone
