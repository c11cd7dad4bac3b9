"""Event tables bucketed by person, for inputs that many joins and aggregates read.

``write_colocated`` writes a table once with its rows dealt to buckets by the
hash of ``person_id`` (one file a bucket). Spark then plans joins and
aggregates on ``person_id`` without shuffling that table again; only the
smaller side moves, into the same number of buckets. A bucket is read by one
task, which adaptive execution cannot split, so a table in which a sketch
finds a hot person (``operators.skew``) is written without buckets instead:
its joins go on shuffling, and spread that person.

``Colocated`` puts such tables in the place of an input set's event tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import HOT_ROWS, find_hot_keys
from .named import REQUIRED_COLUMNS, TableInputs
from .sinks import stage_root

EVENT_TABLES = ("visits", "condition_occurrence")
BUCKET_BYTES = 256 * 1024**2
# Lets a join on (person_id, day bin) meet inside buckets of person_id alone.
_CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def buckets_for(table_bytes: int, bucket_bytes: int = BUCKET_BYTES, least: int = 8) -> int:
    """Buckets of about ``bucket_bytes`` for the largest table of a set, a power
    of two so that sets of other sizes divide into each other."""
    wanted = max(least, -(-table_bytes // bucket_bytes))
    return 1 << (wanted - 1).bit_length()


def write_colocated(df: DataFrame, table: str, path: str, buckets: int, key: str = "person_id",
                    hot_rows: int = HOT_ROWS) -> bool:
    """Write ``df`` to ``path`` as the catalog table ``table``, bucketed by
    ``key`` unless a key is hot (``hot_rows`` rows and more than its share).
    Returns whether it is bucketed. Rows with a null key are kept, in one
    bucket, and therefore count as a hot key when they are as many."""
    nulls = df.where(F.col(key).isNull()).limit(hot_rows).count()
    hot = nulls >= hot_rows or bool(find_hot_keys(df, [key], hot_rows).hashes)
    if hot:
        df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(table)
        return False
    # the exchange deals rows exactly as the buckets do, so every task writes one file
    (df.repartition(buckets, F.col(key)).write.mode("overwrite").format("parquet").bucketBy(buckets, key)
     .option("path", path).saveAsTable(table))
    return True


class Colocated(TableInputs):
    """``inputs`` with its event tables read from bucketed copies; the other inputs are its own."""

    def __init__(self, inputs, tables: dict[str, str], bucketed: dict[str, bool]) -> None:
        self.tables, self.bucketed = dict(tables), dict(bucketed)
        where = f"{inputs.identity} with {sorted(self.tables.items())}"
        super().__init__(inputs.spark, lambda name: inputs.spark.table(tables[name]) if name in tables else getattr(inputs, name),
                         where=where)


def colocate(inputs, buckets: int, base: str | None = None, names: Sequence[str] = EVENT_TABLES,
             hot_rows: int = HOT_ROWS, database: str | None = None) -> Colocated:
    """Write the event tables of ``inputs`` co-located by person under the stage
    root (``base`` or ``spark.checkpoint.dir``) and return inputs that read them.

    Only the columns that operators read are written. Every call writes
    tables of its own, so inputs returned earlier stay readable.
    """
    spark, run = inputs.spark, uuid.uuid4().hex
    root = stage_root(spark, base)
    tables, bucketed = {}, {}
    for name in names:
        table = f"{database + '.' if database else ''}{name}_by_person_{run}"
        df = getattr(inputs, name).select(*REQUIRED_COLUMNS[name])
        bucketed[name] = write_colocated(df, table, f"{root}/{name}_by_person_{run}", buckets, hot_rows=hot_rows)
        tables[name] = table
    return Colocated(inputs, tables, bucketed)


@contextmanager
def joins_inside_buckets(spark: SparkSession) -> Iterator[None]:
    """For plans run inside: joins on person and day bin (cohorts too large to
    broadcast) also stay inside the buckets. Outside, such joins shuffle on
    both keys, which splits a person with very many rows by date; use this
    for bucketed tables, where ``write_colocated`` found no such person."""
    before = spark.conf.get(_CO_PARTITION)
    spark.conf.set(_CO_PARTITION, "false")
    try:
        yield
    finally:
        spark.conf.set(_CO_PARTITION, before)
